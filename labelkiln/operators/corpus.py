"""Subsets, guards and audit counts over a corpus.

Counts are single aggregates (partial aggregation on every partition, one tiny final step); nothing
collects rows to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labelkiln.functions import text as tx


def labelled(df: DataFrame, label: str = "label") -> DataFrame:
    """B1."""
    return df.filter(F.col(label).isNotNull())


def unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    """B2."""
    return df.filter(F.col(label).isNull())


def accept(df: DataFrame, score: str = "score", threshold: float = 0.5, strict: bool = False) -> DataFrame:
    """Keep rows whose confidence passes the threshold (inclusive by default, Q1)."""
    c = F.col(score)
    return df.filter(c > threshold if strict else c >= threshold)


def accept_by_class(df: DataFrame, thresholds: DataFrame | Mapping[str, float], label: str = "label",
                    score: str = "score", default: float | None = None, strict: bool = False) -> DataFrame:
    """Per-class thresholds.  A mapping becomes a literal map (one entry per class, bounded by the
    vocabulary); a DataFrame ``(label, threshold)`` is joined with a broadcast of the small side."""
    if isinstance(thresholds, Mapping):
        m = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
        t = F.element_at(m, F.col(label))
    else:
        df = df.join(thresholds.withColumnRenamed(thresholds.columns[1], "__t"), label, "left")
        t = F.col("__t")
    if default is not None:
        t = F.coalesce(t, F.lit(float(default)))
    out = df.filter(F.col(score) > t if strict else F.col(score) >= t)
    return out.drop("__t") if "__t" in out.columns else out


def min_words(df: DataFrame, n: int = 3, text: str = "text", mode: str = "ascii",
              cleaned: str = "text_cleaned", count_col: str = "word_count") -> DataFrame:
    """B5 (+G1, G2): clean the text, count words, keep rows with at least ``n`` words."""
    # a filter on the count would clean every text a second time, as it runs before the columns are made
    few = 1 <= n <= 64
    out = df.filter(tx.has_words(text, n, mode)) if few else df
    out = out.withColumn(cleaned, tx.clean_text(text, mode))
    out = out.withColumn(count_col, tx.word_count(cleaned))
    return out if few else out.filter(F.col(count_col) >= n)


def ignored_count(df: DataFrame, n: int = 3, text: str = "text", mode: str = "ascii") -> DataFrame:
    """Number of rows dropped by :func:`min_words`."""
    wc = tx.word_count(tx.clean_text(text, mode))
    return df.agg(F.count_if(wc < n).cast("bigint").alias("ignored"), F.count("*").cast("bigint").alias("rows"))


def rare_classes(df: DataFrame, label: str = "label", target: int = 100) -> DataFrame:
    """Classes with fewer than ``target`` rows."""
    return value_counts(df, label).filter(F.col("count") < target)


def check_labelled(df: DataFrame, label: str = "label", minimum: int = 10) -> bool:
    """B10 guard: at least ``minimum`` labelled rows.  Reads no more than ``minimum`` rows."""
    return labelled(df, label).limit(minimum).count() >= minimum


def nothing_to_label(df: DataFrame, label: str = "label") -> bool:
    """B10 guard: True when there is no unlabelled row (stops at the first one found)."""
    return unlabelled(df, label).isEmpty()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value; NULL values are not counted (as pandas does)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count("*").cast("bigint").alias("count")))


def class_share(df: DataFrame, col: str) -> DataFrame:
    """Share of each value.  The total is a scalar subquery over the small count table (no
    global window, no join)."""
    vc = value_counts(df, col)
    tot = vc.agg(F.sum("count")).scalar()
    return vc.select(col, "count", (F.col("count") / tot).alias("share"))


def label_vocab(df: DataFrame, col: str = "label", is_array: bool = False) -> DataFrame:
    """D3: distinct labels (flattened when the column is a list), with 0-based ids in sorted order.

    The distinct set is bounded by the vocabulary; ids are ranks over that small table.
    """
    src = df.select(F.explode(col).alias(col)) if is_array else df.select(col)
    voc = src.filter(F.col(col).isNotNull()).distinct()
    from pyspark.sql.window import Window
    return voc.select(col, (F.row_number().over(Window.orderBy(col)) - 1).alias("label_id"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"{c}_nulls") for c in cols])


def flip_count(before: DataFrame, accepted: DataFrame, relevance: str = "relevance",
               id_col: str = "id") -> DataFrame:
    """Accepted rows that had relevance 0 before (semi join on the key)."""
    return (before.join(accepted.select(id_col), id_col, "left_semi")
            .agg(F.count_if(F.col(relevance) == 0).cast("bigint").alias("flipped")))


def snapshot(df: DataFrame, stage: str, label: str = "label", relevance: str = "relevance") -> DataFrame:
    """D17 half: one aggregate row of counts for a snapshot of the corpus."""
    return df.agg(F.lit(stage).alias("stage"),
                  F.count("*").cast("bigint").alias("rows"),
                  F.count_if(F.col(label).isNull()).cast("bigint").alias("label_nulls"),
                  F.count_if(F.col(relevance) == 1).cast("bigint").alias("relevant"))


def audit(before: DataFrame, after: DataFrame, label: str = "label", new_label: str | None = None,
          relevance: str = "relevance", id_col: str = "id") -> DataFrame:
    """Run audit as a metrics table ``(metric, value)``: initial nulls, assigned, flipped, final
    nulls.  ``after`` must carry the before-relevance as ``relevance_before`` or be joinable on the key;
    here it is computed in one pass over ``after`` joined to ``before`` on the key."""
    nl = new_label or label
    j = (after.select(id_col, F.col(nl).alias("__new"), F.col(relevance).alias("__rel_after"))
         .join(before.select(id_col, F.col(label).alias("__old"), F.col(relevance).alias("__rel_before")),
               id_col, "inner"))
    one = j.agg(
        F.count_if(F.col("__old").isNull()).cast("bigint").alias("initial_nulls"),
        F.count_if(F.col("__old").isNull() & F.col("__new").isNotNull()).cast("bigint").alias("assigned"),
        F.count_if((F.col("__rel_before") == 0) & (F.col("__rel_after") == 1)).cast("bigint").alias("flipped"),
        F.count_if(F.col("__new").isNull()).cast("bigint").alias("final_nulls"),
    )
    return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                         for m in ("initial_nulls", "assigned", "flipped", "final_nulls")])))


AUDIT = ("initial_nulls", "assigned", "flipped", "final_nulls")


def audit_metrics(label: str = "label", new_label: str = "weak_label", before: str = "relevance_before",
                  after: str = "relevance") -> list[Column]:
    """D17 as aggregates over one table that carries both states: to be observed while the rows pass."""
    old, new = F.col(label), F.col(new_label)
    return [F.count_if(old.isNull()).cast("bigint").alias("initial_nulls"),
            F.count_if(old.isNull() & new.isNotNull()).cast("bigint").alias("assigned"),
            F.count_if((F.col(before) == 0) & (F.col(after) == 1)).cast("bigint").alias("flipped"),
            F.count_if(new.isNull()).cast("bigint").alias("final_nulls")]


def audited_write(df: DataFrame, path: str, label: str = "label", new_label: str = "weak_label",
                  before: str = "relevance_before", after: str = "relevance", fmt: str = "parquet") -> DataFrame:
    """Write ``df`` and return ``(metric, value)`` as counted by the write itself: no second pass, no join."""
    seen = Observation(f"audit-{uuid.uuid4().hex[:8]}")
    df.observe(seen, *audit_metrics(label, new_label, before, after)).write.format(fmt).save(path)
    got = seen.get
    return df.sparkSession.createDataFrame([(m, got[m]) for m in AUDIT], "metric string, value bigint")


def vector_checks(df: DataFrame, vec: str = "embedding", dim: int = 64, id_col: str = "id") -> DataFrame:
    """One aggregate row: rows, NULL vectors, wrong length, vectors holding NaN, zero vectors."""
    v = F.col(vec)
    has_nan = F.exists(v, lambda x: F.isnan(x))
    zero = F.forall(v, lambda x: x == 0)
    return df.agg(F.count("*").cast("bigint").alias("rows"),
                  F.count_if(v.isNull()).cast("bigint").alias("null_vectors"),
                  F.count_if(v.isNotNull() & (F.size(v) != dim)).cast("bigint").alias("wrong_length"),
                  F.count_if(v.isNotNull() & has_nan).cast("bigint").alias("with_nan"),
                  F.count_if(v.isNotNull() & zero).cast("bigint").alias("zero_vectors"))


def bad_vectors(df: DataFrame, vec: str = "embedding", dim: int = 64, text: str | None = None) -> DataFrame:
    """The offending rows themselves (with their text when given), for inspection."""
    v = F.col(vec)
    reason = (F.when(v.isNull(), "null").when(F.size(v) != dim, "wrong_length")
              .when(F.exists(v, lambda x: F.isnan(x)), "nan"))
    return df.withColumn("problem", reason).filter(F.col("problem").isNotNull())


def normalize_flag(c: str | Column) -> Column:
    """A5 helper: any truthy spelling of a 0/1 flag to int."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string").try_cast("int"), F.lit(0))
