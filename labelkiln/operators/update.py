"""Key-based updates and set steps.

The reference updates frames in place by position; here every update is a join on the row key, so
the result does not depend on row order or partitioning.  Joins are left/semi/anti equi-joins on the
key: Spark shuffles both sides on the key, or broadcasts a side whose measured size is under the
broadcast threshold (AQE re-plans at run time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_labels(df: DataFrame, accepted: DataFrame, on: str = "id", label: str = "label",
                 new_label: str = "label", relevance: str | None = "relevance",
                 overwrite: bool = False) -> DataFrame:
    """Write accepted labels back by key and set relevance to 1 for those rows.

    ``accepted`` holds ``(on, new_label)``.  Existing labels win unless ``overwrite``; a labelled
    row is never changed by default.  Of several labels accepted for one key the smallest wins.
    """
    acc = accepted.groupBy(on).agg(F.min(new_label).alias("__acc"))
    j = df.join(acc, on, "left")
    lab = (F.coalesce(F.col("__acc"), F.col(label)) if overwrite
           else F.coalesce(F.col(label), F.col("__acc")))
    cols = []
    for c in df.columns:
        if c == label:
            cols.append(lab.alias(label))
        elif relevance and c == relevance:
            hit = F.col("__acc").isNotNull() & (F.lit(overwrite) | F.col(label).isNull())
            cols.append(F.when(hit, F.lit(1)).otherwise(F.col(relevance)).alias(relevance))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def fill_labels(df: DataFrame, suggestions: DataFrame, on: str = "id", label: str = "label",
                suggestion: str = "suggested_label") -> DataFrame:
    """C2 (Q13): fill only missing labels from a suggestion table (left join + coalesce).  Of several
    suggestions for one key the smallest wins."""
    s = suggestions.groupBy(on).agg(F.min(suggestion).alias("__s"))
    return (df.join(s, on, "left")
            .withColumn(label, F.coalesce(F.col(label), F.col("__s"))).drop("__s"))


def changed_rows(df: DataFrame, accepted: DataFrame, on: str = "id") -> DataFrame:
    """Rows of ``df`` that were changed (semi join)."""
    return df.join(accepted.select(on), on, "left_semi")


def remaining_pool(pool: DataFrame, taken: DataFrame, on: str = "id") -> DataFrame:
    """C4: remove newly labelled rows from the pool (anti join)."""
    return pool.join(taken.select(on), on, "left_anti")


def attach_predictions(df: DataFrame, preds: DataFrame, on: str = "id") -> DataFrame:
    """Align predictions with rows by key (never by position, Q4/Q5)."""
    return df.join(preds, on, "left")


def decode_labels(df: DataFrame, vocab: DataFrame, index_col: str = "label_id",
                  label: str = "label", out: str | None = None) -> DataFrame:
    """Class index -> label via the vocabulary table ``(label, label_id)``.  The vocabulary is
    bounded by the number of classes, so it is broadcast."""
    v = vocab.select(F.col(index_col).alias("__i"), F.col(label).alias(out or label))
    return (df.join(v, df[index_col] == v["__i"], "left").drop("__i"))


def append(a: DataFrame, b: DataFrame, allow_missing: bool = True) -> DataFrame:
    """rows of both, matched by column name."""
    return a.unionByName(b, allowMissingColumns=allow_missing)


def all_text(a: DataFrame, b: DataFrame, text: str = "text", id_col: str = "id") -> DataFrame:
    """text of labelled and pool rows together, to fit a vocabulary on."""
    return a.select(id_col, text).unionByName(b.select(id_col, text))


def union_vocab(a: DataFrame, b: DataFrame, col: str = "label") -> DataFrame:
    """distinct union of two label sets."""
    return a.select(col).union(b.select(col)).filter(F.col(col).isNotNull()).distinct()


def with_provenance(gold: DataFrame, weak: DataFrame, on: str = "id", label: str = "label",
                    weak_label: str = "weak_label", keep: Sequence[str] = ()) -> DataFrame:
    """Training set from gold and weak labels; gold wins; provenance says which one."""
    w = weak.select(on, F.col(weak_label).alias("__w"), *keep)
    g = gold.select(on, F.col(label).alias("__g"))
    j = w.join(g, on, "full")
    return j.select(on, *keep, F.coalesce("__g", "__w").alias(label),
                    F.when(F.col("__g").isNotNull(), "gold").when(F.col("__w").isNotNull(), "weak")
                    .alias("source")).filter(F.col(label).isNotNull())
