"""Ranking, ordering and splitting (E1-E8) plus the two skew-safe ranking tools the rest builds on.

``rank_within``: exact 0-based position of each row inside its group in a seeded hash order, without
putting a whole group into one task: rows are first ranked inside (group, hash-prefix bucket), then
shifted by the bucket's offset, taken from a small per-(group, bucket) count table.  Ordering by
(bucket, hash) equals ordering by hash because the bucket IS the hash prefix, so the result equals
``row_number() OVER (PARTITION BY group ORDER BY hash) - 1``.

``global_rank`` / ``running_totals``: exact global order statistics without a single-partition
window: a range-partitioned sort, per-partition totals (one row per partition), offsets, then a
window inside each sorted partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelkiln.session import cut_lineage


def hash_order(id_col: str | Column, seed: int | str = 42) -> Column:
    """Seeded, engine-independent "random" order key: ``md5('<id>:<seed>')`` (same in DuckDB)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def hash_order_sql(id_expr: str, seed: int | str = 42) -> str:
    return f"md5(concat(CAST({id_expr} AS VARCHAR), ':{seed}'))"


def hash_unit(*parts: str | Column, seed: int | str = 42) -> Column:
    """A seeded number in [0, 1) from md5 of the parts (first 8 hex digits / 2^32)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    s = F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / 4294967296.0


def hash_unit_sql(*parts: str, seed: int | str = 42) -> str:
    s = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + f" || ':{seed}'"
    return f"(('0x' || substr(md5({s}), 1, 8))::BIGINT / 4294967296.0)"


def rank_within(df: DataFrame, keys: Sequence[str], order_key: Column, out: str = "pos",
                prefix_digits: int = 3, size_col: str | None = None) -> DataFrame:
    """Exact 0-based rank of each row inside ``keys`` ordered by ``order_key`` (an md5 hex string from
    :func:`hash_order`).  Hot groups are split into ``16**prefix_digits`` hash-prefix buckets.
    With ``size_col`` the group size is added too, taken from the same small bucket-count table (no
    extra pass over the input)."""
    keys = list(keys)
    d = df.withColumn("__h", order_key).withColumn("__b", F.substring("__h", 1, prefix_digits))
    inner = Window.partitionBy(*keys, "__b").orderBy("__h")
    d = d.withColumn("__r", F.row_number().over(inner) - 1)
    counts = d.groupBy(*keys, "__b").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("__n").over(Window.partitionBy(*keys)).cast("bigint").alias(size_col)] if size_col else []
    offs = counts.select(*keys, "__b", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"), *extra)
    # null-safe, so rows whose group key is NULL are a group like any other
    offs = offs.withColumnsRenamed({c: f"__k{i}" for i, c in enumerate([*keys, "__b"])})
    same = F.lit(True)
    for i, c in enumerate([*keys, "__b"]):
        same = same & d[c].eqNullSafe(offs[f"__k{i}"])
    return (d.join(offs, same, "inner")
            .withColumn(out, (F.col("__off") + F.col("__r")).cast("bigint"))
            .drop("__h", "__b", "__r", "__off", *[f"__k{i}" for i in range(len(keys) + 1)]))


def group_sizes(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").cast("bigint").alias(out))


def _sorted_with_partition(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partitioned sort, tagged with partition id and in-partition index, checkpointed so the
    non-deterministic tags are computed exactly once."""
    s = df.orderBy(*order).withColumn("__pid", F.spark_partition_id())
    s = s.withColumn("__mid", F.monotonically_increasing_id())
    return cut_lineage(s)


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Exact 1-based global rank in ``order`` (ties must be broken by the caller, e.g. by id)."""
    s = _sorted_with_partition(df, order)
    sizes = s.groupBy("__pid").agg(F.count("*").alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    first = s.groupBy("__pid").agg(F.min("__mid").alias("__m0"))
    return (s.join(F.broadcast(offs.join(first, "__pid")), "__pid")  # one row per partition
            .withColumn(out, (F.col("__off") + F.col("__mid") - F.col("__m0") + 1).cast("bigint"))
            .drop("__pid", "__mid", "__off", "__m0"))


def running_totals(df: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Exact running sums of ``sums`` in ``order`` (inclusive), as ``cum_<col>``."""
    s = _sorted_with_partition(df, order)
    part = s.groupBy("__pid").agg(*[F.sum(c).alias(f"__p_{c}") for c in sums])
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = part.select("__pid", *[F.coalesce(F.sum(f"__p_{c}").over(w), F.lit(0)).alias(f"__o_{c}")
                                  for c in sums])
    inner = Window.partitionBy("__pid").orderBy("__mid").rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(F.broadcast(offs), "__pid")  # one row per partition
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"__o_{c}") + F.sum(c).over(inner))
    return out.drop("__pid", "__mid", *[f"__o_{c}" for c in sums])


# ---------------------------------------------------------------------------------------------
# E1-E8


def query_batch(scored: DataFrame, n: int, score: str = "uncertainty", id_col: str = "id",
                most_uncertain_first: bool = True) -> DataFrame:
    """The ``n`` rows to send to the expert (top-n by uncertainty, ties by id).  Plans as
    TakeOrderedAndProject: a per-partition top-n, then a merge of n rows per partition."""
    o = F.col(score).desc() if most_uncertain_first else F.col(score).asc()
    return scored.orderBy(o, F.col(id_col)).limit(n)


def best_class(df: DataFrame, probs: str = "probs", labels: Sequence[str] | Column | None = None,
               out_label: str = "pred", out_score: str = "confidence") -> DataFrame:
    """Best class (first maximum, Q2) and its probability per row."""
    p = F.col(probs).cast("array<double>")
    mx = F.array_max(p)
    idx = F.array_position(p, mx) - 1
    if labels is None:
        lab = idx.cast("int")
    else:
        arr = F.array(*[F.lit(x) for x in labels]) if not isinstance(labels, Column) else labels
        lab = F.get(arr, idx.cast("int"))
    return df.withColumn(out_label, lab).withColumn(out_score, mx)


def top_fraction(scored: DataFrame, fraction: float = 0.1, score: str = "confidence",
                 id_col: str = "id") -> DataFrame:
    """The surest ``ceil(fraction * n)`` rows (ties by id), exact and distributed."""
    r = global_rank(scored, [F.col(score).desc(), F.col(id_col).asc()], out="__rank")
    n = scored.agg(F.count("*")).scalar()
    return r.filter(F.col("__rank") <= F.ceil(n * F.lit(fraction))).drop("__rank")


def stratified_split(df: DataFrame, label: str = "label", frac: float = 0.2, seed: int = 42,
                     id_col: str = "id", out: str = "split") -> DataFrame:
    """E5: exact stratified split: the first ``round(frac * n_label)`` rows of each class in seeded
    hash order are ``test``, the rest ``train``.  Skew-safe (see :func:`rank_within`)."""
    r = rank_within(df, [label], hash_order(id_col, seed), out="__pos", size_col="__n")
    return (r.withColumn(out, F.when(F.col("__pos") < F.round(F.col("__n") * frac), "test").otherwise("train"))
            .drop("__pos", "__n"))


def threshold_for_recall(scored: DataFrame, target: float = 0.98, score: str = "score",
                         gold: str = "gold") -> DataFrame:
    """The highest score threshold whose recall (score >= t) reaches ``target``, with the
    precision there.  Rows are pre-aggregated per distinct score before the ordered pass."""
    per = scored.groupBy(score).agg(F.sum(F.col(gold).cast("long")).alias("pos"),
                                    F.count("*").alias("tot"))
    run = running_totals(per, [F.col(score).desc()], ["pos", "tot"])
    total_pos = per.agg(F.sum("pos")).scalar()
    ok = run.filter(F.col("cum_pos") >= F.lit(target) * total_pos)
    best = ok.orderBy(F.col(score).desc()).limit(1)
    return best.select(F.col(score).alias("threshold"),
                       (F.col("cum_pos") / total_pos).alias("recall"),
                       (F.col("cum_pos") / F.col("cum_tot")).alias("precision"),
                       F.col("cum_tot").cast("bigint").alias("selected"))


def preview(df: DataFrame, n: int = 5, id_col: str = "id") -> DataFrame:
    """First rows in key order."""
    return df.orderBy(id_col).limit(n)


def route(scored: DataFrame, hi: float, n: int, score: str = "confidence", id_col: str = "id") -> DataFrame:
    """Hybrid routing over one scored table: rows with confidence >= ``hi`` are pseudo-labelled,
    the ``n`` least sure rows (ties by id) go to the expert."""
    pseudo = scored.filter(F.col(score) >= hi).select(id_col, F.lit("pseudo").alias("route"))
    expert = (scored.orderBy(F.col(score).asc(), F.col(id_col)).limit(n)
              .filter(F.col(score) < hi).select(id_col, F.lit("expert").alias("route")))
    return pseudo.unionByName(expert)
