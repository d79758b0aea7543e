"""Mixing sources to target weights.

Words are summed per source (a partial aggregate per task, so a source that holds a third of all rows
is no bottleneck), targets and repetition rates are derived on the table of sources, and every document
is emitted ``floor(rate)`` times plus once more if a hash of its id, its text and the seed falls below the
fraction.  No exchange of documents by source is needed: the rates go to the rows.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share ``share`` times
all words; a target stops at ``limit`` times its source's words and the excess goes to the others by
weight until none is above.  That level is found exactly from one pass over the sources in order of
``limit * words / weight``.

Defined results: null text has 0 words and is emitted by the same rule; a source without words has
target 0 and rate 0; the empty table gives the empty table.  Null ids draw as the text ``null``; rows
that repeat an id draw by their texts, and rows equal in both draw alike.  The source table (one row per source name) is the only thing that is ever
in one task or sent to all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import null_text, stored, word_count

WEIGHTS, SHARE, LIMIT, SEED = (5, 2, 1), 1.5, 2.0, "mix-1"


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from 32 bits of an md5 of the id, the md5 of the text and the seed."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(null_text(text).cast("binary")),
                   F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``source, source_size`` -> with ``target``.  Windows over the table of sources only."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]),
                   F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    s = sizes.withColumn("weight", weight).withColumn("top", F.col("source_size") * F.lit(float(limit)))
    fill = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    # what a unit of weight gets if all sources before this one stop at their top
    level = (total - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") < F.col("top"))
    water = F.min(F.when(F.col("fits"), F.struct(F.col("top") / F.col("weight"), F.col("source").isNull(),
                                                 F.col("source"), F.col("level").alias("level")))).over(everything)
    return s.withColumn("water", water["level"]).select(
        "source", "source_size",
        F.when(F.col("water").isNull() | (F.col("water") * F.col("weight") >= F.col("top")), F.col("top"))
        .otherwise(F.col("water") * F.col("weight")).alias("target"))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               seed: str = SEED) -> DataFrame:
    """``docs`` with ``_lk_size, _lk_source_size, _lk_target, _lk_copies``."""
    sized = docs.withColumn("_lk_size", word_count(F.col(text_col)))
    per_source = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("_lk_size").alias("source_size"))
    # written first: its size is then known, and Spark broadcasts it if it is small
    rates = stored(targets(per_source).select(
        F.col("source").alias("_lk_source"), F.col("source_size").alias("_lk_source_size"),
        F.col("target").alias("_lk_target")), "rates")
    rate = F.when(F.col("_lk_source_size") > 0, F.col("_lk_target") / F.col("_lk_source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(F.col(id_col), F.col(text_col), seed) < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))
    return (sized.join(rates, sized[source_col].eqNullSafe(rates["_lk_source"])).drop("_lk_source")
            .withColumn("_lk_copies", copies.cast("int")))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: each document as many times as the mix takes it, with the columns of ``docs``."""
    c = mix_counts(docs, id_col, source_col, text_col).filter("_lk_copies > 0")
    return c.withColumn("_lk_copy", F.explode(F.sequence(F.lit(1), F.col("_lk_copies")))).select(*docs.columns)


def mix_report(docs: DataFrame) -> DataFrame:
    """The digest columns of ``op9``."""
    return mix_counts(docs.select("doc_id", "source", "text")).select(
        "doc_id", F.col("_lk_size").alias("size"), F.col("_lk_source_size").alias("source_size"),
        F.col("_lk_target").alias("target"), (F.col("_lk_size") * F.col("_lk_copies")).alias("taken"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS top,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
      WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
      - coalesce(sum(top) OVER (ORDER BY top / weight, source IS NULL, source
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY top / weight, source IS NULL, source
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
water AS (
  SELECT level FROM l WHERE level * weight < top ORDER BY top / weight, source IS NULL, source LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN (SELECT level FROM water) * weight < top
    THEN (SELECT level FROM water) * weight ELSE top END AS target
  FROM l),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST(('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || h || ':mix-1'), 1, 8)) AS BIGINT)
      / 4294967296.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM r
"""
