"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

A normalised text is cut where its content says so (a lower-case letter followed by punctuation, a
digit or a capital, after at least 512 characters; at 4,096 at the latest), so equal stretches of
text give equal chunks.  Distinct chunks are gathered once, byte for byte, in the chunk store; a
chunk's identifier is its 64-bit hash, *verified* there: where two different chunks share a hash,
each also gets its rank among them.  A document is then its recipe, the ordered list of identifiers,
and only recipes (8 bytes a chunk) are compared and moved; the text of a long document is never
shuffled as a whole, and copies of a chunk are merged before the exchange.

Groups of copies may be large: they are first merged per (recipe, salt), and decisions go back to the
rows through the same salted cells, so no task gets a whole group.

Defined results: null text counts as empty, and texts without any other than white space are equal to
each other.  Of equal texts the row with the most code points stays, then the smallest id (null ids
last); of rows that repeat the staying id exactly one is kept.  Other columns are ignored here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import null_text, partitions, stored

#: The characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
CHUNK = r"(?s).{510,4094}?[a-z][.,;:!?0-9A-Z]|.{1,4096}"


def normalised(text: Column) -> Column:
    out = null_text(text)
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def _row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), sha)


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``doc_id, n, text_sha256, recipe, ranks``: two rows have equal ``(recipe, ranks)`` exactly when
    their normalised texts are equal.  ``ranks`` is empty unless chunks of the text share a hash with
    other chunks."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n"),
        normalised(F.col("text")).alias("norm"))
    cut = base.select("doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                      F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk"))
    cut = cut.withColumn("h", chunk_hash(F.col("chunk")))
    store = cut.groupBy("h", "chunk").agg(F.lit(1).alias("one")).drop("one")
    shared = stored(store.groupBy("h").agg(F.count("*").alias("chunks")).filter("chunks > 1").select("h"),
                    "shared-hashes")
    plain = base.select(
        "doc_id", "n", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks(F.col("norm")), lambda c: chunk_hash(c)).alias("recipe"))
    none = F.array().cast("array<struct<pos:int,rank:int>>")
    if shared.isEmpty():  # every identifier is verified as it is
        return plain.withColumn("ranks", none)
    by_chunk = Window.partitionBy("h").orderBy("chunk")
    ranked = store.join(shared, "h", "left_semi").withColumn("rank", F.row_number().over(by_chunk))
    patch = (cut.join(ranked, ["h", "chunk"])
             .groupBy(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("_rk"))
             .agg(F.array_sort(F.collect_set(F.struct("pos", "rank"))).alias("ranks")))
    return (plain.withColumn("_rk", _row_key(F.col("doc_id"), F.col("text_sha256")))
            .join(patch, "_rk", "left").drop("_rk").withColumn("ranks", F.coalesce("ranks", none)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    spark = docs.sparkSession
    # a number of its own for every row, kept with it: equal rows and rows without ids spread over the salts too
    rec = stored(recipes(docs, id_col, text_col, chunk_hash).withColumn("row", F.monotonically_increasing_id()), "recipes")
    rec = rec.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(partitions(spark))).cast("int"))
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row")
    cells = rec.groupBy("recipe", "ranks", "salt").agg(F.count("*").alias("rows"), F.min(order).alias("best"))
    groups = cells.groupBy("recipe", "ranks").agg(F.sum("rows").alias("group_size"), F.min("best").alias("first"))
    decided = cells.select("recipe", "ranks", "salt").join(groups, ["recipe", "ranks"])
    return (rec.join(decided, ["recipe", "ranks", "salt"])
            .select("doc_id", F.col("first.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and one row of each group of equal texts."""
    keep = exact_groups(docs, id_col, text_col).filter("kept").select(
        _row_key(F.col("doc_id"), F.col("text_sha256")).alias("_lk_row"))
    keyed = docs.withColumn("_lk_row", _row_key(F.col(id_col), F.sha2(normalised(F.col(text_col)).cast("binary"), 256)))
    return keyed.join(keep, "_lk_row", "left_semi").dropDuplicates(["_lk_row"]).drop("_lk_row")
