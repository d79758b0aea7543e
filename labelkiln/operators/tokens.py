"""Token lookups under a Zipf distribution.

A join on raw tokens sends every occurrence of a word to one task, and the commonest words are a few per cent of all
tokens each.  So the ``HEAD`` most frequent tokens are looked up in a table of their own, which has ``HEAD`` rows at
most whatever the corpus and goes to all tasks; only the rest, of which no token is frequent, is joined by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkiln.session import cut_lineage

HEAD = 1024


def frequent(tokens: DataFrame, token: str = "token", head: int = HEAD) -> DataFrame:
    """The ``head`` most frequent tokens (partial counts per task, then a top-n; equal: the smaller token)."""
    counts = tokens.groupBy(token).agg(F.count("*").alias("__n")).filter(F.col(token).isNotNull())
    return cut_lineage(counts.orderBy(F.col("__n").desc(), token).limit(head).select(token))


def looked_up(rows: DataFrame, table: DataFrame, token: str, head: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``table`` (one row per token) on ``token``; ``head``: the frequent tokens."""
    known = head.join(table, token, "left").withColumn("__head", F.lit(True))
    near = rows.join(F.broadcast(known), token, "left")  # as many rows as the head has
    rest = near.filter("__head IS NULL").select(*rows.columns).join(table.join(head, token, "left_anti"), token, "left")
    return near.filter("__head").drop("__head").unionByName(rest)
