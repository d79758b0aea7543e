"""Sharding by histogram sort: near-equal bytes per shard, one exchange of the rows.

Rows are ordered by (64-bit hash of the text, id, number of the row in the scan), so equal texts lie side by side and a
group of copies of any size, equal rows too, can still be split.  ``docs`` is read twice and has to give its rows in
the same partitions and order both times, as a scan of files does.  Splitters are found without moving a row: in
each round the bytes and rows between candidate boundaries (probes) are counted exactly across all
partitions, probes inside the intervals that still miss a target are refined between the smallest and
largest key found there, and the round ends when every splitter is within tolerance or no key is left
between its neighbours.  Keys are 192 bits and each round cuts an interval 16-fold between keys that
occur, so at most 48 rounds are needed; a few are usual.

Besides the shard splitters the same rounds place finer ones (by bytes and rows alike), so that the
single exchange deals every shard out over many tasks; exact counts of the pieces give each row its
place in its shard without a window over a whole shard.

Law ``bytes``: sizes near equal; the size of a row is the bytes of its text (null: none) plus 1.
Defined results: null ids sort first; rows equal in id and text may be parted; the empty table gives the empty table.  Other columns go along unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import LOWEST, null_text, partitions, stored
from labelkiln.session import ship_package

TOLERANCE = 0.0005
_FANOUT = 16
_WIDTH = 24
_TOP = (1 << 8 * _WIDTH) - 1


def pack_keys(*parts: np.ndarray) -> np.ndarray:
    """(hash, id, row) of signed longs as 24-byte strings that sort alike."""
    flip = np.uint64(1 << 63)
    out = np.stack([(np.asarray(p, dtype=np.int64).view(np.uint64) ^ flip).astype(">u8") for p in parts], axis=1)
    return np.ascontiguousarray(out).view(f"S{_WIDTH}").ravel()


def _bytes(key: int) -> bytes:
    return key.to_bytes(_WIDTH, "big")


def count_between(keys: DataFrame, probes: list[int]) -> list[tuple]:
    """``(interval, bytes, rows, min key, max key)``; interval i holds keys with ``probe[i-1] < key <=
    probe[i]``.  One row per task and interval is exchanged; the driver gets one per interval."""
    at = np.array([_bytes(p) for p in probes], dtype=f"S{_WIDTH}")

    def count(batches):
        m = len(at) + 1
        size, rows = np.zeros(m, np.int64), np.zeros(m, np.int64)
        low, high = [None] * m, [None] * m
        for b in batches:
            k = pack_keys(b["h"].to_numpy(), b["d"].to_numpy(), b["r"].to_numpy())
            order = np.argsort(k, kind="stable")
            k, s = k[order], b["size"].to_numpy()[order]
            i = np.searchsorted(at, k, side="left")
            np.add.at(size, i, s)
            rows += np.bincount(i, minlength=m)
            first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
            for a, z in zip(first, [*first[1:], len(i)], strict=True):
                lo, hi, j = bytes(k[a]).ljust(_WIDTH, b"\0"), bytes(k[z - 1]).ljust(_WIDTH, b"\0"), int(i[a])
                low[j] = lo if low[j] is None else min(low[j], lo)
                high[j] = hi if high[j] is None else max(high[j], hi)
        hit = np.flatnonzero(rows)
        yield pd.DataFrame({"i": hit, "size": size[hit], "rows": rows[hit],
                            "lo": [low[j] for j in hit], "hi": [high[j] for j in hit]})

    found = keys.mapInPandas(count, "i long, size long, rows long, lo binary, hi binary")
    return [(r[0], r[1], r[2], int.from_bytes(r[3], "big"), int.from_bytes(r[4], "big")) for r in found.groupBy("i").agg(
        F.sum("size"), F.sum("rows"), F.min("lo"), F.max("hi")).collect()]


def find_splitters(keys: DataFrame, shards: int, pieces: int, tolerance: float = TOLERANCE,
                   ) -> tuple[list[int], list[int], list[int]]:
    """Ascending boundaries of the pieces, the rows of each piece, and the shard of each piece."""
    probes = sorted({int((i + 1) * (_TOP + 1) // (2 * pieces)) - 1 for i in range(2 * pieces)})
    while True:
        cells = {i: (s, r, lo, hi) for i, s, r, lo, hi in count_between(keys, probes)}
        size = np.array([cells.get(i, (0, 0))[0] for i in range(len(probes) + 1)], dtype=np.int64)
        rows = np.array([cells.get(i, (0, 0))[1] for i in range(len(probes) + 1)], dtype=np.int64)
        below, count = np.cumsum(size), np.cumsum(rows)
        total, n = int(below[-1]), int(count[-1])
        if not n:
            return [], [], [0]
        load = below / total + count / n
        goals = [(below, total * j / shards, tolerance * total / shards) for j in range(1, shards)]
        goals += [(load, 2 * j / pieces, 0.5 / pieces) for j in range(1, pieces)]
        chosen, more = [], set()
        for k, (measure, goal, near) in enumerate(goals):
            i = int(np.searchsorted(measure, goal))  # the goal lies in interval i
            around = [j for j in (i - 1, i) if 0 <= j < len(probes)]
            best = min(around, key=lambda j: abs(measure[j] - goal))
            if abs(measure[best] - goal) > near and i in cells and cells[i][2] < cells[i][3]:
                lo, hi = cells[i][2], cells[i][3]
                step = max(1, (hi - lo) // _FANOUT)
                more |= set(range(lo, hi, step)) - set(probes)
            chosen.append((probes[best], k < shards - 1))
        if not more:
            break
        # boundaries found stay, the rest of the probes go: the list stays short
        probes = sorted({p for p, _ in chosen} | {probes[j] for j in _neighbours(goals, probes)} | more)
    ends = [p for p, of_shard in chosen if of_shard]
    cuts = sorted({p for p, _ in chosen})
    at = {p: j for j, p in enumerate(probes)}
    upto = [int(count[at[p]]) for p in cuts] + [n]
    return cuts, list(np.diff([0, *upto]).astype(int)), [sum(e <= p for e in ends) for p in [-1, *cuts]]


def _neighbours(goals, probes: list[int]) -> set[int]:
    out = set()
    for measure, goal, _ in goals:
        i = int(np.searchsorted(measure, goal))
        out |= {j for j in (i - 1, i) if 0 <= j < len(probes)}
    return out


def histogram_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``_lk_size, _lk_shard, _lk_slot``, dealt out by shard and piece in key order."""
    spark = docs.sparkSession
    ship_package(spark)
    keyed = docs.withColumns({
        "_lk_size": (F.octet_length(null_text(F.col(text_col))) + 1).cast("long"),
        "_lk_h": F.xxhash64(null_text(F.col(text_col))),
        "_lk_d": F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)),
        "_lk_r": F.monotonically_increasing_id()})
    keys = stored(keyed.select(F.col("_lk_h").alias("h"), F.col("_lk_d").alias("d"), F.col("_lk_r").alias("r"),
                               F.col("_lk_size").alias("size")),
                  "shard-keys")
    cuts, rows, shard_of = find_splitters(keys, shards, max(shards, 4 * partitions(spark)), tolerance)
    start, seen = [], {}
    for s, n in zip(shard_of, rows, strict=False):
        start.append(seen.get(s, 0))
        seen[s] = seen.get(s, 0) + n
    at = np.array([_bytes(p) for p in cuts], dtype=f"S{_WIDTH}")

    @F.pandas_udf("int")
    def piece(h: pd.Series, d: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, pack_keys(h.to_numpy(), d.to_numpy(), r.to_numpy()), side="left"), dtype="int32")

    placed = keyed.withColumn("_lk_piece", piece("_lk_h", "_lk_d", "_lk_r"))
    in_order = Window.partitionBy("_lk_piece").orderBy("_lk_h", "_lk_d", "_lk_r")
    lookup = lambda xs, kind: F.get(F.array(*[F.lit(int(x)).cast(kind) for x in xs or [0]]), F.col("_lk_piece"))
    return (placed.withColumn("_lk_shard", lookup(shard_of, "int"))
            .withColumn("_lk_slot", lookup(start, "long") + F.row_number().over(in_order) - 1)
            .drop("_lk_h", "_lk_d", "_lk_r", "_lk_piece"))


def shard_report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The digest columns of ``op2``."""
    slim = docs.select("doc_id", "text", F.crc32(null_text(F.col("text")).cast("binary")).alias("text_crc32"))
    return histogram_shards(slim, shards).select(
        "doc_id", F.col("_lk_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
        F.col("_lk_shard").alias("shard"), F.col("_lk_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
