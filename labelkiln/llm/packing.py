"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  Documents longer than the longest are cut into whole longest
sequences and a remainder, so nothing is lost.  Pieces are dealt at random (by hash) into blocks of
about ``BLOCK_ROWS`` documents; each block is packed on its own, longest piece first: a piece goes to the open
bin whose free room it leaves smallest, and if none has room, a bin is opened in the length that costs
least a unit packed, given what is left to pack.  In the end each bin is downsized to the
smallest permitted length that holds its contents.  The opening costs are settled jointly per block: each
permitted length is tried as the largest to open, the cheapest result after downsizing is taken.

Costs: a bin of length L costs ``L + overhead``.  Blocks grow in number, not in size, with the input.

Defined results: null text has size 0 and is not packed (``bin`` null); rows that repeat an id are separate
items; the empty table gives the empty table.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import null_text, salted_join, stored, word_count
from labelkiln.session import ship_package

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 32
BLOCK_ROWS = 4096


def best_fit(sizes: list[int], lengths: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece (sizes descending, none above the longest length), and of each bin its
    contents and its length after downsizing."""
    room_of: list[int] = []                       # free room by bin
    used: list[int] = []
    by_room: dict[int, list[int]] = {}            # bins by free room, smallest number first
    mask, left, out = 0, sum(sizes), []
    for size in sizes:
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = heapq.heappop(by_room[room])
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            # what the bin can be expected to hold: this piece and as much as is left
            length = min((x for x in lengths if x >= size),
                         key=lambda x: ((x + overhead) / min(x, left), x))
            b, room = len(used), length
            room_of.append(length)
            used.append(0)
        room -= size
        used[b] += size
        left -= size
        out.append(b)
        if room:
            heapq.heappush(by_room.setdefault(room, []), b)
            mask |= 1 << room
    return out, used, [min(x for x in lengths if x >= u) for u in used]


def pack_block(sizes: list[int], lengths: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the packings that open bins up to each permitted length."""
    best, cost = None, None
    for top in range(len(lengths)):
        if sizes and sizes[0] > lengths[top]:
            continue
        tried = best_fit(sizes, lengths[: top + 1], overhead)
        c = sum(x + overhead for x in tried[2])
        if cost is None or c < cost:
            best, cost = tried, c
    return best or ([], [], [])


def best_fit_pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, piece, piece_start, size, block, bin, bin_offset, bin_used, bin_length``
    (sizes in words).  ``(block, bin)`` names a sequence."""
    spark = docs.sparkSession
    ship_package(spark)
    lengths, top = tuple(sorted(lengths)), max(lengths)
    # written once: the number of rows fixes the number of blocks, and the texts are read a single time
    items = stored(docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("words"),
                               F.xxhash64(F.lit("pack"), F.col(id_col), null_text(F.col(text_col))).alias("h"),
                               F.monotonically_increasing_id().alias("row")), "items")
    # by hash of the row; equal rows are parted by the row number that was written with them
    blocks = max(1, -(-items.count() // block_rows))
    equal = items.groupBy("h").agg(F.count("*").alias("rows")).filter("rows > 1").select("h", F.lit(True).alias("again"))
    dealt = salted_join(items.filter("words > 0"), ["h"], equal, "row", "left").withColumn(
        "nth", F.when(F.col("again"), F.col("row")).otherwise(-1))
    pieces = dealt.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), ((F.col("words") - 1) / top).cast("int")))).select(
        "doc_id", "piece", (F.col("piece").cast("long") * top).alias("piece_start"),
        F.least(F.lit(top).cast("long"), F.col("words") - F.col("piece").cast("long") * top).alias("size"),
        F.pmod(F.xxhash64("h", "nth", "piece"), F.lit(blocks)).alias("block"))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        sizes = block["size"].astype(int).tolist()
        bins, used, length = pack_block(sizes, lengths, overhead)
        filled, offset = [0] * len(used), []
        for b, s in zip(bins, sizes, strict=True):
            offset.append(filled[b])
            filled[b] += s
        return block.assign(bin=bins, bin_offset=offset, bin_used=[used[b] for b in bins],
                            bin_length=[length[b] for b in bins])

    kind = dict(docs.dtypes)[id_col]
    schema = (f"doc_id {kind}, piece int, piece_start long, size long, block long, bin long, bin_offset long, "
              "bin_used long, bin_length int")
    packed = pieces.groupBy("block").applyInPandas(pack, schema)
    empty = items.filter("words = 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("piece_start"),
        F.lit(0).cast("long").alias("size"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("block", "long"), ("bin", "long"), ("bin_offset", "long"), ("bin_used", "long"), ("bin_length", "int"))])
    return packed.unionByName(empty)
