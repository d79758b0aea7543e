"""Line dedup by an exact set-similarity join with prefix, positional and length filters.

A line is its set of distinct words (ASCII lower-cased, 64-bit hashes); two lines are similar at a
Jaccard of 0.8 or more.  A line goes if any earlier line (by document id, then line number) is similar
to it; blank lines stay.

1. Words are ordered by rarity.  The order comes from a table of ``2**COUNTERS`` counters over all words: any fixed
   order gives the exact result, colliding counters only make it a little less selective, and the table's size
   is bounded whatever the vocabulary.
2. Each line gives its class (hash and parity bitmap of its set), its size and the words of its prefix (the
   ``n - ceil(0.8 n) + 1`` rarest).  Words with a count of one occur in no other line and are left out.  Lines of one
   class are merged, known by their first place; full sets do not move.
3. Classes meet in the words of their prefixes.  The length filter, the positional bound on the overlap and the
   parity bitmaps (two bitmaps differ in at most as many bits as the sets differ in words) decide which pairs are
   verified.  The classes of a word meet within one task, in the order of their sizes, as long as they are fewer than
   ``MET``.  Words with more are cut into tiles of one size step and a bounded number of members; there a class meets
   the first ones before all others, and the others only while no earlier similar class is known.
4. The sets of the classes in such pairs are computed anew from the texts and compared in full.

Defined results: null text has no lines (0 lines, cleaned text empty); the parts of an empty text are one
blank line; rows that repeat an id are earlier or later by the hash of their texts, and rows that repeat both
count as the same place, so neither removes the other.  Null ids come first.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import LOWEST, STRIPE_SCHEMA, discard, partitions, salted_join, settled, striped, summed
from labelkiln.llm.sets import mix, similar, word_hashes
from labelkiln.session import ship_package

PERCENT = 80
COUNTERS = 18
#: Classes with one word and size step that one task compares with as many others.
TILE = 256
#: Classes with one word that meet in one task; the classes of a word with more are dealt out in tiles.
MET = 1024


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("d"), F.xxhash64(F.col(text_col)).alias("t"),
                       F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())


def _joined(texts: list[str], limit: int = 1 << 18) -> Iterator[tuple[int, int, str]]:
    """``(lo, hi, text)``: neighbouring texts joined by line breaks, up to about ``limit`` characters and never less
    than one whole text."""
    lo = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= limit or i == len(texts):
            yield lo, i, "\n".join(texts[lo:i])
            lo, size = i, 0


def rarity_levels(slim: DataFrame, bits: int = COUNTERS) -> np.ndarray:
    """``floor(2 log2 count)`` for each counter of the words of all lines (0: at most one)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for _, _, text in _joined(b["text"].tolist()):
                total += np.bincount((word_hashes(text) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        yield from striped(total)

    counts = summed(slim.select("text").mapInPandas(count, STRIPE_SCHEMA), (1 << bits,))
    return np.floor(2 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


LINE_SCHEMA = ("k long, b1 long, b2 long, d long, t long, line int, size int, skip int, cold int, prefix array<int>")
CLS = ["k", "b1", "b2"]
#: Below this level a word has fewer than MET occurrences.
COLD = np.uint64(2 * np.log2(MET))


def line_rows(slim: DataFrame, levels: np.ndarray, percent: int, bits: int = COUNTERS) -> DataFrame:
    """A row for each line that has words: class (``k, b1, b2``), place, ``size`` of the set and the rare end of it.

    ``prefix`` holds the words at positions ``skip`` and on, by the upper half of their hash (two words that share it
    share a counter too, and only add candidates); the first ``cold`` of them are below level ``COLD``.
    """
    shared = slim.sparkSession.sparkContext.broadcast(levels)  # 2**bits bytes, whatever the input

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.astype(np.uint64)
        for b in batches:
            d, t = b.column("d").to_numpy(), b.column("t").to_numpy()
            texts = b.column("text").to_pylist()
            for lo, hi, text in _joined(texts):
                words, ends = _words_by_line(text)
                if len(words):
                    yield cut(table, words, ends, d[lo:hi], t[lo:hi], [x.count("\n") + 1 for x in texts[lo:hi]])

    def cut(table, words, ends, d, t, per_text) -> pa.RecordBatch:
        line = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
        width = np.uint64(max(1, len(ends).bit_length()))
        # line, level, first bits of the word in one number; words that agree in all of these are put in order after
        level = table[(words >> np.uint64(64 - bits)).astype(np.int64)]
        key = (line << (np.uint64(64) - width)) | (level << (np.uint64(57) - width)) | (words >> (np.uint64(7) + width))
        order = np.argsort(key)
        c, w = key[order], words[order]
        if ((c[1:] == c[:-1]) & (w[1:] != w[:-1])).any():
            order = np.lexsort((words, key))
            c, w = key[order], words[order]
        new = np.r_[True, (w[1:] != w[:-1]) | (c[1:] != c[:-1])]
        w, line, level = w[new], line[order][new], level[order][new]
        start = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        size = np.diff(np.r_[start, len(w)])
        bit = np.uint64(1) << (w & np.uint64(63))
        upper = (w & np.uint64(64)) > 0
        with np.errstate(over="ignore"):
            k = mix(np.add.reduceat(mix(w + np.uint64(0x9E3779B97F4A7C15)), start) + size.astype(np.uint64))
        b1 = np.bitwise_xor.reduceat(np.where(upper, np.uint64(0), bit), start)
        b2 = np.bitwise_xor.reduceat(np.where(upper, bit, np.uint64(0)), start)
        pos = np.arange(len(w)) - np.repeat(start, size)
        reach = size - (-(-percent * size // 100)) + 1
        take = (pos < np.repeat(reach, size)) & (level > 0)
        number = np.add.reduceat(take.astype(np.int64), start)
        at = line[start].astype(np.int64)
        text_of = np.repeat(np.arange(len(per_text)), per_text)
        first = np.cumsum(per_text) - per_text
        return pa.RecordBatch.from_arrays([
            pa.array(k.view(np.int64)), pa.array(b1.view(np.int64)), pa.array(b2.view(np.int64)),
            pa.array(d[text_of[at]]), pa.array(t[text_of[at]]), pa.array((at - first[text_of[at]]).astype(np.int32)),
            pa.array(size.astype(np.int32)), pa.array((reach - number).astype(np.int32)),
            pa.array(np.add.reduceat((take & (level < COLD)).astype(np.int32), start).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(number)].astype(np.int32)), pa.array((w[take] >> np.uint64(32)).astype(np.uint32).view(np.int32)))],
            names=["k", "b1", "b2", "d", "t", "line", "size", "skip", "cold", "prefix"])

    return slim.mapInArrow(rows, LINE_SCHEMA)


def _words_by_line(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the whole text, and for each line the number of words up to its end."""
    words = word_hashes(text)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    begins = np.cumsum(~space & np.r_[True, space[:-1]]) if len(raw) else np.zeros(0, np.int64)
    breaks = np.flatnonzero(raw == 0x0A)
    return words, np.r_[begins[breaks], len(words)].astype(np.int64)


def rarity(classes: DataFrame, bits: int = COUNTERS) -> np.ndarray:
    """Counters of the words of all classes, summed in numpy per task and then by Spark."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            if len(b):
                words = np.frombuffer(b"".join(b["set"]), np.uint64)
                total += np.bincount((words >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        yield from striped(total)

    return summed(classes.select("set").mapInPandas(count, STRIPE_SCHEMA), (1 << bits,))


def prefix_pairs(sets: DataFrame, percent: int, agree: float = 0.0, bits: int = COUNTERS) -> DataFrame:
    """Candidate pairs ``a < b`` of ``cls, set, comp`` that are in different ``comp``: they share a word of both
    prefixes and pass the length and positional filters.  Every pair of similar sets is among them.
    ``agree``: ``sets`` has a ``sketch``, and only pairs whose sketches agree in that share of their bytes and whose
    parity bitmaps do not show too many words apart (an exact bound) are given.

    A word's classes are cut into tiles of one size step, and, where a ``comp`` is large, into those of the ``comp`` of
    the first class (side 0, no pairs among themselves) and the others (side 1).
    """
    spark = sets.sparkSession
    n = partitions(spark)
    counts = np.minimum(rarity(sets, bits), np.iinfo(np.int32).max).astype(np.int32)
    shared = spark.sparkContext.broadcast(counts)  # 4 * 2**bits bytes, whatever the input

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for b in batches:
            for lo in range(0, len(b), 512):
                some = b.iloc[lo : lo + 512]
                lens = np.array([len(s) // 8 for s in some["set"]])
                words = np.frombuffer(b"".join(some["set"]), np.uint64)
                row = np.repeat(np.arange(len(some)), lens)
                freq = table[(words >> np.uint64(64 - bits)).astype(np.int64)]
                order = np.lexsort((words, freq, row))
                pos = np.arange(len(words)) - np.repeat(np.cumsum(lens) - lens, lens)
                reach = np.repeat(lens - (-(-percent * lens // 100)) + 1, lens)
                take = (pos < reach) & (freq[order] > 1)
                at = row[order][take]
                out = pd.DataFrame({"word": words[order][take].view(np.int64), "cls": some["cls"].to_numpy()[at],
                                    "size": lens[at], "pos": pos[take], "comp": some["comp"].to_numpy()[at]})
                if agree:
                    both = [p + k for p, k in zip(parities(words, row, len(some)), some["sketch"], strict=True)]
                    out["sketch"] = np.array(both, object)[at]
                yield out

    more = ["sketch"] if agree else []
    pre = sets.select("cls", "set", "comp", *more).mapInPandas(
        prefixes, "word long, cls binary, size int, pos int, comp binary" + ", sketch binary" * bool(agree))
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    # a word of one component only meets nobody; most words are dropped here, before lists move
    salt = F.pmod(F.xxhash64("cls"), F.lit(n)).cast("int")
    cell = pre.withColumn("salt", salt).groupBy("word", "salt").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct("cls", "comp")).alias("first"))
    words = (cell.groupBy("word").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"))
             .filter("lo <> hi").select("word", F.col("first.comp").alias("main")))
    live = salted_join(pre, ["word"], words, "cls").withColumn("step", step).withColumn(
        "side", F.when(F.col("comp") == F.col("main"), 0).otherwise(1)).drop("main")
    live = settled(live, "live-prefixes")
    group = ["word", "side", "step"]
    tiles = live.groupBy(*group).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    other = tiles.select("word", F.col("side").alias("side2"), F.col("step").alias("step2"), F.col("tiles").alias("tiles2"))
    plan = (tiles.join(other, "word")
            .filter((F.col("side") + F.col("side2") > 0) & (F.abs(F.col("step") - F.col("step2")) <= 1))
            .groupBy(*group, "tiles").agg(F.collect_list(F.struct("side2", "step2", "tiles2")).alias("with")))
    placed = salted_join(live, group, plan, "cls").withColumn(
        "tile", F.pmod(F.xxhash64("cls", "word"), F.col("tiles")).cast("int"))
    me = F.struct("side", "step", "tile")
    meetings = F.flatten(F.transform("with", lambda w: F.transform(
        F.sequence(F.lit(0), w["tiles2"] - 1),
        lambda t: F.struct(w["side2"].alias("side"), w["step2"].alias("step"), t.cast("int").alias("tile")))))
    dealt = placed.withColumn("other", F.explode(meetings)).select(
        "word", F.least(me, F.col("other")).alias("m1"), F.greatest(me, F.col("other")).alias("m2"), me.alias("me"),
        "cls", "size", "pos", "comp", *more)
    key = ["word", "m1", "m2"]
    part = lambda x, c: dealt.select(*key, F.col("me").alias(f"me_{x}"), F.col("cls").alias(c), F.col("size").alias(f"n_{x}"),
                                     F.col("pos").alias(f"p_{x}"), F.col("comp").alias(f"c_{x}"),
                                     *[F.col(m).alias(f"{m}_{x}") for m in more])
    # the overlap that is needed, and the most that is possible from these positions on
    need = F.ceil((F.col("n_x") + F.col("n_y")) * percent / F.lit(100 + percent))
    most = F.least(F.col("n_x") - F.col("p_x"), F.col("n_y") - F.col("p_y"))
    once = ((F.col("m1") == F.col("m2")) & (F.col("a") < F.col("b"))) | (F.col("me_x") < F.col("me_y"))
    fits = F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent
    # the smaller set of a similar pair meets the larger one in a shorter prefix of its own already
    short = lambda n, p: F.col(p) < F.col(n) - F.ceil(F.col(n) * 2 * percent / F.lit(100 + percent)) + 1
    fits = fits & ((F.col("n_x") > F.col("n_y")) | short("n_x", "p_x")) & ((F.col("n_y") > F.col("n_x")) | short("n_y", "p_y"))
    pairs = part("x", "a").join(part("y", "b"), key).filter(
        once & fits & (most >= need) & (F.col("c_x") != F.col("c_y")))
    if agree:
        pairs = pairs.select("a", "b", (F.col("n_x") + F.col("n_y")).alias("both"), F.col("sketch_x").alias("sketch_a"),
                             F.col("sketch_y").alias("sketch_b")).mapInPandas(close(agree, percent), "a binary, b binary")
    out = settled(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "prefix-pairs")
    discard(live)
    return out


#: Bytes of a set's parity bitmap.
PARITY = 128


def parities(words: np.ndarray, row: np.ndarray, rows: int) -> list[bytes]:
    """For each row a bitmap of ``8 * PARITY`` cells: whether an odd number of its words fall into the cell.  Two bitmaps
    differ in at most as many cells as the sets differ in words."""
    cells = 8 * PARITY
    at = row * cells + (words & np.uint64(cells - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=rows * cells) & 1).astype(np.uint8).reshape(rows, cells)
    return [x.tobytes() for x in np.packbits(odd, axis=1)]


def close(share: float, percent: int):
    """Keeps ``(a, b)`` whose sketches, after the parity bitmap, agree in ``share`` of their bytes and whose bitmaps allow
    a Jaccard of ``percent``; ``both`` is the sum of the set sizes."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                u, v = (np.frombuffer(b"".join(x[c]), np.uint8).reshape(len(x), -1) for c in ("sketch_a", "sketch_b"))
                apart = np.bitwise_count(u[:, :PARITY] ^ v[:, :PARITY]).sum(axis=1, dtype=np.int64)
                ok = apart * (100 + percent) <= x["both"].to_numpy() * (100 - percent)
                yield x.loc[ok & ((u[:, PARITY:] == v[:, PARITY:]).mean(axis=1) >= share), ["a", "b"]]

    return keep


def agreeing(share: float):
    """Keeps ``(a, b)`` whose ``sketch_a`` and ``sketch_b`` have equal bytes in that share of places at least."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                u, v = (np.frombuffer(b"".join(x[c]), np.uint8).reshape(len(x), -1) for c in ("sketch_a", "sketch_b"))
                yield x.loc[(u == v).mean(axis=1) >= share, ["a", "b"]]

    return keep


def _fits(percent: int, n_x, n_y, p_x, p_y, apart, least):
    """Whether sets of these sizes that share a word at these positions may be similar; columns or arrays.

    Similar sets differ in at most ``(100 - percent) / (100 + percent)`` of their sizes together, and ``apart`` is a
    lower bound of that.  The smaller set of a similar pair meets the larger one in a shorter prefix of its own already.
    """
    both = n_x + n_y
    short = lambda n, p: p * (100 + percent) <= n * (100 - percent)
    return ((apart * (100 + percent) <= both * (100 - percent))
            & (least(n_x - p_x, n_y - p_y) * (100 + percent) >= both * percent)
            & ((n_x > n_y) | short(n_x, p_x)) & ((n_y > n_x) | short(n_y, p_y)))


def frequent_words(pre: DataFrame) -> DataFrame:
    """``word`` of those that ``MET`` classes or more have in their prefixes.  Only words whose counter allows it are
    counted."""
    return pre.filter("i >= cold").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MET).select("word")


def cold_pairs(pre: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``a, b`` of classes that meet in a word that is not ``frequent``."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if left is not None:
                cols = [np.concatenate(x) for x in zip(left, cols, strict=True)]
            # the rows of the last word wait for the next batch; they are fewer than MET
            end = int(np.searchsorted(cols[0], cols[0][-1] >> 32 << 32)) if len(cols[0]) else 0
            left = [c[end:] for c in cols]
            yield from meet([c[:end] for c in cols])
        if left is not None:
            yield from meet(left)

    def meet(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, k, b1, b2, pos = cols
        word, size = key >> 32, key & 0xFFFFFFFF
        ends = np.r_[np.flatnonzero(word[1:] != word[:-1]) + 1, len(word)]
        last = np.repeat(ends, np.diff(ends, prepend=0))
        # the rows of a word ascend in size: a row meets those behind it until they are too large, and as the smaller
        # one (or an equal one) only in the shorter prefix
        at = np.flatnonzero(pos * (100 + percent) <= size * (100 - percent))
        for shift in range(1, len(word)):
            at = at[at + shift < last[at]]
            at = at[size[at + shift] * percent <= size[at] * 100]
            if not len(at):
                return
            to = at + shift
            apart = np.bitwise_count((b1[at] ^ b1[to]).view(np.uint64)).astype(np.int64) + np.bitwise_count(
                (b2[at] ^ b2[to]).view(np.uint64))
            near = apart * (100 + percent) <= (size[at] + size[to]) * (100 - percent)
            x, y = at[near], to[near]
            near = _fits(percent, size[x], size[y], pos[x], pos[y], apart[near], np.minimum) & (
                (k[x] != k[y]) | (b1[x] != b1[y]) | (b2[x] != b2[y]))
            x, y = x[near], y[near]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(c[i]) for i in (x, y) for c in (k, b1, b2)],
                                                 names=[f"{c}_{i}" for i in "xy" for c in CLS])

    # word and size in one number, which is also the order
    rows = pre.join(F.broadcast(frequent), "word", "left_anti").select(
        F.shiftleft(F.col("word").cast("long"), 32).bitwiseOR(F.col("size").cast("long")).alias("key"), *CLS,
        F.col("pos").cast("long"))
    met = rows.repartition(F.shiftright("key", 32)).sortWithinPartitions("key").mapInArrow(
        pairs, ", ".join(f"{c}_{i} long" for i in "xy" for c in CLS))
    return _pair(met).distinct()


def _of(x: str) -> Column:
    return F.struct(*[F.col(f"{c}_{x}").alias(c) for c in CLS])


def _pair(rows: DataFrame) -> DataFrame:
    return rows.select(F.least(_of("x"), _of("y")).alias("a"), F.greatest(_of("x"), _of("y")).alias("b"))


def _may_match(percent: int) -> Column:
    """The earlier row ``x`` and the later row ``y`` pass all filters."""
    apart = sum(F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in ("b1", "b2"))
    return _fits(percent, *[F.col(c) for c in ("size_x", "size_y", "pos_x", "pos_y")], apart, F.least) & (
        F.col("place_x") < F.col("place_y"))


_ROW = [*CLS, "size", "pos", "place"]


def _side(x: str) -> list[Column]:
    return [F.col(c).alias(f"{c}_{x}") for c in _ROW]


def _planned(hot: DataFrame) -> DataFrame:
    """The rows of ``hot`` with the tile counts and first rows of their word in their size step and those beside it."""
    cells = hot.groupBy("word", "step").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"),
                                            F.min(F.struct("place", *CLS, "size", "pos")).alias("first"))
    other = cells.select("word", F.struct("step", "tiles", "first").alias("beside"))
    plan = (cells.join(other, "word").filter(F.abs(F.col("step") - F.col("beside.step")) <= 1)
            .groupBy("word", "step", "tiles").agg(F.collect_list("beside").alias("with")))
    return salted_join(hot, ["word", "step"], plan, "k")


def star_pairs(planned: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of each class with the first ones of its words: as many as there are rows, however many
    classes are alike."""
    met = planned.select(*_side("y"), F.explode("with").alias("w")).select(
        *[F.col(f"{c}_y") for c in _ROW], *[F.col(f"w.first.{c}").alias(f"{c}_x") for c in _ROW])
    return _pair(met.filter(_may_match(percent))).distinct()


def open_pairs(planned: DataFrame, gone: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of the classes that are not ``gone`` yet with all earlier ones of their words."""
    tile = F.pmod(F.xxhash64("k", "word"), F.col("tiles")).cast("int").alias("tile")
    x = planned.select("word", "step", tile, *_side("x"))
    tiles = F.flatten(F.transform("with", lambda w: F.transform(
        F.sequence(F.lit(0), w["tiles"] - 1), lambda t: F.struct(w["step"].alias("step"), t.cast("int").alias("tile")))))
    y = planned.join(gone, CLS, "left_anti").select("word", *_side("y"), F.explode(tiles).alias("m")).select(
        "word", "m.step", "m.tile", *[F.col(f"{c}_y") for c in _ROW])
    return _pair(x.join(y, ["word", "step", "tile"]).filter(_may_match(percent))).distinct()


def sets_of(slim: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, place, set`` of the classes ``wanted`` (``cls, place``), computed anew from the texts of their places."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, t, text, lines in zip(b["d"], b["t"], b["text"], b["lines"], strict=True):
                words, ends = _words_by_line(text)
                begins = np.r_[0, ends[:-1]]
                rows += [(x["k"], x["b1"], x["b2"], d, t, x["line"], np.unique(words[begins[x["line"]] : ends[x["line"]]]).tobytes())
                         for x in lines]
            yield pd.DataFrame(rows, columns=[*CLS, "d", "t", "line", "set"])

    # written first, so that Spark knows its size and moves the texts only where this side is large
    lines = settled(wanted.select("place.d", "place.t", F.struct("place.line", "cls.*").alias("x")).groupBy("d", "t").agg(
        F.collect_list("x").alias("lines")), "wanted-lines")
    found = slim.join(lines, ["d", "t"]).select("d", "t", "text", "lines")
    out = settled(found.mapInPandas(sets, "k long, b1 long, b2 long, d long, t long, line int, set binary").dropDuplicates(
        CLS).select(F.struct(*CLS).alias("cls"), F.struct("d", "t", "line").alias("place"), "set"), "line-sets")
    discard(lines)
    return out


def similar_earlier(slim: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``k, b1, b2`` of the classes that have a similar class with an earlier first place (``place``).

    One such class is enough: in frequent words every class first meets the first ones, and only those that stay open
    meet all earlier ones, so a large group of similar lines makes few pairs.
    """
    pre = classes.select(*CLS, "size", "skip", "cold", "place", F.posexplode("prefix").alias("i", "word")).withColumn(
        "pos", F.col("skip") + F.col("i"))
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    frequent = settled(frequent_words(pre), "frequent-words")
    hot = settled(_planned(pre.filter("i >= cold").join(frequent, "word", "left_semi").select(
        "word", step.alias("step"), *_ROW)), "hot-prefixes")
    first = settled(cold_pairs(pre, frequent, percent).union(star_pairs(hot, percent)).distinct(), "first-pairs")
    gone = later_ones(slim, classes, first, percent)
    discard(first, frequent)
    rest = settled(open_pairs(hot, gone, percent), "open-pairs")
    discard(hot)
    more = later_ones(slim, classes, rest, percent)
    discard(rest)
    out = settled(gone.union(more).distinct(), "gone-classes")
    discard(gone, more)
    return out


def later_ones(slim: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """``k, b1, b2`` of the later class of each of ``pairs`` whose full sets are similar."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    placed = classes.select(F.struct(*CLS).alias("cls"), "place").join(wanted, "cls", "left_semi")
    sets = sets_of(slim, placed)
    of = lambda x: sets.select(F.col("cls").alias(x), F.col("set").alias(f"set_{x}"), F.col("place").alias(f"place_{x}"))
    met = salted_join(salted_join(pairs, ["a"], of("a"), "b"), ["b"], of("b"), "a")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            ok = [similar(np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64), percent)
                  for u, v in zip(x["set_a"], x["set_b"], strict=True)]
            yield x.loc[ok, CLS]

    later = F.when(F.col("place_a") < F.col("place_b"), F.col("b")).when(
        F.col("place_b") < F.col("place_a"), F.col("a"))
    out = settled(met.withColumn("later", later).filter("later IS NOT NULL").select("set_a", "set_b", "later.*").mapInPandas(
        check, "k long, b1 long, b2 long").distinct(), "later-classes")
    discard(sets)
    return out


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``d, t, line`` of the lines that go (``d``: id, ``t``: hash of the text)."""
    spark = docs.sparkSession
    ship_package(spark)
    slim = _slim(docs, id_col, text_col)
    place = F.struct("d", "t", "line")
    full = settled(line_rows(slim, rarity_levels(slim), percent), "full-lines")
    classes = settled(full.groupBy(*CLS).agg(F.min(place).alias("place"), *[
        F.first(c).alias(c) for c in ("size", "skip", "cold", "prefix")]), "line-classes")
    # from here on lines need their class only
    lines = settled(full.select(*CLS, "d", "t", "line"), "lines")
    discard(full)
    near = similar_earlier(slim, classes, percent)
    # all lines of a class with a similar earlier class go; of the others all but those in the first place
    verdict = classes.select(*CLS, "place").join(near.withColumn("gone", F.lit(True)), CLS, "left")
    marked = salted_join(lines.select(*CLS, "d", "t", "line"), CLS, verdict, "d")
    out = settled(marked.filter(F.col("gone") | (place > F.col("place"))).select("d", "t", "line").distinct(), "gone-lines")
    discard(lines, classes, near)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` (line numbers) ``, text`` (cleaned) for each row of ``docs``."""
    gone = settled(dropped_lines(docs, id_col, text_col, percent).groupBy("d", "t")
                  .agg(F.array_sort(F.collect_list("line")).alias("removed")), "removed-lines")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))).withColumn("t", F.xxhash64("text"))
    lines = F.split(F.col("text"), "\n", -1)
    none = F.array().cast("array<int>")
    out = base.join(gone, ["d", "t"], "left").withColumn("removed", F.coalesce("removed", none))
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col("removed"), i))
    return out.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"), "removed",
        F.when(F.size("removed") == 0, F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("text"))


def line_report(docs: DataFrame) -> DataFrame:
    """The digest columns of ``op7``."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed_lines"),
                                    F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
