"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full sets, union-find.

1. A text's words (ASCII lower-cased) give its set of distinct w-word shingles as 64-bit hashes, and a
   SuperMinHash signature: every element throws ranks k + r at registers in the order of a random
   permutation of its own (Fisher-Yates), a register keeps the smallest, and an element stops as soon as
   its rank cannot improve any register of its document.
2. Texts with equal word sequences are one node.  Nodes that agree in a band of ``ROWS`` registers meet
   in its bucket; with 36 bands of 6 a pair at Jaccard 0.8 is missed by all with probability 2e-5, at 0.85 with 4e-8.
3. Every member of a bucket is compared with one node of the bucket (the least by a hash of bucket and node): by set
   size, by signature (a pair at 0.8 falls under ``AGREE`` with probability of about 5e-6) and then on full sets.
   Members that are linked with it, directly or by way of others, are one component and need no pairs among
   themselves; buckets choose apart, so a member that misses one representative meets others.  What is left, buckets
   whose members are in several components, is joined across components on the rare end of the full sets,
   which is exact.  No bucket is cut or sampled.
4. Links are merged by label propagation with pointer jumping; each round is written to the shared folder.

Hot buckets go through salted cells, so no task holds a whole bucket.

Defined results: null or blank text has an empty set and is a component of its own; rows with null ids
take part, and a component without any id has a null component id; ``kept`` is then true.  Repeated
rows of the smallest id are all ``kept`` (``drop_near`` leaves one).  A row is found again by its id and the hash of
its text, so rows that share an id, or have none, are told apart.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import LOWEST, discard, partitions, salted_join, settled
from labelkiln.llm.line_dedup import agreeing, prefix_pairs
from labelkiln.llm.sets import mix, shingle_set, similar, word_hashes
from labelkiln.session import ship_package

BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
WORDS, PERCENT = 5, 80
#: Signature agreement under which a pair is not looked at: over four standard deviations under 0.8.
AGREE = 0.68
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_U32 = np.uint64(0xFFFFFFFF)


def sequence_key(words: np.ndarray) -> bytes:
    """128 bits that stand for the word sequence."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def super_minhash(sets: list[np.ndarray], registers: int = REGISTERS, limit: int = 1 << 16) -> np.ndarray:
    """Signatures (one row a set) of rank * 2**32 + fraction; all elements walk their permutations in step."""
    sig = np.full((len(sets), registers), _EMPTY, np.uint64)
    todo, size = [], 0
    for d, s in enumerate(sets):
        for lo in range(0, len(s), limit):
            todo.append((d, s[lo : lo + limit]))
            size += len(todo[-1][1])
            if size >= limit:
                _throw(sig, todo)
                todo, size = [], 0
    if todo:
        _throw(sig, todo)
    return sig


def _throw(sig: np.ndarray, todo: list[tuple[int, np.ndarray]]) -> None:
    m = sig.shape[1]
    doc = np.repeat(np.array([d for d, _ in todo]), [len(x) for _, x in todo])
    elem = np.concatenate([x for _, x in todo])
    perm = np.tile(np.arange(m, dtype=np.uint16), (len(elem), 1))
    at = np.arange(len(elem))
    flat = sig.ravel()
    with np.errstate(over="ignore"):
        for k in range(m):
            if not len(at):
                return
            h = mix(elem[at] + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15))
            j = k + (((h >> np.uint64(32)) * np.uint64(m - k)) >> np.uint64(32)).astype(np.int64)
            reg = perm[at, j].astype(np.int64)
            perm[at, j] = perm[at, k]
            np.minimum.at(flat, doc[at] * m + reg, (np.uint64(k) << np.uint64(32)) | (mix(h) & _U32))
            # early stop: the next rank is at least k + 1
            worst = sig.max(axis=1)
            at = at[(worst >> np.uint64(32))[doc[at]] > np.uint64(k)]


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band."""
    with np.errstate(over="ignore"):
        out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
        for r in range(rows):
            out = mix(out * np.uint64(0x100000001B3) + sig[:, r * bands : (r + 1) * bands])
    return out


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """``d, t``: the id (null: ``LOWEST``) and the hash of the text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("d"),
            F.xxhash64(F.col(text_col).cast("string")).alias("t")]


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``doc_id, t, n_shingles, seq, bands, sketch``; ``t`` is the hash of the text, the sketch one byte a register."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 256):
                some = b.iloc[lo : lo + 256]
                words = [word_hashes(t) for t in some["text"]]
                sets = [shingle_set(w, width) for w in words]
                sig = super_minhash(sets)
                keys = _signed(band_keys(sig))
                sketch = (sig & np.uint64(0xFF)).astype(np.uint8)
                yield pd.DataFrame({
                    "doc_id": some["doc_id"].to_numpy(), "t": some["t"].to_numpy(), "n_shingles": [len(s) for s in sets],
                    "seq": [sequence_key(w) for w in words], "bands": list(keys),
                    "sketch": [r.tobytes() for r in sketch]})

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col)[1],
                       F.col(text_col).cast("string").alias("text"))
    return slim.mapInPandas(sign, "doc_id long, t long, n_shingles long, seq binary, bands array<long>, sketch binary")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``node, set`` of the nodes of ``wanted`` (``node, d, t``: one row of each), computed anew."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [word_hashes(t) for t in b["text"]]
            # another text of the same id and hash is not the node's
            own = [(n, shingle_set(w, width).tobytes()) for n, w in zip(b["node"], words, strict=True) if sequence_key(w) == n]
            yield pd.DataFrame(own, columns=["node", "set"])

    slim = docs.select(*_row_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    found = slim.join(wanted, ["d", "t"]).select("node", "text")
    return found.mapInPandas(sets, "node binary, set binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose full sets are similar.  ``b`` may be hot."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    both = salted_join(left, ["b"], sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "a")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            ok = [similar(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent)
                  for p, q in zip(x["set_a"], x["set_b"], strict=True)]
            yield x.loc[ok, ["a", "b"]]

    return both.select("a", "b", "set_a", "set_b").mapInPandas(check, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node with a link ``a, b``.

    Each round every label moves to the smallest label beside it, and on to where that one moves; links are then
    drawn between the new labels and loops are dropped, so the graph shrinks until no link is left.
    """
    edges = settled(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    comp = settled(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().select(
        "node", F.col("node").alias("comp")), "comp")
    while not edges.isEmpty():
        low = (edges.select(F.col("u").alias("node"), F.col("v").alias("beside"))
               .union(edges.select("v", "u")).groupBy("node").agg(F.min("beside").alias("beside"))
               .select("node", F.least("node", "beside").alias("to")))
        on = low.select(F.col("node").alias("to"), F.col("to").alias("far"))
        moves = settled(salted_join(low, ["to"], on, "node").select("node", F.col("far").alias("to")), "moves")
        moved = settled(salted_join(comp, ["comp"], moves.select(F.col("node").alias("comp"), "to"), "node", "left").select(
            "node", F.coalesce("to", "comp").alias("comp")), "comp")
        drawn = salted_join(edges, ["u"], moves.select(F.col("node").alias("u"), F.col("to").alias("x")), "v")
        drawn = salted_join(drawn, ["v"], moves.select(F.col("node").alias("v"), F.col("to").alias("y")), "u")
        left = settled(drawn.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                       .distinct(), "links")
        discard(comp, edges, moves)
        comp, edges = moved, left
    discard(edges)
    return comp


def _cells(members: DataFrame, n: int) -> DataFrame:
    return members.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(n)).cast("int"))


def near_links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Verified links ``a, b`` between ``nodes`` (word sequences; given up here) that connect every component."""
    n = partitions(docs.sparkSession)
    # one exchange of the members, by (key, salt): the band is part of the key's hash
    member = _cells(nodes.select("node", "size", F.explode("bands").alias("key")), n).repartition("key", "salt")
    # each bucket has an order of its own, so a member meets as many representatives as it has buckets
    nth = F.xxhash64("key", "node").alias("nth")
    cell = member.groupBy("key", "salt").agg(F.min(F.struct(nth, "node", "size")).alias("low"), F.count("*").alias("rows"))
    bucket = (cell.groupBy("key").agg(F.min("low").alias("low"), F.sum("rows").alias("rows"))
              .filter("rows > 1").select("key", F.col("low.node").alias("rep"), F.col("low.size").alias("rep_size")))
    shared = settled(member.join(cell.select("key", "salt").join(bucket, "key"), ["key", "salt"])
                     .select("key", "node", "size", "rep", "rep_size"), "buckets")
    slim = settled(nodes.drop("bands"), "slim-nodes")
    discard(nodes)
    nodes = slim
    fits = F.least("size", "rep_size") * 100 >= F.greatest("size", "rep_size") * percent
    meets = shared.filter("node <> rep").filter(fits).select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    stars = settled(_agreeing(meets, nodes), "stars")
    first = _confirmed(stars, docs, nodes, id_col, text_col, width, percent, "first-links")
    discard(stars)
    comps = components(first)
    discard(first)
    rest = _across(docs, shared, nodes, comps, id_col, text_col, width, percent)
    links = settled(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).filter("a <> b").union(rest), "all-links")
    discard(nodes, comps, rest)
    return links


def _sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Sets are computed anew from the texts where they are needed, not carried along for every document."""
    return settled(shingle_sets(docs, nodes.join(wanted, "node", "left_semi").select("node", "place.*"), id_col, text_col,
                               width), "sets")


def _confirmed(pairs, docs, nodes, id_col, text_col, width, percent, name) -> DataFrame:
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets_of(wanted, docs, nodes, id_col, text_col, width)
    links = settled(verified(pairs, sets, percent), name)
    discard(sets)
    return links


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in a share of ``AGREE`` of the registers at least."""
    left = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    both = salted_join(left, ["b"], nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "a")

    return both.select("a", "b", "sketch_a", "sketch_b").mapInPandas(agreeing(AGREE), "a binary, b binary")


def _across(docs, shared: DataFrame, nodes: DataFrame, comps: DataFrame, id_col, text_col, width, percent) -> DataFrame:
    """Links between members of buckets (``shared``; given up here) whose members are in several components.

    Documents that merely have a line or passage in common also meet in buckets, in any number, so pairs of a
    bucket are not emitted.  The members are joined exactly on the rare end of their full sets (prefix, length and
    positional filters) instead: similar sets always meet there, and frequent shingles are no meeting point.
    """
    n = partitions(shared.sparkSession)
    labelled = _cells(shared.select("key", "node").join(comps, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node")), n)
    cell = labelled.groupBy("key", "salt").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed = cell.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("key")
    left = settled(labelled.join(cell.select("key", "salt").join(mixed, "key"), ["key", "salt"])
                  .groupBy("node").agg(F.first("comp").alias("comp")), "mixed-members")
    discard(shared)
    sets = _sets_of(left.select("node"), docs, nodes, id_col, text_col, width)
    full = sets.join(left, "node").join(nodes.select("node", "sketch"), "node").withColumnRenamed("node", "cls")
    pairs = prefix_pairs(full, percent, agree=AGREE)
    links = settled(verified(pairs, sets, percent), "second-links")
    discard(left, sets, pairs)
    return links


def _decided(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``doc_id, t, n_shingles, first`` for each row: ``first`` (``no_id, id, t``) is the first row of its component."""
    ship_package(docs.sparkSession)
    sig = settled(signatures(docs, id_col, text_col, width), "signatures")
    nodes = settled(sig.filter("n_shingles > 0").groupBy(F.col("seq").alias("node")).agg(
        F.first("n_shingles").cast("int").alias("size"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(LOWEST)).alias("d"), "t")).alias("place"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    rows = settled(sig.select("doc_id", "t", "n_shingles", F.col("seq").alias("node")), "rows")
    discard(sig)
    links = near_links(docs, nodes, id_col, text_col, width, percent)
    comps = components(links)
    discard(links)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "t")
    full = rows.filter("n_shingles > 0")
    by_node = full.groupBy("node").agg(F.min(place).alias("low"))
    named = by_node.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    first = named.groupBy("comp").agg(F.min("low").alias("first"))
    named = salted_join(named.select("node", "comp"), ["comp"], first, "node").select("node", "first")
    return salted_join(full, ["node"], named, "t").select("doc_id", "t", "n_shingles", "first").unionByName(
        rows.filter("n_shingles = 0").select("doc_id", "t", "n_shingles", place.alias("first")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    out = _decided(docs, id_col, text_col, width, percent).select(
        "doc_id", "n_shingles", F.col("first.id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with all its columns and one row of each group: the one of the smallest id (rows without an id come
    last) and then of the smallest text hash.  Rows without words stay."""
    key = _row_key("doc_id", text_col)[0]
    rows = settled(_decided(docs, id_col, text_col, width, percent).filter("n_shingles > 0").select(
        key, "t", (F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("t") == F.col("first.t"))).alias("stays")), "decided")
    gone = rows.filter("NOT stays").select(F.struct("d", "t").alias("_lk_row")).distinct()
    # equal rows have one key: of those that stay, one does
    again = rows.filter("stays").groupBy("d", "t").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.struct("d", "t").alias("_lk_row"))
    left = docs.withColumn("_lk_row", F.struct(*_row_key(id_col, text_col))).join(gone, "_lk_row", "left_anti")
    return left.join(again, "_lk_row", "left_anti").unionByName(
        left.join(again, "_lk_row", "left_semi").dropDuplicates(["_lk_row"])).drop("_lk_row")
