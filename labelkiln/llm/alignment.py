"""Alignment of two tokenizers' ids over a corpus, counted with inverted pair bitmaps.

Both tokenizers cut the same bytes (a space and the text), so their token ends lie on one axis.  Every stretch
between neighbouring ends of either side belongs to one token of each: these stretches are the links, and ends
that both sides share cut the tokens into groups.

Counting: a task numbers its documents within blocks of at most ``BLOCK_DOCS`` documents and ``BLOCK_LINKS``
(pair, document) entries; the bitmaps of its batches are OR-merged into one bitmap per (block, pair): positions
as 16-bit numbers, or plain bits where those are shorter.  How often a document holds a pair is kept in
multiplicity planes: plane 0 says that it does, plane k + 1 holds bit k of the number of further times.  The
documents of a pair are the popcounts of its plane-0 bitmaps, summed over blocks (partial sums first); its links
are the popcounts of all planes by weight.  Then the postings return the scores: each bitmap meets the count of
its pair, goes to its block, and is added up there per document.  A pair has one bitmap per block and plane, so
no pair is hot, whatever the share of documents that hold it, and a task keeps the sums of one block only.

Defined results: a text that is null, empty, or not rebuilt byte by byte by both tokenizers has no tokens: zeros
and an empty ``groups_sha256``.  Each row is a document of its own, whatever its id (nulls and repeats too); the
empty table gives the empty table.  Other columns are ignored.  Special tokens' strings inside texts are text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import null_text, partitions, stored
from labelkiln.session import ship_package

BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 4_000_000
BATCH_CHARS = 1_000_000
#: The pre-tokenizing pattern of byte-level BPE (fixed value of that vocabulary).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
INDEX_SCHEMA = ("block long, pos int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                "groups_sha256 string, a int, b int, plane int, n int, dense boolean, bits binary")


class ByteBpe:
    """A byte-level BPE of a ``tokenizers`` JSON file: ids by its vocabulary as ranks, token bytes by its alphabet."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        special = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special}
        self.table = [b""] * (max([*ranks.values(), *special]) + 1)
        for t, i in ranks.items():
            self.table[i] = t
        self._encode = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encode(" " + t) for t in texts]


class PieceBpe:
    """A sentencepiece model; it puts the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.table = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in ids)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both sides and their lookup tables, once per worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = (ByteBpe(p) if p.endswith(".json") else PieceBpe(p) for p in (path_a, path_b))
        self.size_a, self.size_b = np.array([len(t) for t in self.a.table]), np.array([len(t) for t in self.b.table])
        self.ids = max(len(self.size_a), len(self.size_b))
        self.written = [f"{i}{end}" for end in ",|;" for i in range(self.ids)]

    def batch(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text ``(n_a, n_b, n_groups, n_links, groups)``, and per link the number of its text, its A and B id."""
        none = np.zeros(0, np.int64)
        a, b = self.a.encode(texts), self.b.encode(texts)
        get_a, get_b = self.a.table.__getitem__, self.b.table.__getitem__
        for k, t in enumerate(texts):
            raw = (" " + t).encode() if t else None
            if b"".join(map(get_a, a[k])) != raw or b"".join(map(get_b, b[k])) != raw:
                a[k], b[k] = [], []
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a, b = (np.concatenate([none, *(np.array(x, np.int64) for x in s if x)]) for s in (a, b))
        if not len(a):
            return [(0, 0, 0, 0, "") for _ in texts], none, none, none
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        closes_a, closes_b = end_a[at_a] == ends, end_b[at_b] == ends
        shared = closes_a & closes_b
        group = np.cumsum(shared) - shared
        doc = np.repeat(np.arange(len(texts)), n_a)[at_a]
        # the tokens of a group: its A ids, then its B ids, each with the sign that follows it
        place = np.concatenate([2 * group[closes_a], 2 * group[closes_b] + 1])
        order = np.argsort(place, kind="stable")
        place, token = place[order], np.concatenate([a, b])[order]
        last = np.append(place[1:] != place[:-1], True)
        signs = np.where(last, 1 + place % 2, 0) * self.ids + token
        upto = np.cumsum(n_a + n_b)
        text_groups = np.bincount(doc, shared, len(texts)).astype(np.int64)
        text_links = np.bincount(doc, minlength=len(texts))
        out = []
        for k in range(len(texts)):
            codes = signs[upto[k] - n_a[k] - n_b[k] : upto[k]].tolist()
            out.append((int(n_a[k]), int(n_b[k]), int(text_groups[k]), int(text_links[k]),
                        "".join(map(self.written.__getitem__, codes))[:-1]))
        return out, doc, a[at_a], b[at_b]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def pack_bitmaps(pair: np.ndarray, pos: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
    """Compressed bitmaps of entries sorted by (pair, pos): ``pairs, cardinalities, dense, offsets, bytes``."""
    pairs, first, n = np.unique(pair, return_index=True, return_counts=True)
    width = -(-docs // 8)
    dense = 2 * n > width
    offsets = np.concatenate([[0], np.cumsum(np.where(dense, width, 2 * n))])
    data = np.zeros(offsets[-1], np.uint8)
    of = np.repeat(np.arange(len(pairs)), n)
    bit = dense[of]
    at = offsets[of[~bit]] + 2 * (np.arange(len(pair)) - first[of])[~bit]
    data[at], data[at + 1] = pos[~bit] & 255, pos[~bit] >> 8
    np.add.at(data, offsets[of[bit]] + (pos[bit] >> 3), (1 << (pos[bit] & 7)).astype(np.uint8))
    return pairs, n, dense, offsets, data


def unpack_bitmaps(dense: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``row, pos`` of every set bit of the bitmaps."""
    rows, places = [], []
    size = np.diff(offsets)
    sparse = np.flatnonzero(~dense & (size > 0))
    if len(sparse):
        n = size[sparse] // 2
        start = np.repeat(offsets[:-1][sparse] - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(n.sum())
        rows.append(np.repeat(sparse, n))
        places.append(data[start].astype(np.int64) | data[start + 1].astype(np.int64) << 8)
    for k in np.flatnonzero(dense):
        pos = np.flatnonzero(np.unpackbits(data[offsets[k] : offsets[k + 1]], bitorder="little"))
        rows.append(np.full(len(pos), k))
        places.append(pos)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *places])


class _Block:
    """The documents and postings of one block of a task."""

    def __init__(self, number: int, ids_b: int):
        self.number, self.ids_b, self.docs, self.keys, self.times, self.entries = number, ids_b, [], [], [], 0

    def add(self, ids: list, told: list[tuple], doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        # documents of a batch are new to the block, so its merged bitmaps are the union of the batches' entries
        keys, times = np.unique((a * self.ids_b + b) << 16 | (doc + len(self.docs)), return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.entries += len(keys)
        self.docs += [(i, *t[:4], hashlib.sha256(t[4].encode()).hexdigest() if t[0] else "")
                      for i, t in zip(ids, told, strict=True)]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        doc_id, n_a, n_b, n_groups, n_links, digest = zip(*self.docs, strict=True)
        yield self._batch(schema, len(self.docs), pos=range(len(self.docs)), doc_id=doc_id, n_a=n_a, n_b=n_b,
                          n_groups=n_groups, n_links=n_links, groups_sha256=digest)
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")
        keys, more, plane = keys[order], times[order] - 1, 0
        held = np.ones(len(keys), bool)
        while held.any():
            pairs, n, dense, offsets, data = pack_bitmaps(keys[held] >> 16, keys[held] & 0xFFFF, len(self.docs))
            for lo in range(0, len(pairs), 50_000):
                hi = min(lo + 50_000, len(pairs))
                cut = offsets[lo : hi + 1] - offsets[lo]
                bits = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer(cut.astype("<i4").tobytes()), pa.py_buffer(data[offsets[lo] : offsets[hi]].tobytes())])
                yield self._batch(schema, hi - lo, a=pairs[lo:hi] // self.ids_b, b=pairs[lo:hi] % self.ids_b,
                                  plane=np.full(hi - lo, plane), n=n[lo:hi], dense=dense[lo:hi], bits=bits)
            held, plane = (more >> plane & 1).astype(bool), plane + 1

    def _batch(self, schema: pa.Schema, rows: int, **given) -> pa.RecordBatch:
        given["block"] = np.full(rows, self.number)
        columns = [pa.array(given[f.name], f.type) if f.name in given and f.name != "bits"
                   else given.get(f.name, pa.nulls(rows, f.type)) for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(","))])


def pair_index(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: a row per document (``plane`` null) and a bitmap per (block, pair, plane)."""
    ship_package(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, schema = aligner(path_a, path_b), _arrow_schema(INDEX_SCHEMA)
        task, seq, block = TaskContext.get().partitionId(), 0, None
        for rb in batches:
            ids, texts = rb.column(0).to_pylist(), rb.column(1).to_pylist()
            lo = 0
            while lo < len(ids):
                block = block or _Block(task << 32 | seq, len(both.size_b))
                hi, chars = lo, 0
                while hi < len(ids) and chars < BATCH_CHARS and len(block.docs) + hi - lo < BLOCK_DOCS:
                    chars, hi = chars + len(texts[hi]), hi + 1
                block.add(ids[lo:hi], *both.batch(texts[lo:hi]))
                lo = hi
                if block.entries >= BLOCK_LINKS or len(block.docs) >= BLOCK_DOCS:
                    yield from block.rows(schema)
                    seq, block = seq + 1, None
        if block:
            yield from block.rows(schema)

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), null_text(F.col(text_col)).alias("text"))
    return stored(plain.mapInArrow(build, INDEX_SCHEMA), "pair-index")


def pair_table(index: DataFrame) -> DataFrame:
    """``a, b, docs, links, best``: in how many documents a pair is linked, how often, and whether no B id is
    linked with the A id in more documents."""
    weight = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(
        F.expr("shiftleft(1L, greatest(plane - 1, 0))"))
    counts = index.filter("plane IS NOT NULL").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n").cast("long"))).alias("docs"),
        F.sum(F.col("n") * weight).alias("links"))
    counts = stored(counts, "pair-counts")
    top = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(top, "a").select("a", "b", "docs", "links", (F.col("docs") == F.col("most")).alias("best"))


def returned_scores(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """The document rows of the index with ``n_best`` and ``count_sum``, added up from the postings."""
    postings = index.filter("plane IS NOT NULL").select("block", "a", "b", "plane", "dense", "bits").join(
        pairs.select("a", "b", "docs", "best"), ["a", "b"]).drop("a", "b")
    doc_cols = ["pos", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = postings.unionByName(index.filter("plane IS NULL").select("block", *doc_cols), allowMissingColumns=True)
    out_schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, " \
                 "groups_sha256 string"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, block = _arrow_schema(out_schema), None
        best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
        for rb in batches:
            number = rb.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if number[lo] != block:
                    block = number[lo]
                    best[:], total[:] = 0, 0
                some = rb.slice(lo, hi - lo)
                # postings come before the documents of their block
                held = some.filter(some.column("plane").is_valid())
                if held.num_rows:
                    bits = held.column("bits")
                    offsets = np.frombuffer(bits.buffers()[1], "<i4")[bits.offset : bits.offset + len(bits) + 1].astype(np.int64)
                    row, pos = unpack_bitmaps(held.column("dense").to_numpy(zero_copy_only=False), offsets,
                                              np.frombuffer(bits.buffers()[2], np.uint8))
                    plane = held.column("plane").to_numpy()
                    times = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0)).astype(np.int64)
                    np.add.at(total, pos, (times * held.column("docs").to_numpy())[row])
                    np.add.at(best, pos, (times * held.column("best").to_numpy(zero_copy_only=False))[row])
                docs = some.filter(some.column("plane").is_null())
                if docs.num_rows:
                    pos = docs.column("pos").to_numpy()
                    sums = {"n_best": pa.array(best[pos]), "count_sum": pa.array(total[pos])}
                    yield pa.RecordBatch.from_arrays(
                        [sums[f.name] if f.name in sums else docs.column(f.name) for f in schema], schema=schema)

    return (rows.repartition(partitions(index.sparkSession), "block")
            .sortWithinPartitions("block", F.col("plane").isNull()).mapInArrow(score, out_schema))


def alignment_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The digest columns of ``op12``."""
    index = pair_index(docs, path_a, path_b)
    return returned_scores(index, stored(pair_table(index), "pairs"))
