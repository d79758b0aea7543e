"""Token ids of documents in Simple-8b files.

Documents are dealt out in blocks of consecutive ids (one exchange of the texts) and every task
tokenizes its blocks in id order and writes them as rows of whole documents, about ``CHUNK_IDS`` ids
each: the packed words, the word offsets of the coding's blocks, the escapes, and the documents' ids
and lengths.  Spark's writer puts the rows into Parquet files, so the commit protocol covers lost
executors and any file system that Spark reaches will do.

Tokenizing: white space runs belong to what follows them, so a text can be cut before each run that follows
another character without changing any id; each task asks the tokenizer only for pieces that it
has not met, ``RUN`` of them in one text, and puts the answers together.  The table of pieces is bounded (``KNOWN``) and
only saves time.

Defined results: null text counts as empty, an empty text has the end id alone, null ids come first, rows
that repeat an id follow each other in the order of the hash of their texts.  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkiln.llm import simple8b
from labelkiln.llm.common import LOWEST, block_of, null_text, partitions, scratch, upper_splitters
from labelkiln.session import ship_package

CHUNK_IDS = 1 << 16
KNOWN = 800_000
RUN = 500
END_ID = 0
FILE_SCHEMA = ("block int, seq int, id_start long, n_ids long, words binary, offsets binary, escape_at binary, "
               "escapes binary, doc_ids binary, null_ids binary, lengths binary")
# White space as the tokenizer's pattern knows it: Python's adds four separators, which are left out.
_PIECES = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_SPACES = frozenset(re.findall(r"[^\S\x1c-\x1f]", "".join(map(chr, range(0x3100)))))


def _put(store: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` behind the first ``used`` values; the room doubles when it is short."""
    if used + len(more) > len(store):
        store = np.concatenate([store[:used], np.zeros(max(used, len(more)), store.dtype)])
    store[used : used + len(more)] = more
    return store


class _Numbers(dict):
    """The number of every piece; one that has none gets the next and stands in ``new``."""

    def __init__(self, pieces: list[str]):
        super().__init__(zip(pieces, range(len(pieces)), strict=True))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        number = self[piece] = len(self)
        return number


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    Every piece that was met has a number, and its ids stand in one long array.  When more than ``KNOWN`` pieces are
    known, those that were not met again since the last time are given up.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # a character of the byte-level alphabet is one byte; strings of added tokens are written as they are
        added = self.tokenizer.get_added_tokens_decoder()
        self.length = np.array([len(added[i].content.encode()) if i in added else len(self.tokenizer.id_to_token(i) or "")
                                for i in range(size)], np.int64)
        self.known = _Numbers([])
        self.start, self.count, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids, self.used = np.zeros(0, "<u4"), 0

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, first: int, new: list[str]) -> None:
        """Ids of the pieces ``new``, which have the numbers from ``first`` on."""
        # pieces that begin with white space and end without may stand behind each other; the others stand alone
        follows = np.array([p[0] in _SPACES and p[-1] not in _SPACES for p in new], bool)
        behind, alone = list(compress(new, follows)), list(compress(new, ~follows))
        parts, counts = [], []
        runs = ["".join(behind[lo : lo + RUN]) for lo in range(0, len(behind), RUN)]
        for lo, ids in zip(range(0, len(behind), RUN), self._encoded(runs), strict=True):
            ends = np.cumsum([len(p.encode()) for p in behind[lo : lo + RUN]])
            upto = np.searchsorted(np.cumsum(self.length[ids]), ends, side="right")
            parts.append(ids)
            counts.append(np.diff(upto, prepend=0))
        for ids in self._encoded(alone):
            parts.append(ids)
            counts.append(np.array([len(ids)]))
        count = np.concatenate([np.zeros(0, np.int64), *counts])
        place = np.empty(len(new), np.int64)
        place[np.r_[np.flatnonzero(follows), np.flatnonzero(~follows)]] = np.arange(len(new))
        self.start = _put(self.start, first, (self.used + np.cumsum(count) - count)[place])
        self.count = _put(self.count, first, count[place])
        self.met = _put(self.met, first, np.zeros(len(new), bool))
        self.ids, self.used = _put(self.ids, self.used, np.concatenate(parts)), self.used + int(count.sum())

    def _forget(self) -> None:
        kept = [p for p, code in self.known.items() if self.met[code]]
        if len(kept) > KNOWN // 2:
            kept = []
        codes = np.array([self.known[p] for p in kept], np.int64)
        ids = self._gather(codes)
        self.known = _Numbers(kept)
        self.count = self.count[codes]
        self.start, self.met, self.ids, self.used = np.cumsum(self.count) - self.count, np.zeros(len(kept), bool), ids, len(ids)

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        n = self.count[codes]
        return self.ids[np.repeat(self.start[codes] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KNOWN:
            self._forget()
        cut = [_PIECES.findall(t) for t in texts]
        first = len(self.known)
        codes = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64)
        self.met[codes[codes < first]] = True
        if self.known.new:
            self._learn(first, self.known.new)
            self.known.new = []
        flat = self._gather(codes)
        upto = np.cumsum(np.bincount(np.repeat(np.arange(len(cut)), [len(p) for p in cut]), self.count[codes],
                                     len(cut)).astype(np.int64))
        return [part.tobytes() for part in np.split(flat, upto[:-1])] if cut else []


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _row(block: int, seq: int, id_start: int, docs: list[tuple], encoded: list[bytes]) -> tuple:
    ids = np.frombuffer(b"".join(encoded), "<u4")
    words, offsets, escape_at, escapes = simple8b.encode(ids)
    return (block, seq, id_start, len(ids), words.astype("<u8").tobytes(), offsets.astype("<u4").tobytes(),
            escape_at.astype("<u4").tobytes(), escapes.astype("<u8").tobytes(),
            np.array([d if d is not None else LOWEST for d in docs], "<i8").tobytes(),
            np.array([d is None for d in docs], "u1").tobytes(),
            np.array([len(e) // 4 for e in encoded], "<u4").tobytes())


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Write the ids of all documents, an end id after each, in ascending id order."""
    spark = docs.sparkSession
    ship_package(spark)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), null_text(F.col(text_col)).alias("text"))
    keyed = keyed.withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    cuts = upper_splitters(keyed, "key", 4 * partitions(spark))
    end = np.array([END_ID], "<u4").tobytes()

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        block, seq, start, size, ids, parts, rows = None, 0, 0, 0, [], [], []
        for b in batches:
            # a few texts at a time: the pieces of a batch are in memory together
            for lo in range(0, len(b), 128):
                some = b.iloc[lo : lo + 128]
                coded = enc(some["text"].tolist())
                for at, doc, got in zip(some["block"], some["doc_id"], coded, strict=True):
                    if parts and (at != block or size >= CHUNK_IDS):
                        rows.append(_row(block, seq, start, ids, parts))
                        start, seq, size, ids, parts = start + size, seq + 1, 0, [], []
                    if at != block:
                        block, seq, start = at, 0, 0
                    ids.append(None if pd.isna(doc) else int(doc))
                    parts.append(got + end)
                    size += len(got) // 4 + 1
                if len(rows) >= 8:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        if parts:
            rows.append(_row(block, seq, start, ids, parts))
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = [c.split()[0] for c in FILE_SCHEMA.split(",")]
    (keyed.withColumn("block", block_of(F.col("key"), cuts))
     .repartition(partitions(spark), "block")
     .sortWithinPartitions("block", "key", F.xxhash64("text"), "text")
     .select("block", F.col("doc_id").cast("long"), "text")
     .mapInPandas(code, FILE_SCHEMA).write.parquet(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document of the files."""
    ship_package(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # one number a block: as many as the writer made blocks
    sizes = {r[0]: r[1] for r in files.groupBy("block").agg(F.sum("n_ids")).collect()}
    before, total = {}, 0
    for b in sorted(sizes):
        before[b], total = total, total + sizes[b]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                ids = simple8b.decode(np.frombuffer(r.words, "<u8"), np.frombuffer(r.offsets, "<u4"), r.n_ids,
                                      np.frombuffer(r.escape_at, "<u4"), np.frombuffer(r.escapes, "<u8"))
                raw, n = ids.astype("<u4"), np.frombuffer(r.lengths, "<u4").astype(np.int64)
                ends = np.cumsum(n)
                doc = pd.array(np.frombuffer(r.doc_ids, "<i8"), dtype="Int64")
                doc[np.frombuffer(r.null_ids, "u1").astype(bool)] = pd.NA
                spans = [raw[e - k : e] for e, k in zip(ends, n, strict=True)]
                out = pd.DataFrame({"doc_id": doc, "start": before[r.block] + r.id_start + ends - n, "n_tokens": n,
                                    "ids_crc32": [zlib.crc32(s) for s in spans]})
                yield out.assign(ids=[s.astype(np.int64) for s in spans]) if with_ids else out

    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long"
                             + (", ids array<long>" if with_ids else ""))


def token_report(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """The digest columns of ``op3``: written in the file format, then read from the files."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_token_files(docs, tokenizer, path)
    return read_token_files(spark, path)
