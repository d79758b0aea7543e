"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text, an ordinary one and a toxic one.  The toxic one is trained on what
telling about toxic text: its stretches whose 6-byte sequences are many times as frequent there as in the ordinary
sample, by share of texts; its size is that of the distinct stretches.  A text is cut into overlapping windows; each is compressed
with the ordinary dictionary and with both, and a window counts as suspect from a saving of ``STEP`` bytes
on.  A logistic curve over the windows' savings (largest, mean, shares of suspect windows) and then isotonic
regression turn them into a score; both are fitted on savings under dictionaries of the other half of the sample.

Labels are learned from at most ``SAMPLE`` toxic and twice as many ordinary documents, taken in the order of
a hash of their ids (a documented bound; scoring covers every window of every document).  Only the text is an input of a
score.

Defined results: null and empty texts have no window and score as a text without savings; where the
labelled rows are not of both classes nothing can be learned and every score is 0.0; rows that repeat an id
are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import held_out, isotonic, null_text
from labelkiln.session import ship_package

WINDOW, HOP, STEP = 128, 112, 2
SAMPLE = 2000
MER = 6
SMOOTH, RATIO = 1.0, 8.0
#: Both dictionaries together stay within the compressor's window of 2**18 bytes.
ORDINARY_BYTES, TOXIC_BYTES = 1 << 17, (1 << 17) - WINDOW
THRESHOLD = 0.3


@dataclass
class ToxicModel:
    ordinary: bytes
    toxic: bytes
    weights: list[float]
    x: list[float]
    y: list[float]
    key: int = field(default=0)


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def windows(raw: bytes) -> list[bytes]:
    return [raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - (WINDOW - HOP)), HOP)] if raw else []


class Savings:
    """What a toxic dictionary saves on each window of a text, in bytes."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as z

        how = z.ZstdCompressionParameters(
            window_log=18, chain_log=17, hash_log=17, search_log=4, min_match=4, target_length=32,
            strategy=z.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False)

        def compressor(content: bytes):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            return z.ZstdCompressor(dict_data=d, compression_params=how).compress

        self.plain, self.both = compressor(ordinary), compressor(ordinary + toxic)

    def features(self, text: str | None) -> list[float]:
        ws = windows(lowered(text))
        if not ws:
            return [0.0] * 5
        s = np.array([len(self.plain(w)) - len(self.both(w)) for w in ws], float)
        n = len(s)
        suspect = [(s >= t).sum() for t in (STEP, STEP + 1)]
        return [min(s.max(), 12.0), s.mean(), np.sqrt(suspect[0] / (n + 1.0)), np.sqrt(suspect[1] / (n + 1.0)),
                np.log1p(suspect[1])]


_SAVINGS: dict[int, Savings] = {}


def _savings(model: ToxicModel) -> Savings:
    if model.key not in _SAVINGS:
        _SAVINGS.clear()
        _SAVINGS[model.key] = Savings(model.ordinary, model.toxic)
    return _SAVINGS[model.key]


def _mers(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = len(a) - MER + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(MER if n > 0 else 0):
        out |= a[j : j + n] << np.uint64(8 * j)
    return out


def _by_texts(texts: list[bytes], among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The 6-byte sequences (of ``among``) and in how many texts each occurs; 500 texts at a time."""
    mers, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for lo in range(0, len(texts), 500):
        each = [np.unique(_mers(t)) for t in texts[lo : lo + 500]]
        new, n = np.unique(np.concatenate([m if among is None else m[_among(m, among)] for m in each]), return_counts=True)
        both, at = np.unique(np.concatenate([mers, new]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
        mers = both
    return mers, counts


def telling_stretches(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The stretches of toxic texts whose 6-byte sequences recur there and are ``RATIO`` times as frequent (smoothed shares
    of texts) as in the ordinary texts; a few mislabelled or quoting ordinary texts do not remove a sequence."""
    each, texts = _by_texts(toxic)
    recur = texts >= min(2, len(toxic))
    each, texts = each[recur], texts[recur]
    plain = np.zeros(len(each))
    known, n = _by_texts(ordinary, each)
    plain[np.searchsorted(each, known)] = n
    ratio = np.log((texts + SMOOTH) / (len(toxic) + 2 * SMOOTH)) - np.log((plain + SMOOTH) / (len(ordinary) + 2 * SMOOTH))
    telling, out = each[ratio >= np.log(RATIO)], []
    for raw in toxic:
        edge = np.diff(_among(_mers(raw), telling).astype(np.int8), prepend=0, append=0)
        out += [raw[a : b + MER - 1] for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
    return out


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except (z.ZstdError, ValueError):  # too little text to train on: it is the dictionary itself
        return b"".join(samples)[-size:] or b" "


def train_dictionaries(texts: pd.Series, y: pd.Series) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries."""
    raw = {v: [lowered(t) for t in texts[y == v]] for v in (0, 1)}
    ordinary = _trained([w for t in raw[0] for w in windows(t)], ORDINARY_BYTES, 64, 8)
    stretches = telling_stretches(raw[1], raw[0])
    return ordinary, _trained(stretches, min(TOXIC_BYTES, max(256, sum(map(len, set(stretches))))), 16, 6)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, learn, per_class: int, id_col: str,
                    text_col: str, label_id: str) -> pd.DataFrame:
    """Up to ``per_class`` toxic and twice as many ordinary labelled texts, in the order of a hash of the id: the bounded sample."""
    lab = labels.select(F.col(label_id).alias("_id"), F.col(target).cast("int").alias("y")).filter(
        F.col("_id").isNotNull() & F.col("y").isin(0, 1)).filter(learn(F.col("_id"))).withColumn("u", F.xxhash64("_id"))
    # one row an id: repeated label rows count once, and an id labelled both ways counts as toxic
    lab = lab.groupBy("_id", "u").agg(F.max("y").alias("y"))
    top = [lab.filter(F.col("y") == v).orderBy("u", "_id").limit(per_class * (2 - v)) for v in (0, 1)]
    ids = {r[0]: r[1] for r in top[0].unionByName(top[1]).select("_id", "y").collect()}
    if not ids:
        return pd.DataFrame({"_id": [], "text": [], "y": []})
    found = docs.select(F.col(id_col).alias("_id"), null_text(F.col(text_col)).alias("text"))
    # of rows that repeat an id the smallest text, found before anything is fetched
    rows = found.filter(F.col("_id").isin(list(ids))).groupBy("_id").agg(F.min("text").alias("text")).toPandas()
    rows = rows.sort_values("_id")
    return rows.assign(y=rows["_id"].map(ids), u=np.random.RandomState(7).permutation(len(rows))).sort_values("u")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-penalized logistic weights (Newton steps); the last one is the constant."""
    x = np.c_[x, np.ones(len(x))]
    w, keep = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_id: str = "doc_id", target: str = "toxic", learn=None, sample: int = SAMPLE) -> ToxicModel | None:
    """``learn`` tells from the id which labels may be used (default: the rows that are not held out)."""
    learn = learn or (lambda c: ~held_out(c, 4, 2))
    s = labelled_sample(docs, labels, target, learn, sample, id_col, text_col, label_id)
    y, fold = s["y"].to_numpy(float), np.arange(len(s)) % 2
    if len(s) < 4 or any(len(set(y[fold == f])) < 2 for f in (0, 1)):
        return None
    x = np.zeros((len(s), 5))
    for f in (0, 1):
        tried = Savings(*train_dictionaries(s["text"][fold != f], s["y"][fold != f]))
        x[fold == f] = [tried.features(t) for t in s["text"][fold == f]]
    w = logistic(x, y)
    # the sample is taken by class, so each class is weighed back to its share of the rows learned from
    counts = labels.filter(F.col(label_id).isNotNull() & F.col(target).isin(0, 1)).filter(learn(F.col(label_id))).groupBy(label_id).agg(
        F.max(F.col(target).cast("int")).alias("y")).groupBy("y").count().collect()
    share = {r[0]: r[1] for r in counts}
    weigh = np.where(y == 1, share[1] / y.sum(), share[0] / (1 - y).sum())
    xs, ys = isotonic(np.c_[x, np.ones(len(x))] @ w, y, weigh / weigh.mean())
    ordinary, toxic = train_dictionaries(s["text"], s["y"])
    return ToxicModel(ordinary, toxic, w.tolist(), xs, ys, hash((ordinary, toxic)))


def score_toxic(docs: DataFrame, model: ToxicModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, saving, score`` for every row of ``docs``; ``saving`` is the largest of any window."""
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return slim.select("doc_id", F.lit(0.0).alias("saving"), F.lit(0.0).alias("score"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, w = _savings(model), np.array(model.weights)
        for b in batches:
            x = np.array([m.features(t) for t in b["text"]], float).reshape(len(b), 5)
            yield pd.DataFrame({"doc_id": b["doc_id"], "saving": x[:, 0],
                                "score": np.interp(x @ w[:-1] + w[-1], model.x, model.y)})

    return slim.mapInPandas(score, f"doc_id {dict(slim.dtypes)['doc_id']}, saving double, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns of ``op8``."""
    s = score_toxic(docs, fit_toxic(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
