"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Every text is reduced to ``len(STATS)`` statistics (lengths, shares of character kinds, repetition of words
and lines).  Random Fourier features of the standardized statistics approximate a Gaussian kernel; each
task sums its part of the normal equations, Spark adds the parts up, and the driver solves one system of
``FEATURES + 1`` unknowns.  Ridge scores of labelled rows that were kept apart are gathered in a fixed number of
bins, and isotonic regression over the bins gives the score.

Texts are read once and never shuffled: what meets the labels is the table of statistics.

Defined results: null text counts as empty, and empty texts have statistics of their own (all zero), so they get
a score like any text; without learnable labels of both classes every score is 1.0 (nothing is rejected);
rows that repeat an id are scored each, and a label that repeats counts once per row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import STRIPE_SCHEMA, held_out, isotonic, null_text, stored, striped, summed
from labelkiln.session import ship_package

STATS = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "stop", "mark", "symbol", "high",
         "distinct", "top_word", "next_same", "line_words", "line_repeats", "mark_pairs")
FEATURES, WIDTH, RIDGE, SEED, BINS = 256, 3.0, 1.0, 11, 2000
THRESHOLD = 0.3

_KIND = np.full(256, 6, np.uint8)                      # 6: other symbols
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                      (b" \t\n\x0b\x0c\r", 3), (b".,;:", 4), (b"!?'\"()-", 5)):
    _KIND[list(_chars)] = _kind
_KIND[128:] = 7                                        # bytes of characters beyond ASCII


def text_stats(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(STATS)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8) / len(raw)
    words = raw.split()
    n = max(1, len(words))
    seen = Counter(words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    codes = np.frombuffer(raw, np.uint8)
    marks = (_KIND[codes] == 5) | (_KIND[codes] == 6)
    return [np.log1p(len(raw)), np.log1p(len(words)), min(sum(map(len, words)) / n, 40.0),
            kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7],
            len(seen) / n / (1 + np.log(n)) * 4, max(seen.values(), default=0) / n, same / n,
            np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
            float((marks[1:] & marks[:-1]).mean()) if len(raw) > 1 else 0.0]


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats``."""
    ship_package(docs.sparkSession)

    def stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "stats": [[float(v) for v in text_stats(t)] for t in b["text"]]})

    slim = docs.select(F.col(id_col).alias("doc_id"), null_text(F.col(text_col)).alias("text"))
    return slim.mapInPandas(stats, f"doc_id {dict(slim.dtypes)['doc_id']}, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    x: list[float]
    y: list[float]

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        rff = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.c_[rff, np.ones(len(z))]

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(stats), self.x, self.y)


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_list()) if len(col) else np.zeros((0, len(STATS)))


def fit_quality(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id", target: str = "quality",
                learn=None) -> QualityModel | None:
    """``stats``: the table of ``with_stats``; ``learn`` tells from the id which labels may be used."""
    learn = learn or (lambda c: ~held_out(c, 5, 0))
    lab = labels.select(F.col(label_id).alias("_id"), F.col(target).cast("int").alias("y")).filter(
        F.col("_id").isNotNull() & F.col("y").isin(0, 1)).filter(learn(F.col("_id")))
    # a quarter of the labelled rows is kept for calibration
    apart: Column = F.pmod(F.xxhash64("_id", F.lit("calibrate")), F.lit(4)) == 0
    rows = stored(stats.join(lab, stats["doc_id"] == lab["_id"]).select("stats", "y", apart.alias("apart")), "labelled")
    n = len(STATS)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, n))
        for b in batches:
            m = _matrix(b["stats"])
            total += [m.sum(axis=0), (m * m).sum(axis=0), [len(m), b["y"].sum(), *[0.0] * (n - 2)]]
        yield from striped(total)

    s1, s2, (count, good, *_) = summed(rows.mapInPandas(moments, STRIPE_SCHEMA), (3, n))
    if not 0 < good < count:
        return None
    mean = s1 / count
    scale = np.sqrt(np.maximum(s2 / count - mean**2, 1e-12)) + 1e-6
    rng = np.random.RandomState(SEED)
    model = QualityModel(mean, scale, rng.normal(size=(n, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES),
                         np.zeros(FEATURES + 1), [], [])
    d = FEATURES + 1

    def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d + 1))
        for b in batches:
            z = model.features(_matrix(b["stats"]))
            total += z.T @ np.c_[z, b["y"].to_numpy(float)]
        yield from striped(total)

    eq = summed(rows.filter("NOT apart").mapInPandas(normal, STRIPE_SCHEMA), (d, d + 1))
    model.weights = np.linalg.solve(eq[:, :d] + RIDGE * np.diag([*[1.0] * FEATURES, 1e-6]), eq[:, d])

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, BINS))
        for b in batches:
            at = np.clip(((model.ridge(_matrix(b["stats"])) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            total += [np.bincount(at, minlength=BINS), np.bincount(at, b["y"].to_numpy(float), BINS)]
        yield from striped(total)

    cases, ones = summed(rows.filter("apart").mapInPandas(bins, STRIPE_SCHEMA), (2, BINS))
    hit = np.flatnonzero(cases)
    if not len(hit):
        model.x, model.y = [0.0, 1.0], [0.0, 1.0]
    else:
        model.x, model.y = isotonic((hit + 0.5) / BINS * 2 - 0.5, ones[hit] / cases[hit], cases[hit])
    return model


def score_stats(stats: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id, score`` for every row of ``stats``."""
    if model is None:
        return stats.select("doc_id", F.lit(1.0).alias("score"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": model.score(_matrix(b["stats"]))})

    return stats.mapInPandas(score, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns of ``op10``."""
    stats = stored(with_stats(docs), "stats")
    s = score_stats(stats, fit_quality(stats, labels))
    return s.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the documents that score under the threshold.

    The fitted model goes to the rows: texts are scored where they are read, and nothing is joined back.
    """
    model = fit_quality(stored(with_stats(docs, id_col, text_col), "stats"), labels)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([text_stats(t) for t in text], float).reshape(len(text), len(STATS))))

    return docs.filter(score(null_text(F.col(text_col))) >= THRESHOLD)
