"""Fingerprints over the whole text, and the scores of both classifiers, recomputed without Spark's arrays."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.llm import fingerprints, quality, toxicity

POS = (1 << 28) - 1
MASK = ((1 << 63) - 1) & ~POS


def plain_signature(spark, text, bins=64, size=2, k=3):
    """Every element visits all bins, each bin takes its first ``size`` visits."""
    words = text.split()
    grams = [words[i:i + k] for i in range(max(1, len(words) - k + 1))]
    grams = [g + [None] * (k - len(g)) for g in grams]
    df = spark.createDataFrame(list(enumerate(grams)), "i int, g array<string>")
    h = {r.i: r.h & MASK for r in df.select("i", F.xxhash64(*[F.col("g")[j] for j in range(k)]).alias("h")).collect()}
    count, again = Counter(), []
    for i, g in enumerate(grams):
        again.append((i, h[i] >> 28, count[tuple(g)]))
        count[tuple(g)] += 1
    own = {r.i: r.h & MASK for r in spark.createDataFrame(again, "i int, v long, j int").select(
        "i", F.xxhash64("v", "j").alias("h")).collect()}
    elements = sorted((h[i] if j == 0 else own[i]) | i for i, _, j in again)
    rounds = spark.createDataFrame([(n, x >> 28) for n, x in enumerate(elements)], "n int, v long").select(
        "n", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("r"), "v").select("n", "r", F.xxhash64("v", "r").alias("h"))
    visits = defaultdict(list)
    for n, x in enumerate(elements):
        visits[x >> 57].append((0, 0, n))
    for r in rounds.collect():
        x = elements[r.n]
        visits[((x >> 57) + r.r * (2 * (x >> 28 & 31) + 1)) % bins].append((r.r, (r.h % (1 << 64)) >> 41, r.n))
    runs = [(b, sorted((elements[n] for _, _, n in sorted(visits[b])[:size]), key=lambda x: x & POS)) for b in sorted(visits)]
    hashed = spark.createDataFrame([(b, [x >> 28 for x in run]) for b, run in runs], "b int, xs array<long>")
    return sorted(r.b << 32 | (r.h & 0xFFFFFFFF) for r in hashed.select("b", F.hash("xs").alias("h")).collect())


@pytest.mark.parametrize("n, letters", [(1, "abcdefgh"), (2, "abcdefgh"), (4, "abcdefgh"), (25, "ab"), (90, "abc"), (400, "abcdefgh")])
def test_whole_text_signature(spark, n, letters):
    rnd = random.Random(n)
    text = " ".join("".join(rnd.choices(letters, k=2)) for _ in range(n))
    got = spark.createDataFrame([(text,)], "t string").select(
        fingerprints.order_minhash(F.col("t"), whole=True).alias("s")).first().s
    assert sorted(got) == plain_signature(spark, text)


def labelled(spark):
    rnd = random.Random(11)
    rows, lab = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(3, 8))) for _ in range(rnd.randint(5, 60))]
        rows.append((i, " ".join(words + ["vile", "wretched", "insult"] * bad) if i % 50 else None, "en", "s", 0))
        lab.append((i, int(not bad), int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(lab, "doc_id long, quality int, toxic int"), rows)


def test_toxic_scores_by_hand(spark):
    """Savings of each window measured with plain zstandard calls, then the model's weights and curve."""
    docs, lab, rows = labelled(spark)
    model = toxicity.fit_toxic(docs, lab)
    got = {r.doc_id: r.score for r in toxicity.score_toxic(docs, model).collect()}
    tried = toxicity.Savings(model.ordinary, model.toxic)
    for i, text, *_ in rows[:60]:
        x = np.array(tried.features(text), float)
        score = float(np.interp(x @ np.array(model.weights[:-1]) + model.weights[-1], model.x, model.y))
        assert got[i] == pytest.approx(score)
        assert 0 <= got[i] <= 1
    assert np.mean([got[i] for i in range(0, 300, 3)]) > np.mean([got[i] for i in range(1, 300, 3)])


def test_quality_is_learned_without_held_out_rows(spark):
    docs, lab, _ = labelled(spark)
    got = quality.quality_report(docs, lab).collect()
    flipped = lab.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                               1 - F.col("quality")).otherwise(F.col("quality")))
    other = {r.doc_id: r.score for r in quality.quality_report(docs, flipped).collect()}
    assert all(r.score == pytest.approx(other[r.doc_id]) for r in got)
