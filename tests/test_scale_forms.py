"""Forms that hold at size: statistics of many rules, accelerated EM, frequent tokens, batches, streams, audits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.operators import corpus as C
from labelkiln.operators import labelmodel as LM
from labelkiln.operators import learn as L
from labelkiln.operators import pairs as P
from labelkiln.operators import rules as R
from labelkiln.operators import vector as VO
from labelkiln.operators.tokens import frequent, looked_up
from labelkiln.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def jobs():
    registry.load_all()
    return registry.JOBS


def many_votes(spark, rules=200, rows=300, seed=1):
    rnd = random.Random(seed)
    names = [f"r{j}" for j in range(rules)]
    data = [(i, rnd.choice([None, "x", "y"]), *[rnd.choice("xyz") if rnd.random() < 0.02 else None for _ in names])
            for i in range(rows)]
    return spark.createDataFrame(data, "id long, gold string, " + ", ".join(f"{n} string" for n in names)), names, data


def test_many_rules(spark):
    df, names, data = many_votes(spark)
    n = len(data)
    got = {r.lf: r for r in LM.lf_summary(df, names, "gold").collect()}
    assert set(got) == set(names)
    for j in (0, 7, 199):
        cast = [(r[1], r[2 + j], [v for k, v in enumerate(r[2:]) if k != j and v is not None]) for r in data if r[2 + j]]
        r = got[names[j]]
        assert r.coverage == pytest.approx(len(cast) / n)
        assert r.overlap == pytest.approx(sum(bool(o) for _, _, o in cast) / n)
        assert r.conflict == pytest.approx(sum(any(x != v for x in o) for _, v, o in cast) / n)
        assert r.polarity == sorted({v for _, v, _ in cast})
        checked = [g == v for g, v, _ in cast if g is not None]
        assert r.accuracy == (pytest.approx(np.mean(checked)) if checked else None)
    agree = {(r.lf_i, r.lf_j): r for r in LM.lf_agreement(df, names).collect()}
    assert len(agree) == 200 * 199 // 2
    for i, j in ((0, 1), (3, 150), (198, 199)):
        met = [(r[2 + i], r[2 + j]) for r in data if r[2 + i] and r[2 + j]]
        r = agree[names[i], names[j]]
        assert (r.both, r.agree, r.disagree, r.n) == (len(met), sum(a == b for a, b in met), sum(a != b for a, b in met), n)
        assert r.cov_i == sum(x[2 + i] is not None for x in data)


def test_rules_that_never_vote(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id long, a string, b string")
    s = {r.lf: r for r in LM.lf_summary(df, ["a", "b"]).collect()}
    assert s["a"].coverage == 0 and s["a"].polarity == [] and s["b"].coverage == 0.5 and s["b"].overlap == 0
    assert LM.lf_agreement(df, ["a", "b"]).first().both == 0


def test_triplets_by_hand(spark):
    df, names, data = many_votes(spark, 5, 400, 3)
    df = df.select("id", *[F.when(F.rand(j) < 0.6, F.lit("x")).when(F.rand(j + 50) < 0.5, F.lit("y")).alias(n)
                           for j, n in enumerate(names)]).cache()
    v = np.array([[0 if x is None else (1 if x == "x" else -1) for x in r[1:]] for r in df.collect()], float)
    m = LM.fit_triplets(df, names, ["x"])["x"]
    mom = v.T @ v / len(v)
    for i, n in enumerate(names):
        c = [np.sqrt(abs(mom[i, j] * mom[i, k] / mom[j, k])) for j in range(5) for k in range(j + 1, 5)
             if i not in (j, k) and mom[j, k] != 0]
        cov = np.abs(v[:, i]).mean()
        assert m.accuracy[f"__b_{n}"] == pytest.approx(min(0.99, max(0.01, (1 + np.median(c) / cov) / 2)))
        assert m.coverage[f"__b_{n}"] == pytest.approx(cov)


def test_accelerated_em_reaches_the_same_optimum(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(3000):
        y = rnd.random() < 0.4
        rows.append((i, *[None if rnd.random() < 0.3 else ("p" if (rnd.random() < a) == y else "n") for a in (0.9, 0.75, 0.7, 0.65)]))
    df = spark.createDataFrame(rows, "id long, a string, b string, c string, d string")
    fast = LM.fit_em(df, list("abcd"), ["n", "p"])
    plain = LM.fit_em(df, list("abcd"), ["n", "p"], max_iter=300, tol=1e-5, memory=0)
    assert fast.iterations < plain.iterations
    assert fast.log_likelihood >= plain.log_likelihood - 1e-6 * abs(plain.log_likelihood)


def test_hash_ties(spark):
    model = LM.EMModel(["n", "p"], ["a", "b"], np.array([0.5, 0.5]),
                       np.array([[[0.2, 0.6, 0.2], [0.2, 0.2, 0.6]]] * 2), 1, 0.0)
    df = spark.createDataFrame([(i, "n", "p") for i in range(200)] + [(200, "n", "n"), (201, None, None)],
                               "id long, a string, b string")
    tied = {r.id: r.pred for r in LM.predict_em(df, model, "abstain").collect()}
    assert all(tied[i] is None for i in range(200)) and tied[200] == "n" and tied[201] is None
    hashed = {r.id: r.pred for r in LM.predict_em(df.repartition(7), model, "hash").collect()}
    again = {r.id: r.pred for r in LM.predict_em(df, model, "hash").collect()}
    share = np.mean([hashed[i] == "p" for i in range(200)])
    assert hashed == again and 0.35 < share < 0.65 and hashed[200] == "n" and hashed[201] is None


def test_frequent_tokens_apart(spark):
    rows = [(i, t) for i in range(300) for t in ("the", "of", f"w{i % 40}", None)]
    toks = spark.createDataFrame(rows, "id long, token string")
    table = spark.createDataFrame([("the", 1), ("w3", 2), ("absent", 3)], "token string, k int")
    head = frequent(toks, "token", 2)
    assert {r.token for r in head.collect()} == {"the", "of"}
    got = sorted(((r.id, r.token or "", r.k) for r in looked_up(toks, table, "token", head).collect()), key=str)
    want = sorted(((i, t or "", {"the": 1, "w3": 2}.get(t)) for i, t in rows), key=str)
    assert got == want


def test_mixed_batches(spark):
    df = spark.createDataFrame([(i, "abc"[min(2, i % 5)]) for i in range(203)] + [(900, None)], "id long, label string")
    rows = P.mixed_batches(df, 16).collect()
    assert len(rows) == 203
    by = {}
    for r in rows:
        by.setdefault(r.batch, []).append(r.label)
    assert all(len(by[b]) == 16 for b in by if b < max(by)) and len(by[max(by)]) == 203 % 16
    assert all(len(set(b)) == 3 for b in by.values())


def test_signed_vectors(spark):
    import hashlib

    df = spark.createDataFrame([(1, "Two words two"), (2, ""), (3, None)], "id long, text string")
    got = {r.id: r.vec for r in VO.hashed_embedding(df, dim=8).collect()}
    x = np.zeros(8)
    for w in ("two", "words", "two"):
        v = int(hashlib.md5(w.encode()).hexdigest()[:5], 16)
        x[(v % (1 << 19)) % 8] += -1 if v >> 19 else 1
    assert np.allclose(got[1], x / np.linalg.norm(x)) and got[2] == [0.0] * 8 and len(got[3] or []) in (0, 8)


def test_audit_while_writing(spark, tmp_path):
    rows = [(1, None, 0, 1, "a"), (2, "b", 1, 1, "b"), (3, None, 0, 0, None)]
    df = spark.createDataFrame(rows, "id long, label string, relevance_before int, relevance int, weak_label string")
    got = {r.metric: r.value for r in C.audited_write(df, str(tmp_path / "o")).collect()}
    assert got == {"initial_nulls": 2, "assigned": 1, "flipped": 1, "final_nulls": 1}
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_stream_cascade_equals_batch(spark, jobs):
    as_rows = lambda t: sorted((r.id, r.labels) for r in t.collect())
    assert as_rows(jobs["stream_cascade"](spark, SF)) == as_rows(jobs["cascade"](spark, SF))


def test_quantities(spark):
    df = spark.createDataFrame([(1, "about 250ML or 3 l"), (2, "none"), (3, None)], "id long, text string")
    got = {r.id: (r.q, r.a) for r in df.select(
        "id", tx.extract_quantity("text").alias("q"), tx.extract_all("text", r"\d+").alias("a")).collect()}
    assert got == {1: (250, ["250", "3"]), 2: (None, []), 3: (None, None)}


def test_rules_skip_labelled_rows(spark):
    df = spark.createDataFrame([(1, "x", "bad", 1), (2, None, "bad", 0)], "id long, label string, text string, relevance int")
    lf = R.LF("boom", "y", lambda: F.when(F.col("id") == 1, F.raise_error(F.lit("evaluated"))).otherwise(F.lit(True)).cast("boolean"))
    got = {r.id: r.weak_label for r in R.union_label(df, [lf]).collect()}
    assert got == {1: "x", 2: "y"}


def test_clean_text_replaces_nothing_match_by_match(spark):
    """Runs to keep are joined (F12), with the texts of the step-by-step form."""
    texts = [None, "", " ", "a - b", "a 　 b\u0085c", "\t\n\x0b\f\r", "é-É x_y 1", "a​b!c ?d  e", "- a - b -"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    for mode, keep in (("ascii", "a-zA-Z0-9"), ("unicode", r"\p{L}\p{N}")):
        plain = F.regexp_replace(F.coalesce("text", F.lit("")), f"[^{keep}{tx.WS_CLASS[1:-1]}]", "")
        plain = F.lower(F.trim(F.regexp_replace(plain, f"{tx.WS_CLASS}+", " ")))
        assert d.filter(~plain.eqNullSafe(tx.clean_text("text", mode))).isEmpty()
    plan = d.select(tx.clean_text("text"))._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan


def test_min_words_cleans_a_text_once(spark):
    """The filter reads the text, not the cleaned column, which would clean every text twice."""
    texts = [None, "", "one", "one two", "one - two", "one - two !3", "a-b-c", " a  b  c ", "é è x", "a b c d"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for mode in ("ascii", "unicode"):
        count = tx.word_count(tx.clean_text("text", mode))
        for n in (0, 1, 2, 3, 4, 70):
            want = {(r.id, r.n) for r in d.select("id", count.alias("n")).filter(F.col("n") >= n).collect()}
            assert {(r.id, r.word_count) for r in C.min_words(d, n, mode=mode).collect()} == want
    plan = C.min_words(d, 3).select("id", "word_count")._jdf.queryExecution().executedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert "array_join" not in condition and "regexp_replace" not in condition


def test_tfidf_deals_the_texts_once(spark):
    """Counts and row lengths need no shuffle of (id, term) pairs beyond that of the texts (F9); rows of one id are one
    document, rows without id count for the vocabulary only."""
    d = spark.createDataFrame([(1, "aa bb aa"), (1, "bb cc"), (2, "aa dd"), (None, "aa ee"), (3, None)], "id int, text string")
    t = L.tfidf_relational(d, "text", "id", 10)
    got = {(r.id, r.term): r.weight for r in t.collect()}
    assert set(got) == {(1, "aa"), (1, "bb"), (1, "cc"), (2, "aa"), (2, "dd")}
    idf = {"aa": np.log(6 / 4) + 1, "bb": np.log(6 / 2) + 1, "cc": np.log(6 / 2) + 1, "dd": np.log(6 / 2) + 1}
    one = {"aa": 2 * idf["aa"], "bb": 2 * idf["bb"], "cc": idf["cc"]}
    for w, x in one.items():
        assert abs(got[1, w] - x / np.sqrt(sum(v * v for v in one.values()))) < 1e-12
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


def test_hashed_embedding_adds_up_in_pieces(spark, monkeypatch):
    """A batch is added up so many tokens at a time (F4, F6), whatever the piece."""
    d = spark.createDataFrame([(0, "aa bb cc aa"), (1, ""), (2, None), (3, "dd " * 9), (4, "aa")], "id int, text string").coalesce(1)
    want = {r.id: r.vec for r in VO.hashed_embedding(d).collect()}
    assert want[1] == [0.0] * 64 and abs(sum(x * x for x in want[0]) - 1) < 1e-12
    monkeypatch.setattr(VO, "BAG_TOKENS", 3)
    assert {r.id: r.vec for r in VO.hashed_embedding(d).collect()} == want
