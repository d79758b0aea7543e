"""Property, recovery and equivalence tests for the distributed building blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelkiln.operators import corpus as C
from labelkiln.operators import labelmodel as LM
from labelkiln.operators import learn as L
from labelkiln.operators import ranking as RK
from labelkiln.operators import vector as VO


def _skewed(spark, n=3000):
    # one hot label holding a third of the rows
    rows = [(i, "hot" if i % 3 == 0 else f"c{i % 7}") for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, label string")


def test_rank_within_equals_row_number(spark):
    df = _skewed(spark)
    got = RK.rank_within(df, ["label"], RK.hash_order("id", 5), out="pos", prefix_digits=2)
    w = Window.partitionBy("label").orderBy(RK.hash_order("id", 5))
    ref = df.withColumn("ref", F.row_number().over(w) - 1)
    j = got.join(ref, ["id", "label"])
    assert j.count() == df.count() and j.filter(F.col("pos") != F.col("ref")).count() == 0


def test_global_rank_exact(spark):
    df = spark.createDataFrame([(i, float((i * 37) % 101)) for i in range(500)], "id bigint, s double")
    got = RK.global_rank(df.repartition(7), [F.col("s").desc(), F.col("id")], out="r")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("s").desc(), F.col("id"))))
    j = got.join(ref, "id")
    assert j.filter(F.col("r") != F.col("ref")).count() == 0


def test_stratified_split_disjoint_complete(spark):
    df = _skewed(spark, 1000)
    s = RK.stratified_split(df, "label", 0.2, 3)
    assert s.count() == 1000 and s.select("id").distinct().count() == 1000
    per = {r.label: (r.t, r.n) for r in s.groupBy("label").agg(
        F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect()}
    assert all(t == round(n * 0.2 + 1e-9) or abs(t - n * 0.2) <= 0.5 for t, n in per.values())


def test_rebalance_exact_counts(spark):
    from labelkiln.operators.balance import rebalance
    df = _skewed(spark, 700)
    r = rebalance(df, "label", 150, 1)
    assert {x["count"] for x in r.groupBy("label").count().collect()} == {150}


def _planted_votes(spark, n=20000, seed=0):
    rng = np.random.default_rng(seed)
    accs, covs = [0.9, 0.8, 0.7, 0.65], [0.6, 0.5, 0.7, 0.4]
    y = rng.random(n) < 0.7
    rows = []
    for i in range(n):
        votes = []
        for a, c in zip(accs, covs):
            if rng.random() < c:
                right = rng.random() < a
                votes.append(("pos" if y[i] else "neg") if right else ("neg" if y[i] else "pos"))
            else:
                votes.append(None)
        rows.append((i, *votes))
    return spark.createDataFrame(rows, "id bigint, a string, b string, c string, d string"), accs


def test_em_recovers_planted_accuracies(spark):
    df, accs = _planted_votes(spark)
    m = LM.fit_em(df, ["a", "b", "c", "d"], ["neg", "pos"])
    got = m.accuracies()
    for name, a in zip("abcd", accs):
        assert got[name] == pytest.approx(a, abs=0.03)
    p = LM.predict_em(df, m)
    none = df.filter("a IS NULL AND b IS NULL AND c IS NULL AND d IS NULL").count()
    assert p.filter("pred IS NULL").count() >= none  # all-abstain rows stay unlabelled (Q12)


def test_triplet_recovers_planted_accuracies(spark):
    df, accs = _planted_votes(spark, seed=1)
    b = LM.binary_votes(df, ["a", "b", "c", "d"], "pos")
    cols = ["__b_a", "__b_b", "__b_c", "__b_d"]
    m = LM.fit_triplet(b.select(*cols), cols)
    for c, a in zip(cols, accs):
        assert m.accuracy[c] == pytest.approx(a, abs=0.03)


def _vecs(spark, n, d, seed, label=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>"), x


def test_nearest_matches_brute_force(spark):
    q, xq = _vecs(spark, 200, 8, 1)
    p, xp = _vecs(spark, 6, 8, 2)
    protos = p.select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("label"), F.col("vec").alias("proto"))
    got = {r.id: r.pred for r in VO.nearest(q, protos).collect()}
    un = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    best = np.argmax(un(xq) @ un(xp).T, axis=1)
    assert all(got[i] == f"p{best[i]}" for i in range(200))
    blocked = {r.id: r.pred for r in VO.nearest(q, protos, max_broadcast_values=16).collect()}
    assert blocked == got


def test_semantic_search_blocked_equals_broadcast(spark):
    q, _ = _vecs(spark, 120, 6, 3)
    c, _ = _vecs(spark, 300, 6, 4)
    a = {(r.id, r.rank): r.hit for r in VO.semantic_search(q, c, 3).collect()}
    b = {(r.id, r.rank): r.hit for r in VO.semantic_search(q, c, 3, query_rows=9, block_rows=70).collect()}
    assert a == b and len(a) == 360


def test_self_training_invariants(spark):
    from labelkiln.plans.jobs_vector import emb_corpus
    e = L.vectors_as_features(emb_corpus(spark, "/root/testdata/sf0.001"))
    lab0, pool0 = C.labelled(e), C.unlabelled(e)
    n_lab, n_pool = lab0.count(), pool0.count()
    log = []
    lab, pool = L.self_train(lab0, pool0, [0.3, 0.2], 2, log=log)
    assert lab.count() + pool.count() == n_lab + n_pool
    assert lab.join(pool, "id").count() == 0
    assert lab.count() - n_lab == sum(k for _, k in log)


def test_cascade_every_id_once(spark):
    rows = [(i, "bad idiot text" if i % 2 else "fine words here", i % 2, "toxic" if i % 2 else "clean")
            for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, text string, relevance int, label string")
    fm = L.tfidf_features(df, "text", 50)
    d = L.featurize(fm, df).withColumn("labels", F.array("label"))
    gate = L.train_relevance(d, "relevance")
    ms = L.train_multilabel(d, "labels", ["toxic"])
    out = L.cascade(d, gate, lambda x: L.predict_multilabel(ms, x))
    assert out.count() == 60 and out.select("id").distinct().count() == 60
    stopped = out.filter("relevance = 0").collect()
    assert all(r.labels_pred == [] for r in stopped)


def test_active_learning_grows_by_batch(spark):
    from labelkiln.plans.jobs_vector import emb_corpus
    e = L.vectors_as_features(emb_corpus(spark, "/root/testdata/sf0.001"))
    expert = e.select("id", F.col("gold").alias("label"))
    lab0 = C.labelled(e)
    n0 = lab0.count()
    lab, pool = L.active_learn(lab0, C.unlabelled(e), expert, 5, 2)
    assert lab.count() == n0 + 10 and lab.join(pool, "id").count() == 0


def test_eda_synonym_rows(spark):
    from labelkiln.operators.balance import eda_synonym
    df = spark.createDataFrame([(1, "Red lipstick and red gloss"), (2, "blue mascara"), (3, "")],
                               "id bigint, text string")
    syn = spark.createDataFrame([("red", "crimson"), ("gloss", "shine"), ("blue", "navy")], "word string, synonym string")
    more = df.union(spark.createDataFrame([(1, "red gloss"), (4, None), (2, "blue mascara")], df.schema))
    got = {(r.id, r.text): r.augmented for r in eda_synonym(more, syn, p=1.1, seed=3).collect()}
    assert got == {(1, "Red lipstick and red gloss"): "crimson lipstick and crimson shine", (2, "blue mascara"): "navy mascara",
                   (3, ""): "", (1, "red gloss"): "crimson shine", (4, None): None}
    assert eda_synonym(more, syn, p=1.1, seed=3).count() == 6


def test_null_cases(spark):
    """NULL predictions count as misses, NULL labels are a class of a split, NULL vectors have no hits."""
    from labelkiln.operators import metrics as M
    from labelkiln.operators import ranking as RK
    from labelkiln.operators import update as U
    from labelkiln.operators import vector as VO
    df = spark.createDataFrame([(1, 1), (None, 1), (1, 0)], "pred int, gold int")
    m = M.binary_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn, m.recall) == (1, 1, 1, 0, 0.5)
    d = spark.createDataFrame([(i, None if i % 3 == 0 else "x") for i in range(30)], "id long, label string")
    assert RK.stratified_split(d, "label", 0.2).groupBy("split").count().orderBy("split").collect()[0]["count"] == 6
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "id long, vec array<float>")
    assert {(r.id, r.hit) for r in VO.semantic_search(v, v, 1).collect()} == {(1, 1), (3, 3)}
    acc = spark.createDataFrame([(1, "b"), (1, "a")], "id long, label string")
    base = spark.createDataFrame([(1, None, 0)], "id long, label string, relevance int")
    assert U.apply_labels(base, acc).first().label == "a"


def test_rules_with_several_labels(spark):
    from labelkiln.operators import rules as R

    df = spark.createDataFrame([(1, "red apple, green pear"), (2, "an apple"), (3, "stone"), (4, ""), (5, None)],
                               "id long, text string")
    lfs = [R.topics_lf("fruit", {"pear": ["pear"], "apple": ["apple"]}), R.keyword_lf("k", "apple", ["red"]),
           R.ListLF("none", lambda: F.lit(None).cast("array<string>"))]
    got = {r[0]: r[1] for r in df.select("id", R.merge_votes(lfs)).collect()}
    assert got == {1: ["apple", "pear"], 2: ["apple"], 3: [], 4: [], 5: []}
