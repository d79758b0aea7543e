"""Joint fits, supplied classifiers, loop controls and the vector index."""

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from labelkiln.operators import corpus as C
from labelkiln.operators import joint as J
from labelkiln.operators import learn as L
from labelkiln.operators import vector as VO
from labelkiln.operators import vector_index as VX
from labelkiln.operators.classifier import BatchClassifier, MLClassifier

SF = "/root/testdata/sf0.001"


def table(spark, n=240, d=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = np.abs(rng.normal(size=d)) * (rng.random(d) < 0.7)
        a = "abc"[int(np.argmax(x[:3] + 0.3 * rng.random(3)))]
        b = None if i % 17 == 0 else ("x" if x[3] > x[4] else "y")
        c = None if b is None else ("p" if x[5] + 0.2 * rng.random() > 0.6 else "q")
        vec = Vectors.sparse(d, np.flatnonzero(x).tolist(), x[x != 0].tolist()) if i % 3 else Vectors.dense(x.tolist())
        labels = None if i % 13 == 0 else sorted({v for v, on in (("u", x[0] > 0.5), ("v", x[1] > 0.9), ("w", False)) if on})
        rows.append((i, vec, a, b, c, labels, i % 2, 1.0 + i % 3))
    return spark.createDataFrame(rows, ["id", "features", "a", "b", "c", "labels", "relevance", "w"])


@pytest.fixture(scope="module")
def df(spark):
    return table(spark).repartition(3).cache()


def single(df, label, weight=None):
    m = L.train_lr(df, label, "features", weight, max_iter=2000, tol=1e-13).stages[1]
    return m.coefficientMatrix.toArray().T, m.interceptVector.toArray()


def test_joint_hierarchy_equals_single_fits(df):
    m = L.train_hierarchy(df, ["a", "b", "c"])
    assert set(m.keys) == {"", "a", "b", "c"} | {f"{a}/{b}" for a in "abc" for b in "xy"}
    for key, cond, level in (("", "true", "a"), ("b", "a = 'b'", "b"), ("c/x", "a = 'c' AND b = 'x'", "c")):
        w, b = single(df.filter(cond), level)
        p = m.keys.index(key)
        assert np.abs(m.weight[p] - w).max() < 1e-4 and np.abs(m.bias[p] - b).max() < 1e-4


def test_joint_weights_and_multilabel(df):
    m = J.fit_multilabel(df, "labels", ["u", "v", "w"], weight="w")
    lab = df.filter("labels IS NOT NULL").withColumn("y", F.array_contains("labels", "v").cast("string"))
    w, b = single(lab, "y", "w")
    assert np.abs(m.weight[1] - w).max() < 1e-4 and np.abs(m.bias[1] - b).max() < 1e-4
    got = L.predict_multilabel(m, df)
    x = np.array([r.features.toArray() for r in got.collect()])
    for k, r in enumerate(got.collect()):
        p = [1 / (1 + np.exp(-(x[k] @ (m.weight[i][:, 1] - m.weight[i][:, 0]) + m.bias[i][1] - m.bias[i][0]))) for i in range(3)]
        assert r.labels_pred == [v for v, q in zip("uvw", p) if q > 0.5]
    assert not any("w" in r.labels_pred for r in got.collect())


def test_path_is_the_way_down(spark, df):
    levels = ["a", "b", "c"]
    m = L.train_hierarchy(df, levels, min_rows=30)
    got = {r.id: r for r in L.predict_path(m, df, 3).collect()}
    for r in got.values():
        x, key, path = r.features.toArray(), "", []
        for _ in levels:
            if key not in m.keys:
                break
            p = m.keys.index(key)
            path.append(m.classes[p][int(np.argmax(x @ m.weight[p] + m.bias[p]))])
            key = "/".join(path)
        assert r.path == path
    none = spark.createDataFrame([(1, None)], df.select("id", "features").schema)
    assert L.predict_path(m, none, 3).first().path is None
    assert len(L.train_hierarchy(df.limit(0), levels)) == 0
    assert L.predict_path(L.train_hierarchy(df.limit(0), levels), df, 2).filter("size(path) > 0").count() == 0


def centroids():
    def train(rows, label, features, weight):
        got = rows.select(label, F.col(features).alias("f")).collect()
        names = sorted({r[0] for r in got})
        return names, np.stack([np.mean([r.f.toArray() for r in got if r[0] == n], axis=0) for n in names])

    def predict(state):
        def run(x):
            import numpy as np
            near = np.exp(-((x[:, None, :] - state[None]) ** 2).sum(axis=2))
            return near / near.sum(axis=1, keepdims=True)
        return run

    return BatchClassifier(train, predict)


@pytest.mark.parametrize("make", [lambda: MLClassifier(NaiveBayes()), centroids])
def test_supplied_classifiers(df, make):
    clf = make()
    lab, pool = df.filter("id < 60"), df.filter("id >= 60")
    log = []
    got, rest = L.self_train(lab, pool, 0.5, 2, "a", log=log, classifier=clf)
    assert got.count() + rest.count() == 240 and log and got.count() == 60 + sum(n for _, n in log)
    assert got.filter("round > 0 AND a NOT IN ('a', 'b', 'c')").count() == 0
    asked, _ = L.active_learn(lab, pool, df.select("id", "a"), 7, 1, "entropy", "a", classifier=clf)
    assert asked.count() == 67
    m = L.train_hierarchy(df, ["a", "b"], classifier=clf)
    paths = L.predict_path(m, df, 2)
    assert paths.count() == 240 and paths.filter("size(path) <> 2").count() == 0
    ms = L.train_multilabel(df, "labels", ["u", "v"], classifier=clf)
    gate = clf.fit(df.withColumn("r", F.col("relevance").cast("string")), "r")
    out = L.cascade(df, gate, lambda x: L.predict_multilabel(ms, x))
    assert out.count() == 240 and set(out.columns) == {*df.columns, "labels_pred"}


def test_narrow_cascade(df):
    gate = L.train_relevance(df.withColumn("relevance", (F.col("a") == "a").cast("int")))
    ms = L.train_multilabel(df, "labels", ["u", "v"])
    narrow = {r.id: r.labels_pred for r in L.cascade(df, gate, ms).collect()}
    by_rows = {r.id: r.labels_pred for r in L.cascade(df, gate, lambda x: L.predict_multilabel(ms, x)).collect()}
    passed = {r.id for r in L.gate_passes(gate, df).filter("gate_passes").collect()}
    assert narrow == by_rows and 0 < len(passed) < 240
    assert all(narrow[i] == [] for i in narrow if i not in passed) and any(narrow.values())
    plan = L.cascade(df, gate, ms)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    strict = L.gate_passes(gate, df, threshold=0.9).filter("gate_passes").count()
    assert strict < len(passed)


def test_self_train_controls_each_round(df):
    lab, pool = df.filter("id < 45"), df.filter("id >= 45")
    plan = [{"a": 0.5, "b": 0.4}, {"a": 0.45, "b": 0.4}, 0.1]
    log, before = [], None
    for rounds in (1, 2, 3):
        log = []
        got, rest = L.self_train(lab, pool, plan, rounds, "a", log=log, surest=0.1, balance=30)
        rows = {r.id: (r.a, r["round"]) for r in got.collect()}
        assert got.count() == len(rows) and len(rows) + rest.count() == 240
        left = 195
        for r, n in log:
            mine = [a for a, k in rows.values() if k == r]
            assert len(mine) == n <= -(-left // 10)           # the surest 10 % at most
            if r < 3:
                assert set(mine) <= {"a", "b"}                # a class without a threshold is not accepted
            left -= n
        if before:                                            # earlier rounds are not revised
            assert all(rows[i] == v for i, v in before.items())
        before = rows


def test_active_learning_strategies(df):
    lab, pool = df.filter("id < 60"), df.filter("id >= 60")
    got, _ = L.active_learn(lab, pool, df.select("id", "a"), 10, 1, "egl", "a")
    picked = {r.id for r in got.filter("round = 1").collect()}
    s = L.score(L.train_lr(lab, "a"), pool).collect()
    length = {r.id: np.linalg.norm(r.features.toArray())
              * sum(p * np.sqrt(sum(np.square(r.probs)) - 2 * p + 1) for p in r.probs) for r in s}
    assert picked == {i for _, i in sorted((-v, i) for i, v in length.items())[:10]}
    lists = lab.filter("labels IS NOT NULL")
    got, _ = L.active_learn(lists, pool, df.select("id", "labels").filter("labels IS NOT NULL"), 10, 2, "multilabel_most", "labels")
    assert got.count() > lists.count()
    m = L.train_multilabel(lists, "labels", ["u", "v"])
    unsure = {r.id: max(1 - 2 * abs(p - 0.5) for p in r.p)
              for r in pool.withColumn("p", J.label_scores(m, "features")).collect()}
    first = {r.id for r in got.filter("round = 1").collect()}
    assert first <= {i for _, i in sorted((-v, i) for i, v in unsure.items())[:10]}


# ---------------------------------------------------------------------------------------------- vector index


def blobs(spark, n=900, d=12, seed=2):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, d))
    x = centre[rng.integers(0, 9, n)] + 0.6 * rng.normal(size=(n, d))
    x[: n // 3] = x[0]  # a third of the rows are one vector
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)] + [(n, None), (n + 1, [0.0] * d)]
    return spark.createDataFrame(rows, "id long, vec array<double>")


def test_index_search(spark):
    c = blobs(spark).repartition(4)
    q = blobs(spark, 120, seed=5).withColumn("id", F.col("id") + 5000)
    truth = VO.semantic_search(q.filter("id < 5120"), c.filter("id < 900"), 4).cache()
    index = VX.build_index(c, part_rows=100)
    assert index.vectors.groupBy("cell", "part").count().agg(F.max("count")).first()[0] < 330
    exact = VX.search_index(index, q, 4, 2, exact=True)
    as_rows = lambda t: sorted((r.id, r["rank"], round(r.score, 9)) for r in t.collect())
    assert as_rows(exact) == as_rows(truth)
    probes = VX.probes_for(index, q, 4, 0.95)
    found = VX.search_index(index, q, 4, probes, query_rows=50)
    scores = {(r.id, r["rank"]): r.score for r in found.collect()}
    good = [scores.get((r.id, r["rank"]), -2) >= r.score - 1e-9 for r in truth.collect()]
    assert np.mean(good) >= 0.9
    assert probes < len(index.centres)


def test_index_recall_on_the_tables(spark):
    from labelkiln.plans.jobs_vector import emb_corpus
    from labelkiln.plans.registry import JOBS, load_all

    load_all()
    sf = "/root/testdata/sf0.01"
    e = emb_corpus(spark, sf)
    truth = VO.semantic_search(e.filter("id % 50 = 0"), e, 5)
    r = VX.recall(JOBS["semantic_search_index"](spark, sf), truth).first()
    assert r.wanted == truth.count() and r.recall >= 0.9


def test_index_of_nothing(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    q = blobs(spark, 9)
    assert VX.search_index(VX.build_index(none), q, 3).count() == 0
    assert VX.search_index(VX.build_index(q), none, 3, exact=True).count() == 0
    few = VX.search_index(VX.build_index(q), q, 50, 1, exact=True)
    assert few.groupBy("id").count().filter("count = 9").count() == 9


def test_nearest_large_equals_nearest(spark):
    from labelkiln.plans.jobs_vector import emb_corpus

    e = emb_corpus(spark, SF)
    protos = VO.prototypes(C.labelled(e), "label", "vec")
    as_rows = lambda t: sorted((r.id, r.pred, round(r.score, 9)) for r in t.collect())
    assert as_rows(VX.nearest_large(C.unlabelled(e), protos)) == as_rows(VO.nearest(C.unlabelled(e), protos))


def test_svm_scores_after_an_observation(spark):
    """A session that has observed a metric still scores with a fitted SVM (F1)."""
    from pyspark.sql import Observation

    spark.range(3).observe(Observation("seen_before_svm"), F.count("*").alias("n")).collect()
    rows = [(i, i % 2, Vectors.dense([1.0 if i % 2 else -1.0, 0.5])) for i in range(20)]
    d = spark.createDataFrame(rows, ["id", "relevance", "features"])
    got = L.train_svm(d).transform(d).select("relevance", "svm_pred").collect()
    assert len(got) == 20 and all(r.relevance == r.svm_pred for r in got)
