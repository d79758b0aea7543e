"""Forms that keep shuffles, passes and task reads of the learning and search jobs small, and their results."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from labelkiln.operators import balance as B
from labelkiln.operators import learn as L
from labelkiln.operators import vector as VO
from labelkiln.operators import vector_index as VX


def _vectors(spark, n, dim=8, seed=1):
    rnd = np.random.default_rng(seed)
    return spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=dim)]) for i in range(n)], "id long, vec array<double>")


def test_a_query_goes_once_to_a_bundle_of_cells(spark):
    """all cells are within one bundle, so a query that wants all of them is sent once."""
    c, q = _vectors(spark, 400), _vectors(spark, 30, seed=2)
    index = VX.build_index(c, cells=20)
    assert len(index.centres) > 10
    sent = q.select("id", VX.unit("vec").alias("v")).select(
        "id", F.explode(VX._nearest_cells(index, "v", len(index.centres))).alias("to"))
    assert sent.count() == 30


def test_bundles_of_all_sizes_find_the_exact_hits(spark, monkeypatch):
    """F2: cells of several parts, several bundles, equal vectors, few scores at a time."""
    monkeypatch.setattr(VX, "SCORES", 50)
    c = _vectors(spark, 300).unionByName(spark.createDataFrame([(1000 + i, [1.0] * 8) for i in range(40)], "id long, vec array<double>"))
    q = _vectors(spark, 25, seed=3).unionByName(spark.createDataFrame([(500, [2.0] * 8), (501, None)], "id long, vec array<double>"))
    truth = {(r.id, r.rank): r.hit for r in VO.semantic_search(q, c, 3).collect()}
    for part_rows in (15, 60, 1000):
        index = VX.build_index(c, cells=12, part_rows=part_rows)
        found = VX.search_index(index, q, 3, 2, exact=True, query_rows=7)
        assert {(r.id, r.rank): r.hit for r in found.collect()} == truth
    assert [truth[500, k] for k in (1, 2, 3)] == [1000, 1001, 1002]


def test_class_weights_do_not_gather_the_rows_of_a_class(spark):
    """rows stay in their tasks when they get the weight of their class."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 400, 1, 8).select("id", F.when(F.col("id") < 390, "x").otherwise("y").alias("label"))
        d = B.with_weights(df, B.class_weights(df), out="w").withColumn("task", F.spark_partition_id())
        assert d.filter("label = 'x'").select("task").distinct().count() == 8
        assert {(r.label, r.w) for r in d.select("label", "w").distinct().collect()} == {("x", 400 / 780), ("y", 20.0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_rows_of_a_fit_hold_no_texts(spark):
    """every step of a fit reads the stored rows."""
    from labelkiln.plans import jobs_learn
    assert set(jobs_learn._doc_features(spark, "/root/testdata/sf0.001").columns) == {"id", "relevance", "label", "lang", "features"}


def test_texts_are_cut_into_tokens_twice(spark):
    """once for the vocabulary, once for the counts; the features are those of the fitted pipeline."""
    texts = ["aa bb aa", None, "", "bb cc", "aa dd cc bb aa", "éé x Éé", "dd"]
    seen = spark.sparkContext.accumulator(0)

    def read(t):
        seen.add(1)
        return t

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").coalesce(1)
    model, rows = L.tfidf_rows(df.withColumn("text", F.udf(read)("text")), "text", 50)
    got = {r.id: r.features for r in rows.collect()}
    assert seen.value == 2 * len(texts) and set(rows.columns) == {"id", "features"}
    assert got == {r.id: r.features for r in L.featurize(L.tfidf_features(df, "text", 50), df).collect()}
    assert got == {r.id: r.features for r in L.featurize(model, df).collect()}


def test_embedding_hashes_a_token_once(spark, monkeypatch):
    """no hash per occurrence in the plan; the vectors are those of the md5 of each token."""
    monkeypatch.setattr(VO, "BAG_TOKENS", 4)
    texts = ["Aa bb aa éé cc dd bb", "", None, "zz yy xx ww vv uu zz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").coalesce(1)
    v = VO.embed(df, dim=8)
    assert "md5" not in v._jdf.queryExecution().toString()
    got = {r.id: r.vec for r in v.collect()}
    for i, t in enumerate(texts):
        x = np.zeros(8)
        for w in (t or "").lower().split():
            code = int(hashlib.md5(w.encode()).hexdigest()[:5], 16)
            x[code % (1 << 19) % 8] += -1.0 if code >> 19 else 1.0
        assert np.allclose(got[i], x / (np.linalg.norm(x) or 1.0))


def test_semantic_filter_embeds_a_text_once(spark, tmp_path, monkeypatch):
    """F8: one row a document is embedded, not one a pair and side; equal texts but for case are left out."""
    from labelkiln.plans import jobs_more
    rows = [(i, t, "s", "en", 1) for i, t in enumerate(["aa bb", "AA bb", "aa bb cc", "aa bb dd", None, "aa bb cc ee"])]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen, embed = [], VO.embed
    monkeypatch.setattr(VO, "embed", lambda df, **kw: seen.append(df.count()) or embed(df, **kw))
    out = jobs_more.semantic_filter(spark, str(tmp_path)).collect()
    assert seen == [6]
    vec = {r.id: np.array(r.vec) for r in embed(spark.createDataFrame([r[:2] for r in rows], "id long, text string")).collect()}
    for r in out:
        assert rows[r.a][1] is not None and rows[r.b][1] is not None and {r.a, r.b} != {0, 1}
        assert abs(r.similarity - vec[r.a] @ vec[r.b]) < 1e-6
    assert out
