"""Small fixtures restating the reference's literal examples, with hand-derived results."""

import math

import pytest
from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.functions import vector as V
from labelkiln.operators import balance as B
from labelkiln.operators import corpus as C
from labelkiln.operators import pairs as P
from labelkiln.operators import rules as R
from labelkiln.operators import update as U
from labelkiln.operators import vector as VO

TEXTS = [
    (0, "W sklepie leży pomadka w odcieniu maliny.", 1, "lipstick"),
    (1, "Szukam: tusz do rzęs, wodoodporny.", 1, "mascara"),
    (2, "Rano piję wodę z cytryną.", 0, None),
    (3, "Czy ten podkład wytrzyma upał?", 0, None),
    (4, "Próbka: KREM BB, jasny.", 0, None),
    (5, "Błyszczyk pachnie wanilią.", 0, None),
    (6, "Pomadki, szminki i podkłady stoją z lewej.", 0, None),
    (7, "Rower czeka w garażu.", 0, None),
]
SCHEMA = "id bigint, text string, relevance int, label string"


def cosmetics_rules():
    return [R.keyword_lf("lf_lipstick", "lipstick", ["pomadka", "błyszczyk", "konturówka"]),
            R.keyword_lf("lf_mascara", "mascara", ["tusz do rzęs", "zalotka"]),
            R.keyword_lf("lf_foundation", "foundation", ["krem bb", "podkład", "puder"])]


def test_f1_union_label(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    out = {r.id: r for r in R.union_label(df, cosmetics_rules()).collect()}
    assert [out[i].weak_label for i in range(8)] == ["lipstick", "mascara", None, "foundation", "foundation",
                                                     "lipstick", None, None]
    assert [out[i].relevance for i in range(8)] == [1, 1, 0, 1, 1, 1, 0, 0]


def test_f2_label_matrix(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    classes = ["foundation", "lipstick", "mascara"]
    m = {r.id: r.L for r in R.label_matrix(df, cosmetics_rules(), classes).collect()}
    assert [m[i] for i in range(8)] == [[1, -1, -1], [-1, 2, -1], [-1, -1, -1], [-1, -1, 0], [-1, -1, 0],
                                        [1, -1, -1], [-1, -1, -1], [-1, -1, -1]]


def test_unicode_case_folding(spark):
    df = spark.createDataFrame([(0, "Tusz do RZĘS")], "id bigint, text string")
    assert df.filter(tx.has_keyword("text", ["tusz do rzęs"])).count() == 1


def test_negative_rule_overrides(spark):
    df = spark.createDataFrame([(0, "pomadka MIT licence", 0, None)], SCHEMA)
    lfs = cosmetics_rules() + [R.negative_lf("lf_neg", ["licence"])]
    r = R.union_label(df, lfs).first()
    assert r.weak_label is None and r.relevance == 0


def test_apply_labels_never_changes_labelled(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    acc = spark.createDataFrame([(0, "foundation"), (2, "foundation")], "id bigint, new string")
    out = {r.id: r for r in U.apply_labels(df, acc, new_label="new").collect()}
    assert out[0].label == "lipstick" and out[2].label == "foundation" and out[2].relevance == 1


def test_f3_prototype(spark):
    df = spark.createDataFrame([(1, "lipstick", [1.0, 0.0]), (2, "lipstick", [0.8, 0.6]), (3, "mascara", [0.0, 1.0]),
                                (4, None, [0.9, 0.3])], "id bigint, label string, vec array<float>")
    protos = VO.prototypes(df, "label", "vec")
    p = {r.label: r.proto for r in protos.collect()}
    assert p["lipstick"] == pytest.approx([0.9, 0.3], abs=1e-6)
    n = VO.nearest(df.filter("label IS NULL"), protos).first()
    assert n.pred == "lipstick" and n.score == pytest.approx(1.0, abs=1e-6)
    strict = VO.embedding_label(df.filter("label IS NULL"), protos, 1.0, strict=True)
    assert strict.count() == 0 or strict.first().score > 1.0


def test_f9_uncertainty(spark):
    df = spark.createDataFrame([("A", [0.45, 0.30, 0.25]), ("B", [0.51, 0.48, 0.01]), ("C", [0.33, 0.33, 0.34])],
                               "id string, p array<double>")
    out = {r.id: r for r in df.select("id", V.least_confidence("p").alias("lc"), V.margin("p").alias("m"),
                                      V.entropy("p").alias("e")).collect()}
    assert out["A"].lc == pytest.approx(0.55) and out["B"].m == pytest.approx(0.03)
    assert out["A"].e == pytest.approx(1.067094, abs=1e-6)
    assert out["B"].e == pytest.approx(0.741763, abs=1e-6)
    assert out["C"].e == pytest.approx(1.098513, abs=1e-6)


def test_f10_class_weights(spark):
    rows = [(i, "rel") for i in range(3000)] + [(3000 + i, "irr") for i in range(87000)]
    df = spark.createDataFrame(rows, "id bigint, label string")
    w = {r.label: r.weight for r in B.class_weights(df).collect()}
    assert w["rel"] == pytest.approx(15.0) and w["irr"] == pytest.approx(0.517241, abs=1e-6)


def test_f11_deficits_and_augment(spark):
    rows = [(0, "a b c", "powder"), (1, "d e f", "powder"), (2, "g h i", "powder"), (3, "j k l", "mascara"),
            (4, "m n o", "liquid_powder")]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    d = {r.label: (r.deficit, r.variants) for r in B.deficits(df, "label", 3).collect()}
    assert d == {"powder": (0, 0), "mascara": (2, 2), "liquid_powder": (2, 2)}
    a = B.augment_to_target(df, "label", 3)
    assert {r.label: r["count"] for r in a.groupBy("label").count().collect()} == {
        "powder": 3, "mascara": 3, "liquid_powder": 3}
    rows2 = [(i, "x", "a") for i in range(200)] + [(1000 + i, "y", "b") for i in range(100)] + \
            [(2000 + i, "z", "c") for i in range(20)]
    d2 = {r.label: (r.deficit, r.variants) for r in
          B.deficits(spark.createDataFrame(rows2, "id bigint, text string, label string"), "label", 150).collect()}
    assert d2 == {"a": (0, 0), "b": (50, 1), "c": (130, 7)}


def test_f12_multi_hot(spark):
    df = spark.createDataFrame([(3, ["foundation", "concealer"]), (6, ["foundation", "powder"])],
                               "id int, labels array<string>")
    vocab = ["concealer", "foundation", "lipstick", "mascara", "powder"]
    h = {r.id: r.h for r in df.select("id", V.multi_hot("labels", vocab).alias("h")).collect()}
    assert h[3] == [1, 1, 0, 0, 0] and h[6] == [0, 1, 0, 0, 1]


def test_f13_pairs(spark):
    rows = [(1, "liquid_powder"), (2, "liquid_powder"), (3, "mascara"), (4, "mascara"), (5, "lipstick"),
            (6, "lipstick"), (7, "powder")]
    df = spark.createDataFrame(rows, "id bigint, label string")
    assert P.positive_pairs(df, 1).count() == 3
    neg = P.negative_pairs(df, 3).collect()
    assert all(r.anchor_label != r.negative_label for r in neg) and len(neg) == 21
    tr = P.triplets(df, 1).collect()
    assert len(tr) == 6 and all(r.anchor != r.positive for r in tr)


def test_f17_cleaning(spark):
    df = spark.createDataFrame([(0, "Tusz do rzęs!!  HIT"), (1, "ok"), (2, None)], "id int, text string")
    out = C.min_words(df, 3).collect()
    assert [(r.id, r.text_cleaned, r.word_count) for r in out] == [(0, "tusz do rzs hit", 4)]
    assert C.ignored_count(df, 3).first().ignored == 2


def test_cosine_symmetric_bounded(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [-1.0, 0.5, 2.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<double>, b array<double>")
    r = df.select(V.cosine("a", "b").alias("x"), V.cosine("b", "a").alias("y")).collect()
    assert r[0].x == pytest.approx(r[0].y) and -1 <= r[0].x <= 1 and r[1].x is None


def test_clean_text_idempotent(spark):
    df = spark.createDataFrame([("  Zażółć  gęślą\tjaźń!! ",), ("A b",)], "t string")
    once = df.select(tx.clean_text("t", "unicode").alias("t"))
    twice = once.select(tx.clean_text("t", "unicode").alias("t"))
    assert [r.t for r in once.collect()] == [r.t for r in twice.collect()]
    assert once.collect()[1].t == "a b"


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>")
    s = df.select(V.softmax("x").alias("p")).first().p
    assert math.isclose(sum(s), 1.0) and s[2] > s[1] > s[0]


def test_pandas_lf_slow_path(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    lf = R.pandas_lf("lf_py", "car", lambda t: "Rower" in t)
    out = {r.id: r.lf_py for r in R.apply_lfs(df, [lf]).collect()}
    assert out[7] == "car" and out[0] is None
