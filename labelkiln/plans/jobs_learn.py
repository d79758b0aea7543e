"""Registered jobs: features, classifiers, cascades, hierarchies and training loops.

Fits are iterative, so most of these have no SQL twin; the tests check their properties.  The
relational TF-IDF and the sequence encoding are exact and have DuckDB twins.
"""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.operators import corpus as C
from labelkiln.operators import learn as L
from labelkiln.operators.classifier import MLClassifier
from labelkiln.operators import ranking as RK
from labelkiln.plans.jobs_vector import emb_corpus
from labelkiln.plans.registry import job
from labelkiln.session import cut_lineage
from labelkiln.sources.corpus import CORPUS_SQL, corpus_from_tables, read_table

CS = f"({CORPUS_SQL}) c"


@job("tfidf", f"""WITH toks AS (SELECT id, unnest({tx.words_sql('text')}) AS term FROM {CS}),
  tf AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY id, term),
  st AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY term),
  voc AS (SELECT * FROM st ORDER BY cf DESC, term LIMIT 1000),
  w AS (SELECT tf.id, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + voc.df)) + 1) AS w
        FROM tf JOIN voc ON tf.term = voc.term)
  SELECT w.id, w.term, round(w.w / sqrt(sum(w.w * w.w) OVER (PARTITION BY w.id)), 6) AS weight FROM w""")
def tfidf(spark, sf):
    """L1 relational TF-IDF with a 1,000-term vocabulary, smooth IDF + 1, L2 rows."""
    c = corpus_from_tables(spark, sf)
    t = L.tfidf_relational(c, "text", "id", 1000)
    return t.select("id", "term", F.round("weight", 6).alias("weight"))


@job("encode_sequences", f"""WITH toks AS (SELECT unnest({tx.words_sql('text')}) AS token FROM {CS}),
  voc AS (SELECT token, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS INT) AS token_id FROM toks GROUP BY token),
  seq AS (SELECT id, unnest(list_slice({tx.words_sql('text')}, 1, 512)) AS token,
                 unnest(generate_series(0, len(list_slice({tx.words_sql('text')}, 1, 512)) - 1)) AS pos FROM {CS}),
  ids AS (SELECT seq.id, list(coalesce(voc.token_id, 1) ORDER BY pos) AS ids FROM seq LEFT JOIN voc ON seq.token = voc.token GROUP BY seq.id)
  SELECT c.id, array_to_string(list_concat(coalesce(ids.ids, []), list_transform(range(512 - len(coalesce(ids.ids, []))), lambda x: 0)), ',') AS input_ids,
         CAST(len(coalesce(ids.ids, [])) AS INT) AS attention FROM {CS} LEFT JOIN ids ON c.id = ids.id""")
def encode_sequences(spark, sf):
    """Word-level ids, truncated/padded to 512, with attention mask (summed here)."""
    c = corpus_from_tables(spark, sf)
    voc = L.token_vocab(c, "text")
    e = L.encode_sequences(c, voc, "text", "id", 512)
    return e.select("id", F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("attention"))


def _doc_features(spark, sf):
    c = corpus_from_tables(spark, sf, ("lang",))
    return L.tfidf_rows(c, "text", 1000)[1]


@job("train_lr")
def train_lr(spark, sf):
    """L1 + L2: TF-IDF features, multinomial LR on labelled documents, scores for the unlabelled."""
    d = _doc_features(spark, sf)
    m = L.train_lr(C.labelled(d), "label")
    return L.score(m, C.unlabelled(d)).select("id", "pred", F.round("confidence", 6).alias("confidence"))


@job("train_relevance")
def train_relevance(spark, sf):
    """L3: class-balanced gatekeeper on relevance (labelled vs not), scored on every document."""
    d = _doc_features(spark, sf)
    m = L.train_relevance(d, "relevance")
    return L.score(m, d).select("id", F.col("pred").alias("relevant"), F.round("confidence", 6).alias("confidence"))


@job("train_svm")
def train_svm(spark, sf):
    """Weighted linear SVM gatekeeper."""
    d = _doc_features(spark, sf)
    m = L.train_svm(d, "relevance")
    return m.transform(d).select("id", F.col("svm_pred").cast("int").alias("relevant"))


@job("fewshot_label")
def fewshot_label(spark, sf):
    """L4: classifier head on stored vectors, accept >= 0.6, write back by key."""
    e = emb_corpus(spark, sf).select("id", "vec", "label", "relevance")
    return L.fewshot_label(e, "vec", "label", 0.6).select("id", "label", "relevance")


def _ml_features(spark, sf):
    d = _doc_features(spark, sf)
    lab = read_table(spark, sf, "labels")
    arr = F.filter(F.array(F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 0, "low_quality")),
                   lambda x: x.isNotNull())
    return d.join(lab.select(F.col("doc_id").alias("id"), arr.alias("labels")), "id", "left")


@job("train_multilabel")
def train_multilabel(spark, sf):
    """One binary model per label (low_quality, toxic), labels above 0.5 per document."""
    d = _ml_features(spark, sf)
    ms = L.train_multilabel(d.filter(F.col("labels").isNotNull()), "labels", ["low_quality", "toxic"])
    return L.predict_multilabel(ms, d).select("id", F.array_join("labels_pred", ",").alias("labels"))


def cascade_models(spark, sf, features):
    """The relevance gate and the label specialist on documents with ``features``."""
    lab = read_table(spark, sf, "labels")
    arr = F.filter(F.array(F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 0, "low_quality")),
                   lambda x: x.isNotNull())
    d = cut_lineage(features.join(lab.select(F.col("doc_id").alias("id"), arr.alias("labels")), "id", "left"))
    return L.train_relevance(d, "relevance"), L.train_multilabel(d, "labels", ["low_quality", "toxic"])


@job("cascade")
def cascade(spark, sf):
    """Relevance gate first, multi-label specialist only on rows the gate passes; every id once."""
    d = _doc_features(spark, sf)
    out = L.cascade(d, *cascade_models(spark, sf, d))
    return out.select("id", F.array_join("labels_pred", ",").alias("labels"))


@job("hierarchy")
def hierarchy(spark, sf):
    """One classifier per parent over lang -> quality -> toxicity, descended level by level."""
    d = _doc_features(spark, sf)
    lab = read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.when(F.col("quality") == 0, "low").otherwise("ok").alias("quality_level"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("civil").alias("toxic_level"))
    d = d.join(lab, "id", "left")
    levels = ["lang", "quality_level", "toxic_level"]
    ms = L.train_hierarchy(d.filter(F.col("quality_level").isNotNull()), levels)
    p = L.predict_path(ms, d.select("id", "features"), 3)
    return p.select("id", tx.path_key("path").alias("path"))


@job("self_train")
def self_train(spark, sf):
    """Self-training on vectors, 3 rounds, thresholds 0.3 then 0.25 then 0.2 (a lowering
    schedule), stop on empty pool or nothing accepted."""
    e = L.vectors_as_features(emb_corpus(spark, sf))
    lab, pool = L.self_train(C.labelled(e), C.unlabelled(e), [0.3, 0.25, 0.2], 3)
    return lab.select("id", "label", "round")


@job("self_train_balanced")
def self_train_balanced(spark, sf):
    """L8-L10 with all controls: a threshold per class that falls each round, the surest 10 % of the pool per round at most,
    and each fit on 60 rows per class, cut or repeated; naive Bayes as a supplied classifier, on shifted vectors."""
    e = emb_corpus(spark, sf)
    e = L.vectors_as_features(e.withColumn("vec", F.transform("vec", lambda x: x.cast("double") + 1.0)))
    classes = [r[0] for r in C.labelled(e).select("label").distinct().orderBy("label").collect()]
    plan = [{c: (0.4 if i % 2 else 0.35) - 0.1 * r for i, c in enumerate(classes)} for r in range(3)]
    lab, _ = L.self_train(C.labelled(e), C.unlabelled(e), plan, 3, surest=0.1, balance=60,
                          classifier=MLClassifier(NaiveBayes(modelType="gaussian")))
    return lab.select("id", "label", "round")


@job("active_learn_egl")
def active_learn_egl(spark, sf):
    """L11 with expected gradient length, and with a yes/no model per label (the most undecided one counts): which rows
    each asks the expert for."""
    e = L.vectors_as_features(emb_corpus(spark, sf))
    one, _ = L.active_learn(C.labelled(e), C.unlabelled(e), e.select("id", F.col("gold").alias("label")), 20, 2, "egl")
    lists = e.withColumn("label", F.when(F.col("label").isNotNull(), F.array("label")))
    many, _ = L.active_learn(C.labelled(lists), C.unlabelled(lists), e.select("id", F.array("gold").alias("label")), 20, 2,
                             "multilabel_most")
    return (one.select("id", "round", "label", F.lit("egl").alias("strategy"))
            .unionByName(many.select("id", "round", F.array_join("label", ",").alias("label"),
                                     F.lit("multilabel_most").alias("strategy"))))


@job("active_learn")
def active_learn(spark, sf):
    """3 rounds of 20 least-confident rows answered by the expert table (gold labels)."""
    e = L.vectors_as_features(emb_corpus(spark, sf))
    expert = e.select("id", F.col("gold").alias("label"))
    lab, pool = L.active_learn(C.labelled(e), C.unlabelled(e), expert, 20, 3)
    return lab.select("id", "label", "round")


@job("search")
def search(spark, sf):
    """15 seeded random LR settings, objective F1 of the 'toxic' class, validation split."""
    d = _doc_features(spark, sf)
    m = L.search(C.labelled(d), "label", trials=15, seed=42, positive="toxic")
    return L.search_results(m, spark).select("trial", "reg", "elastic_net", "max_iter", F.round("f1", 6).alias("f1"))


@job("fit_best")
def fit_best(spark, sf):
    """L15 (+E5, D14): stratified split, fit with chosen settings, per-class metrics on the test part."""
    d = _doc_features(spark, sf)
    s = RK.stratified_split(C.labelled(d), "label", 0.2, 42)
    _, res = L.fit_best(s.filter("split = 'train'"), s.filter("split = 'test'"), {"regParam": 0.01, "maxIter": 50})
    return res.select("label", "tp", "fp", "fn", F.round("f1", 6).alias("f1"))
