"""Registered jobs: embedding operators on the driver's ``embeddings`` table (D6, C5, E2, E3, H1-H9,
J6, K2-K11, D18, B3, B4).

Part of the labels is hidden by seeded hash order to get the reference's setting: a few labelled
vectors and a pool of unlabelled ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.functions import vector as V
from labelkiln.operators import corpus as C
from labelkiln.operators import ranking as RK
from labelkiln.operators import vector as VO
from labelkiln.operators import vector_index as VX
from labelkiln.plans.registry import SQL, job
from labelkiln.sources.corpus import CORPUS_SQL, read_table

SEED = 7
T_ACCEPT = 0.2      # inclusive (Q1)
T_EMB_LF = 0.25     # strict, as the embedding rule (J6)
TEMPERATURE = 10.0  # softmax of cosine scores -> class probabilities


def emb_corpus(spark, sf):
    """(id, vec, gold, label, relevance): a quarter of the rows keep their label."""
    e = read_table(spark, sf, "embeddings")
    hidden = F.substring(RK.hash_order("vec_id", SEED), 1, 1) >= "4"
    gold = F.concat(F.lit("c"), F.col("label").cast("string"))
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), gold.alias("gold"),
                    F.when(hidden, None).otherwise(gold).alias("label"),
                    F.when(hidden, 0).otherwise(1).alias("relevance"))


EMB_SQL = (f"SELECT vec_id AS id, embedding::DOUBLE[] AS vec, 'c' || CAST(label AS VARCHAR) AS gold, "
           f"CASE WHEN substr({RK.hash_order_sql('vec_id', SEED)}, 1, 1) >= '4' THEN NULL "
           f"ELSE 'c' || CAST(label AS VARCHAR) END AS label, "
           f"CASE WHEN substr({RK.hash_order_sql('vec_id', SEED)}, 1, 1) >= '4' THEN 0 ELSE 1 END AS relevance "
           f"FROM embeddings")

PROTO_SQL = (f"SELECT label, list(m ORDER BY pos) AS proto FROM (SELECT label, pos, avg(x) AS m FROM "
             f"(SELECT label, unnest(vec) AS x, unnest(generate_series(0, len(vec) - 1)) AS pos "
             f"FROM ({EMB_SQL}) e WHERE label IS NOT NULL AND vec IS NOT NULL) GROUP BY label, pos) GROUP BY label")

SCORES_SQL = (f"SELECT e.id, e.gold, p.label, list_cosine_similarity(e.vec, p.proto) AS score "
              f"FROM ({EMB_SQL}) e, ({PROTO_SQL}) p WHERE e.label IS NULL AND e.vec IS NOT NULL")

RANKED_SQL = (f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rank "
              f"FROM ({SCORES_SQL}) s")

NEAREST_SQL = f"SELECT id, gold, label AS pred, score FROM ({RANKED_SQL}) r WHERE rank = 1"

# zero-shot stand-in for embedded label names: per class, the labelled vector first in hash order
LABEL_VECS_SQL = (f"SELECT label, vec AS proto FROM (SELECT label, vec, row_number() OVER (PARTITION BY label "
                  f"ORDER BY {RK.hash_order_sql('id', SEED)}) AS r FROM ({EMB_SQL}) e WHERE label IS NOT NULL) "
                  f"WHERE r = 1")

ZS_SQL = (f"SELECT id, label AS pred, score FROM (SELECT e.id, p.label, list_cosine_similarity(e.vec, p.proto) "
          f"AS score, row_number() OVER (PARTITION BY e.id ORDER BY list_cosine_similarity(e.vec, p.proto) DESC, "
          f"p.label) AS rank FROM ({EMB_SQL}) e, ({LABEL_VECS_SQL}) p WHERE e.label IS NULL) WHERE rank = 1")

PROBS_SQL = (f"SELECT id, gold, list_transform(sc, lambda x: exp({TEMPERATURE} * x - {TEMPERATURE} * list_max(sc)) / "
             f"list_sum(list_transform(sc, lambda y: exp({TEMPERATURE} * y - {TEMPERATURE} * list_max(sc))))) AS probs "
             f"FROM (SELECT id, gold, list(score ORDER BY label) AS sc FROM ({SCORES_SQL}) s GROUP BY id, gold)")


def _pool_and_protos(spark, sf):
    e = emb_corpus(spark, sf)
    protos = VO.prototypes(C.labelled(e), "label", "vec")
    return e, C.unlabelled(e), protos


def _label_vecs(e):
    first = RK.rank_within(C.labelled(e), ["label"], RK.hash_order("id", SEED), out="__r")
    return first.filter(F.col("__r") == 0).select("label", F.col("vec").alias("proto"))


def _probs(spark, sf):
    e, pool, protos = _pool_and_protos(spark, sf)
    labels = VO.prototype_labels(protos)
    s = VO.score_matrix(pool, protos, keep=("gold",))
    return s.select("id", "gold", V.softmax(F.transform("scores", lambda x: x * TEMPERATURE)).alias("probs")), labels


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


@job("prototypes", f"SELECT label, CAST(pos AS INT) AS pos, round(avg(x), 6) AS value FROM "
                   f"(SELECT label, unnest(vec) AS x, unnest(generate_series(0, len(vec) - 1)) AS pos "
                   f"FROM ({EMB_SQL}) e WHERE label IS NOT NULL) GROUP BY label, pos")
def prototypes(spark, sf):
    """Mean vector per label (long form, 6 places)."""
    e = emb_corpus(spark, sf)
    return VO.prototypes_long(e, "label", "vec").select("label", "pos", r6("value").alias("value"))


@job("prototype_sizes", f"SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(len(list(id)) AS BIGINT) AS members "
                        f"FROM ({EMB_SQL}) e WHERE label IS NOT NULL GROUP BY label")
def prototype_sizes(spark, sf):
    """D6 member counts and D7 member rows (their number) per label."""
    e = emb_corpus(spark, sf)
    p = VO.prototypes(e, "label", "vec").select("label", "n")
    m = VO.members(e, "label").groupBy("label").agg(F.count("*").cast("bigint").alias("members"))
    return p.join(m, "label")


@job("nearest", f"SELECT id, pred, round(score, 6) AS score FROM ({NEAREST_SQL}) n")
def nearest(spark, sf):
    """Best prototype per unlabelled vector."""
    e, pool, protos = _pool_and_protos(spark, sf)
    return VO.nearest(pool, protos).select("id", "pred", r6("score").alias("score"))


@job("top_k", f"SELECT id, CAST(rank AS INT) AS rank, label AS pred, round(score, 6) AS score FROM ({RANKED_SQL}) r "
              f"WHERE rank <= 3")
def top_k(spark, sf):
    """Three best prototypes per row."""
    e, pool, protos = _pool_and_protos(spark, sf)
    return VO.top_k(pool, protos, 3).select("id", "rank", "pred", r6("score").alias("score"))


@job("prototype_scores", f"SELECT id, label AS pred, round(score, 6) AS score FROM ({SCORES_SQL}) s")
def prototype_scores(spark, sf):
    """K3: score of every unlabelled vector against every prototype."""
    e, pool, protos = _pool_and_protos(spark, sf)
    return VO.prototype_scores(pool, protos).select("id", "pred", r6("score").alias("score"))


@job("accept", f"SELECT id, pred, round(score, 6) AS score FROM ({NEAREST_SQL}) n WHERE score >= {T_ACCEPT}")
def accept(spark, sf):
    """Inclusive confidence threshold."""
    e, pool, protos = _pool_and_protos(spark, sf)
    n = VO.nearest(pool, protos)
    return C.accept(n, "score", T_ACCEPT).select("id", "pred", r6("score").alias("score"))


_CLASS_T = {"c0": 0.22, "c1": 0.22, "c2": 0.22}


@job("accept_by_class", f"SELECT id, pred, round(score, 6) AS score FROM ({NEAREST_SQL}) n WHERE score >= "
                        f"CASE WHEN pred IN ('c0', 'c1', 'c2') THEN 0.22 ELSE {T_ACCEPT} END")
def accept_by_class(spark, sf):
    """Higher thresholds for some classes."""
    e, pool, protos = _pool_and_protos(spark, sf)
    n = VO.nearest(pool, protos)
    return (C.accept_by_class(n, _CLASS_T, label="pred", score="score", default=T_ACCEPT)
            .select("id", "pred", r6("score").alias("score")))


@job("embedding_lf", f"SELECT id, pred AS vote FROM ({NEAREST_SQL}) n WHERE score > {T_EMB_LF}")
def embedding_lf(spark, sf):
    """Embedding rule, best prototype when cosine > 0.25 (strict)."""
    e, pool, protos = _pool_and_protos(spark, sf)
    return VO.embedding_label(pool, protos, T_EMB_LF, strict=True).select("id", F.col("pred").alias("vote"))


@job("prototype_label", f"""SELECT e.id, coalesce(e.label, a.pred) AS label,
  CASE WHEN e.label IS NULL AND a.pred IS NOT NULL THEN 1 ELSE e.relevance END AS relevance
  FROM ({EMB_SQL}) e LEFT JOIN (SELECT id, pred FROM ({NEAREST_SQL}) n WHERE score >= {T_ACCEPT}) a ON e.id = a.id""")
def prototype_label(spark, sf):
    """K2: prototypes -> nearest -> inclusive threshold -> write back by key."""
    e = emb_corpus(spark, sf)
    return VO.prototype_label(e.select("id", "vec", "label", "relevance"), T_ACCEPT).select(
        "id", "label", "relevance")


@job("zero_shot", f"SELECT id, pred, round(score, 6) AS score FROM ({ZS_SQL}) z")
def zero_shot(spark, sf):
    """K4: nearest label-name vector for every unlabelled row."""
    e = emb_corpus(spark, sf)
    return VO.zero_shot(C.unlabelled(e), _label_vecs(e)).select("id", "pred", r6("score").alias("score"))


@job("fallback", f"""SELECT u.id, coalesce(a.pred, b.pred) AS pred,
  CASE WHEN a.pred IS NOT NULL THEN 0 WHEN b.pred IS NOT NULL THEN 1 END AS method
  FROM (SELECT id FROM ({EMB_SQL}) e WHERE label IS NULL) u
  LEFT JOIN (SELECT id, pred FROM ({NEAREST_SQL}) n WHERE score >= 0.25) a ON u.id = a.id
  LEFT JOIN (SELECT id, pred FROM ({ZS_SQL}) z WHERE score >= 0.3) b ON u.id = b.id""")
def fallback(spark, sf):
    """K8: prototypes first (>= 0.25), else zero-shot (>= 0.3)."""
    e, pool, protos = _pool_and_protos(spark, sf)
    a = VO.nearest(pool, protos)
    b = VO.zero_shot(pool, _label_vecs(e))
    return VO.fallback(pool, [(a, 0.25), (b, 0.3)])


@job("unmatched", f"""SELECT u.id FROM (SELECT id FROM ({EMB_SQL}) e WHERE label IS NULL) u
  WHERE u.id NOT IN (SELECT id FROM ({NEAREST_SQL}) n WHERE score >= 0.25)
    AND u.id NOT IN (SELECT id FROM ({ZS_SQL}) z WHERE score >= 0.3)""")
def unmatched(spark, sf):
    """Rows no method is sure about."""
    return VO.unmatched(fallback(spark, sf)).select("id")


@job("semantic_search", f"""SELECT id, CAST(rank AS INT) AS rank, hit, round(score, 6) AS score FROM (
  SELECT q.id, c.id AS hit, list_cosine_similarity(q.vec, c.vec) AS score,
         row_number() OVER (PARTITION BY q.id ORDER BY list_cosine_similarity(q.vec, c.vec) DESC, c.id) AS rank
  FROM ({EMB_SQL}) q, ({EMB_SQL}) c WHERE q.label IS NULL AND c.label IS NOT NULL) WHERE rank <= 3""")
def semantic_search(spark, sf):
    """K9: three most similar labelled vectors for every unlabelled one."""
    e = emb_corpus(spark, sf)
    return (VO.semantic_search(C.unlabelled(e), C.labelled(e), 3)
            .select("id", "rank", "hit", r6("score").alias("score")))


@job("semantic_search_index")
def semantic_search_index(spark, sf):
    """K9 by a cell index: every row whose id is divisible by 50 searches all vectors, with as many probes as a
    recall of 0.95 takes on a sample of the queries; the tests measure recall against the exact search."""
    e = emb_corpus(spark, sf)
    queries = e.filter(F.col("id") % 50 == 0)
    index = VX.build_index(e)
    probes = VX.probes_for(index, queries, 5, 0.95)
    return VX.search_index(index, queries, 5, probes).select("id", "rank", "hit", r6("score").alias("score"))


@job("semantic_search_exact", SQL["semantic_search"])
def semantic_search_exact(spark, sf):
    """K9 by a cell index that visits every cell that can hold a better hit: the rows of the exact search."""
    e = emb_corpus(spark, sf)
    index = VX.build_index(C.labelled(e))
    return (VX.search_index(index, C.unlabelled(e), 3, 4, exact=True)
            .select("id", "rank", "hit", r6("score").alias("score")))


@job("nearest_large", SQL["nearest"])
def nearest_large(spark, sf):
    """C5 with prototypes in a cell index: neither side collected or broadcast."""
    e = emb_corpus(spark, sf)
    protos = VO.prototypes(C.labelled(e), "label", "vec")
    return VX.nearest_large(C.unlabelled(e), protos).select("id", "pred", r6("score").alias("score"))


@job("vector_checks", "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(embedding IS NULL) AS BIGINT) AS null_vectors, "
                      "CAST(count_if(embedding IS NOT NULL AND len(embedding) <> 64) AS BIGINT) AS wrong_length, "
                      "CAST(count_if(embedding IS NOT NULL AND list_bool_or(list_transform(embedding, lambda x: isnan(x)))) "
                      "AS BIGINT) AS with_nan, CAST(count_if(embedding IS NOT NULL AND list_bool_and(list_transform("
                      "embedding, lambda x: x = 0))) AS BIGINT) AS zero_vectors FROM embeddings")
def vector_checks(spark, sf):
    """Vector quality checks."""
    return C.vector_checks(read_table(spark, sf, "embeddings"), "embedding", 64)


@job("cosine", f"SELECT a.id, round(list_cosine_similarity(a.vec, b.proto), 6) AS cosine, "
               f"round(list_dot_product(a.vec, b.proto), 6) AS dot, round(sqrt(list_dot_product(a.vec, a.vec)), 6) AS norm "
               f"FROM ({EMB_SQL}) a JOIN ({LABEL_VECS_SQL}) b ON a.gold = b.label")
def cosine(spark, sf):
    """H1, H2: cosine, dot and norm as column expressions (each vector vs its class's label vector)."""
    e = emb_corpus(spark, sf)
    lv = _label_vecs(e).withColumnRenamed("label", "gold")
    j = e.join(F.broadcast(lv), "gold")  # one row per class
    return j.select("id", r6(V.cosine("vec", "proto")).alias("cosine"), r6(V.dot("vec", "proto")).alias("dot"),
                    r6(V.norm("vec")).alias("norm"))


@job("best_class", f"SELECT id, 'c' || CAST(list_position(probs, list_max(probs)) - 1 AS VARCHAR) AS pred, "
                   f"round(list_max(probs), 6) AS confidence FROM ({PROBS_SQL}) p")
def best_class(spark, sf):
    """Best class and its probability from a probability vector (H4 softmax of scores)."""
    probs, labels = _probs(spark, sf)
    return RK.best_class(probs, "probs", labels).select("id", "pred", r6("confidence").alias("confidence"))


@job("uncertainty", f"""SELECT id, round(1 - list_max(probs), 6) AS least_confidence,
  round(list_sort(probs, 'DESC')[1] - list_sort(probs, 'DESC')[2], 6) AS margin,
  round(-list_sum(list_transform(probs, lambda x: CASE WHEN x > 0 THEN x * ln(x) ELSE 0 END)), 6) AS entropy,
  round(list_sum(list_transform(probs, lambda x: x * sqrt(list_sum(list_transform(probs, lambda y: y * y)) - 2 * x + 1))), 6) AS egl,
  round(list_avg(list_transform(probs, lambda x: 1 - 2 * abs(x - 0.5))), 6) AS ml_uncertainty,
  round(list_max(list_transform(probs, lambda x: 1 - 2 * abs(x - 0.5))), 6) AS ml_most
  FROM ({PROBS_SQL}) p""")
def uncertainty(spark, sf):
    """H5-H9: least confidence, margin, entropy, expected gradient length, multi-label uncertainty."""
    probs, _ = _probs(spark, sf)
    return probs.select("id", r6(V.least_confidence("probs")).alias("least_confidence"),
                        r6(V.margin("probs")).alias("margin"), r6(V.entropy("probs")).alias("entropy"),
                        r6(V.egl("probs", F.lit(1.0))).alias("egl"),
                        r6(V.multilabel_uncertainty("probs")).alias("ml_uncertainty"),
                        r6(V.multilabel_uncertainty("probs", "max")).alias("ml_most"))


@job("query_batch", f"SELECT id, round(1 - list_max(probs), 6) AS uncertainty FROM ({PROBS_SQL}) p "
                    f"ORDER BY 1 - list_max(probs) DESC, id LIMIT 50")
def query_batch(spark, sf):
    """The 50 least certain rows for the expert (a top-n report: the limit is the feature)."""
    probs, _ = _probs(spark, sf)
    s = probs.select("id", V.least_confidence("probs").alias("uncertainty"))
    return RK.query_batch(s, 50, "uncertainty").select("id", r6("uncertainty").alias("uncertainty"))


@job("top_fraction", f"SELECT id, round(list_max(probs), 6) AS confidence FROM (SELECT *, row_number() OVER "
                     f"(ORDER BY list_max(probs) DESC, id) AS r, count(*) OVER () AS n FROM ({PROBS_SQL}) p) "
                     f"WHERE r <= ceil(n * 0.1)")
def top_fraction(spark, sf):
    """The surest 10% of the pool."""
    probs, _ = _probs(spark, sf)
    s = probs.select("id", F.array_max("probs").alias("confidence"))
    return RK.top_fraction(s, 0.1, "confidence").select("id", r6("confidence").alias("confidence"))


@job("route", f"""SELECT id, CASE WHEN list_max(probs) >= 0.3 THEN 'pseudo' ELSE 'expert' END AS route FROM (
  SELECT *, row_number() OVER (ORDER BY 1 - list_max(probs) DESC, id) AS r FROM ({PROBS_SQL}) p)
  WHERE list_max(probs) >= 0.3 OR r <= 20""")
def route(spark, sf):
    """Surest rows pseudo-labelled (confidence >= 0.3), the 20 least sure sent to the expert."""
    probs, _ = _probs(spark, sf)
    s = probs.select("id", F.array_max("probs").alias("confidence"))
    return RK.route(s, 0.3, 20)


@job("softmax_sigmoid", f"""SELECT id, array_to_string(list_transform(probs, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',') AS probs,
  round(1 / (1 + exp(-list_max(probs))), 6) AS sigmoid_max FROM ({PROBS_SQL}) p""")
def softmax_sigmoid(spark, sf):
    """H3, H4: the softmax of the scores; sigmoid of the top probability."""
    probs, _ = _probs(spark, sf)
    return probs.select("id", F.array_join(F.transform("probs", lambda x: F.round(x * 1000000).cast("bigint").cast("string")), ",").alias("probs"),
                        r6(V.sigmoid(F.array_max("probs"))).alias("sigmoid_max"))


def _doc_vectors(spark, sf):
    from labelkiln.sources.corpus import corpus_from_tables
    return VO.embed(corpus_from_tables(spark, sf), text="text", out="vec", dim=64)


@job("embed", f"""SELECT id, CAST(64 AS INT) AS dim, array_to_string(list_transform(vec, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',') AS vec
  FROM ({VO.hashed_embedding_sql(f"({CORPUS_SQL}) c")})""")
def embed(spark, sf):
    """K1: text -> vector for the whole documents table (built-in hashed bag of words; a supplied
    encoder runs through the same call on Arrow batches)."""
    v = _doc_vectors(spark, sf)
    whole = F.transform("vec", lambda x: F.round(x * 1000000).cast("bigint").cast("string"))
    return v.select("id", F.size("vec").alias("dim"), F.array_join(whole, ",").alias("vec"))


@job("score_map", f"SELECT id, string_agg(label || '=' || CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY label) AS scores "
                  f"FROM ({RANKED_SQL}) r GROUP BY id")
def score_map(spark, sf):
    """K3: all scores of a row in one map, here written out in label order."""
    e, pool, protos = _pool_and_protos(spark, sf)
    m = VO.score_map(pool, protos)
    each = F.transform(F.array_sort(F.map_entries("scores")), lambda x: F.concat(
        x["key"], F.lit("="), F.round(x["value"] * 1000000).cast("bigint").cast("string")))
    return m.select("id", F.array_join(each, ",").alias("scores"))


_DAMAGED_SQL = ("SELECT e.vec_id AS id, d.text, CASE WHEN vec_id % 40 = 1 THEN NULL WHEN vec_id % 40 = 2 THEN list_slice(embedding, 1, 63) "
                "WHEN vec_id % 40 = 3 THEN list_prepend('NaN'::FLOAT, list_slice(embedding, 2, 64)) ELSE embedding END AS vec "
                "FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id")


@job("bad_vectors", f"SELECT id, text, CASE WHEN vec IS NULL THEN 'null' WHEN len(vec) <> 64 THEN 'wrong_length' ELSE 'nan' END AS problem "
                    f"FROM ({_DAMAGED_SQL}) v WHERE vec IS NULL OR len(vec) <> 64 OR list_bool_or(list_transform(vec, lambda x: isnan(x)))")
def bad_vectors(spark, sf):
    """The rows with unusable vectors and their texts; some vectors of the table are damaged first."""
    e, d = read_table(spark, sf, "embeddings"), read_table(spark, sf, "documents")
    k, v = F.col("vec_id") % 40, F.col("embedding")
    vec = (F.when(k == 1, None).when(k == 2, F.slice(v, 1, 63))
           .when(k == 3, F.concat(F.array(F.lit(float("nan")).cast("float")), F.slice(v, 2, 63))).otherwise(v))
    rows = e.join(d, e["vec_id"] == d["doc_id"], "left").select(F.col("vec_id").alias("id"), "text", vec.alias("vec"))
    return C.bad_vectors(rows, "vec", 64, "text").select("id", "text", "problem")


@job("prototype_label_docs")
def prototype_label_docs(spark, sf):
    """K2 end to end on documents: embed -> prototypes of labelled docs -> nearest for the rest ->
    inclusive threshold 0.5 -> write back (relevance 1)."""
    v = _doc_vectors(spark, sf).select("id", "vec", "label", "relevance")
    return VO.prototype_label(v, 0.5).select("id", "label", "relevance")
