"""Registered jobs: weights, deficits, sampling, augmentation, pairs and metrics (D8-D10, D14-D16, D19,
E5, E6, F4, F5, M1-M9, G10, C9, C10, C12, C13, H10-H13, K10, I1, I2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.functions import vector as V
from labelkiln.operators import balance as B
from labelkiln.operators import corpus as C
from labelkiln.operators import metrics as M
from labelkiln.operators import pairs as P
from labelkiln.operators import ranking as RK
from labelkiln.operators import rules as R
from labelkiln.plans.corpus_rules import positive_rules
from labelkiln.plans.jobs_vector import EMB_SQL, emb_corpus, r6
from labelkiln.plans.registry import job
from labelkiln.sources.corpus import CORPUS_SQL, corpus_from_tables, read_table

CS = f"({CORPUS_SQL}) c"
LAB = f"(SELECT * FROM {CS} WHERE label IS NOT NULL) lab"
SEED = 42


def _hu(*parts: str, seed=SEED) -> str:
    return RK.hash_unit_sql(*parts, seed=seed)


def _pos_sql(src: str, label: str = "label", id_col: str = "id", seed=SEED) -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {RK.hash_order_sql(id_col, seed)}) - 1 AS pos, "
            f"count(*) OVER (PARTITION BY {label}) AS n, dense_rank() OVER (ORDER BY {label}) - 1 AS li, "
            f"count(DISTINCT {label}) OVER () AS n_labels FROM {src} WHERE {label} IS NOT NULL")


# --------------------------------------------------------------------------------------- weights


@job("class_weights", f"SELECT label, CAST(count(*) AS BIGINT) AS n, round(sum(count(*)) OVER () / "
                      f"(count(*) OVER () * count(*)), 6) AS weight FROM {LAB} GROUP BY label")
def class_weights(spark, sf):
    """Balanced class weights N / (k * n_j)."""
    c = corpus_from_tables(spark, sf)
    return B.class_weights(c).select("label", "n", r6("weight").alias("weight"))


_GOLD_ARR = ("list_filter([CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 0 THEN 'low_quality' END], "
             "lambda x: x IS NOT NULL)")


def _gold_sets(spark, sf):
    lab = read_table(spark, sf, "labels")
    arr = F.filter(F.array(F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 0, "low_quality")),
                   lambda x: x.isNotNull())
    return lab.select("doc_id", arr.alias("labels"))


@job("pos_weights", f"SELECT label, CAST(count(*) AS BIGINT) AS pos, CAST((SELECT count(*) FROM labels) - count(*) AS BIGINT) "
                    f"AS neg, round(((SELECT count(*) FROM labels) - count(*)) / count(*), 6) AS pos_weight FROM "
                    f"(SELECT unnest(list_distinct({_GOLD_ARR})) AS label FROM labels) GROUP BY label")
def pos_weights(spark, sf):
    """Per-label positive weight neg/pos for the multi-label gold sets."""
    return B.pos_weights(_gold_sets(spark, sf), "labels").select("label", "pos", "neg", r6("pos_weight").alias("pos_weight"))


@job("deficits", f"SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(greatest(100 - count(*), 0) AS BIGINT) AS deficit, "
                 f"CAST(ceil(greatest(100 - count(*), 0) / count(*)) AS BIGINT) AS variants FROM {LAB} GROUP BY label")
def deficits(spark, sf):
    """Deficit to 100 and variants per text."""
    return B.deficits(corpus_from_tables(spark, sf), "label", 100)


@job("stratified_split", f"SELECT id, label, CASE WHEN pos < round(n * 0.2) THEN 'test' ELSE 'train' END AS split "
                         f"FROM ({_pos_sql(CS)})")
def stratified_split(spark, sf):
    """E5: exact 80/20 stratified split in seeded hash order."""
    c = C.labelled(corpus_from_tables(spark, sf)).select("id", "label")
    return RK.stratified_split(c, "label", 0.2, SEED)


@job("balanced_sample", f"SELECT id, label FROM ({_pos_sql(CS)}) WHERE pos < 40")
def balanced_sample(spark, sf):
    """40 rows of each class (all of a smaller class)."""
    c = corpus_from_tables(spark, sf).select("id", "label")
    return B.balanced_sample(c, "label", 40, SEED)


@job("rebalance", f"SELECT id, label, CAST(copy AS INT) AS copy FROM (SELECT *, unnest(generate_series(0, "
                  f"CAST(ceil(100 / n) AS BIGINT) - 1)) AS copy FROM ({_pos_sql(CS)})) WHERE copy * n + pos < 100")
def rebalance(spark, sf):
    """every class to exactly 100 rows (cut or repeated)."""
    c = corpus_from_tables(spark, sf).select("id", "label")
    return B.rebalance(c, "label", 100, SEED).select("id", "label", F.col("copy").cast("int"))


# --------------------------------------------------------------------------------------- augmentation

_WORDS_SQL = "list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')"


@job("eda_delete", f"SELECT id, array_to_string(CASE WHEN len(k) > 0 THEN k ELSE w[1:1] END, ' ') AS augmented FROM ("
                   f"SELECT id, w, list_filter(w, lambda x, i: {_hu('id', 'i - 1')} >= 0.1) AS k FROM "
                   f"(SELECT id, {_WORDS_SQL} AS w FROM {CS}))")
def eda_delete(spark, sf):
    """M4: random deletion of words (p = 0.1, seeded)."""
    c = corpus_from_tables(spark, sf)
    return c.select("id", F.array_join(B.eda_delete(B.split_words("text"), "id", 0.1, SEED), " ").alias("augmented"))


@job("eda_swap", f"SELECT id, array_to_string(CASE WHEN len(w) < 2 THEN w ELSE list_transform(w, lambda x, i: CASE "
                 f"WHEN i - 1 = i1 THEN w[i2 + 1] WHEN i - 1 = i2 THEN w[i1 + 1] ELSE x END) END, ' ') AS augmented FROM ("
                 f"SELECT id, w, CAST(floor({_hu('id', chr(39) + 's1' + chr(39))} * len(w)) AS INT) AS i1, "
                 f"CAST(floor({_hu('id', chr(39) + 's2' + chr(39))} * len(w)) AS INT) AS i2 FROM "
                 f"(SELECT id, {_WORDS_SQL} AS w FROM {CS}))")
def eda_swap(spark, sf):
    """M3: random swap of two words (seeded)."""
    c = corpus_from_tables(spark, sf)
    return B.eda_swap_df(c.select("id", "text"), "text", "id", SEED).select("id", "augmented")


@job("mask_words", f"SELECT id, array_to_string(list_transform(w, lambda x, i: CASE WHEN "
                   f"{_hu('id', 'i - 1', chr(39) + 'm' + chr(39))} < 0.15 THEN '[MASK]' ELSE x END), ' ') AS augmented "
                   f"FROM (SELECT id, {_WORDS_SQL} AS w FROM {CS})")
def mask_words(spark, sf):
    """M5: mask random words with [MASK] (p = 0.15, seeded)."""
    c = corpus_from_tables(spark, sf)
    return c.select("id", F.array_join(B.mask_words(B.split_words("text"), "id", 0.15, SEED), " ").alias("augmented"))


def _synonyms(spark, sf):
    """Synonym table derived from the data: every benchmark token and a marked variant of it."""
    b = read_table(spark, sf, "benchmark")
    t = b.select(F.explode(tx.words("text")).alias("word")).distinct()
    return t.select("word", F.concat("word", F.lit("_alt")).alias("synonym"))


_SYN_SQL = (f"(SELECT word, min_by(synonym, md5(word || ':' || synonym || ':{SEED}')) AS synonym FROM "
            f"(SELECT DISTINCT unnest({tx.words_sql('text')}) AS word, unnest({tx.words_sql('text')}) || '_alt' AS synonym "
            f"FROM benchmark) GROUP BY word)")


@job("eda_synonym", f"""SELECT id, string_agg(CASE WHEN s.synonym IS NOT NULL AND {_hu('id', 'pos', chr(39) + 'r' + chr(39))} < 0.2
  THEN s.synonym ELSE w END, ' ' ORDER BY pos) AS augmented FROM (
  SELECT id, unnest(ws) AS w, unnest(generate_series(0, len(ws) - 1)) AS pos FROM
  (SELECT id, {_WORDS_SQL} AS ws FROM {CS} WHERE text IS NOT NULL)) x LEFT JOIN {_SYN_SQL} s ON lower(x.w) = s.word
  GROUP BY id""")
def eda_synonym(spark, sf):
    """M1: synonym replacement (p = 0.2) with a synonym table derived from the benchmark texts."""
    c = corpus_from_tables(spark, sf).filter(F.col("text").isNotNull())
    return B.eda_synonym(c.select("id", "text"), _synonyms(spark, sf), p=0.2, seed=SEED).select("id", "augmented")


@job("eda_insert", f"""SELECT id, array_to_string(CASE WHEN s.synonym IS NOT NULL THEN list_concat(list_slice(w, 1, ins_at - 1), [s.synonym], list_slice(w, ins_at, len(w))) ELSE w END, ' ')
  AS augmented FROM (SELECT id, w, lower(w[CAST(floor({_hu('id', chr(39) + 'i1' + chr(39))} * len(w)) AS INT) + 1]) AS pick,
  CAST(floor({_hu('id', chr(39) + 'i2' + chr(39))} * (len(w) + 1)) AS INT) + 1 AS ins_at
  FROM (SELECT id, {_WORDS_SQL} AS w FROM {CS} WHERE text IS NOT NULL)) x LEFT JOIN {_SYN_SQL} s ON x.pick = s.word""")
def eda_insert(spark, sf):
    """M2: random insertion of a synonym."""
    c = corpus_from_tables(spark, sf).filter(F.col("text").isNotNull())
    return B.eda_insert(c.select("id", "text"), _synonyms(spark, sf), seed=SEED).select("id", "augmented")


_AUGMENTED_SQL = f"""SELECT id, 0 AS variant_no, label, text FROM {LAB}
  UNION ALL
  SELECT id, CAST(variant_no AS INT) AS variant_no, label, array_to_string(CASE
    WHEN variant_no % 2 = 1 THEN CASE WHEN len(d) > 0 THEN d ELSE w[1:1] END
    WHEN len(w) < 2 THEN w
    ELSE list_transform(w, lambda x, i: CASE WHEN i - 1 = i1 THEN w[i2 + 1] WHEN i - 1 = i2 THEN w[i1 + 1] ELSE x END) END, ' ') AS text
  FROM (SELECT *, list_filter(w, lambda x, i: {_hu('k', 'i - 1')} >= 0.1) AS d,
          CAST(floor({_hu('k', "'s1'")} * len(w)) AS INT) AS i1, CAST(floor({_hu('k', "'s2'")} * len(w)) AS INT) AS i2
        FROM (SELECT *, {_WORDS_SQL} AS w, CAST(id AS VARCHAR) || ':' || CAST(variant_no AS VARCHAR) AS k FROM (
          SELECT g.*, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || ':' || CAST(variant_no AS VARCHAR) || ':{SEED}')) - 1 AS p
          FROM (SELECT lab.id, lab.label, lab.text, d.deficit, unnest(generate_series(1, d.variants)) AS variant_no FROM {LAB}
                JOIN (SELECT label, greatest(100 - count(*), 0) AS deficit, CAST(ceil(greatest(100 - count(*), 0) / count(*)) AS BIGINT) AS variants
                      FROM {LAB} GROUP BY label) d ON lab.label = d.label WHERE d.deficit > 0) g) WHERE p < deficit))"""


@job("augment_to_target", _AUGMENTED_SQL)
def augment_to_target(spark, sf):
    """M6: fill every class up to 100 rows with EDA variants (deletions and swaps): originals and generated texts."""
    c = corpus_from_tables(spark, sf).select("id", "text", "label")
    a = B.augment_to_target(c, "label", 100, seed=SEED)
    return a.select("id", F.col("variant_no").cast("int").alias("variant_no"), "label", "text")


@job("review_sample", f"SELECT id FROM {CS} ORDER BY {RK.hash_order_sql('id', SEED)} LIMIT 25")
def review_sample(spark, sf):
    """M8: seeded review sample of 25 rows (the limit is the feature)."""
    return B.review_sample(corpus_from_tables(spark, sf), 25, SEED).select("id")


_TEMPLATES = ["Rewrite in other words: {text}", "Write a similar sentence to: {text}"]


@job("prompt_table", f"SELECT id, CAST(t.i AS INT) AS template_no, replace(t.tpl, '{{text}}', text) AS prompt FROM "
                     f"{CS}, (SELECT * FROM (VALUES (0, '{_TEMPLATES[0]}'), "
                     f"(1, '{_TEMPLATES[1]}')) v(i, tpl)) t")
def prompt_table(spark, sf):
    """Prompt rows for an outside generator, one per document and template."""
    c = corpus_from_tables(spark, sf)
    return B.prompt_table(c, _TEMPLATES).select("id", F.col("template_no").cast("int"), "prompt")


# --------------------------------------------------------------------------------------- metrics

_PRED_SQL = (f"SELECT c.id, c.label AS gold, CASE WHEN regexp_matches(c.text, "
             f"'{tx.keyword_regex_sql(['trash', 'idiot', 'clown', 'scum', 'worthless', 'moron', 'pathetic', 'loser', 'disgusting', 'stupid'])}') "
             f"THEN 1 ELSE 0 END AS pred_toxic, CASE WHEN c.label = 'toxic' THEN 1 ELSE 0 END AS gold_toxic FROM {CS} "
             f"WHERE c.label IS NOT NULL")


def _preds(spark, sf):
    c = C.labelled(corpus_from_tables(spark, sf, ("n_chars",)))
    lfs = positive_rules()
    tox = [lf for lf in lfs if lf.name == "lf_toxic"][0]
    return c.select("id", F.col("label").alias("gold"), F.when(tox.predicate, 1).otherwise(0).alias("pred_toxic"),
                    F.when(F.col("label") == "toxic", 1).otherwise(0).alias("gold_toxic"),
                    R.merge_labels([lf.vote() for lf in lfs]).alias("pred_labels"))


@job("binary_metrics", f"""SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1 FROM (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall
  FROM (SELECT count_if(pred_toxic = 1 AND gold_toxic = 1) AS tp, count_if(pred_toxic = 1 AND gold_toxic <> 1) AS fp,
               count_if(pred_toxic <> 1 AND gold_toxic = 1) AS fn, count_if(pred_toxic <> 1 AND gold_toxic <> 1) AS tn FROM ({_PRED_SQL})))""")
def binary_metrics(spark, sf):
    """precision/recall/F1 of the toxic keyword rule against gold labels."""
    m = M.binary_metrics(_preds(spark, sf), "pred_toxic", "gold_toxic", 1)
    return m.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


_ML_SQL = (f"SELECT d.id, list_sort(list_distinct(list_filter([" + ", ".join(lf.vote_sql() for lf in positive_rules())
           + f"], lambda x: x IS NOT NULL))) AS p, list_distinct({_GOLD_ARR}) AS g FROM ({CORPUS_SQL}) d "
             f"JOIN labels l ON d.id = l.doc_id")


@job("multilabel_metrics", f"""SELECT round(avg(CASE WHEN len(p) + len(g) > 0 THEN 2.0 * len(list_intersect(p, g)) / (len(p) + len(g)) ELSE 0 END), 6)
  AS f1_samples, round(avg(CASE WHEN list_sort(p) = list_sort(g) THEN 1.0 ELSE 0.0 END), 6) AS exact_match,
  CAST(count(*) AS BIGINT) AS rows FROM ({_ML_SQL})""")
def multilabel_metrics(spark, sf):
    """Sample F1 and exact match of rule label sets vs gold label sets."""
    c = corpus_from_tables(spark, sf, ("n_chars",))
    lfs = positive_rules()
    p = c.select("id", R.merge_labels([lf.vote() for lf in lfs]).alias("pred_labels"))
    g = _gold_sets(spark, sf).withColumnRenamed("doc_id", "id")
    m = M.multilabel_metrics(p.join(g, "id"), "pred_labels", "labels")
    return m.select(r6("f1_samples").alias("f1_samples"), r6("exact_match").alias("exact_match"), "rows")


@job("confusion", f"SELECT gold, CASE WHEN pred_toxic = 1 THEN 'toxic' ELSE 'other' END AS pred, "
                  f"CAST(count(*) AS BIGINT) AS count FROM ({_PRED_SQL}) GROUP BY ALL")
def confusion(spark, sf):
    """Confusion counts of the toxic rule against gold classes."""
    p = _preds(spark, sf).withColumn("pred", F.when(F.col("pred_toxic") == 1, "toxic").otherwise("other"))
    return M.confusion(p, "pred", "gold")


@job("per_class_recall", f"SELECT gold, CAST(count(*) AS BIGINT) AS support, round(avg(CASE WHEN (CASE WHEN pred_toxic = 1 "
                         f"THEN 'toxic' ELSE 'other' END) = gold THEN 1.0 ELSE 0.0 END), 6) AS recall FROM ({_PRED_SQL}) GROUP BY gold")
def per_class_recall(spark, sf):
    """Recall per gold class."""
    p = _preds(spark, sf).withColumn("pred", F.when(F.col("pred_toxic") == 1, "toxic").otherwise("other"))
    return M.per_class_recall(p, "pred", "gold").select("gold", "support", r6("recall").alias("recall"))


@job("path_error", f"""SELECT round(avg(CASE WHEN d IS NULL THEN 0 ELSE pow(2.0, -d) END), 6) AS path_error,
  round(avg(CASE WHEN d IS NULL THEN 1.0 ELSE 0.0 END), 6) AS exact_paths, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CASE WHEN d0 THEN 0 WHEN d1 THEN 1 WHEN d2 THEN 2 END AS d FROM (
    SELECT false AS d0, (CASE WHEN l.quality = 0 THEN 'low' ELSE 'ok' END) IS DISTINCT FROM
             (CASE WHEN n_chars < 120 OR regexp_matches(text, '[!#*%@$~^&]{{2}}') THEN 'low' ELSE 'ok' END) AS d1,
           (CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'civil' END) IS DISTINCT FROM
             (CASE WHEN regexp_matches(text, '{tx.keyword_regex_sql(['trash', 'idiot', 'clown', 'scum', 'worthless', 'moron', 'pathetic', 'loser', 'disgusting', 'stupid'])}') THEN 'toxic' ELSE 'civil' END) AS d2
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id))""")
def path_error(spark, sf):
    """Hierarchical error of rule-predicted paths lang/quality/toxicity vs gold paths."""
    d = read_table(spark, sf, "documents").alias("d")
    lab = read_table(spark, sf, "labels").alias("l")
    j = d.join(lab, "doc_id")
    from labelkiln.plans.corpus_rules import DECORATION, TOXIC_WORDS
    low = (F.col("n_chars") < 120) | F.col("text").rlike(DECORATION)
    gold = F.array(F.col("lang"), F.when(F.col("quality") == 0, "low").otherwise("ok"),
                   F.when(F.col("toxic") == 1, "toxic").otherwise("civil"))
    pred = F.array(F.col("lang"), F.when(low, "low").otherwise("ok"),
                   F.when(tx.has_keyword("text", TOXIC_WORDS), "toxic").otherwise("civil"))
    m = M.path_error(j.select(gold.alias("gold_path"), pred.alias("pred_path")))
    return m.select(r6("path_error").alias("path_error"), r6("exact_paths").alias("exact_paths"), "rows")


# --------------------------------------------------------------------------------------- pairs

_EPOS = _pos_sql(f"({EMB_SQL}) e", "gold")


@job("positive_pairs", f"""SELECT DISTINCT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, a.gold AS label FROM
  (SELECT id, gold, pos, n, unnest(generate_series(1, least(2, n - 1))) AS j FROM ({_EPOS})) a
  JOIN ({_EPOS}) b ON a.gold = b.gold AND (a.pos + a.j) % a.n = b.pos""")
def positive_pairs(spark, sf):
    """Same-label pairs, two partners per anchor."""
    e = emb_corpus(spark, sf)
    return P.positive_pairs(e, 2, "gold", "id", SEED).select("a", "b", F.col("gold").alias("label"))


@job("negative_pairs", f"""SELECT a.id AS anchor, b.id AS negative, a.gold AS anchor_label, b.gold AS negative_label FROM
  (SELECT id, gold, pos, li, n_labels, unnest(generate_series(1, least(2, n_labels - 1))) AS j FROM ({_EPOS})) a
  JOIN ({_EPOS}) b ON b.li = (a.li + a.j) % a.n_labels AND b.pos = a.pos % b.n""")
def negative_pairs(spark, sf):
    """Different-label pairs, two per anchor."""
    e = emb_corpus(spark, sf)
    return P.negative_pairs(e, 2, "gold", "id", SEED)


_TRIPLETS_SQL = f"""SELECT a.id AS anchor, p.id AS positive, ng.id AS negative, a.gold AS label FROM
  (SELECT id, gold, pos, n, li, n_labels, unnest(generate_series(1, least(1, n - 1, n_labels - 1))) AS j FROM ({_EPOS})) a
  JOIN ({_EPOS}) p ON p.gold = a.gold AND p.pos = (a.pos + a.j) % a.n
  JOIN ({_EPOS}) ng ON ng.li = (a.li + a.j) % a.n_labels AND ng.pos = a.pos % ng.n"""


@job("triplets", _TRIPLETS_SQL)
def triplets(spark, sf):
    """Anchor / positive / negative, one per anchor."""
    e = emb_corpus(spark, sf)
    return P.triplets(e, 1, "gold", "id", SEED).select("anchor", "positive", "negative", F.col("gold").alias("label"))


@job("label_batches", f"SELECT id, gold AS label, CAST(floor(pos / 4) AS BIGINT) AS batch FROM ({_EPOS})")
def label_batches(spark, sf):
    """Batches of 4 rows per label."""
    e = emb_corpus(spark, sf)
    return P.label_batches(e, 4, "gold", "id", SEED).select("id", F.col("gold").alias("label"), "batch")


@job("mixed_batches", f"""SELECT id, label, CAST(floor((row_number() OVER (ORDER BY place, label) - 1) / 16) AS BIGINT) AS batch FROM (
  SELECT id, gold AS label, (pos + 0.5) / n AS place FROM ({_EPOS}))""")
def mixed_batches(spark, sf):
    """Batches of 16 rows, labels interleaved by their place within their label."""
    e = emb_corpus(spark, sf)
    return P.mixed_batches(e, 16, "gold", "id", SEED).select("id", F.col("gold").alias("label"), "batch")


def _trip_vecs(spark, sf):
    e = emb_corpus(spark, sf)
    t = P.triplets(e, 1, "gold", "id", SEED)
    return P.with_vectors(t, e, ["anchor", "positive", "negative"])


@job("triplet_loss", f"""SELECT anchor, round(d_pos, 6) AS d_pos, round(d_neg, 6) AS d_neg, d_pos + 0.5 < d_neg AS satisfied,
  round(greatest(0, d_pos - d_neg + 0.5), 6) AS loss FROM (
  SELECT t.anchor, 1 - list_cosine_similarity(va.vec, vp.vec) AS d_pos, 1 - list_cosine_similarity(va.vec, vn.vec) AS d_neg
  FROM ({_TRIPLETS_SQL}) t JOIN ({EMB_SQL}) va ON t.anchor = va.id JOIN ({EMB_SQL}) vp ON t.positive = vp.id
  JOIN ({EMB_SQL}) vn ON t.negative = vn.id)""")
def triplet_loss(spark, sf):
    """Triplet margin check and hinge loss (cosine distance, margin 0.5)."""
    t = P.triplet_loss(_trip_vecs(spark, sf), 0.5)
    return t.select("anchor", r6("d_pos").alias("d_pos"), r6("d_neg").alias("d_neg"), "satisfied", r6("loss").alias("loss"))


@job("info_nce", f"""SELECT anchor, round(ln(sum(exp(sim / 0.1))) - max(CASE WHEN is_pos THEN sim END) / 0.1, 6) AS loss FROM (
  SELECT t.anchor, list_cosine_similarity(va.vec, vp.vec) AS sim, true AS is_pos FROM ({_TRIPLETS_SQL}) t
    JOIN ({EMB_SQL}) va ON t.anchor = va.id JOIN ({EMB_SQL}) vp ON t.positive = vp.id
  UNION ALL
  SELECT t.anchor, list_cosine_similarity(va.vec, vn.vec) AS sim, false AS is_pos FROM ({_TRIPLETS_SQL}) t
    JOIN ({EMB_SQL}) va ON t.anchor = va.id JOIN ({EMB_SQL}) vn ON t.negative = vn.id) GROUP BY anchor""")
def info_nce(spark, sf):
    """InfoNCE per anchor over its positive and negative (temperature 0.1)."""
    t = _trip_vecs(spark, sf)
    s = (t.select("anchor", V.cosine("anchor_vec", "positive_vec").alias("sim"), F.lit(True).alias("is_pos"))
         .unionByName(t.select("anchor", V.cosine("anchor_vec", "negative_vec").alias("sim"), F.lit(False).alias("is_pos"))))
    return P.info_nce(s, 0.1).select("anchor", r6("loss").alias("loss"))


@job("separation", f"""SELECT round(avg(CASE WHEN same THEN c END), 6) AS same_label, round(avg(CASE WHEN NOT same THEN c END), 6) AS diff_label,
  round(avg(CASE WHEN same THEN c END) - avg(CASE WHEN NOT same THEN c END), 6) AS gap FROM (
  SELECT list_cosine_similarity(va.vec, vp.vec) AS c, true AS same FROM ({_TRIPLETS_SQL}) t JOIN ({EMB_SQL}) va ON t.anchor = va.id
    JOIN ({EMB_SQL}) vp ON t.positive = vp.id
  UNION ALL
  SELECT list_cosine_similarity(va.vec, vn.vec) AS c, false AS same FROM ({_TRIPLETS_SQL}) t JOIN ({EMB_SQL}) va ON t.anchor = va.id
    JOIN ({EMB_SQL}) vn ON t.negative = vn.id)""")
def separation(spark, sf):
    """Same-label closeness vs separation of labels over triplet pairs."""
    from labelkiln.operators.vector import separation as sep
    t = _trip_vecs(spark, sf)
    pr = (t.select(F.col("anchor_vec").alias("a_vec"), F.col("positive_vec").alias("b_vec"), F.lit(True).alias("same"))
          .unionByName(t.select(F.col("anchor_vec").alias("a_vec"), F.col("negative_vec").alias("b_vec"),
                                F.lit(False).alias("same"))))
    return sep(pr).select(*[r6(c).alias(c) for c in ("same_label", "diff_label", "gap")])


@job("multi_hot", f"SELECT doc_id, CAST(list_contains(l, 'low_quality') AS DOUBLE) AS h_low_quality, "
                  f"CAST(list_contains(l, 'toxic') AS DOUBLE) AS h_toxic, array_to_string(list_sort(l), ',') AS above "
                  f"FROM (SELECT doc_id, {_GOLD_ARR} AS l FROM labels)")
def multi_hot(spark, sf):
    """Multi-hot over the sorted vocabulary, then decoded back (labels above 0.5)."""
    g = _gold_sets(spark, sf)
    vocab = ["low_quality", "toxic"]
    h = g.select("doc_id", V.multi_hot("labels", vocab).alias("h"))
    return h.select("doc_id", F.col("h")[0].alias("h_low_quality"), F.col("h")[1].alias("h_toxic"),
                    F.array_join(V.labels_above("h", vocab, 0.5), ",").alias("above"))


@job("losses", f"""SELECT doc_id, round(list_avg(list_transform(list_zip(p, y), lambda t: -(2.0 * t[2] * ln(greatest(t[1], 1e-7))
  + (1 - t[2]) * ln(greatest(1 - t[1], 1e-7))))), 6) AS bce,
  round(list_avg(list_transform(list_zip(p, y), lambda t: -pow(1 - CASE WHEN t[2] = 1 THEN t[1] ELSE 1 - t[1] END, 2)
  * ln(greatest(CASE WHEN t[2] = 1 THEN t[1] ELSE 1 - t[1] END, 1e-7)))), 6) AS focal FROM (
  SELECT doc_id, [0.3 + 0.4 * (1 - quality), 0.2 + 0.6 * toxic]::DOUBLE[] AS p, [1.0 - quality, toxic * 1.0]::DOUBLE[] AS y FROM labels)""")
def losses(spark, sf):
    """Weighted binary cross-entropy (positive weight 2) and focal loss (gamma 2) per row."""
    lab = read_table(spark, sf, "labels")
    p = F.array(0.3 + 0.4 * (1 - F.col("quality")), 0.2 + 0.6 * F.col("toxic")).cast("array<double>")
    y = F.array(1.0 - F.col("quality"), F.col("toxic") * 1.0).cast("array<double>")
    w = F.array(F.lit(2.0), F.lit(2.0))
    return lab.select("doc_id", r6(V.weighted_bce(p, y, w)).alias("bce"), r6(V.focal_loss(p, y, 2.0)).alias("focal"))
