"""Registered jobs: corpus subsets, text functions, counts, updates (A5, B1-B10, C1-C4, D1-D5, D17,
F1-F3, G1-G9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.operators import corpus as C
from labelkiln.operators import rules as R
from labelkiln.operators import update as U
from labelkiln.plans.corpus_rules import document_rules
from labelkiln.plans.registry import SQL, job
from labelkiln.session import checkpoint_dir
from labelkiln.sources.corpus import CORPUS_SQL, corpus_from_tables, read_table

CS = f"({CORPUS_SQL}) c"


def _weak(spark, sf):
    """Corpus after rule labelling: (id, label, relevance, weak_label) + accepted table."""
    c = corpus_from_tables(spark, sf, ("n_chars",))
    return c, R.union_label(c, document_rules())


_WEAK_SQL = R.union_label_sql(CORPUS_SQL, document_rules(), cols=("id", "label", "text", "lang"))


@job("labelled", f"SELECT id, label FROM {CS} WHERE label IS NOT NULL")
def labelled(spark, sf):
    return C.labelled(corpus_from_tables(spark, sf)).select("id", "label")


@job("unlabelled", f"SELECT id, relevance FROM {CS} WHERE label IS NULL")
def unlabelled(spark, sf):
    return C.unlabelled(corpus_from_tables(spark, sf)).select("id", "relevance")


@job("clean_text", f"SELECT id, {tx.clean_text_sql('text')} AS text_cleaned FROM {CS}")
def clean_text(spark, sf):
    return corpus_from_tables(spark, sf).select("id", tx.clean_text("text").alias("text_cleaned"))


@job("clean_text_unicode", f"SELECT id, {tx.clean_text_sql('text', 'unicode')} AS text_cleaned FROM {CS}")
def clean_text_unicode(spark, sf):
    return corpus_from_tables(spark, sf).select("id", tx.clean_text("text", "unicode").alias("text_cleaned"))


@job("word_count", f"SELECT id, CAST({tx.word_count_sql(tx.clean_text_sql('text'))} AS BIGINT) AS word_count "
                   f"FROM {CS}")
def word_count(spark, sf):
    return corpus_from_tables(spark, sf).select(
        "id", tx.word_count(tx.clean_text("text")).cast("bigint").alias("word_count"))


@job("min_words", f"SELECT id, CAST(wc AS BIGINT) AS word_count FROM (SELECT id, "
                  f"{tx.word_count_sql(tx.clean_text_sql('text'))} AS wc FROM {CS} WHERE label IS NULL) "
                  f"WHERE wc >= 3")
def min_words(spark, sf):
    """B5 on the unlabelled rows (the reference filters the rows it is about to label)."""
    c = C.unlabelled(corpus_from_tables(spark, sf))
    return C.min_words(c, 3).select("id", F.col("word_count").cast("bigint"))


@job("ignored_count", f"SELECT CAST(count_if(wc < 3) AS BIGINT) AS ignored, CAST(count(*) AS BIGINT) AS rows "
                      f"FROM (SELECT {tx.word_count_sql(tx.clean_text_sql('text'))} AS wc FROM {CS} "
                      f"WHERE label IS NULL)")
def ignored_count(spark, sf):
    return C.ignored_count(C.unlabelled(corpus_from_tables(spark, sf)), 3)


@job("words", f"SELECT id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(list_distinct(toks)) AS BIGINT) "
              f"AS n_distinct, array_to_string(toks, ' ') AS tokens FROM (SELECT id, {tx.words_sql('text')} AS toks FROM {CS})")
def words(spark, sf):
    """Tokens per document, their count and distinct count."""
    t = corpus_from_tables(spark, sf).select("id", tx.words("text").alias("toks"))
    return t.select("id", F.size("toks").cast("bigint").alias("n_tokens"),
                    F.size(F.array_distinct("toks")).cast("bigint").alias("n_distinct"),
                    F.array_join("toks", " ").alias("tokens"))


@job("has_keyword", f"SELECT id FROM {CS} WHERE regexp_matches(text, "
                    f"'{tx.keyword_regex_sql(['idiot', 'moron', 'released under'])}')")
def has_keyword(spark, sf):
    """Whole-word, any-case keyword test."""
    c = corpus_from_tables(spark, sf)
    return c.filter(tx.has_keyword("text", ["idiot", "moron", "released under"])).select("id")


#: Product texts of the part table: even keys name a quantity, in several spellings, odd ones a number without a unit.
_PART_SQL = ("SELECT p_partkey AS id, concat(p_name, CASE p_partkey % 4 WHEN 0 THEN concat(' ', p_size, ' ML, pack of 6') "
             "WHEN 2 THEN concat(' ', p_size, 'ml') ELSE concat(' size ', p_size) END) AS text FROM part")


def _parts(spark, sf):
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    tail = (F.when(k == 0, F.concat(F.lit(" "), F.col("p_size"), F.lit(" ML, pack of 6")))
            .when(k == 2, F.concat(F.lit(" "), F.col("p_size"), F.lit("ml"))).otherwise(F.concat(F.lit(" size "), F.col("p_size"))))
    return p.select(F.col("p_partkey").alias("id"), F.concat("p_name", tail).alias("text"))


@job("extract_quantity", f"SELECT id, CAST(regexp_extract(text, '(?i)(\\d+)\\s?ml', 1) AS BIGINT) AS ml, "
                         f"array_to_string(regexp_extract_all(text, '\\d+'), ',') AS numbers "
                         f"FROM ({_PART_SQL}) p WHERE regexp_matches(text, '(?i)(\\d+)\\s?ml')")
def extract_quantity(spark, sf):
    """First captured quantity of a product text and all its numbers (rows without a quantity are dropped)."""
    return (_parts(spark, sf).select("id", tx.extract_quantity("text").alias("ml"),
                                     F.array_join(tx.extract_all("text", r"\d+"), ",").alias("numbers"))
            .filter(F.col("ml").isNotNull()))


@job("value_counts", "SELECT lang, CAST(count(*) AS BIGINT) AS count FROM documents "
                     "WHERE lang IS NOT NULL GROUP BY lang")
def value_counts(spark, sf):
    return C.value_counts(read_table(spark, sf, "documents"), "lang")


@job("class_share", f"SELECT label, CAST(count(*) AS BIGINT) AS count, count(*) / sum(count(*)) OVER () "
                    f"AS share FROM {CS} WHERE label IS NOT NULL GROUP BY label")
def class_share(spark, sf):
    return C.class_share(corpus_from_tables(spark, sf), "label")


@job("label_vocab", f"SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS label_id "
                    f"FROM (SELECT DISTINCT label FROM {CS} WHERE label IS NOT NULL)")
def label_vocab(spark, sf):
    return C.label_vocab(corpus_from_tables(spark, sf), "label")


@job("null_counts", f"SELECT CAST(count_if(label IS NULL) AS BIGINT) AS label_nulls, "
                    f"CAST(count_if(text IS NULL) AS BIGINT) AS text_nulls FROM {CS}")
def null_counts(spark, sf):
    return C.null_counts(corpus_from_tables(spark, sf), ["label", "text"])


@job("rare_classes", f"SELECT label, CAST(count(*) AS BIGINT) AS count FROM {CS} "
                     f"WHERE label IS NOT NULL GROUP BY label HAVING count(*) < 100")
def rare_classes(spark, sf):
    return C.rare_classes(corpus_from_tables(spark, sf), "label", 100)


@job("flip_count", f"SELECT CAST(count_if(c.relevance = 0) AS BIGINT) AS flipped FROM {CS} "
                   f"WHERE c.id IN (SELECT id FROM ({_WEAK_SQL}) w WHERE w.label IS NULL AND w.weak_label IS NOT NULL)")
def flip_count(spark, sf):
    """Rows newly labelled by the rules that had relevance 0."""
    c, w = _weak(spark, sf)
    acc = w.filter(F.col("label").isNull() & F.col("weak_label").isNotNull())
    return C.flip_count(c, acc)


@job("audit", f"""SELECT metric, value FROM (
  SELECT CAST(count_if(c.label IS NULL) AS BIGINT) AS initial_nulls,
         CAST(count_if(c.label IS NULL AND w.weak_label IS NOT NULL) AS BIGINT) AS assigned,
         CAST(count_if(c.relevance = 0 AND w.relevance = 1) AS BIGINT) AS flipped,
         CAST(count_if(w.weak_label IS NULL) AS BIGINT) AS final_nulls
  FROM {CS} JOIN ({R.union_label_sql(CORPUS_SQL, document_rules(), cols=('id',))}) w ON c.id = w.id)
UNPIVOT (value FOR metric IN (initial_nulls, assigned, flipped, final_nulls))""")
def audit(spark, sf):
    """before/after audit of the rule labelling run."""
    c, w = _weak(spark, sf)
    return C.audit(c, w, label="label", new_label="weak_label")


@job("audit_observed", SQL["audit"])
def audit_observed(spark, sf):
    """D17 in flight: the audit numbers of the rule labelling run, counted while its result is written."""
    c = corpus_from_tables(spark, sf, ("n_chars",)).withColumn("relevance_before", F.col("relevance"))
    w = R.union_label(c, document_rules()).select("id", "label", "relevance", "relevance_before", "weak_label")
    path = f"{checkpoint_dir(spark).rstrip('/')}/audited-{uuid.uuid4().hex}"
    return C.audited_write(w, path, "label", "weak_label", "relevance_before", "relevance")


@job("apply_labels", f"""SELECT c.id, CASE WHEN c.label IS NULL AND a.weak_label IS NOT NULL THEN 1 ELSE c.relevance END
  AS relevance, coalesce(c.label, a.weak_label) AS label FROM {CS} LEFT JOIN
  (SELECT id, weak_label FROM ({_WEAK_SQL}) w WHERE label IS NULL AND weak_label IS NOT NULL) a ON c.id = a.id""")
def apply_labels(spark, sf):
    """Write accepted rule labels back by key, relevance to 1."""
    c, w = _weak(spark, sf)
    acc = w.filter(F.col("label").isNull() & F.col("weak_label").isNotNull()).select("id", "weak_label")
    return U.apply_labels(c.select("id", "relevance", "label"), acc, new_label="weak_label")


@job("fill_labels", f"""SELECT c.id, coalesce(c.label, s.suggested_label) AS label FROM {CS} LEFT JOIN
  (SELECT id, weak_label AS suggested_label FROM ({_WEAK_SQL}) w) s ON c.id = s.id""")
def fill_labels(spark, sf):
    """Fill only missing labels from suggestions."""
    c, w = _weak(spark, sf)
    sug = w.select("id", F.col("weak_label").alias("suggested_label"))
    return U.fill_labels(c.select("id", "label"), sug)


@job("changed_rows", f"SELECT id, relevance FROM {CS} WHERE id IN (SELECT id FROM ({_WEAK_SQL}) w "
                     f"WHERE label IS NULL AND weak_label IS NOT NULL)")
def changed_rows(spark, sf):
    c, w = _weak(spark, sf)
    acc = w.filter(F.col("label").isNull() & F.col("weak_label").isNotNull())
    return U.changed_rows(c.select("id", "relevance"), acc)


@job("remaining_pool", f"SELECT id FROM {CS} WHERE label IS NULL AND id NOT IN (SELECT id FROM ({_WEAK_SQL}) w "
                       f"WHERE label IS NULL AND weak_label IS NOT NULL)")
def remaining_pool(spark, sf):
    c, w = _weak(spark, sf)
    acc = w.filter(F.col("label").isNull() & F.col("weak_label").isNotNull())
    return U.remaining_pool(C.unlabelled(c).select("id"), acc)


@job("append", f"SELECT id, label, 'gold' AS source FROM {CS} WHERE label IS NOT NULL UNION ALL "
               f"SELECT id, weak_label AS label, 'weak' AS source FROM ({_WEAK_SQL}) w "
               f"WHERE label IS NULL AND weak_label IS NOT NULL")
def append(spark, sf):
    """labelled rows plus newly labelled rows."""
    c, w = _weak(spark, sf)
    gold = C.labelled(c).select("id", "label", F.lit("gold").alias("source"))
    new = (w.filter(F.col("label").isNull() & F.col("weak_label").isNotNull())
           .select("id", F.col("weak_label").alias("label"), F.lit("weak").alias("source")))
    return U.append(gold, new)


@job("union_vocab", f"SELECT DISTINCT label FROM (SELECT label FROM {CS} UNION ALL SELECT lang AS label "
                    f"FROM documents) WHERE label IS NOT NULL")
def union_vocab(spark, sf):
    """distinct union of two label sets (document classes and languages)."""
    c = corpus_from_tables(spark, sf)
    d = read_table(spark, sf, "documents").select(F.col("lang").alias("label"))
    return U.union_vocab(c, d)


@job("training_set", f"""SELECT id, label, source FROM (
  SELECT w.id, coalesce(g.label, w.weak_label) AS label,
         CASE WHEN g.label IS NOT NULL THEN 'gold' WHEN w.weak_label IS NOT NULL THEN 'weak' END AS source
  FROM (SELECT id, CASE WHEN label IS NULL THEN weak_label END AS weak_label FROM ({_WEAK_SQL}) x) w
  FULL JOIN (SELECT id, label FROM {CS} WHERE label IS NOT NULL) g ON w.id = g.id) WHERE label IS NOT NULL""")
def training_set(spark, sf):
    """Gold + weak labels, gold wins, with provenance."""
    c, w = _weak(spark, sf)
    weak = w.select("id", F.when(F.col("label").isNull(), F.col("weak_label")).alias("weak_label"))
    return U.with_provenance(C.labelled(c), weak)


@job("normalize_corpus", "SELECT doc_id AS id, text, CAST(coalesce(TRY_CAST(CAST(quality AS VARCHAR) AS INT), 0) AS INT) "
                         "AS relevance, CASE WHEN trim(lang) = '' THEN NULL ELSE trim(lang) END AS label "
                         "FROM (SELECT d.doc_id, d.text, d.lang, l.quality FROM documents d "
                         "LEFT JOIN labels l ON d.doc_id = l.doc_id)")
def normalize_corpus(spark, sf):
    """A5: cast on load (flag to int, blank label to NULL) on a raw join of the driver tables."""
    d = read_table(spark, sf, "documents").alias("d")
    lab = read_table(spark, sf, "labels").alias("l")
    raw = d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left").select(
        F.col("d.doc_id"), F.col("d.text"), F.col("l.quality"), F.col("d.lang"))
    out = C.normalize_flag("quality")
    return (raw.select(F.col("doc_id").alias("id"), "text", out.alias("relevance"), F.col("lang").alias("label"))
            .transform(lambda x: x.withColumn("label", F.when(F.trim("label") == "", None)
                                              .otherwise(F.trim("label")))))


def _scratch(spark, name):
    import os
    import uuid

    from labelkiln.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:8]}")


@job("csv_roundtrip", f"SELECT id, text, relevance, label FROM {CS}")
def csv_roundtrip(spark, sf):
    """A1 + A3: write the corpus as CSV with a header (no index column), read it back with an
    explicit schema (quoted multi-line texts survive)."""
    from labelkiln.sources.corpus import CORPUS_SCHEMA, read_corpus, write_corpus
    c = corpus_from_tables(spark, sf).select("id", "text", "relevance", "label")
    path = _scratch(spark, "corpus_csv")
    write_corpus(c, path, "csv")
    return read_corpus(spark, path, CORPUS_SCHEMA, "csv", multi_line=True)


@job("json_roundtrip", f"SELECT id, text, label FROM {CS} WHERE label IS NOT NULL")
def json_roundtrip(spark, sf):
    """A4: export the labelled set as JSON lines and import it again with a schema."""
    from labelkiln.sources.corpus import export_json, read_json
    c = C.labelled(corpus_from_tables(spark, sf)).select("id", "text", "label")
    path = _scratch(spark, "labelled_json")
    export_json(c, path)
    return read_json(spark, path, "id bigint, text string, label string")
