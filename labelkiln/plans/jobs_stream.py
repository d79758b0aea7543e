"""Registered jobs: the row-wise operators run as Structured Streaming queries over the driver's
parquet files (available-now trigger, exactly-once file sink in the shared checkpoint folder).  Their
results must equal the batch jobs, so they share the batch jobs' DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.operators import learn as L
from labelkiln.operators import rules as R
from labelkiln.operators import vector as VO
from labelkiln.operators import corpus as C
from labelkiln.operators import ranking as RK
from labelkiln.plans import jobs_corpus, jobs_learn, jobs_rules, jobs_vector
from labelkiln.plans.corpus_rules import document_rules
from labelkiln.plans.registry import SQL, job
from labelkiln.sources.corpus import corpus_from_tables, quality_label, read_table
from labelkiln.streaming.labelling import audited_to_table, read_stream, run_to_table


def _glob(sf: str, table: str) -> str:
    """A file stream needs a directory or a glob; the driver tables are single files in one folder."""
    return f"{sf.rstrip('/')}/{table}.parq[u]et"


@job("stream_union_label", SQL["union_label"])
def stream_union_label(spark, sf):
    """J8 on a document stream joined to the static labels table (stream-static left join)."""
    schema = read_table(spark, sf, "documents").schema
    d = read_stream(spark, _glob(sf, "documents"), schema).alias("d")
    lab = read_table(spark, sf, "labels").alias("l")
    c = (d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left")
         .select(F.col("d.doc_id").alias("id"), F.col("d.text").alias("text"),
                 F.when(F.col("l.doc_id").isNull(), 0).otherwise(1).alias("relevance"),
                 quality_label("l").alias("label"), F.col("d.n_chars")))
    out, _ = run_to_table(R.union_label(c, document_rules()).select("id", "label", "relevance", "weak_label"),
                          "union_label")
    return spark.read.parquet(out)


@job("stream_nearest", SQL["nearest"])
def stream_nearest(spark, sf):
    """C5 on a stream of vectors: prototypes fitted in batch, the stream scored against them."""
    e = jobs_vector.emb_corpus(spark, sf)
    protos = VO.prototypes(C.labelled(e), "label", "vec")
    schema = read_table(spark, sf, "embeddings").schema
    s = read_stream(spark, _glob(sf, "embeddings"), schema)
    hidden = F.substring(RK.hash_order("vec_id", jobs_vector.SEED), 1, 1) >= "4"
    pool = s.filter(hidden).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    out, _ = run_to_table(VO.nearest(pool, protos).select("id", "pred", F.round("score", 6).alias("score")),
                          "nearest")
    return spark.read.parquet(out)


@job("stream_clean", SQL["clean_text"])
def stream_clean(spark, sf):
    """G1 on a document stream."""
    s = read_stream(spark, _glob(sf, "documents"), read_table(spark, sf, "documents").schema)
    out, _ = run_to_table(s.select(F.col("doc_id").alias("id"), tx.clean_text("text").alias("text_cleaned")), "clean")
    return spark.read.parquet(out)


@job("stream_cascade")
def stream_cascade(spark, sf):
    """L6 on a document stream: features, gate and specialist are fitted in batch; the stream is one projection."""
    docs = corpus_from_tables(spark, sf, ("lang",))
    model, rows = L.tfidf_rows(docs, "text", 1000)
    gate, specialist = jobs_learn.cascade_models(spark, sf, rows)
    s = read_stream(spark, _glob(sf, "documents"), read_table(spark, sf, "documents").schema)
    s = L.featurize(model, s.select(F.col("doc_id").alias("id"), "text"))
    done = L.cascade(s, gate, specialist).select("id", F.array_join("labels_pred", ",").alias("labels"))
    out, _ = run_to_table(done, "cascade")
    return spark.read.parquet(out)


@job("stream_audit", SQL["audit"])
def stream_audit(spark, sf):
    """D17 on a stream: audit numbers of the rule labelling, observed while the micro-batches are written."""
    schema = read_table(spark, sf, "documents").schema
    d = read_stream(spark, _glob(sf, "documents"), schema).alias("d")
    lab = read_table(spark, sf, "labels").alias("l")
    c = (d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left")
         .select(F.col("d.doc_id").alias("id"), F.col("d.text").alias("text"),
                 F.when(F.col("l.doc_id").isNull(), 0).otherwise(1).alias("relevance"),
                 quality_label("l").alias("label"), F.col("d.n_chars")).withColumn("relevance_before", F.col("relevance")))
    w = R.union_label(c, document_rules()).select("id", "label", "relevance", "relevance_before", "weak_label")
    _, total = audited_to_table(w, "audit", C.audit_metrics())
    return spark.createDataFrame([(m, total.get(m, 0)) for m in C.AUDIT], "metric string, value bigint")


_ = (jobs_corpus, jobs_rules)  # the batch twins are registered first
