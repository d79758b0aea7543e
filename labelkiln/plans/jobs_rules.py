"""Registered jobs: rule labelling on ``documents LEFT JOIN labels``."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.operators import rules as R
from labelkiln.plans.corpus_rules import document_rules, positive_rules, topic_rules
from labelkiln.plans.registry import job
from labelkiln.sources.corpus import CORPUS_SQL, corpus_from_tables

_EXTRA = ("n_chars",)


def _votes_sql(lfs) -> str:
    return ", ".join(f"{lf.vote_sql()} AS {lf.name}" for lf in lfs)


@job("union_label", R.union_label_sql(CORPUS_SQL, document_rules(), cols=("id", "label")))
def union_label(spark, sf):
    """Flagship (J8): label the unlabelled documents by the union of rule votes."""
    c = corpus_from_tables(spark, sf, _EXTRA)
    return R.union_label(c, document_rules()).select("id", "label", "relevance", "weak_label")


@job("apply_lfs", f"SELECT id, {_votes_sql(document_rules())} FROM ({CORPUS_SQL}) c")
def apply_lfs(spark, sf):
    """Wide label matrix, one vote column per rule."""
    c = corpus_from_tables(spark, sf, _EXTRA)
    lfs = document_rules()
    return R.apply_lfs(c, lfs).select("id", *[lf.name for lf in lfs])


@job("votes_long", "SELECT id, lf, vote FROM (SELECT id, unnest([" + ", ".join(
    f"{{'lf': '{lf.name}', 'vote': {lf.vote_sql()}}}" for lf in document_rules())
    + f"], recursive := true) FROM ({CORPUS_SQL}) c) WHERE vote IS NOT NULL")
def votes_long(spark, sf):
    """J7 long form (id, lf, vote) without abstains."""
    return R.votes_long(corpus_from_tables(spark, sf, _EXTRA), document_rules())


@job("merge_labels", "SELECT id, array_to_string(list_sort(list_distinct(list_filter(["
     + ", ".join(lf.vote_sql() for lf in positive_rules())
     + f"], lambda x: x IS NOT NULL))), ', ') AS labels FROM ({CORPUS_SQL}) c")
def merge_labels(spark, sf):
    """Distinct, sorted rule labels per row as one string."""
    c = corpus_from_tables(spark, sf, _EXTRA)
    lfs = positive_rules()
    return c.select("id", F.array_join(R.merge_labels([lf.vote() for lf in lfs]), ", ").alias("labels"))


@job("topic_labels", f"SELECT id, array_to_string({R.merge_votes_sql(topic_rules())}, ', ') AS labels "
                     f"FROM ({CORPUS_SQL}) c")
def topic_labels(spark, sf):
    """Labels per row from rules that return lists and rules that return one label."""
    c = corpus_from_tables(spark, sf, _EXTRA)
    return c.select("id", F.array_join(R.merge_votes(topic_rules()), ", ").alias("labels"))


@job("relevance_from_label", f"SELECT id, CASE WHEN label IS NULL THEN 0 ELSE 1 END AS relevance "
                             f"FROM ({CORPUS_SQL}) c")
def relevance_from_label(spark, sf):
    """B7."""
    c = corpus_from_tables(spark, sf)
    return c.select("id", R.relevance_from_label("label").alias("relevance"))
