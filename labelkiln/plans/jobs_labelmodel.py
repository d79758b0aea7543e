"""Registered jobs: rule analysis and label models on the document rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.operators import labelmodel as LM
from labelkiln.operators import rules as R
from labelkiln.plans.corpus_rules import CLASSES, positive_rules
from labelkiln.plans.registry import job
from labelkiln.sources.corpus import CORPUS_SQL, corpus_from_tables

_LFS = [lf.name for lf in positive_rules()]
_VOTES_SQL = (f"SELECT id, label AS gold, " + ", ".join(f"{lf.vote_sql()} AS {lf.name}" for lf in positive_rules())
              + f" FROM ({CORPUS_SQL}) c")


def _votes(spark, sf):
    c = corpus_from_tables(spark, sf, ("n_chars",))
    return R.apply_lfs(c, positive_rules()).select("id", F.col("label").alias("gold"), *_LFS)


def _summary_sql() -> str:
    parts = []
    for c in _LFS:
        others = [o for o in _LFS if o != c]
        any_o = " OR ".join(f"{o} IS NOT NULL" for o in others)
        conf = " OR ".join(f"({o} IS NOT NULL AND {o} <> {c})" for o in others)
        parts.append(
            f"SELECT '{c}' AS lf, round(count_if({c} IS NOT NULL) / count(*), 6) AS coverage, "
            f"round(count_if({c} IS NOT NULL AND ({any_o})) / count(*), 6) AS overlap, "
            f"round(count_if({c} IS NOT NULL AND ({conf})) / count(*), 6) AS conflict, "
            f"coalesce(array_to_string(list_sort(list_distinct(list({c}) FILTER (WHERE {c} IS NOT NULL))), ','), '') AS polarity, "
            f"round(count_if(gold IS NOT NULL AND {c} IS NOT NULL AND {c} = gold) / "
            f"nullif(count_if(gold IS NOT NULL AND {c} IS NOT NULL), 0), 6) AS accuracy FROM ({_VOTES_SQL}) v")
    return " UNION ALL ".join(parts)


@job("lf_summary", _summary_sql())
def lf_summary(spark, sf):
    """Coverage, overlap, conflict, polarity, empirical accuracy per rule."""
    s = LM.lf_summary(_votes(spark, sf), _LFS, gold="gold")
    return s.select("lf", *[F.round(c, 6).alias(c) for c in ("coverage", "overlap", "conflict")],
                    F.array_join("polarity", ",").alias("polarity"), F.round("accuracy", 6).alias("accuracy"))


def _agree_sql() -> str:
    parts = []
    for a in range(len(_LFS)):
        for b in range(a + 1, len(_LFS)):
            i, j = _LFS[a], _LFS[b]
            both = f"{i} IS NOT NULL AND {j} IS NOT NULL"
            parts.append(f"SELECT '{i}' AS lf_i, '{j}' AS lf_j, CAST(count_if({both}) AS BIGINT) AS both, "
                         f"CAST(count_if({both} AND {i} = {j}) AS BIGINT) AS agree, "
                         f"CAST(count_if({both} AND {i} <> {j}) AS BIGINT) AS disagree, "
                         f"CAST(count_if({i} IS NOT NULL) AS BIGINT) AS cov_i, CAST(count_if({j} IS NOT NULL) AS BIGINT) AS cov_j, "
                         f"CAST(count(*) AS BIGINT) AS n FROM ({_VOTES_SQL}) v")
    return " UNION ALL ".join(parts)


@job("lf_agreement", _agree_sql())
def lf_agreement(spark, sf):
    """Pairwise rule agreement counts."""
    return LM.lf_agreement(_votes(spark, sf), _LFS)


@job("correlated_lfs", f"SELECT lf_i, lf_j, \"both\", agree, round(lift, 6) AS lift FROM (SELECT *, CASE WHEN cov_i * cov_j > 0 THEN "
                       f"(\"both\" / n) / ((cov_i / n) * (cov_j / n)) END AS lift FROM ({_agree_sql()})) WHERE lift >= 2.0")
def correlated_lfs(spark, sf):
    """Rule pairs voting together at least twice as often as independence predicts."""
    c = LM.correlated_lfs(_votes(spark, sf), _LFS, 2.0)
    return c.select("lf_i", "lf_j", "both", "agree", F.round("lift", 6).alias("lift"))


@job("vote_patterns", f"SELECT {', '.join(_LFS)}, CAST(count(*) AS BIGINT) AS cnt FROM ({_VOTES_SQL}) v GROUP BY ALL")
def vote_patterns(spark, sf):
    """Label-model input: distinct vote patterns with counts."""
    return LM.vote_patterns(_votes(spark, sf), _LFS)


def _code_sql(lf) -> str:
    return f"CASE WHEN {lf.sql} THEN {CLASSES.index(lf.label)} ELSE -1 END"


@job("label_matrix", "SELECT id, array_to_string([" + ", ".join(_code_sql(lf) for lf in positive_rules())
     + f"], ',') AS L FROM ({CORPUS_SQL}) c")
def label_matrix(spark, sf):
    """J7 classic form: class indexes per rule, -1 = abstain (as text for comparison)."""
    c = corpus_from_tables(spark, sf, ("n_chars",))
    m = R.label_matrix(c, positive_rules(), CLASSES)
    return m.select("id", F.array_join(F.col("L").cast("array<string>"), ",").alias("L"))


@job("label_model")
def label_model(spark, sf):
    """Dawid-Skene EM over vote patterns (3 classes); prediction per document, all-abstain
    rows stay unlabelled.  Iterative fit: checked by tests on planted votes, not by SQL."""
    v = _votes(spark, sf)  # narrow: votes are cheaper to take again than to keep
    m = LM.fit_em(v, _LFS, CLASSES, max_iter=100)
    p = LM.predict_em(v, m, tie_break="abstain")
    return p.select("id", "pred", F.round("confidence", 6).alias("confidence"))


@job("label_model_hash")
def label_model_hash(spark, sf):
    """The same model with ties settled by a seeded hash of the id."""
    v = _votes(spark, sf)
    m = LM.fit_em(v, _LFS, CLASSES, max_iter=100)
    return LM.predict_em(v, m, tie_break="hash").select("id", "pred")


_TARGETS = ["low_quality", "toxic"]
#: Moments, triplet accuracies, priors and log odds of all targets, from the votes.
_MOMENTS_SQL = f"""
  v AS ({_VOTES_SQL}),
  lab AS (SELECT unnest({_TARGETS!r}) AS t),
  l AS (SELECT id, unnest(range({len(_LFS)})) AS i, unnest([{', '.join(_LFS)}]) AS vote FROM v),
  b AS (SELECT t, id, i, CASE WHEN vote IS NULL THEN 0 WHEN vote = t THEN 1 ELSE -1 END AS s FROM l, lab),
  m AS (SELECT x.t, x.i, y.i AS j, avg(x.s * y.s) AS m FROM b x JOIN b y ON x.t = y.t AND x.id = y.id AND x.i <> y.i GROUP BY ALL),
  c AS (SELECT t, i, avg(s) AS mean, avg(abs(s)) AS cov FROM b GROUP BY ALL),
  a AS (SELECT p.t, p.i, median(sqrt(abs(p.m * q.m / d.m))) AS a FROM m p JOIN m q ON p.t = q.t AND p.i = q.i AND p.j < q.j
        JOIN m d ON d.t = p.t AND d.i = p.j AND d.j = q.j WHERE d.m <> 0 GROUP BY ALL),
  f AS (SELECT c.t, c.i, coalesce(a, 0) AS a, mean,
          CASE WHEN cov > 0 THEN least(0.99, greatest(0.01, (1 + coalesce(a, 0) / cov) / 2)) ELSE 0.5 END AS acc
        FROM c LEFT JOIN a ON c.t = a.t AND c.i = a.i),
  p AS (SELECT t, least(0.99, greatest(0.01, (1 + coalesce(avg(mean / a) FILTER (WHERE a > 0), 0)) / 2)) AS prior
        FROM f GROUP BY t),
  o AS (SELECT b.id, b.t, bool_or(b.s <> 0) AS voted,
          1 / (1 + exp(-(ln(any_value(prior) / (1 - any_value(prior))) + sum(b.s * ln(acc / (1 - acc)))))) AS p
        FROM b JOIN f ON b.t = f.t AND b.i = f.i JOIN p ON p.t = b.t GROUP BY b.id, b.t)"""


@job("label_model_ovr", f"WITH {_MOMENTS_SQL} SELECT id, coalesce(string_agg(t, ',' ORDER BY t) FILTER (WHERE voted AND p > 0.5), '') "
                        f"AS labels FROM o GROUP BY id")
def label_model_ovr(spark, sf):
    """One-vs-rest triplet-moment models per label, labels above 0.5."""
    v = _votes(spark, sf)
    out = LM.label_model_ovr(v, _LFS, _TARGETS, 0.5)
    return out.select("id", F.array_join("labels", ",").alias("labels"))


@job("label_model_moments", f"WITH {_MOMENTS_SQL} SELECT id, t AS target, round(CASE WHEN voted THEN p END, 6) AS p FROM o")
def label_model_moments(spark, sf):
    """J9 (moments): the probability of each target per document, NULL where no rule voted."""
    v = _votes(spark, sf)
    models = LM.fit_triplets(v, _LFS, _TARGETS)
    for t in _TARGETS:
        v = LM.predict_triplet(LM.binary_votes(v, _LFS, t), models[t], f"p_{t}").drop(*[f"__b_{c}" for c in _LFS])
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.round(f"p_{t}", 6).alias("p")) for t in _TARGETS]))
    return v.select("id", each.alias("x")).select("id", "x.target", "x.p")
