"""Rule analysis and label models.

Votes are first compressed to distinct vote patterns with their counts (one shuffle); statistics of rules, of pairs of
rules, and every fitting step run on that table, in long form, so that plans do not grow with the number of rules.  Only fitted parameters (rules x classes
x outcomes numbers) come back to the driver; prediction is a narrow step (Arrow batches, one numpy
pass whatever the number of rules and classes), so it also runs on streams.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.session import cut_lineage, ship_package

ABSTAIN = None


def _voted(c: str) -> Column:
    return F.col(c).isNotNull()


def _patterns(votes: DataFrame, lfs: Sequence[str], gold: str | None = None) -> DataFrame:
    """Distinct patterns as lists of the votes cast, ``cast`` (``j``: number of the rule, ``v``: its vote), with counts ``n``.

    One grouping key whatever the number of rules; the plan does not grow with them."""
    key = [F.array(*[F.col(c) for c in lfs]).alias("votes")] + ([F.col(gold).alias("gold")] if gold else [])
    counted = votes.select(*key).groupBy("votes", *(["gold"] if gold else [])).agg(F.count("*").cast("bigint").alias("n"))
    cast = F.filter(F.transform("votes", lambda v, j: F.struct(j.alias("j"), v.alias("v"))), lambda x: x["v"].isNotNull())
    return cut_lineage(counted.withColumn("cast", cast).drop("votes"))


def _named(votes: DataFrame, lfs: Sequence[str]) -> DataFrame:
    return votes.sparkSession.createDataFrame(list(enumerate(lfs)), "j int, lf string")


def lf_summary(votes: DataFrame, lfs: Sequence[str], gold: str | None = None) -> DataFrame:
    """Per rule coverage, overlap, conflict (as fractions of all rows), polarity (labels it
    votes) and, with a gold column, empirical accuracy on gold rows it voted on.

    Patterns are compressed first; each then gives a row per vote cast."""
    pat = _patterns(votes, lfs, gold)
    total = pat.agg(F.sum("n")).scalar()
    one = pat.withColumn("x", F.explode("cast"))
    other = F.size("cast") > 1
    against = F.exists("cast", lambda y: y["v"] != F.col("x.v"))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    aggs = [F.sum("n").alias("voted"), count(other).alias("shared"), count(against).alias("against"),
            F.array_sort(F.collect_set("x.v")).alias("polarity")]
    if gold:
        aggs += [count(F.col("gold").isNotNull()).alias("checked"), count(F.col("gold") == F.col("x.v")).alias("right")]
    s = _named(votes, lfs).join(one.groupBy(F.col("x.j").alias("j")).agg(*aggs), "j", "left")
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / total
    kind = votes.schema[lfs[0]].dataType.simpleString()
    out = [share("voted").alias("coverage"), share("shared").alias("overlap"), share("against").alias("conflict"),
           F.coalesce("polarity", F.array().cast(f"array<{kind}>")).alias("polarity")]
    if gold:
        out.append(F.when(F.col("checked") > 0, F.col("right") / F.col("checked")).alias("accuracy"))
    return s.select("lf", *out)


def _pairs_cast(pat: DataFrame) -> DataFrame:
    """``i, j, a, b, n``: how often rules ``i < j`` cast the votes ``a`` and ``b`` on one row."""
    pairs = F.flatten(F.transform("cast", lambda x, at: F.transform(
        F.slice("cast", at + 2, F.size("cast")), lambda y: F.struct(x["j"].alias("i"), y["j"].alias("j"), x["v"].alias("a"),
                                                                   y["v"].alias("b")))))
    return (pat.filter(F.size("cast") > 1).withColumn("p", F.explode(pairs))
            .groupBy("p.i", "p.j", "p.a", "p.b").agg(F.sum("n").alias("n")))


def _votes_cast(pat: DataFrame) -> DataFrame:
    """``j, v, n``: how often rule ``j`` cast the vote ``v``."""
    return pat.withColumn("x", F.explode("cast")).groupBy("x.j", "x.v").agg(F.sum("n").alias("n"))


def pair_votes(votes: DataFrame, lfs: Sequence[str]) -> DataFrame:
    """``lf_i, lf_j, vote_i, vote_j, n`` for the rule pairs and votes that occur (numbers of rules: i < j)."""
    names = _named(votes, lfs)
    return (_pairs_cast(_patterns(votes, lfs)).join(names.select(F.col("j").alias("i"), F.col("lf").alias("lf_i")), "i")
            .join(names.select("j", F.col("lf").alias("lf_j")), "j")
            .select("lf_i", "lf_j", F.col("a").alias("vote_i"), F.col("b").alias("vote_j"), "n"))


def lf_agreement(votes: DataFrame, lfs: Sequence[str]) -> DataFrame:
    """For every ordered pair of rules (i < j): rows where both voted, agreed, disagreed."""
    pat = _patterns(votes, lfs)
    total = pat.agg(F.sum("n")).scalar()
    met = _pairs_cast(pat).groupBy("i", "j").agg(
        F.sum("n").alias("both"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("agree"))
    cov = cut_lineage(_votes_cast(pat).groupBy("j").agg(F.sum("n").alias("cov")))
    grid = votes.sparkSession.createDataFrame(
        [(i, j, lfs[i], lfs[j]) for i in range(len(lfs)) for j in range(i + 1, len(lfs))],
        "i int, j int, lf_i string, lf_j string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return (grid.join(met, ["i", "j"], "left")
            .join(cov.select(F.col("j").alias("i"), F.col("cov").alias("cov_i")), "i", "left")
            .join(cov.select("j", F.col("cov").alias("cov_j")), "j", "left")
            .select("lf_i", "lf_j", zero("both").alias("both"), zero("agree").alias("agree"),
                    (zero("both") - zero("agree")).alias("disagree"), zero("cov_i").alias("cov_i"),
                    zero("cov_j").alias("cov_j"), total.cast("bigint").alias("n")))


def correlated_lfs(votes: DataFrame, lfs: Sequence[str], lift: float = 2.0) -> DataFrame:
    """Rule pairs that vote together much more often than independence predicts
    (``both / n >= lift * cov_i/n * cov_j/n``), candidates for redundancy."""
    a = lf_agreement(votes, lfs)
    expected = (F.col("cov_i") / F.col("n")) * (F.col("cov_j") / F.col("n"))
    obs = F.col("both") / F.col("n")
    return (a.withColumn("lift", F.when(expected > 0, obs / expected))
            .filter(F.col("lift") >= lift).select("lf_i", "lf_j", "both", "agree", "lift"))


def vote_patterns(votes: DataFrame, lfs: Sequence[str]) -> DataFrame:
    """Compress the vote table to distinct patterns with counts (the only shuffle of a fit)."""
    return votes.groupBy(*lfs).agg(F.count("*").cast("bigint").alias("cnt"))


# ---------------------------------------------------------------------------------------------
# Dawid-Skene EM, K classes, abstain as an outcome


@dataclass
class EMModel:
    classes: list[str]
    lfs: list[str]
    prior: np.ndarray            # K
    theta: np.ndarray            # J x K x (K + 1); outcome 0 = abstain, 1 + c = vote for class c
    iterations: int
    log_likelihood: float

    def accuracies(self) -> dict[str, float]:
        """P(rule votes the true class | it votes), averaged over the prior."""
        out = {}
        for j, name in enumerate(self.lfs):
            voted = sum(self.prior[k] * (1 - self.theta[j, k, 0]) for k in range(len(self.classes)))
            right = sum(self.prior[k] * self.theta[j, k, 1 + k] for k in range(len(self.classes)))
            out[name] = right / voted if voted > 0 else float("nan")
        return out


def _outcome(c: str, classes: Sequence[str]) -> Column:
    """Vote column -> outcome index (0 abstain, 1 + class index)."""
    e = F.when(F.col(c).isNull(), F.lit(0))
    for i, k in enumerate(classes):
        e = e.when(F.col(c) == k, F.lit(i + 1))
    return e.otherwise(F.lit(0))


def _log_joint(o: np.ndarray, prior: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """rows x classes: ln prior_k + sum_j ln theta[j, k, outcome_j]."""
    lj = np.tile(np.log(prior), (len(o), 1))
    for j in range(o.shape[1]):
        lj += np.log(theta[j])[:, o[:, j]].T
    return lj


def _outcomes(lfs: Sequence[str], classes: Sequence[str]) -> Column:
    return F.array(*[_outcome(c, classes) for c in lfs])


def _rows(col: pd.Series, width: int) -> np.ndarray:
    return np.array(col.to_list(), dtype=int).reshape(len(col), width)


PATTERN_ROWS = 20_000


def _normal(z: list[np.ndarray]) -> list[np.ndarray]:
    """Logs of distributions along the last axis, made to add up to one."""
    return [x - (m := x.max(axis=-1, keepdims=True)) - np.log(np.exp(x - m).sum(axis=-1, keepdims=True)) for x in z]


def _mixed(points: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Anderson's next point from the last points ``(z, EM step of z)``: the mix of steps whose changes cancel best."""
    z, g = points[-1]
    if len(points) < 2:
        return g
    change = np.stack([(b[1] - b[0]) - (a[1] - a[0]) for a, b in zip(points, points[1:], strict=False)], axis=1)
    moved = np.stack([b[1] - a[1] for a, b in zip(points, points[1:], strict=False)], axis=1)
    gamma = np.linalg.lstsq(change, g - z, rcond=1e-10)[0]
    return g - moved @ gamma


def fit_em(votes: DataFrame, lfs: Sequence[str], classes: Sequence[str], max_iter: int = 100,
           tol: float = 1e-6, smoothing: float = 0.01, memory: int = 5) -> EMModel:
    """Dawid-Skene EM on vote patterns, started from vote shares.

    Votes are compressed to distinct patterns with counts (one shuffle, checkpointed in parts of about ``PATTERN_ROWS``).
    In each step every task sums the expected counts of its patterns per (rule, outcome, class) in numpy and Spark adds them
    up; the driver gets the sums of the outcomes that occur, never patterns.  Steps are accelerated: the next point mixes the
    last ``memory`` EM steps (Anderson), and a point of lower likelihood is given up for the plain EM step before it.  The fit ends
    when an EM step changes no parameter by ``tol``, when two steps in turn change the likelihood by less than a tenth of that share
    of it (votes that leave the parameters open), or after ``max_iter`` jobs.
    """
    ship_package(votes.sparkSession)
    lfs, classes = list(lfs), list(classes)
    J, K = len(lfs), len(classes)
    pat = cut_lineage(vote_patterns(votes, lfs).select(_outcomes(lfs, classes).alias("o"), "cnt"))
    pat = pat.coalesce(max(1, -(-pat.count() // PATTERN_ROWS)))

    def step(params) -> tuple[list[np.ndarray], float]:
        """Log parameters after one EM step, and the log likelihood before it."""
        def expect(batches):
            sums, total, ll = np.zeros((J, K + 1, K)), np.zeros(K), 0.0
            for b in batches:
                if not len(b):
                    continue
                o, cnt = _rows(b["o"], J), b["cnt"].to_numpy(float)
                if params is None:
                    n = np.stack([(o == k + 1).sum(axis=1) for k in range(K)], axis=1).astype(float)
                    tot = n.sum(axis=1, keepdims=True)
                    resp = np.where(tot > 0, (n + smoothing) / (tot + K * smoothing), 1.0 / K)
                else:
                    lj = _log_joint(o, *[np.exp(x) for x in params])
                    m = lj.max(axis=1, keepdims=True)
                    z = np.exp(lj - m).sum(axis=1, keepdims=True)
                    resp = np.exp(lj - m) / z
                    ll += float((cnt * (m[:, 0] + np.log(z[:, 0]))).sum())
                w = resp * cnt[:, None]
                total += w.sum(axis=0)
                for j in range(J):
                    np.add.at(sums[j], o[:, j], w)
            j, v, k = np.nonzero(sums)
            yield pd.DataFrame({"j": np.r_[j, [-1] * K, -2], "v": np.r_[v, [0] * K, 0], "k": np.r_[k, np.arange(K), 0],
                                "s": np.r_[sums[j, v, k], total, ll]})

        rows = pat.mapInPandas(expect, "j int, v int, k int, s double").groupBy("j", "v", "k").agg(F.sum("s")).collect()
        nk, counts, ll = np.zeros(K), np.zeros((J, K, K + 1)), float("nan")
        for j, v, k, value in rows:
            if j == -2:
                ll = value
            elif j == -1:
                nk[k] = value
            else:
                counts[j, k, v] = value
        return _normal([np.log(nk + smoothing), np.log(counts + smoothing)]), ll

    flat = lambda z: np.concatenate([x.ravel() for x in z])
    back = lambda x: _normal([x[:K], x[K:].reshape(J, K, K + 1)])
    at, points, last, ll, jobs, still = step(None)[0], [], None, float("nan"), 1, 0
    while jobs <= max_iter:
        after, ll = step(at)
        jobs += 1
        if last is not None and ll < last[0] - 1e-9 * abs(last[0]) and last[1] is not None:
            at, points, last = last[1], [], (last[0], None)
            continue
        still = still + 1 if last is not None and abs(ll - last[0]) < 0.1 * tol * abs(last[0]) else 0
        last = (ll, after)
        if still > 1 or max(np.abs(np.exp(a) - np.exp(b)).max() for a, b in zip(after, at, strict=True)) < tol:
            break
        points = [*points, (flat(at), flat(after))][-memory - 1 :]
        at = back(_mixed(points))
    return EMModel(classes, lfs, np.exp(at[0]), np.exp(at[1]), jobs - 1, ll)


def predict_em(votes: DataFrame, model: EMModel, tie_break: str = "abstain", seed: int = 123,
               id_col: str = "id", tol: float = 1e-9) -> DataFrame:
    """Class probabilities and the predicted label per row.  A row with no vote is
    abstain (Q12).  Equal best probabilities: ``abstain`` or a seeded ``hash`` pick."""
    lfs, classes = model.lfs, model.classes
    ship_package(votes.sparkSession)
    prior, theta = model.prior, model.theta

    @F.pandas_udf("array<double>")
    def posterior(o: pd.Series) -> pd.Series:
        lj = _log_joint(_rows(o, len(lfs)), prior, theta)
        p = np.exp(lj - lj.max(axis=1, keepdims=True)) if len(o) else lj
        return pd.Series(list(p / p.sum(axis=1, keepdims=True)))

    d = votes.withColumn("__o", _outcomes(lfs, classes)).withColumn("probs", posterior("__o"))
    mx = F.array_max("probs")
    tied = F.filter(F.transform(F.col("probs"), lambda p, i: F.when(p >= mx - tol, i)), lambda x: x.isNotNull())
    any_vote = F.array_max("__o") > 0
    labels = F.array(*[F.lit(c) for c in classes])
    pick_hash = F.element_at(tied, (F.conv(F.substring(F.md5(F.concat(F.col(id_col).cast("string"),
                                                                      F.lit(f":{seed}"))), 1, 8), 16, 10)
                                    .cast("bigint") % F.size(tied) + 1).cast("int"))
    single = F.element_at(tied, 1)
    idx = F.when(F.size(tied) == 1, single)
    if tie_break == "hash":
        idx = idx.otherwise(pick_hash)
    pred = F.when(any_vote, F.get(labels, idx.cast("int")))
    return d.withColumn("pred", pred).withColumn("confidence", F.when(F.col("pred").isNotNull(), mx)).drop("__o")


# ---------------------------------------------------------------------------------------------
# Triplet (moments) method for binary votes in {-1, 0, +1}


@dataclass
class TripletModel:
    lfs: list[str]
    accuracy: dict[str, float]
    coverage: dict[str, float]
    prior: float


def binary_votes(votes: DataFrame, lfs: Sequence[str], target: str) -> DataFrame:
    """One-vs-rest view: vote for ``target`` -> +1, vote for another label -> -1, none -> 0."""
    return votes.select("*", *[F.when(F.col(c) == target, 1).when(F.col(c).isNotNull(), -1).otherwise(0)
                               .alias(f"__b_{c}") for c in lfs])


def _fit_moments(single: DataFrame, pairs: DataFrame, rules: int, clip: float) -> DataFrame:
    """``label, i, acc, cov, prior`` from first moments (``label, i, mean, cov``) and second ones (``label, i, j, m``;
    pairs that are not listed have 0).

    With ``M_ij = E[v_i v_j] = a_i a_j`` and ``a_i = cov_i (2 acc_i - 1)``, ``|a_i|`` is the median over pairs (j, k) of
    ``sqrt(|M_ij M_ik / M_jk|)``; rules are assumed better than chance."""
    both = cut_lineage(pairs.filter("m <> 0").select("label", "i", "j", "m").unionByName(
        pairs.filter("m <> 0").select("label", F.col("j").alias("i"), F.col("i").alias("j"), "m")))
    side = both.groupBy("label", "i").agg(F.count("*").alias("beside"))
    of = lambda x, y, m: both.select("label", F.col("i").alias(x), F.col("j").alias(y), F.col("m").alias(m))
    # every pair (j, k) with a moment is a candidate for every other rule; where i lacks a moment, it counts as 0
    den = of("j", "k", "m_jk").filter("j < k")
    full = of("i", "j", "m_ij").join(of("i", "k", "m_ik"), ["label", "i"]).filter("j < k").join(den, ["label", "j", "k"])
    value = full.select("label", "i", F.sqrt(F.abs(F.col("m_ij") * F.col("m_ik") / F.col("m_jk"))).alias("x"))
    # the zeros are not listed: how many there are follows from the numbers of pairs
    total = den.groupBy("label").agg(F.count("*").alias("pairs"))
    by_rule = value.groupBy("label", "i").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    base = (single.select("label", "i", "mean", "cov").join(total, "label", "left").join(side, ["label", "i"], "left")
            .join(by_rule, ["label", "i"], "left"))
    n = (F.coalesce("pairs", F.lit(0)) - F.coalesce("beside", F.lit(0))).cast("int")  # pairs without rule i
    xs = F.coalesce("xs", F.array().cast("array<double>"))
    nth = lambda k: F.when(k < n - F.size(xs), 0.0).otherwise(F.get(xs, (k - (n - F.size(xs))).cast("int")))
    low, high = F.floor((n - 1) / 2), F.floor(n / 2)
    a = F.when(n > 0, (nth(low) + nth(high)) / 2).otherwise(0.0)
    one = base.withColumn("a", a).withColumn("acc", F.when(
        F.col("cov") > 0, F.least(F.lit(1 - clip), F.greatest(F.lit(clip), (1 + F.col("a") / F.col("cov")) / 2)))
        .otherwise(0.5))
    prior = one.groupBy("label").agg(F.coalesce(F.avg(F.when(F.col("a") > 0, F.col("mean") / F.col("a"))), F.lit(0.0)).alias("s"))
    prior = prior.select("label", F.least(F.lit(1 - clip), F.greatest(F.lit(clip), (1 + F.col("s")) / 2)).alias("prior"))
    return one.join(prior, "label").select("label", "i", "acc", "cov", "prior")


def _models(fitted: DataFrame, names: Sequence[str], prior: float | None = None) -> dict[str, TripletModel]:
    """The fitted table (labels x rules numbers) as a model per label."""
    out: dict[str, TripletModel] = {}
    for r in fitted.orderBy("label", "i").collect():
        m = out.setdefault(r.label, TripletModel(list(names), {}, {}, r.prior if prior is None else prior))
        m.accuracy[names[r.i]], m.coverage[names[r.i]] = r.acc, r.cov
    return out


def fit_triplet(votes: DataFrame, lfs: Sequence[str], prior: float | None = None, clip: float = 0.01) -> TripletModel:
    """J9 (moments) for one target: ``lfs`` are columns holding -1/0/+1.  See ``_fit_moments``."""
    signs = votes.select(*[F.when(F.col(c) != 0, F.when(F.col(c) > 0, "+").otherwise("-")).alias(c) for c in lfs])
    return fit_triplets(signs, lfs, ["+"], prior, clip, list(lfs))["+"]


def fit_triplets(votes: DataFrame, lfs: Sequence[str], labels: Sequence[str], prior: float | None = None,
                 clip: float = 0.01, names: Sequence[str] | None = None) -> dict[str, TripletModel]:
    """The moments of all one-vs-rest targets from one table of pair votes.

    Votes are compressed to patterns, and those to counts per (rule, vote) and (rule, rule, vote, vote); each target
    reads its moments off these counts (+1: a vote for it, -1: for another label)."""
    names = list(names or [f"__b_{c}" for c in lfs])
    pat = _patterns(votes, lfs)
    total = pat.agg(F.sum("n")).scalar()
    targets = F.explode(F.array(*[F.lit(t) for t in labels])).alias("label")
    sign = lambda v: F.when(F.col(v) == F.col("label"), 1.0).otherwise(-1.0)
    grid = votes.sparkSession.createDataFrame([(t, i) for t in labels for i in range(len(lfs))], "label string, i int")
    single = _votes_cast(pat).select("*", targets).groupBy("label", F.col("j").alias("i")).agg(
        F.sum(F.col("n") * sign("v")).alias("s"), F.sum("n").alias("c"))
    single = grid.join(single, ["label", "i"], "left").select(
        "label", "i", (F.coalesce("s", F.lit(0.0)) / total).alias("mean"), (F.coalesce("c", F.lit(0)) / total).alias("cov"))
    pairs = _pairs_cast(pat).select("*", targets).groupBy("label", "i", "j").agg(
        (F.sum(F.col("n") * sign("a") * sign("b")) / total).alias("m"))
    return _models(_fit_moments(single, pairs, len(lfs), clip), names, prior)


def predict_triplet(votes: DataFrame, model: TripletModel, out: str = "p_positive") -> DataFrame:
    """Posterior ``P(y = +1)`` from the log-odds sum; NULL when no rule voted."""
    lo = F.lit(math.log(model.prior / (1 - model.prior)))
    anyv = F.lit(False)
    for c in model.lfs:
        a = model.accuracy[c]
        lo = lo + F.col(c) * F.lit(math.log(a / (1 - a)))
        anyv = anyv | (F.col(c) != 0)
    return votes.withColumn(out, F.when(anyv, 1 / (1 + F.exp(-lo))))


def label_model_ovr(votes: DataFrame, lfs: Sequence[str], labels: Sequence[str], threshold: float = 0.5,
                    id_col: str = "id") -> DataFrame:
    """One-vs-rest triplet models, one per target label, then labels above the threshold
    (sorted, NULL when no rule voted).  One pass over the votes fits all of them, one projection predicts."""
    models = fit_triplets(votes, lfs, labels)
    d = votes
    for t in labels:
        d = predict_triplet(binary_votes(d, lfs, t), models[t], f"p_{t}").drop(*[f"__b_{c}" for c in lfs])
    arr = F.array(*[F.when(F.col(f"p_{t}") > threshold, F.lit(t)) for t in labels])
    return d.withColumn("labels", F.array_sort(F.filter(arr, lambda x: x.isNotNull())))
