"""Learned classifiers and training loops on ``pyspark.ml``.

Fits are distributed (one aggregate job per optimizer step); features are sparse vectors built once.  The parents of
a hierarchy and the labels of a multi-label task are fitted together (:mod:`labelkiln.operators.joint`).  Loops
(self-training, active learning) are driver loops over DataFrames: each round is fit -> score -> choose, and the state of
a loop is a table of keys (id, label, round) that is joined to the fixed feature tables, so a checkpoint of a round
holds no features.  Every loop takes a classifier of one's own (:mod:`labelkiln.operators.classifier`).
Nothing but fitted parameters and per-round counts comes back to the driver.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelkiln.functions import text as tx
from labelkiln.functions import vector as V
from labelkiln.operators import joint
from labelkiln.operators.classifier import Classifier, LogisticClassifier, Model, as_model, scored
from labelkiln.operators.ranking import hash_order, query_batch, top_fraction
from labelkiln.operators.tokens import HEAD, looked_up
from labelkiln.operators.update import apply_labels
from labelkiln.session import checkpoint_dir, cut_lineage

JAVA_TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}_]{2,}"


# --------------------------------------------------------------------------------------- features


def _counts(text: str, max_features: int | None, min_df: float) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__tok", pattern=JAVA_TOKEN_PATTERN, gaps=False, toLowercase=True),
        CountVectorizer(inputCol="__tok", outputCol="__tf", vocabSize=max_features or (1 << 31) - 1, minDF=min_df)])


def _weighted(counted: PipelineModel, rows: DataFrame, out: str) -> PipelineModel:
    """The pipeline of the term counts with the weights that ``rows`` (with counts) give."""
    idf = IDF(inputCol="__tf", outputCol="__idf").fit(rows).idf
    # smooth IDF: ln((1 + n) / (1 + df)) + 1, so a term of every document still counts
    smooth = ElementwiseProduct(scalingVec=Vectors.dense(idf.toArray() + 1.0), inputCol="__tf", outputCol="__idf")
    return PipelineModel(stages=[*counted.stages, smooth, Normalizer(inputCol="__idf", outputCol=out, p=2.0)])


def tfidf_features(df: DataFrame, text: str = "text", max_features: int | None = 1000,
                   out: str = "features", min_df: float = 1.0) -> PipelineModel:
    """L1: tokenizer (lower case, runs of 2+ word characters) -> term counts (``max_features``: the most
    frequent terms; None: all) -> smooth IDF -> L2 normalization.  Returns the fitted pipeline."""
    d = df.select(text).na.fill({text: ""})
    counted = _counts(text, max_features, min_df).fit(d)
    return _weighted(counted, counted.transform(d), out)


def tfidf_rows(df: DataFrame, text: str = "text", max_features: int | None = 1000, out: str = "features",
               min_df: float = 1.0) -> tuple[PipelineModel, DataFrame]:
    """:func:`tfidf_features` and the features of the rows it is fitted on, stored without their texts.  The term counts are
    stored on the way, so the texts are cut into tokens twice: for the vocabulary and for the counts."""
    d = df.na.fill({text: ""})
    counted = _counts(text, max_features, min_df).fit(d.select(text))
    rows = cut_lineage(counted.transform(d).drop(text, "__tok"))
    model = _weighted(counted, rows, out)
    for stage in model.stages[-2:]:
        rows = stage.transform(rows)
    return model, cut_lineage(rows.drop("__tf", "__idf"))


def featurize(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    return model.transform(df.na.fill({text: ""})).drop("__tok", "__tf", "__idf")


def tfidf_relational(df: DataFrame, text: str = "text", id_col: str = "id", max_features: int = 1000) -> DataFrame:
    """L1 (relational, SQL-checkable): ``(id, term, weight)`` with the usual smooth IDF
    ``ln((1 + n) / (1 + df)) + 1`` and L2-normalized rows; the vocabulary is the ``max_features``
    terms with the highest corpus count (ties by term)."""
    # the texts are dealt by id once; counts, the vocabulary's document counts and the lengths of the rows need no other
    # shuffle than one line a term and task
    toks = df.select(id_col, text).repartition(F.col(id_col)).select(id_col, F.explode(tx.words(text)).alias("term"))
    tf = toks.groupBy(id_col, "term").agg(F.count("*").alias("tf"))
    n = df.agg(F.count("*")).scalar()
    stats = tf.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))
    voc = cut_lineage(stats.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features))  # the vocabulary cap
    w = tf.filter(F.col(id_col).isNotNull()).join(F.broadcast(voc), "term").withColumn(
        "w", F.col("tf") * (F.log((1 + n) / (1 + F.col("df"))) + 1))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / length).alias("weight"))


def vectors_as_features(df: DataFrame, vec: str = "vec", out: str = "features") -> DataFrame:
    """Stored embeddings (array<float>) as ``pyspark.ml`` dense vectors."""
    return df.withColumn(out, array_to_vector(F.col(vec).cast("array<double>")))


# --------------------------------------------------------------------------------------- models


def train_lr(df: DataFrame, label: str = "label", features: str = "features", weight: str | None = None,
             reg: float | None = None, max_iter: int = 200, elastic_net: float = 0.0, c: float = 1.0,
             tol: float = 1e-6) -> PipelineModel:
    """L2: multinomial logistic regression; labels indexed alphabetically (one vocabulary for the
    whole run, Q15).  ``weight`` is a per-row weight column (L3).

    L2-regularized with strength ``C = c``: the summed loss weighs ``c`` against the penalty, which is
    ``regParam = 1 / (c n)`` for Spark's mean loss.  ``reg`` sets ``regParam`` itself."""
    df = df.filter(F.col(label).isNotNull())
    if reg is None:
        reg = 1.0 / (c * max(1, df.count()))
    idx = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc", handleInvalid="skip")
    lr = LogisticRegression(featuresCol=features, labelCol="__y", probabilityCol="__prob", predictionCol="__pred",
                            rawPredictionCol="__raw", regParam=reg, elasticNetParam=elastic_net, maxIter=max_iter,
                            standardization=False, family="multinomial", tol=tol)
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[idx, lr]).fit(df.filter(F.col(label).isNotNull()))


def model_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def score(model: Model | PipelineModel, df: DataFrame, out_label: str = "pred", out_conf: str = "confidence",
          probs: str = "probs") -> DataFrame:
    """L2: class probabilities as an array, best class (E3) and its probability."""
    return scored(model, df, out_label, out_conf, probs)


def train_relevance(df: DataFrame, label: str = "relevance", features: str = "features",
                    balanced: bool = True, classifier: Classifier | None = None) -> Model:
    """L3: class-balanced binary "gatekeeper" (weights ``N / (k n_j)`` from D8)."""
    from labelkiln.operators.balance import class_weights, with_weights
    d = df.withColumn("__lab", F.col(label).cast("string"))
    if balanced:
        d = with_weights(d, class_weights(d, "__lab"), "__lab", "__w")
    return (classifier or LogisticClassifier()).fit(d, "__lab", features, "__w" if balanced else None)


def train_svm(df: DataFrame, label: str = "relevance", features: str = "features", reg: float = 0.01):
    """Weighted linear SVM gatekeeper (linear kernel only)."""
    from labelkiln.operators.balance import class_weights, with_weights
    d = df.withColumn("__lab", F.col(label).cast("string"))
    d = with_weights(d, class_weights(d, "__lab"), "__lab", "__w").withColumn("__y", F.col(label).cast("double"))
    fitted = LinearSVC(featuresCol=features, labelCol="__y", weightCol="__w", regParam=reg,
                       predictionCol="svm_pred", rawPredictionCol="svm_raw").fit(d)
    # a fitted model holds its training summary and with it the session, which tasks cannot take once the session has
    # observed a metric; a stored and loaded model has its parameters only
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/svm-{uuid.uuid4().hex}"
    fitted.write().save(path)
    return LinearSVCModel.load(path)


def fewshot_label(df: DataFrame, vec: str = "vec", label: str = "label", threshold: float = 0.6,
                  id_col: str = "id", relevance: str = "relevance") -> DataFrame:
    """L4: classifier head on stored vectors; unlabelled rows whose best probability is >= threshold
    get the label (relevance 1), written back by key."""
    d = vectors_as_features(df, vec)
    m = train_lr(d.filter(F.col(label).isNotNull()), label)
    s = score(m, d.filter(F.col(label).isNull()))
    acc = s.filter(F.col("confidence") >= threshold).select(id_col, F.col("pred").alias("__new"))
    return apply_labels(df, acc, on=id_col, label=label, new_label="__new", relevance=relevance)


def train_multilabel(df: DataFrame, labels: str = "labels", vocab: Sequence[str] = (), features: str = "features",
                     classifier: Classifier | None = None, parallelism: int = 4) -> joint.JointModel | dict[str, Model]:
    """One yes/no model per label.  All labels are fitted together, one job a step; with a ``classifier`` of one's own
    its fits run ``parallelism`` at a time over the shared rows."""
    if classifier is None:
        return joint.fit_multilabel(df, labels, vocab, features)
    d = cut_lineage(df.select(features, labels).filter(F.col(labels).isNotNull()))

    def fit(v: str) -> tuple[str, Model]:
        return v, classifier.fit(d.withColumn("__bin", F.when(F.array_contains(labels, v), "1").otherwise("0")),
                                 "__bin", features)

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return dict(ex.map(fit, list(vocab)))


def predict_multilabel(models: joint.JointModel | Mapping[str, Model], df: DataFrame, cut: float = 0.5,
                       out: str = "labels_pred", features: str = "features") -> DataFrame:
    """Labels whose own model gives P(yes) > cut, sorted (I2).  Row-wise."""
    if isinstance(models, joint.JointModel):
        return df.withColumn(out, joint.labels_above(models, features, cut))
    d, kept = df, []
    for k, (v, m) in enumerate(sorted(models.items())):
        if "1" in m.labels:
            d = m.probabilities(d, f"__p{k}")
            kept.append(F.when(F.get(f"__p{k}", F.lit(m.labels.index("1"))) > cut, F.lit(v)))
    arr = F.array(*kept) if kept else F.array().cast("array<string>")
    return d.withColumn(out, F.array_sort(F.filter(arr, lambda x: x.isNotNull()))).select(*df.columns, out)


def gate_passes(gate: Model | PipelineModel, df: DataFrame, gate_label: str = "1", out: str = "gate_passes",
                threshold: float | None = None) -> DataFrame:
    """L6, first half: whether the gate's best class is ``gate_label``, or its probability reaches ``threshold``."""
    m = as_model(gate)
    d = scored(m, df, "__gate", "__gate_conf", "__gate_probs")
    if threshold is None:
        ok = F.col("__gate") == gate_label
    else:
        ok = F.get("__gate_probs", F.lit(m.labels.index(gate_label))) >= threshold if gate_label in m.labels else F.lit(False)
    return d.withColumn(out, F.coalesce(ok, F.lit(False))).drop("__gate", "__gate_conf", "__gate_probs")


def cascade(df: DataFrame, gate: Model | PipelineModel, specialist: joint.JointModel | Callable[[DataFrame], DataFrame],
            gate_label: str = "1", out: str = "labels_pred", features: str = "features", cut: float = 0.5,
            threshold: float | None = None) -> DataFrame:
    """The cheap gate scores every row; only rows it passes go to the specialist; rows the gate stops get
    an empty label list.  Every row once, without a join, so it also runs on streams.

    A joint model sees the features of passed rows only and everything is one projection; a function gets the
    passed rows and returns each with ``out`` (a gate score is then computed on both branches)."""
    none = F.array().cast("array<string>")
    d = gate_passes(gate, df, gate_label, "__pass", threshold)
    if isinstance(specialist, joint.JointModel):
        seen = joint.labels_above(specialist, F.when(F.col("__pass"), F.col(features)), cut)
        return d.withColumn(out, F.when(F.col("__pass"), seen).otherwise(none)).drop("__pass")
    passed = specialist(d.filter("__pass").drop("__pass")).withColumn(out, F.coalesce(out, none))
    return passed.select(*df.columns, out).unionByName(
        d.filter("NOT __pass").drop("__pass").withColumn(out, none).select(*df.columns, out))


# --------------------------------------------------------------------------------------- hierarchy


def train_hierarchy(df: DataFrame, levels: Sequence[str], features: str = "features", min_rows: int = 2,
                    classifier: Classifier | None = None, parallelism: int = 4) -> joint.JointModel | dict[str, Model]:
    """One classifier per parent node (key = slash path of the parent, '' for the root) over the
    next level.  Parents with fewer than two children or ``min_rows`` rows get no model (F15).

    All parents of all levels are fitted together; with a ``classifier`` of one's own its fits run ``parallelism`` at
    a time, one per parent."""
    if classifier is None:
        return joint.fit_hierarchy(df, levels, features, min_rows)
    d = cut_lineage(df.select(features, *levels, *[joint.path_key(levels[:k]).alias(f"__key{k}") for k in range(len(levels))]))
    wanted = []
    for k, level in enumerate(levels):
        stats = d.filter(F.col(f"__key{k}").isNotNull() & F.col(level).isNotNull()).groupBy(f"__key{k}").agg(
            F.countDistinct(level).alias("k"), F.count("*").alias("n"))
        wanted += [(k, level, r[0]) for r in stats.filter((F.col("k") >= 2) & (F.col("n") >= min_rows)).collect()]

    def fit(task: tuple[int, str, str]) -> tuple[str, Model]:
        k, level, key = task
        rows = d.filter(F.col(f"__key{k}") == key).withColumn("__child", F.col(level).cast("string"))
        return key, classifier.fit(rows, "__child", features)

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return dict(ex.map(fit, wanted))


def predict_path(models: joint.JointModel | Mapping[str, Model], df: DataFrame, depth: int, id_col: str = "id",
                 out: str = "path", features: str = "features") -> DataFrame:
    """C11: descend level by level; rows at a parent with a model get its prediction appended, rows
    at a parent without one stop (their path ends there).

    With a joint model the whole way down is one expression over the row's features.  Other models score the rows at
    their own parent only."""
    if isinstance(models, joint.JointModel):
        return df.withColumn(out, joint.path_column(models, features, depth))
    cur = df.withColumn(out, F.array().cast("array<string>")).withColumn("__key", F.lit(""))
    done = None
    for _ in range(depth):
        parts = [scored(m, cur.filter(F.col("__key") == key), "__next", "__c", "__p")
                 .withColumn(out, F.concat(F.col(out), F.array("__next"))).withColumn("__key", tx.path_key(out))
                 .drop("__next", "__c", "__p") for key, m in models.items()]
        stopped = cur.filter(~F.col("__key").isin(list(models)))
        done = stopped if done is None else done.unionByName(stopped)
        cur = parts[0] if parts else cur.limit(0)
        for p in parts[1:]:
            cur = cur.unionByName(p)
        cur = cut_lineage(cur)
    return done.unionByName(cur).drop("__key") if done is not None else cur.drop("__key")


# --------------------------------------------------------------------------------------- loops


def _by_class(thresholds: float | Mapping[str, float], label: Column) -> Column:
    """The threshold of a row's class (B4); a class that is not named is never accepted."""
    if not isinstance(thresholds, Mapping):
        return F.lit(float(thresholds))
    named = F.lit(None).cast("double")
    for name, t in thresholds.items():
        named = F.when(label == name, F.lit(float(t))).otherwise(named)
    return named


def self_train(labelled: DataFrame, pool: DataFrame, threshold: float | Mapping[str, float] | Sequence = 0.9,
               rounds: int = 1, label: str = "label", features: str = "features", id_col: str = "id",
               log: list | None = None, classifier: Classifier | None = None, surest: float | None = None,
               balance: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Fit on the labelled set, pseudo-label pool rows with confidence >= the round's threshold, append them,
    remove them from the pool.  Stops when the pool is empty or nothing is accepted.  Returns (labelled, pool).

    ``threshold``: a number, one per class (B4), or a list of either, one per round.  ``surest``: at most this
    share of the pool per round, the surest rows (E4).  ``balance``: each round fits on so many rows per class, cut or
    repeated in seeded order (F5).  ``log`` gets ``(round, accepted)``.

    The state of the loop is the table of accepted keys; features are read from ``pool``, whose ids are unique.
    """
    from labelkiln.operators.balance import rebalance

    clf = classifier or LogisticClassifier()
    plan = list(threshold) if isinstance(threshold, (list, tuple)) else [threshold] * max(1, rounds)
    start = labelled.select(id_col, features, label, F.lit(0).alias("round"))
    rows = pool.select(id_col, features)
    taken = None

    def grown() -> DataFrame:
        return start if taken is None else start.unionByName(
            rows.join(taken, id_col).select(id_col, features, label, "round"))

    def rest() -> DataFrame:
        return rows if taken is None else rows.join(taken, id_col, "left_anti")

    for r in range(1, rounds + 1):
        left = rest()
        if left.isEmpty():
            break
        train = grown()
        if balance is not None:
            train = rebalance(train.filter(F.col(label).isNotNull()), label, balance, seed, id_col)
        model = clf.fit(train, label, features)
        s = scored(model, left).select(id_col, F.col("pred").alias(label), "confidence")
        if surest is not None:
            s = top_fraction(s, surest, "confidence", id_col)
        sure = s.filter(F.col("confidence") >= _by_class(plan[min(r - 1, len(plan) - 1)], F.col(label)))
        sure = cut_lineage(sure.select(id_col, label, F.lit(r).alias("round")))
        n = sure.count()
        if log is not None:
            log.append((r, n))
        if n == 0:
            break
        taken = sure if taken is None else taken.unionByName(sure)
    return grown(), rest()


def uncertainty(strategy: str | Callable[[Column], Column], probs: str = "probs", features: str = "features") -> Column:
    """H5-H9 by name: how unsure a row is.  ``egl`` also takes the length of the features into account; the two multi-label
    strategies read every probability as a yes/no of its own.  A function of the probabilities is taken as it is."""
    if callable(strategy):
        return strategy(F.col(probs))
    return {"least_confidence": lambda: V.least_confidence(probs), "margin": lambda: -V.margin(probs),
            "entropy": lambda: V.entropy(probs), "egl": lambda: V.egl(probs, joint.vector_norm(features)),
            "multilabel_mean": lambda: V.multilabel_uncertainty(probs, "mean"),
            "multilabel_most": lambda: V.multilabel_uncertainty(probs, "max")}[strategy]()


def active_learn(labelled: DataFrame, pool: DataFrame, expert: DataFrame, n: int = 50, rounds: int = 3,
                 strategy: str | Callable[[Column], Column] = "least_confidence", label: str = "label",
                 features: str = "features", id_col: str = "id", log: list | None = None,
                 classifier: Classifier | None = None) -> tuple[DataFrame, DataFrame]:
    """Each round fit, score the pool, take the ``n`` least sure rows (E1), look their
    answers up in the expert table ``(id, label)`` (a key join), append, remove from the pool.

    Where ``label`` is a list of labels, a yes/no model per label is fitted (L5) and the probabilities are theirs.  The
    state of the loop is the table of answered keys, as in :func:`self_train`."""
    clf = classifier or LogisticClassifier()
    start = labelled.select(id_col, features, label, F.lit(0).alias("round"))
    rows = pool.select(id_col, features)
    several = dict(labelled.dtypes)[label].startswith("array")
    taken = None

    def grown() -> DataFrame:
        return start if taken is None else start.unionByName(
            rows.join(taken, id_col).select(id_col, features, label, "round"))

    def rest() -> DataFrame:
        return rows if taken is None else rows.join(taken, id_col, "left_anti")

    def probabilities(train: DataFrame, left: DataFrame) -> DataFrame:
        if not several:
            return scored(clf.fit(train, label, features), left)
        vocab = [r[0] for r in train.select(F.explode(label).alias("v")).distinct().orderBy("v").collect()]
        return left.withColumn("probs", joint.label_scores(joint.fit_multilabel(train, label, vocab, features), features))

    for r in range(1, rounds + 1):
        left = rest()
        if left.isEmpty():
            break
        s = probabilities(grown(), left).withColumn("uncertainty", uncertainty(strategy, "probs", features))
        asked = query_batch(s.select(id_col, "uncertainty"), n, "uncertainty", id_col).select(id_col)
        got = cut_lineage(asked.join(expert.select(id_col, F.col(label)), id_col).withColumn("round", F.lit(r)))
        k = got.count()
        if log is not None:
            log.append((r, k))
        if k == 0:
            break
        taken = got if taken is None else taken.unionByName(got)
    return grown(), rest()


# --------------------------------------------------------------------------------------- search


def search(df: DataFrame, label: str = "label", features: str = "features", trials: int = 15, seed: int = 42,
           folds: int = 0, positive: str | None = None, parallelism: int = 4, space: dict | None = None):
    """Seeded random search over LR settings, objective F1 (Q19).  Each of the ``trials`` draws takes
    ``reg`` log-uniform and ``elastic_net`` uniform from the ranges of ``space`` and ``max_iter`` from its list.  F1 of the
    positive class when given, else weighted F1.  ``folds`` > 1 uses cross-validation, otherwise a
    seeded 80/20 train/validation split.  Fits run ``parallelism`` at a time."""
    rnd = random.Random(seed)
    idx = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc", handleInvalid="skip")
    lr = LogisticRegression(featuresCol=features, labelCol="__y", standardization=False)
    space = {"reg": (1e-4, 1.0), "elastic_net": (0.0, 1.0), "max_iter": [20, 50, 100]} | (space or {})
    low, high = space["reg"]
    grid = [{lr.regParam: low * (high / low) ** rnd.random(), lr.elasticNetParam: rnd.uniform(*space["elastic_net"]),
             lr.maxIter: rnd.choice(space["max_iter"])} for _ in range(trials)]
    if positive is not None:
        ev = MulticlassClassificationEvaluator(labelCol="__y", metricName="fMeasureByLabel")
    else:
        ev = MulticlassClassificationEvaluator(labelCol="__y", metricName="f1")
    d = idx.fit(df).transform(df)
    if positive is not None:
        ev.setMetricLabel(float(idx.fit(df).labels.index(positive)))
    if folds and folds > 1:
        tv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed,
                            parallelism=parallelism)
    else:
        tv = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.8, seed=seed,
                                  parallelism=parallelism)
    return tv.fit(d)


def search_results(model, spark) -> DataFrame:
    """One row per trial ``(trial, reg, elastic_net, max_iter, f1)``."""
    metrics = model.avgMetrics if hasattr(model, "avgMetrics") else model.validationMetrics
    rows = []
    for i, (pm, m) in enumerate(zip(model.getEstimatorParamMaps(), metrics)):
        p = {k.name: v for k, v in pm.items()}
        rows.append((i, float(p["regParam"]), float(p["elasticNetParam"]), int(p["maxIter"]), float(m)))
    return spark.createDataFrame(rows, "trial int, reg double, elastic_net double, max_iter int, f1 double")


def fit_best(train: DataFrame, test: DataFrame, params: dict, label: str = "label", features: str = "features",
             path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit with the chosen settings, evaluate on the held-out rows (per-class precision/recall/F1
    via D14 one-vs-rest), optionally save the model."""
    from labelkiln.operators.metrics import binary_metrics
    m = train_lr(train, label, features, reg=params.get("regParam", 0.0), max_iter=params.get("maxIter", 100),
                 elastic_net=params.get("elasticNetParam", 0.0))
    s = score(m, test)
    parts = []
    for c in model_labels(m):
        t = s.select((F.col("pred") == c).cast("int").alias("p"), (F.col(label) == c).cast("int").alias("g"))
        parts.append(binary_metrics(t, "p", "g", 1).withColumn("label", F.lit(c)))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    if path:
        m.write().overwrite().save(path)
    return m, res


# --------------------------------------------------------------------------------------- sequences


def token_vocab(df: DataFrame, text: str = "text", specials: Sequence[str] = ("[PAD]", "[UNK]")) -> DataFrame:
    """I5 vocabulary: specials first (ids 0, 1, ...), then tokens by corpus count desc, token asc.
    The distinct-token table can be large, so ids come from the distributed exact rank
    (range-partitioned sort + per-partition offsets), not from a single-partition window."""
    from labelkiln.operators.ranking import global_rank
    toks = df.select(F.explode(tx.words(text)).alias("token")).groupBy("token").agg(F.count("*").alias("cf"))
    ranked = global_rank(toks, [F.col("cf").desc(), F.col("token")], out="__r").select(
        "token", (F.col("__r") - 1 + len(specials)).alias("token_id"))
    sp = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(specials)], "token string, token_id int")
    return sp.unionByName(ranked.withColumn("token_id", F.col("token_id").cast("int")))


def encode_sequences(df: DataFrame, vocab: DataFrame, text: str = "text", id_col: str = "id",
                     max_len: int = 512, pad_id: int = 0, unk_id: int = 1) -> DataFrame:
    """Token ids truncated and padded to ``max_len`` plus the attention mask.  Truncation happens
    before the explode, so at most ``max_len`` tokens per row go through the vocabulary join."""
    t = df.select(id_col, F.posexplode(F.slice(tx.words(text), 1, max_len)).alias("pos", "token"))
    # ids follow the corpus counts, so the frequent tokens are the first ones
    head = vocab.filter(F.col("token_id") < HEAD).select("token").distinct()
    j = looked_up(t, vocab, "token", head).withColumn("token_id", F.coalesce("token_id", F.lit(unk_id)))
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("__s"))
    ids = F.transform("__s", lambda s: s["token_id"])
    out = df.select(id_col).join(g, id_col, "left").withColumn("__ids", F.coalesce(ids, F.array().cast("array<int>")))
    n = F.size("__ids")
    return out.select(id_col,
                      F.concat("__ids", F.array_repeat(F.lit(pad_id), F.lit(max_len) - n)).alias("input_ids"),
                      F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
                      .alias("attention_mask"))


def hash_split(df: DataFrame, frac: float = 0.2, seed: int = 42, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Seeded unstratified split by hash (train, test)."""
    u = F.conv(F.substring(hash_order(id_col, seed), 1, 8), 16, 10).cast("bigint") / 4294967296.0
    return df.filter(u >= frac), df.filter(u < frac)
