"""Supplied classifiers (N5): anything with ``fit`` and class probabilities.

The loops, cascades and hierarchies of :mod:`labelkiln.operators.learn` take a ``Classifier``: ``fit`` gets a table of
labelled rows and returns a ``Model`` that knows its ``labels`` and adds an array of probabilities in their order.  Three are
given: the library's logistic regression, any ``pyspark.ml`` probabilistic classifier, and a pair of user functions,
of which the second runs on batches of feature rows in the tasks (``predict_batch_udf``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelkiln.operators.joint import OneModel, fit_one, vector_width


class Model(Protocol):
    labels: list[str]

    def probabilities(self, df: DataFrame, out: str = "probs") -> DataFrame:
        """``df`` with ``array<double>`` probabilities in the order of ``labels``; row-wise."""


class Classifier(Protocol):
    def fit(self, rows: DataFrame, label: str = "label", features: str = "features", weight: str | None = None) -> Model:
        """Fit on the rows whose label is not NULL."""


@dataclass
class MLModel:
    """A fitted ``pyspark.ml`` classifier; ``model`` has the columns ``__prob``, ``__pred`` and ``__raw``."""

    labels: list[str]
    model: Any

    def probabilities(self, df: DataFrame, out: str = "probs") -> DataFrame:
        return self.model.transform(df).withColumn(out, vector_to_array("__prob")).drop("__prob", "__pred", "__raw")


@dataclass
class MLClassifier:
    """Any ``pyspark.ml`` estimator with a probability column (naive Bayes, trees, networks, ...)."""

    estimator: Estimator

    def fit(self, rows: DataFrame, label: str = "label", features: str = "features", weight: str | None = None) -> MLModel:
        rows = rows.filter(F.col(label).isNotNull())
        index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc", handleInvalid="skip").fit(rows)
        est = self.estimator.copy()
        names = {"featuresCol": features, "labelCol": "__y", "probabilityCol": "__prob", "predictionCol": "__pred",
                 "rawPredictionCol": "__raw"}
        if weight:
            if not est.hasParam("weightCol"):
                raise ValueError(f"{type(est).__name__} takes no weights")
            names["weightCol"] = weight
        for name, value in names.items():
            if est.hasParam(name):
                est = est.copy({est.getParam(name): value})
        return MLModel(list(index.labels), est.fit(index.transform(rows)))


@dataclass
class LogisticClassifier:
    """The library's default: multinomial logistic regression with an L2 penalty of strength ``C = c``."""

    c: float = 1.0

    def fit(self, rows: DataFrame, label: str = "label", features: str = "features", weight: str | None = None) -> OneModel:
        return fit_one(rows, label, features, weight, c=self.c)


@dataclass
class BatchModel:
    labels: list[str]
    predict: Callable[[], Callable[[np.ndarray], np.ndarray]]
    features: str
    width: int
    batch_size: int

    def probabilities(self, df: DataFrame, out: str = "probs") -> DataFrame:
        udf = predict_batch_udf(self.predict, return_type=T.ArrayType(T.DoubleType()), batch_size=self.batch_size,
                                input_tensor_shapes=[[self.width]])
        return df.withColumn("__x", vector_to_array(self.features)).withColumn(out, udf("__x")).drop("__x")


@dataclass
class BatchClassifier:
    """User functions: ``train(rows, label, features, weight) -> (labels, state)`` runs on the driver over a DataFrame, and
    ``predict(state)`` gives, once per task, a function from a matrix of feature rows to one of probabilities."""

    train: Callable[[DataFrame, str, str, str | None], tuple[list[str], Any]]
    predict: Callable[[Any], Callable[[np.ndarray], np.ndarray]]
    batch_size: int = 1024

    def fit(self, rows: DataFrame, label: str = "label", features: str = "features", weight: str | None = None) -> BatchModel:
        rows, predict = rows.filter(F.col(label).isNotNull()), self.predict
        labels, state = self.train(rows, label, features, weight)
        return BatchModel(list(labels), lambda: predict(state), features, vector_width(rows, features), self.batch_size)


def as_model(model: Model | PipelineModel) -> Model:
    """A fitted indexer + classifier pipeline as a ``Model``; models as they are."""
    return MLModel(list(model.stages[0].labels), model.stages[1]) if isinstance(model, PipelineModel) else model


def scored(model: Model | PipelineModel, df: DataFrame, out_label: str = "pred", out_conf: str = "confidence",
           probs: str = "probs") -> DataFrame:
    """Probabilities, the best class (equal: the first label) and its probability; row-wise, so also on streams."""
    m = as_model(model)
    best = F.array_position(probs, F.array_max(probs)).cast("int")
    names = F.array(*[F.lit(x) for x in m.labels])
    return (m.probabilities(df, probs).withColumn(out_conf, F.array_max(probs))
            .withColumn(out_label, F.get(names, best - 1)))
