"""Evaluation (D14-D16, D19, N7): each metric is one aggregate over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, pred: str = "pred", gold: str = "gold", positive=1) -> DataFrame:
    """Precision, recall, F1 of the positive class (0 when a denominator is 0).  A NULL prediction
    (an abstaining model) is not a positive one, so it counts as a miss on positive rows."""
    p = F.coalesce(F.col(pred) == positive, F.lit(False))
    g = F.coalesce(F.col(gold) == positive, F.lit(False))
    a = df.agg(F.count_if(p & g).cast("bigint").alias("tp"), F.count_if(p & ~g).cast("bigint").alias("fp"),
               F.count_if(~p & g).cast("bigint").alias("fn"), F.count_if(~p & ~g).cast("bigint").alias("tn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return (a.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                        F.col("precision") + F.col("recall"))))


def multilabel_metrics(df: DataFrame, pred: str = "pred_labels", gold: str = "gold_labels") -> DataFrame:
    """Sample-averaged F1 (``2|P∩G| / (|P|+|G|)``, 0 when both are empty) and exact-match
    accuracy over label sets."""
    p, g = F.array_distinct(F.col(pred)), F.array_distinct(F.col(gold))
    inter = F.size(F.array_intersect(p, g))
    denom = F.size(p) + F.size(g)
    f1 = F.when(denom > 0, 2.0 * inter / denom).otherwise(0.0)
    exact = F.when(F.array_sort(p) == F.array_sort(g), 1.0).otherwise(0.0)
    return df.agg(F.avg(f1).alias("f1_samples"), F.avg(exact).alias("exact_match"),
                  F.count("*").cast("bigint").alias("rows"))


def confusion(df: DataFrame, pred: str = "pred", gold: str = "gold") -> DataFrame:
    """Confusion counts ``(gold, pred, count)``."""
    return df.groupBy(gold, pred).agg(F.count("*").cast("bigint").alias("count"))


def per_class_recall(df: DataFrame, pred: str = "pred", gold: str = "gold") -> DataFrame:
    """Recall per gold class, to find the weak classes."""
    return df.groupBy(gold).agg(F.count("*").cast("bigint").alias("support"),
                                F.avg(F.when(F.col(pred) == F.col(gold), 1.0).otherwise(0.0)).alias("recall"))


def path_error(df: DataFrame, pred_path: str = "pred_path", gold_path: str = "gold_path") -> DataFrame:
    """Hierarchical error; a wrong path costs ``2^-d`` where d is the first differing level
    (0 = root), so mistakes near the root cost more; a correct path costs 0."""
    z = F.arrays_zip(F.col(pred_path).alias("p"), F.col(gold_path).alias("g"))
    diff = F.filter(F.transform(z, lambda e, i: F.when(~e["p"].eqNullSafe(e["g"]), i)), lambda x: x.isNotNull())
    first = F.array_min(diff)
    cost = F.when(first.isNull(), 0.0).otherwise(F.pow(F.lit(2.0), -first))
    return df.agg(F.avg(cost).alias("path_error"),
                  F.avg(F.when(first.isNull(), 1.0).otherwise(0.0)).alias("exact_paths"),
                  F.count("*").cast("bigint").alias("rows"))
