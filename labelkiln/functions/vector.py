"""Numeric and array column functions.

Vectors are ``array<float>`` or ``array<double>`` columns; maths is done in double with built-in
higher-order functions, so no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(v: str | Column) -> Column:
    return _c(v).cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    """H2: dot product (NULL when lengths differ)."""
    a, b = as_double(a), as_double(b)
    prod = F.zip_with(a, b, lambda x, y: x * y)
    return F.when(F.size(a) == F.size(b), F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x))


def norm(a: str | Column) -> Column:
    """H2: Euclidean norm."""
    return F.sqrt(F.aggregate(as_double(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: str | Column, b: str | Column) -> Column:
    """H1: cosine similarity in double; NULL when a norm is zero or lengths differ."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def mean_element(a: str | Column) -> Column:
    """H2: mean of the elements of one vector."""
    return F.aggregate(as_double(a), F.lit(0.0), lambda acc, x: acc + x) / F.size(_c(a))


def sigmoid(x: str | Column) -> Column:
    """H3."""
    return 1.0 / (1.0 + F.exp(-_c(x)))


def softmax(arr: str | Column) -> Column:
    """H4: numerically stable softmax of an array of logits."""
    a = as_double(arr)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def least_confidence(p: str | Column) -> Column:
    """H5: ``1 - max p``."""
    return 1.0 - F.array_max(as_double(p))


def margin(p: str | Column) -> Column:
    """H6: best minus second best probability (the whole best when there is one class)."""
    s = F.sort_array(as_double(p), asc=False)
    return F.when(F.size(s) > 1, s[0] - s[1]).otherwise(s[0])


def entropy(p: str | Column) -> Column:
    """H7: ``-sum p ln p`` with ``0 ln 0 = 0``."""
    return -F.aggregate(as_double(p), F.lit(0.0),
                        lambda acc, x: acc + F.when(x > 0, x * F.log(x)).otherwise(0.0))


def egl(p: str | Column, x_norm: str | Column) -> Column:
    """H8: expected gradient length of a softmax regression:
    ``||x|| * sum_c p_c * ||p - e_c||``, with ``||p - e_c||^2 = sum p^2 - 2 p_c + 1``."""
    pd = as_double(p)
    sq = F.aggregate(pd, F.lit(0.0), lambda acc, v: acc + v * v)
    return _c(x_norm) * F.aggregate(pd, F.lit(0.0),
                                    lambda acc, v: acc + v * F.sqrt(sq - 2 * v + 1))


def multilabel_uncertainty(p: str | Column, how: str = "mean") -> Column:
    """H9: per label ``1 - 2|p - 0.5|`` (1 = undecided), averaged or the most undecided."""
    u = F.transform(as_double(p), lambda x: 1.0 - 2.0 * F.abs(x - 0.5))
    if how == "mean":
        return F.aggregate(u, F.lit(0.0), lambda acc, x: acc + x) / F.size(u)
    return F.array_max(u)


def weighted_bce(p: str | Column, y: str | Column, w: str | Column, eps: float = 1e-7) -> Column:
    """Mean over labels of ``-(w y ln p + (1-y) ln(1-p))`` (positive weight per label)."""
    z = F.arrays_zip(as_double(p).alias("p"), _c(y).cast("array<double>").alias("y"),
                     _c(w).cast("array<double>").alias("w"))
    terms = F.transform(z, lambda t: -(t["w"] * t["y"] * F.log(F.greatest(t["p"], F.lit(eps)))
                                       + (1 - t["y"]) * F.log(F.greatest(1 - t["p"], F.lit(eps)))))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) / F.size(terms)


def focal_loss(p: str | Column, y: str | Column, gamma: float = 2.0, eps: float = 1e-7) -> Column:
    """Mean over labels of ``-(1-p_t)^gamma ln p_t`` with ``p_t = p`` if y=1 else ``1-p``."""
    z = F.arrays_zip(as_double(p).alias("p"), _c(y).cast("array<double>").alias("y"))
    terms = F.transform(z, lambda t: F.when(t["y"] == 1, t["p"]).otherwise(1 - t["p"]))
    loss = F.transform(terms, lambda pt: -F.pow(1 - pt, gamma) * F.log(F.greatest(pt, F.lit(eps))))
    return F.aggregate(loss, F.lit(0.0), lambda acc, x: acc + x) / F.size(loss)


def multi_hot(labels: str | Column, vocab: Sequence[str] | Column) -> Column:
    """0/1 vector over the sorted vocabulary."""
    v = F.array(*[F.lit(x) for x in vocab]) if not isinstance(vocab, Column) else vocab
    lab = _c(labels)
    return F.transform(v, lambda x: F.when(F.array_contains(lab, x), 1.0).otherwise(0.0))


def labels_above(p: str | Column, vocab: Sequence[str] | Column, t: float = 0.5,
                 strict: bool = True) -> Column:
    """Labels whose probability passes the cut (``> t`` by default, as with sigmoid > 0.5)."""
    v = F.array(*[F.lit(x) for x in vocab]) if not isinstance(vocab, Column) else vocab
    z = F.arrays_zip(as_double(p).alias("p"), v.alias("l"))
    keep = F.filter(z, lambda e: e["p"] > t if strict else e["p"] >= t)
    return F.transform(keep, lambda e: e["l"])


def argmax(p: str | Column) -> Column:
    """0-based position of the first maximum."""
    a = as_double(p)
    return F.array_position(a, F.array_max(a)) - 1
