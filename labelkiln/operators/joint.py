"""Many logistic regressions fitted together.

A *problem* is one classifier: a parent of a hierarchy, or one label of a multi-label task.  All problems of a run
take their optimizer steps together: one job per step, in which every task sums loss and gradient of all problems over
its rows, and Spark adds the tasks' sums up per problem.  A run therefore takes as many jobs as its slowest problem
takes steps, whatever the number of problems.  Rows stay sparse and where they are; only coefficients (features x classes)
pass through the driver.

Each problem is the model of :func:`labelkiln.operators.learn.train_lr`: multinomial, L2 penalty of strength ``C = c``, intercepts
without penalty.  Prediction is one column expression over a broadcast table of all coefficients keyed by problem, so
the way down a hierarchy, or all labels of a row, take one narrow pass, in batch and on streams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.session import cut_lineage, ship_package

CHUNK_VALUES = 2_000_000
#: Features whose second moments are taken in full, and the rows they are taken from (both set the pace only).
GRAM_FEATURES, GRAM_ROWS = 1024, 100_000


# ------------------------------------------------------------------------------------------- rows as matrices


def dense_chunks(vectors: pa.StructArray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """``first row, matrix`` over the rows of an ML vector column, at most ``CHUNK_VALUES`` values at a time."""
    step = max(1, CHUNK_VALUES // max(1, width))
    for lo in range(0, len(vectors), step):
        kind, _, indices, values = vectors.slice(lo, step).flatten()
        n = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
        sparse = kind.to_numpy(zero_copy_only=False) == 0
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at[sparse[row]] = indices.flatten().to_numpy(zero_copy_only=False)
        x = np.zeros((len(n), width))
        x[row, at] = values.flatten().to_numpy(zero_copy_only=False)
        yield lo, x


def _for_rows(v: pa.StructArray, width: int, compute) -> tuple[list, pa.Array | None]:
    """``compute`` over the rows that have a vector, chunk by chunk; and, if some have none, which result is whose."""
    if not v.null_count:
        return [compute(x) for _, x in dense_chunks(v, width)], None
    valid = v.is_valid().to_numpy(zero_copy_only=False)
    own = pa.array(np.cumsum(valid) - 1, mask=~valid)
    return [compute(x) for _, x in dense_chunks(v.filter(pa.array(valid)), width)], own


def _lists(parts: list[np.ndarray], own: pa.Array | None, width: int) -> pa.Array:
    """Rows of a matrix as a list column; rows without a vector are NULL."""
    m = np.concatenate(parts) if parts else np.zeros((0, width))
    rows = pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * width, m.ravel())
    return rows if own is None else rows.take(own)


def vector_norm(vec: str) -> Column:
    """L2 length of an ML vector column."""
    @F.arrow_udf("double")
    def norm(v: pa.Array) -> pa.Array:
        values = v.flatten()[3]
        n = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(n)), n)
        return pa.array(np.sqrt(np.bincount(row, values.flatten().to_numpy(zero_copy_only=False) ** 2, len(n))))

    return norm(vec)


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=1, keepdims=True)
    return e / total, (top + np.log(total))[:, 0]


# ------------------------------------------------------------------------------------------- the optimizer


class _Descent:
    """L-BFGS with backtracking for one problem, told one value and gradient at a time.  ``solve`` is a first guess at the
    inverse of the second derivatives; it decides how many steps are taken, not where they lead."""

    def __init__(self, x: np.ndarray, tol: float, solve: Callable[[np.ndarray], np.ndarray], memory: int = 20):
        self.x, self.tol, self.solve, self.memory = x, tol, solve, memory
        self.f, self.g, self.direction, self.step = None, None, None, 1.0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.done = False

    def trial(self) -> np.ndarray:
        return self.x if self.direction is None else self.x + self.step * self.direction

    def tell(self, f: float, g: np.ndarray) -> None:
        if self.direction is not None:
            slope = float(self.g @ self.direction)
            if not f <= self.f + 1e-4 * self.step * slope + 1e-14 * abs(self.f):
                self.step *= 0.5
                self.done = self.step < 1e-10
                return
            s, y = self.step * self.direction, g - self.g
            if s @ y > 1e-14 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs[1 - self.memory:], (s, y)]
            self.x = self.x + s
        self.f, self.g = f, g
        if np.abs(self.solve(g)).max(initial=0.0) <= self.tol:
            self.done = True
            return
        q, used = g.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (y @ s)
            q -= a * y
            used.append(a)
        q = self.solve(q)
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ self.solve(y))
        for (s, y), a in zip(self.pairs, reversed(used), strict=True):
            q += s * (a - (y @ q) / (y @ s))
        self.direction, self.step = -q, 1.0


class _Curvature:
    """Second moments of the features, shared by all problems: in full among the ``GRAM_FEATURES`` weightiest features and the
    intercept, the diagonal for the rest.  Taken from a bounded sample of rows, as it only sets the pace."""

    def __init__(self, data: DataFrame, n: int, width: int):
        rows = data.sample(min(1.0, GRAM_ROWS / max(1, n)), seed=42) if n > GRAM_ROWS else data

        def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(width), 0
            for rb in batches:
                for _, x in dense_chunks(rb.column("x"), width):
                    total, seen = total + (x * x).sum(axis=0), seen + len(x)
            yield pa.RecordBatch.from_pydict({"k": pa.array([0], pa.int32()), "part": [np.append(total, seen).tobytes()]})

        schema = "k int, part binary"
        total = _added(rows.mapInArrow(squares, schema))[0]
        self.n, self.diagonal = max(1.0, total[-1]), total[:-1] / max(1.0, total[-1])
        self.full = np.sort(np.argsort(-self.diagonal, kind="stable")[:GRAM_FEATURES])
        full = self.full

        def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = np.zeros((len(full) + 1, len(full) + 1))
            for rb in batches:
                for _, x in dense_chunks(rb.column("x"), width):
                    z = np.hstack([x[:, full], np.ones((len(x), 1))])
                    m += z.T @ z
            parts = np.array_split(m, 8)
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(8), pa.int32()), "part": [p.tobytes() for p in parts]})

        parts = _added(rows.mapInArrow(gram, schema))
        m = np.concatenate([parts[k] for k in sorted(parts)]).reshape(len(full) + 1, -1) / self.n
        self.value, self.vector = np.linalg.eigh(m)
        self.rows = np.append(full, width)
        self.rest = np.setdiff1d(np.arange(width), full)

    def solver(self, shares: np.ndarray, penalty: float) -> Callable[[np.ndarray], np.ndarray]:
        """For a problem whose classes have these shares of its rows: at the start p (1 - p) is the same in all rows."""
        bend = np.maximum(shares * (1 - shares), 1e-6)
        inner = 1.0 / (np.maximum(self.value, 0.0)[:, None] * bend + penalty)
        outer = 1.0 / (self.diagonal[self.rest][:, None] * bend + penalty)

        def solve(q: np.ndarray) -> np.ndarray:
            m = q.reshape(-1, len(bend))
            out = np.empty_like(m)
            out[self.rows] = self.vector @ (inner * (self.vector.T @ m[self.rows]))
            out[self.rest] = outer * m[self.rest]
            return out.ravel()

        return solve


def _added(parts: DataFrame) -> dict[int, np.ndarray]:
    """The arrays that tasks yielded as ``k, part`` (eight-byte floats), added up per ``k`` on the executors."""
    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(f["part"].iloc[0]).copy()
        for p in f["part"].iloc[1:]:
            total += np.frombuffer(p)
        return pd.DataFrame({"k": f["k"].iloc[:1], "part": [total.tobytes()]})

    return {r.k: np.frombuffer(r.part) for r in parts.groupBy("k").applyInPandas(add, "k int, part binary").collect()}


# ------------------------------------------------------------------------------------------- models


@dataclass
class JointModel:
    """Coefficients by problem; ``weight[p]`` is features x classes, ``bias[p]`` one number a class."""

    keys: list[str]
    classes: list[list[str]]
    weight: list[np.ndarray]
    bias: list[np.ndarray]
    steps: int = 0
    losses: list[float] = field(default_factory=list)

    def __contains__(self, key: str) -> bool:
        return key in self.keys

    def __len__(self) -> int:
        return len(self.keys)


def fit_members(rows: DataFrame, keys: Sequence[str], classes: Sequence[Sequence[str]], features: str = "features",
                members: str = "members", weight: str | None = None, c: float = 1.0, tol: float = 2e-6,
                max_steps: int = 200) -> JointModel:
    """Fit every problem from rows that name the problems they belong to.

    ``members`` is ``array<struct<p:int, y:int>>``: number of the problem and of the class within it.  The rows are
    checkpointed once (they are read in every step); each step is one job over them.  A problem
    rests when its coefficients are within about ``tol`` of the optimum (gradient over second derivatives).
    """
    spark = rows.sparkSession
    ship_package(spark)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    data = cut_lineage(rows.filter(F.size(members) > 0).select(
        F.col(features).alias("x"), F.col(members).alias("members"), w.alias("w")))
    if not keys or data.isEmpty():
        return JointModel([], [], [], [])
    width = vector_width(data, "x")
    seen = data.select(F.explode("members").alias("m"), "w").groupBy("m.p", "m.y").agg(
        F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    n, mass = np.zeros(len(keys)), [np.zeros(len(k)) for k in classes]
    for r in seen:
        n[r.p] += r.n
        mass[r.p][r.y] += r.w
    penalty = [1.0 / (c * max(1.0, k)) for k in n]
    curvature = _Curvature(data, int(n.max()), width)
    runs = []
    for p, cl in enumerate(classes):
        total = max(mass[p].sum(), 1e-300)
        prior = np.log(np.maximum(mass[p], 1e-300))
        start = np.zeros((width + 1, len(cl)))
        start[-1] = np.where(mass[p] > 0, prior - prior[mass[p] > 0].mean(), 0.0) if n[p] else 0.0
        runs.append(_Descent(start.ravel(), tol, curvature.solver(mass[p] / total, penalty[p])))
        runs[-1].done = n[p] == 0 or len(cl) < 2
    steps = 0
    while steps < max_steps and not all(r.done for r in runs):
        active = {p: r.trial().reshape(width + 1, -1) for p, r in enumerate(runs) if not r.done}
        for p, sums in _sums(data, active, width).items():
            x = active[p]
            lam, total = penalty[p], mass[p].sum()
            f = sums[0] / total + 0.5 * lam * float((x[:-1] ** 2).sum())
            g = sums[1:].reshape(x.shape) / total
            g[:-1] += lam * x[:-1]
            runs[p].tell(f, g.ravel())
        steps += 1
    fitted = [r.x.reshape(width + 1, -1) for r in runs]
    return JointModel(list(keys), [list(k) for k in classes], [x[:-1] for x in fitted],
                      [x[-1] - x[-1].mean() for x in fitted], steps, [r.f or 0.0 for r in runs])


def vector_width(rows: DataFrame, vec: str) -> int:
    """The length of an ML vector column, as its first row has it (0 without rows)."""
    @F.arrow_udf("int")
    def width(v: pa.Array) -> pa.Array:
        kind, size, _, values = v.flatten()
        return pc.if_else(pc.equal(kind, 0), size, pc.list_value_length(values)).cast(pa.int32())

    row = rows.filter(F.col(vec).isNotNull()).select(width(vec)).first()
    return int(row[0]) if row else 0


def _sums(data: DataFrame, active: dict[int, np.ndarray], width: int) -> dict[int, np.ndarray]:
    """Loss and gradient of the active problems, one array each: one job, summed per problem on the executors."""
    bc = data.sparkSession.sparkContext.broadcast(active)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = bc.value
        loss, grad = dict.fromkeys(at, 0.0), {p: np.zeros_like(x) for p, x in at.items()}
        for rb in batches:
            member, w = rb.column("members"), rb.column("w").to_numpy()
            n = pc.list_value_length(member).to_numpy(zero_copy_only=False)
            p_of, y_of = (part.to_numpy(zero_copy_only=False) for part in member.flatten().flatten())
            row_of = np.repeat(np.arange(len(n)), n)
            for lo, x in dense_chunks(rb.column("x"), width):
                here = (row_of >= lo) & (row_of < lo + len(x))
                row, p_here, y_here = row_of[here] - lo, p_of[here], y_of[here]
                for p in np.unique(p_here):
                    if p not in at:
                        continue
                    mine = p_here == p
                    r, y = row[mine], y_here[mine]
                    xs, ws = x[r], w[lo + r]
                    prob, norm = _softmax(xs @ at[p][:-1] + at[p][-1])
                    score = np.einsum("ij,ij->i", xs, at[p][:-1].T[y]) + at[p][-1][y]
                    loss[p] += float((ws * (norm - score)).sum())
                    prob[np.arange(len(y)), y] -= 1.0
                    prob *= ws[:, None]
                    grad[p][:-1] += xs.T @ prob
                    grad[p][-1] += prob.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"k": pa.array(list(at), pa.int32()),
                                          "part": [np.append(loss[p], grad[p].ravel()).tobytes() for p in at]})

    out = _added(data.mapInArrow(task, "k int, part binary"))
    bc.destroy()
    return out


# ------------------------------------------------------------------------------------------- hierarchies


def path_key(levels: Sequence[str]) -> Column:
    """Slash path of the levels above; '' for the root, NULL below a missing level."""
    cols = [F.col(x).cast("string") for x in levels]
    return F.when(F.array_contains(F.transform(F.array(*cols), lambda v: v.isNull()), True), None).otherwise(
        F.concat_ws("/", *cols)) if cols else F.lit("")


def fit_hierarchy(df: DataFrame, levels: Sequence[str], features: str = "features", min_rows: int = 2,
                  weight: str | None = None, **fit) -> JointModel:
    """A classifier per parent node over its children, all parents of all levels in one joint fit.

    Parents with fewer than two children or ``min_rows`` rows get no model.  The table of (parent, child) pairs comes to
    the driver: it is the label vocabulary."""
    steps = F.filter(F.array(*[F.struct(path_key(levels[:k]).alias("key"), F.col(x).cast("string").alias("child"))
                               for k, x in enumerate(levels)]), lambda s: s["key"].isNotNull() & s["child"].isNotNull())
    rows = cut_lineage(df.select(features, *([weight] if weight else []), steps.alias("__steps")))
    found = rows.select(F.explode("__steps").alias("s")).groupBy("s.key", "s.child").agg(F.count("*").alias("n")).collect()
    children: dict[str, dict[str, int]] = {}
    for r in found:
        children.setdefault(r["key"], {})[r["child"]] = r["n"]
    keys = sorted(k for k, c in children.items() if len(c) >= 2 and sum(c.values()) >= min_rows)
    classes = [sorted(children[k]) for k in keys]
    places = {(k, c): {"p": p, "y": y} for p, k in enumerate(keys) for y, c in enumerate(classes[p])}
    if not places:
        return JointModel([], [], [], [])

    @F.arrow_udf("array<struct<p: int, y: int>>")
    def members(steps: pa.Array) -> pa.Array:
        at = [[places[x["key"], x["child"]] for x in row or [] if (x["key"], x["child"]) in places] for row in steps.to_pylist()]
        return pa.array(at, pa.list_(pa.struct([("p", pa.int32()), ("y", pa.int32())])))

    return fit_members(rows.withColumn("__members", members("__steps")), keys, classes, features, "__members", weight, **fit)


def path_column(model: JointModel, features: str | Column, depth: int) -> Column:
    """C11: the path of each row as ``array<string>``: at every level the best child of the node reached, until a node has
    no model or ``depth`` is reached.  Equal scores go to the smaller class."""
    if not model.keys:
        return F.when((F.col(features) if isinstance(features, str) else features).isNotNull(), F.array().cast("array<string>"))
    number = {k: p for p, k in enumerate(model.keys)}
    classes, weight, bias = model.classes, model.weight, model.bias

    def descend(x: np.ndarray) -> list[list[str]]:
        paths: list[list[str]] = [[] for _ in range(len(x))]
        groups = {"": np.arange(len(x))}
        for _ in range(depth):
            below: dict[str, list[np.ndarray]] = {}
            for key, rows in groups.items():
                p = number.get(key)
                if p is None:
                    continue
                best = np.argmax(x[rows] @ weight[p] + bias[p], axis=1)
                for y in np.unique(best):
                    name, to = classes[p][y], rows[best == y]
                    for i in to:
                        paths[i].append(name)
                    below.setdefault(f"{key}/{name}" if key else name, []).append(to)
            groups = {k: np.concatenate(r) for k, r in below.items()}
        return paths

    @F.arrow_udf("array<string>")
    def path(v: pa.Array) -> pa.Array:
        parts, own = _for_rows(v, len(weight[0]), descend)
        rows = pa.array([p for part in parts for p in part], pa.list_(pa.string()))
        return rows if own is None else rows.take(own)

    return path(features)


# ------------------------------------------------------------------------------------------- several labels


def fit_multilabel(df: DataFrame, labels: str = "labels", vocab: Sequence[str] = (), features: str = "features",
                   weight: str | None = None, **fit) -> JointModel:
    """One yes/no model per label of ``vocab``, all in one joint fit; NULL label lists are left out.

    A label that all rows have, or none, gets a model that says so."""
    vocab = list(vocab)
    members = F.array(*[F.struct(F.lit(p).alias("p"), F.array_contains(labels, v).cast("int").alias("y"))
                        for p, v in enumerate(vocab)])
    rows = df.filter(F.col(labels).isNotNull()).withColumn("__members", members)
    return fit_members(rows, vocab, [["0", "1"]] * len(vocab), features, "__members", weight, **fit)


def label_scores(model: JointModel, features: str | Column) -> Column:
    """P(yes) per problem of a yes/no model, in the order of ``model.keys``."""
    if not model.keys:
        return F.array().cast("array<double>")
    slope = np.stack([w[:, 1] - w[:, 0] for w in model.weight], axis=1)
    shift = np.array([b[1] - b[0] for b in model.bias])

    @F.arrow_udf("array<double>")
    def scores(v: pa.Array) -> pa.Array:
        parts, own = _for_rows(v, len(slope), lambda x: 1.0 / (1.0 + np.exp(-(x @ slope + shift))))
        return _lists(parts, own, len(shift))

    return scores(features)


def labels_above(model: JointModel, features: str | Column, cut: float = 0.5) -> Column:
    """Sorted labels whose own model gives P(yes) > ``cut``."""
    named = F.arrays_zip(F.array(*[F.lit(k) for k in model.keys]).alias("label"),
                         label_scores(model, features).alias("p")) if model.keys else None
    if named is None:
        return F.array().cast("array<string>")
    return F.array_sort(F.transform(F.filter(named, lambda x: x["p"] > cut), lambda x: x["label"]))


@dataclass
class OneModel:
    """One problem of a joint fit as a classifier model (see :mod:`labelkiln.operators.classifier`)."""

    labels: list[str]
    model: JointModel
    features: str

    def probabilities(self, df: DataFrame, out: str = "probs") -> DataFrame:
        return df.withColumn(out, class_probabilities(self.model, "", self.features))


def fit_one(df: DataFrame, label: str = "label", features: str = "features", weight: str | None = None, **fit) -> OneModel:
    """A single multinomial model: the hierarchy that is its root alone.  A table of one class has that class's
    probability at 1."""
    names = [r[0] for r in df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string")).distinct().collect()]
    if len(names) < 2:
        width = vector_width(df, features)
        flat = JointModel([""], [names], [np.zeros((width, len(names)))], [np.zeros(len(names))])
        return OneModel(names, flat, features)
    model = fit_hierarchy(df, [label], features, 1, weight, **fit)
    return OneModel(model.classes[0], model, features)


def class_probabilities(model: JointModel, key: str, features: str | Column) -> Column:
    """Probabilities of the classes of one problem, in the order of its classes."""
    p = model.keys.index(key)
    weight, bias = model.weight[p], model.bias[p]

    @F.arrow_udf("array<double>")
    def probs(v: pa.Array) -> pa.Array:
        parts, own = _for_rows(v, len(weight), lambda x: _softmax(x @ weight + bias)[0])
        return _lists(parts, own, len(bias))

    return probs(features)
