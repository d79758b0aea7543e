"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkiln.session import checkpoint_dir

#: A word, as every contract of this subpackage counts it.
WORD = r"[^\x20\x09-\x0D]+"
#: Sorts before every id that a table holds; stands for a null id where an order is needed.
LOWEST = -(1 << 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the measure for block and salt counts, which so follow the
    size of the cluster rather than a constant."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (also inside lambdas), without the
    optimizer writing the expression out at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def null_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of the cluster."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and what is read again
    is not computed again when an executor is lost."""
    path = scratch(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def settled(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files behind the table go once it is written; ``discard`` takes it back."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        path = scratch(df.sparkSession, name)
        schema = df.schema
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``settled`` after their last reader is itself written."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(df))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(left: DataFrame, key: list[str], right: DataFrame, spread: str, how: str = "inner") -> DataFrame:
    """``left`` joined with the one row of ``right`` per ``key``, whatever the share of a key in ``left``.

    Rows of ``left`` are spread by a salt from column ``spread``; ``right`` is first brought to the (key, salt) cells
    that occur, of which a key has at most as many as there are salts.
    """
    n = partitions(left.sparkSession)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
    cells = salted.groupBy(*key, "_salt").agg(F.lit(1).alias("_one")).drop("_one").join(right, key)
    return salted.join(cells, [*key, "_salt"], how).drop("_salt")


def upper_splitters(df: DataFrame, key: str, blocks: int) -> list[int]:
    """Up to ``blocks`` distinct ascending values of the non-null long column ``key``; the last one is
    its maximum.  One small aggregate; the driver gets ``blocks`` numbers."""
    blocks = max(1, blocks)
    at = [i / blocks for i in range(1, blocks)]
    row = df.agg(F.max(key), *([F.percentile_approx(key, at, max(10_000, 20 * blocks))] if at else [])).first()
    if row[0] is None:
        return [0]
    return sorted({*(row[1] if at else ()), row[0]})


def block_of(key: Column, splitters: Sequence[int]) -> Column:
    """How many splitters lie below ``key``: two short searches instead of one long one."""
    width = max(1, int(len(splitters) ** 0.5))
    coarse = list(splitters[width - 1 :: width])
    below = lambda values: F.size(F.filter(values, lambda s: s < key))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    skip = below(longs(coarse)) * F.lit(width)
    return let(skip, lambda c: c + below(F.slice(longs(splitters), c + 1, F.lit(width)))).cast("int")


STRIPES = 64


def striped(values: np.ndarray) -> Iterator[pd.DataFrame]:
    """One task's summand for ``summed``: the array in stripes, without stripes that are all zero."""
    for i, part in enumerate(np.array_split(np.asarray(values, np.float64).ravel(), STRIPES)):
        if part.any():
            yield pd.DataFrame({"stripe": [i], "part": [part.astype("<f8").tobytes()]})


STRIPE_SCHEMA = "stripe int, part binary"


def summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Add up the arrays that the tasks of ``parts`` yielded through ``striped``.

    Stripes are first summed per (stripe, salt), so that many tasks share the adding; the driver gets one array of
    the given, fixed shape.
    """
    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(f["part"].iloc[0], "<f8").copy()
        for p in f["part"].iloc[1:]:
            total += np.frombuffer(p, "<f8")
        return pd.DataFrame({"stripe": f["stripe"].iloc[:1], "part": [total.tobytes()]})

    fan = max(1, int(partitions(parts.sparkSession) ** 0.5))
    first = parts.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(fan))).groupBy("stripe", "salt").applyInPandas(
        add, STRIPE_SCHEMA)
    out = np.array_split(np.zeros(int(np.prod(shape))), STRIPES)
    for r in first.groupBy("stripe").applyInPandas(add, STRIPE_SCHEMA).collect():
        out[r[0]] = np.frombuffer(r[1], "<f8")
    return np.concatenate(out).reshape(shape)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> tuple[list[float], list[float]]:
    """Pool adjacent violators; half a case of the base rate is added to each pool, so that a small pool
    does not claim certainty.  Returns the knots of a non-decreasing curve for ``numpy.interp``."""
    w = np.ones(len(x)) if w is None else w
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for v, t, n in zip(x[order], (y * w)[order], w[order], strict=True):
        if pools and pools[-1][3] == v:
            pools[-1][0] += t
            pools[-1][1] += n
        else:
            pools.append([t, n, v, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t2, n2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + t2, pools[-1][1] + n2, pools[-1][2], hi]
    base = float((y * w).sum() / w.sum())
    xs, ys = [], []
    for t, n, lo, hi in pools:
        p = (t + 0.5 * base) / (n + 0.5)
        xs += [lo] if lo == hi else [lo, hi]
        ys += [p] if lo == hi else [p, p]
    return [float(v) for v in xs], [float(v) for v in np.maximum.accumulate(ys)]


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, by its remainder (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
