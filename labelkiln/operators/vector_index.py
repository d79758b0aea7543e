"""Cell index for similarity search between two large sides.

The corpus is cut into cells around centres, which k-means (cosine) fits on a bounded sample; every vector goes
to the cell of its nearest centre and is stored there once, in parts of about ``part_rows`` rows, so a cell that holds a
third of all vectors is many parts.  A query is scored against the cells whose centres are nearest to it, and no others.
Cells that follow each other along the main direction of the centres travel in bundles of about ``part_rows`` vectors: a query
goes once to every bundle it has a cell in, with one bit a cell, and not once to every cell.

``exact=True`` visits, after those first cells, exactly those further cells that can still hold a better hit: all vectors of
a cell lie within an angle of its centre that is kept with the cell, so the angle between query and centre less that
radius bounds every hit of the cell.  The result is that of :func:`labelkiln.operators.vector.semantic_search`.

Rows without a vector, or with one of length zero, have no hits and are no hits; equal scores go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelkiln.operators.ranking import hash_order
from labelkiln.session import cut_lineage, ship_package

#: Rows that the centres are fitted on, at most about so many per cell.
SAMPLE_A_CELL = 200
PART_ROWS, QUERY_ROWS = 20_000, 5_000
#: Scores that are computed at a time.
SCORES = 4_000_000
#: Scores are compared across cells with this much room for rounding.
_ROOM = 1e-9


@dataclass
class CellIndex:
    """``vectors``: ``cell, part, id, vec`` (unit vectors), stored; ``centres``: cells x dim, of length 1."""

    vectors: DataFrame
    centres: np.ndarray
    parts: DataFrame      # cell, parts, rows, radius (largest angle to the centre), bundle (of its first part), bit (place in it)
    id_type: T.DataType


def _matrix(v: pa.Array) -> np.ndarray:
    n = len(v)
    return v.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def unit(vec: str | Column) -> Column:
    """The vector in doubles at length 1; NULL if it is NULL, has NULLs or has no direction."""
    v = F.col(vec) if isinstance(vec, str) else vec
    v = v.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.when((norm > 0) & ~F.isnan(norm) & (norm < float("inf")), F.transform(v, lambda x: x / norm))


def cell_of(centres: np.ndarray, vec: str | Column) -> Column:
    """``struct<cell, cosine>`` of the nearest centre (equal: the first)."""
    @F.arrow_udf("struct<cell: int, cosine: double>")
    def nearest(v: pa.Array) -> pa.Array:
        s = _matrix(v) @ centres.T if len(v) else np.zeros((0, len(centres)))
        best = s.argmax(axis=1) if len(v) else np.zeros(0, int)
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(s[np.arange(len(best)), best])],
                                          ["cell", "cosine"])

    return nearest(vec)


def build_index(corpus: DataFrame, cells: int | None = None, id_col: str = "id", vec: str = "vec",
                part_rows: int = PART_ROWS, seed: int = 42) -> CellIndex:
    """Fit the centres on at most about ``SAMPLE_A_CELL * cells`` rows (chosen by a hash of the id) and store every vector
    in its cell.  ``cells``: the square root of the number of rows unless given."""
    ship_package(corpus.sparkSession)
    plain = corpus.select(F.col(id_col).alias("id"), unit(vec).alias("vec")).filter("vec IS NOT NULL")
    plain = cut_lineage(plain)
    n = plain.count()
    cells = max(1, min(n, cells or round(n ** 0.5)))
    share = min(1.0, SAMPLE_A_CELL * cells / max(1, n))
    u = F.conv(F.substring(hash_order("id", seed), 1, 8), 16, 10).cast("double") / float(1 << 32)
    sample = plain.filter(u < share) if share < 1 else plain
    id_type = corpus.schema[id_col].dataType
    if not n:
        empty = plain.select(F.lit(0).alias("cell"), F.lit(0).alias("part"), "id", "vec")
        return CellIndex(empty, np.zeros((0, 1)), empty.select("cell", F.lit(1).alias("parts"), F.lit(0).alias("rows"),
                                                               F.lit(0.0).alias("radius"), F.lit(0).alias("bundle"),
                                                               F.lit(0).alias("bit")), id_type)
    fit = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=10, featuresCol="f").fit(
        sample.select(array_to_vector("vec").alias("f")))
    centres = np.array(fit.clusterCenters())
    length = np.linalg.norm(centres, axis=1, keepdims=True)
    centres = (centres / np.where(length > 0, length, 1))[length[:, 0] > 0]
    # cells near each other get numbers near each other
    along = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0]
    centres = centres[np.argsort(centres @ along, kind="stable")]
    placed = plain.withColumn("at", cell_of(centres, "vec")).select(
        F.col("at.cell").alias("cell"), F.col("at.cosine").alias("cosine"), "id", "vec")
    placed = cut_lineage(placed)
    sizes = placed.groupBy("cell").agg(
        F.count("*").alias("rows"), F.acos(F.greatest(F.lit(-1.0), F.min("cosine") - _ROOM)).alias("radius"))
    rows = _bundles(sizes.orderBy("cell").collect(), part_rows)  # one row a cell, like the centres
    parts = corpus.sparkSession.createDataFrame(pa.table(dict(zip(_PARTS.names, zip(*rows), strict=True)), _PARTS))
    # equal ids of one cell part by their vectors too
    salt = F.pmod(F.xxhash64("id", "vec"), F.col("parts")).cast("int")
    return CellIndex(placed.join(F.broadcast(parts.select("cell", "parts")), "cell").select(
        "cell", salt.alias("part"), "id", "vec"), centres, parts, id_type)


_PARTS = pa.schema([("cell", pa.int32()), ("parts", pa.int32()), ("rows", pa.int64()), ("radius", pa.float64()),
                    ("bundle", pa.int32()), ("bit", pa.int32())])


def _bundles(sizes: list, part_rows: int) -> list[tuple]:
    """``cell, parts, rows, radius, bundle, bit``: cells in their order, so many in a bundle as hold ``part_rows`` rows; a cell
    of several parts has a bundle of its own for each of them."""
    out, bundle, held, bit = [], 0, 0, 0
    for r in sizes:
        n = -(-r.rows // part_rows)
        if held and held + r.rows > part_rows:
            bundle, held, bit = bundle + 1, 0, 0
        out.append((r.cell, n, r.rows, r.radius, bundle, bit))
        if n > 1:
            bundle += n
        else:
            held, bit = held + r.rows, bit + 1
    return out


def _by_bundle(index: CellIndex) -> Callable[[np.ndarray], pa.Array]:
    """From which cells (columns) every query (row) wants to the bundles it goes to, with the wanted cells as bits."""
    rows = index.parts.select("cell", "bundle", "parts").collect()  # one row a cell
    cells: dict[int, list[int]] = {}
    for r in sorted(rows, key=lambda r: r.cell):
        for part in range(r.parts):
            cells.setdefault(r.bundle + part, []).append(r.cell)

    def pack(wanted: np.ndarray) -> pa.Array:
        row, bundle, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], []
        for b, own in cells.items():
            mine = wanted[:, own]
            some = np.flatnonzero(mine.any(axis=1))
            row.append(some)
            bundle.append(np.full(len(some), b, np.int32))
            bits += [m.tobytes() for m in np.packbits(mine[some], axis=1)]
        row = np.concatenate(row)
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(len(wanted) + 1)).astype(np.int32)
        to = pa.StructArray.from_arrays([pa.array(np.concatenate(bundle)), pa.array(bits, pa.binary())], ["bundle", "cells"])
        return pa.ListArray.from_arrays(cuts, to.take(pa.array(order)))

    return pack


_TO = "array<struct<bundle: int, cells: binary>>"
_TO_ARROW = pa.list_(pa.struct([("bundle", pa.int32()), ("cells", pa.binary())]))


def _first(row: np.ndarray, col: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` entries of every row (equal: the smaller column)."""
    order = np.lexsort((col, -score, row))
    row, col, score = row[order], col[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], col[kept], score[kept]


def _probe(index: CellIndex, queries: DataFrame, picked: Column, k: int, query_rows: int) -> DataFrame:
    """``qid, hit, score``: for every query the best ``k`` of its cells in each bundle."""
    wanted = queries.select("qid", "qvec", F.explode(picked).alias("to")).select("qid", "qvec", "to.bundle", "to.cells")
    # the queries of a bundle go in blocks, so a bundle that many queries want is many tasks, too; one row a bundle
    busy = F.broadcast(wanted.groupBy("bundle").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("qid", "qvec"), F.col("blocks")).cast("int")
    wanted = wanted.join(busy, "bundle").withColumn("block", block)
    stored = index.vectors.join(F.broadcast(index.parts.select("cell", "bundle", "bit")), "cell")
    stored = stored.withColumn("bundle", F.col("bundle") + F.col("part")).join(busy, "bundle")
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    fields = [T.StructField("qid", queries.schema["qid"].dataType), T.StructField("hit", index.id_type),
              T.StructField("score", T.DoubleType())]

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"qid": q["qid"][:0], "hit": c["id"][:0], "score": pd.Series(dtype=float)})
        c = c.sort_values("id", kind="stable")  # columns are in id order
        x, y, bit = np.stack(q["qvec"].to_list()), np.stack(c["vec"].to_list()), c["bit"].to_numpy()
        wants = np.unpackbits(np.stack([np.frombuffer(m, np.uint8) for m in q["cells"]]), axis=1)
        found = []
        for b in np.unique(bit):
            rows, cols = np.flatnonzero(wants[:, b]), np.flatnonzero(bit == b)
            most = min(k, len(cols))
            step = max(1, SCORES // len(cols))
            for lo in range(0, len(rows), step):
                some = rows[lo : lo + step]
                s = x[some] @ y[cols].T
                least = np.partition(s, -most, axis=1)[:, -most]
                row, col = np.nonzero(s >= least[:, None])
                found.append(_first(some[row], cols[col], s[row, col], most))
        row, col, score = _first(*(np.concatenate(part) for part in zip(*found, strict=True)), k) if found else (
            np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pd.DataFrame({"qid": q["qid"].to_numpy()[row], "hit": c["id"].to_numpy()[col], "score": score})

    key = ["bundle", "block"]
    return (wanted.select(*key, "qid", "qvec", "cells").groupBy(*key)
            .cogroup(stored.select(*key, "id", "vec", "bit").groupBy(*key)).applyInPandas(best, T.StructType(fields)))


def _nearest_cells(index: CellIndex, vec: str, probes: int) -> Column:
    centres, pack = index.centres, _by_bundle(index)

    @F.arrow_udf(_TO)
    def pick(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], _TO_ARROW)
        wanted = []
        for x in _slices(_matrix(v), len(centres)):
            s = x @ centres.T
            wanted.append(np.zeros(s.shape, bool))
            np.put_along_axis(wanted[-1], np.argsort(-s, axis=1, kind="stable")[:, :probes], True, axis=1)
        return pack(np.concatenate(wanted))

    return pick(vec)


def _cells_in_reach(index: CellIndex, radius: np.ndarray, vec: str, probes: int, worst: str) -> Column:
    """Cells beyond the first ``probes`` that can hold a vector at least as near as ``worst`` (NULL: any)."""
    centres, pack = index.centres, _by_bundle(index)

    @F.arrow_udf(_TO)
    def pick(v: pa.Array, w: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], _TO_ARROW)
        least = w.fill_null(-2.0).to_numpy(zero_copy_only=False)
        wanted, at = [], 0
        for x in _slices(_matrix(v), len(centres)):
            s = x @ centres.T
            reach = np.cos(np.clip(np.arccos(np.clip(s, -1, 1)) - radius, 0, np.pi))
            wanted.append(reach >= least[at : at + len(x), None] - _ROOM)
            np.put_along_axis(wanted[-1], np.argsort(-s, axis=1, kind="stable")[:, :probes], False, axis=1)
            at += len(x)
        return pack(np.concatenate(wanted))

    return pick(vec, worst)


def _slices(x: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Rows of ``x``, so many at a time as have ``SCORES`` scores against ``width`` vectors."""
    step = max(1, SCORES // max(1, width))
    for lo in range(0, len(x), step):
        yield x[lo : lo + step]


def search_index(index: CellIndex, queries: DataFrame, k: int = 5, probes: int = 8, exact: bool = False,
                 id_col: str = "id", vec: str = "vec", query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` most similar vectors of the index per query, as ``(id, rank, hit, score)``."""
    ship_package(queries.sparkSession)
    q = cut_lineage(queries.select(F.col(id_col).alias("qid"), unit(vec).alias("qvec")).filter("qvec IS NOT NULL"))
    by = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("hit"))

    def winners(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)

    if not len(index.centres):
        return q.select(F.col("qid").alias(id_col), F.lit(1).alias("rank"), F.lit(None).cast(index.id_type).alias("hit"),
                        F.lit(0.0).alias("score")).limit(0)
    found = _probe(index, q, _nearest_cells(index, "qvec", probes), k, query_rows)
    if exact:
        found = cut_lineage(winners(found).drop("rank"))
        # fewer than k hits so far: no bound yet
        worst = found.groupBy("qid").agg(F.when(F.count("*") >= k, F.min("score")).alias("worst"))
        radius = np.zeros(len(index.centres))
        for r in index.parts.select("cell", "radius").collect():  # one number a cell, like the centres
            radius[r.cell] = r.radius
        rest = q.join(worst, "qid", "left")
        found = found.unionByName(_probe(
            index, rest, _cells_in_reach(index, radius, "qvec", probes, "worst"), k, query_rows))
    return winners(found).select(F.col("qid").alias(id_col), F.col("rank").cast("int").alias("rank"), "hit", "score")


def _cell_rank(centres: np.ndarray, vec: str, cell: str) -> Column:
    """At which place (1: nearest) a cell comes for a query."""
    @F.arrow_udf("int")
    def rank(v: pa.Array, c: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.int32())
        s = _matrix(v) @ centres.T
        own = np.take_along_axis(s, c.to_numpy(zero_copy_only=False)[:, None].astype(int), 1)
        return pa.array((s >= own).sum(axis=1), pa.int32())

    return rank(vec, cell)


def probes_for(index: CellIndex, queries: DataFrame, k: int = 5, target: float = 0.95, sample: int = 500,
               id_col: str = "id", vec: str = "vec", seed: int = 42) -> int:
    """How many cells a search must visit to find ``target`` of the exact hits, measured on about ``sample`` queries: their
    exact hits are looked up, and the places of the hits' cells tell the recall of every number of probes."""
    q = queries.filter(F.col(vec).isNotNull())
    share = min(1.0, sample / max(1, q.count()))
    u = F.conv(F.substring(hash_order(id_col, seed), 1, 8), 16, 10).cast("double") / float(1 << 32)
    some = cut_lineage(q.filter(u < share) if share < 1 else q)
    hits = search_index(index, some, k, max(1, len(index.centres) // 4), True, id_col, vec)
    placed = (hits.select(id_col, "hit").join(index.vectors.select(F.col("id").alias("hit"), "cell"), "hit")
              .join(some.select(id_col, unit(vec).alias("qvec")), id_col))
    row = placed.withColumn("place", _cell_rank(index.centres, "qvec", "cell")).groupBy("place").count().orderBy("place").collect()
    total, seen = sum(r["count"] for r in row), 0
    for r in row:  # at most one row a cell
        seen += r["count"]
        if seen >= target * total:
            return r.place
    return max(1, len(index.centres))


def recall(found: DataFrame, truth: DataFrame, id_col: str = "id") -> DataFrame:
    """``hits, wanted, recall``: how many of the exact hits the search found."""
    both = truth.join(found.select(id_col, "hit"), [id_col, "hit"], "left_semi").agg(F.count("*").alias("hits"))
    return both.crossJoin(truth.agg(F.count("*").alias("wanted"))).withColumn("recall", F.col("hits") / F.col("wanted"))


def nearest_large(df: DataFrame, protos: DataFrame, vec: str = "vec", id_col: str = "id", label: str = "label",
                  proto_vec: str = "proto", cells: int | None = None, probes: int = 4) -> DataFrame:
    """C5 for a prototype table of any size: best prototype per row by cosine, exact, as ``(id, pred, score)``.  Neither side
    is collected or broadcast."""
    index = build_index(protos, cells, label, proto_vec)
    return search_index(index, df, 1, probes, True, id_col, vec).select(
        id_col, F.col("hit").alias("pred"), "score")
