"""The driver contract: entry() runs, every job has a stable schema, SQL twins agree with DuckDB on
the smallest tables, and the streaming jobs equal their batch twins."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from labelkiln.plans import registry
from labelkiln.sources.corpus import TABLES

registry.load_all()

SF = "/root/testdata/sf0.001"
def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "label", "relevance", "weak_label"]
    assert df.count() >= 0


def test_oracle_sql_needs_no_spark():
    # the SQL twins are plain strings and every key exists in queries()
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(registry.JOBS)))
def test_job_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    so = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted(tuple(_norm(r[i]) for i in so) for r in srows)
    b = sorted(tuple(_norm(r[i]) for i in do) for r in drows)
    assert a == b


def test_jobs_return_what_they_compute(spark):
    assert {"id", "variant_no", "variant"} <= set(registry.JOBS["variant_pairs"](spark, SF).columns)
    assert "vec" in registry.JOBS["embed"](spark, SF).columns
    rows = registry.JOBS["augment_errors"](spark, SF)
    assert {"id", "variant_no", "text", "label"} <= set(rows.columns)


def test_supplied_encoder_and_augmenter(spark):
    from pyspark.sql import functions as F

    from labelkiln.operators import balance, vector

    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (3, "abc", "x"), (4, "d", "y")], "id long, text string, label string")
    got = {r.id: list(r.vec) for r in vector.embed(df, lambda ts: [[len(t), 1.0] for t in ts], batch_size=2).collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0], 3: [3.0, 1.0], 4: [1.0, 1.0]}
    more = balance.augment_to_target(df, target=3, augmenter=lambda d: d.withColumn("text", F.concat(F.lit("new "), "text")))
    assert sorted((r.id, r.variant_no > 0, r.text) for r in more.filter("label = 'y'").collect()) == [
        (4, False, "d"), (4, True, "new d"), (4, True, "new d")]


def test_prototype_sizes_collects_no_lists(spark):
    plan = E.queries()["prototype_sizes"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("name", sorted(set(registry.JOBS) - set(registry.SQL)))
def test_job_without_twin_runs(spark, name):
    df = registry.JOBS[name](spark, SF)
    assert df.count() > 0 and df.columns
