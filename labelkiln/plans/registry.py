"""Registry of named jobs over the driver tables, each with an optional DuckDB twin.

A job is ``fn(spark, sf_dir) -> DataFrame`` reading the given parquet tables (or data Spark derives
from them), so its work grows with the tables.  The SQL twin computes the same result in DuckDB on
the same files and is the correctness oracle; jobs whose result is not expressible in SQL (iterative
fits) register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def deco(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"duplicate job {name}")
        JOBS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers jobs."""
    from labelkiln.plans import (  # noqa: F401
        jobs_balance, jobs_corpus, jobs_labelmodel, jobs_learn, jobs_more, jobs_rules, jobs_vector, jobs_stream,
    )
