"""Row-wise labelling on Structured Streaming (§2.14: J7/J8, G1, K2 scoring, L6 gate).

Rules, cleaning and prototype scoring are narrow projections against broadcast parameters, so the
same operators run unchanged on a streaming DataFrame: ``readStream`` -> operator -> ``writeStream``
with a checkpoint location in the cluster's shared checkpoint folder (exactly-once file sink, restart
after executor or driver loss resumes from the last committed batch).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from labelkiln.operators import rules as R
from labelkiln.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream with an explicit schema (no inference on a stream)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_to_table(stream: DataFrame, name: str, out_dir: str | None = None, fmt: str = "parquet",
                 available_now: bool = True) -> tuple[str, StreamingQuery]:
    """Write a stream to files under the shared checkpoint folder (or ``out_dir``) with its own
    checkpoint location; with ``available_now`` it processes what is there and stops."""
    spark = stream.sparkSession
    base = out_dir or os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:8]}")
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", os.path.join(base, "_checkpoint")).option("path", os.path.join(base, "data")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return os.path.join(base, "data"), q


def label_stream_to_table(spark: SparkSession, path: str, schema, lfs: Sequence[R.LF],
                          prepare: Callable[[DataFrame], DataFrame] | None = None, name: str = "union_label",
                          **kw) -> DataFrame:
    """Read a file stream, label it by rules, write it exactly-once, and return the written table."""
    s = read_stream(spark, path, schema)
    if prepare is not None:
        s = prepare(s)
    out, _ = run_to_table(R.union_label(s, lfs, **kw), name)
    return spark.read.parquet(out)


def audited_to_table(stream: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, dict[str, int]]:
    """Write a stream and count on the way: the table, and the metrics (counts) summed over its micro-batches."""
    out, q = run_to_table(stream.observe(name, *metrics), name)
    total: dict[str, int] = {}
    for p in q.recentProgress:
        row = p.observedMetrics.get(name)
        for m, n in (row.asDict() if row is not None else {}).items():
            total[m] = total.get(m, 0) + (n or 0)
    return stream.sparkSession.read.parquet(out), total
