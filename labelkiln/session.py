"""Session settings and lineage cutting.

Settings aim at a large cluster: adaptive execution (partition coalescing, skew-join splitting,
runtime broadcast conversion), Arrow batches for the few Python steps, UTC timestamps.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "labelkiln", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  Where it is unset, a local session gets a scratch folder;
    on any other master that is an error, as executors would not see a folder of the driver.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="labelkiln-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``labelkiln`` importable in Python workers (``mapInPandas`` / Pandas UDF steps) by
    shipping it once per application with ``addPyFile``, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    import labelkiln
    pkg = os.path.dirname(os.path.abspath(labelkiln.__file__))
    out = tempfile.mkdtemp(prefix="labelkiln-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "labelkiln"), "zip", root_dir=os.path.dirname(pkg),
                                  base_dir="labelkiln")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
