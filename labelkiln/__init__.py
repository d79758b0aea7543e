"""labelkiln: Spark-native operators for turning mostly unlabelled text tables into training data.

Every operator takes and returns DataFrames, uses an explicit row key (``id`` by default) and runs as
Spark DataFrame / SQL / ``pyspark.ml`` jobs.  See README.md for the module map.
"""

from labelkiln.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
