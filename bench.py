"""Benchmark: run the headline jobs on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and print ONE JSON line with per-job wall-clock seconds.

Each job is executed fully (``write.format("noop")``) so no result is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelkiln.plans import registry  # noqa: E402
from labelkiln.session import build_session  # noqa: E402

HEADLINE = [
    "union_label", "apply_lfs", "lf_summary", "label_model", "audit",
    "prototypes", "nearest", "prototype_label", "zero_shot", "semantic_search", "uncertainty",
    "stratified_split", "rebalance", "augment_to_target", "eda_synonym", "triplets", "info_nce",
    "binary_metrics", "words", "clean_text", "tfidf", "encode_sequences", "label_model_ovr", "self_train", "cascade",
    "hierarchy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="labelkiln-bench",
                          extra={"spark.driver.memory": "16g"})
    registry.load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in registry.JOBS]
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labelkiln-bench-"))
    registry.JOBS["clean_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not counted
    times = {}
    for name in names:
        t0 = time.time()
        registry.JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
