"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

HEADLINE = (
    "pointers_latest", "pointers_per_channel", "latest_routes", "choose_release", "defect_totals", "coherence_rollup",
    "shared_handshakes", "ja4_strings", "h2_fingerprint", "select_halves", "sampling_summary", "field_stability",
    "assemble_profile", "movements_by_route", "field_diff", "header_position_diff", "conformance_counts", "conformance_by_field",
    "property_routes", "tree_diff", "corpus_digest", "directory_sizes", "anchor_lists", "decode_hello", "decode_h2_frames",
    "rebuild_audit", "stream_select_halves",
)


def session(name: str) -> SparkSession:
    root = os.path.dirname(os.path.abspath(__file__))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (root, os.environ.get("PYTHONPATH"))))  # for Python workers
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from calipers.plans import fixtures
    from calipers.plans.bindings import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench")
    QUERIES["pointers_latest"](spark, "/root/testdata/sf0.001").collect()  # start executors and code generation
    clock = time.perf_counter
    start, derived = clock(), {}
    for name, make in {s: lambda s=s: fixtures.profiles(spark, sf_dir, s) for s in ("current", "before", "after")}.items():
        make()
        derived[f"profiles {name}"] = round(clock() - start, 3)
        start = clock()
    fixtures.captures(spark, sf_dir)
    derived["captures"] = round(clock() - start, 3)
    times, planned, rows = {}, {}, {}
    for name in HEADLINE:
        start = clock()
        df = QUERIES[name](spark, sf_dir)
        df._jdf.queryExecution().executedPlan()
        planned[name] = round(clock() - start, 3)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        times[name] = round(clock() - start, 3)
        rows[name] = seen.get["n"]
    total = round(sum(times.values()), 3)
    out = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}
    print(json.dumps(out | {"planning": planned, "rows": rows, "derivation": derived}))
    spark.stop()


if __name__ == "__main__":
    main()
