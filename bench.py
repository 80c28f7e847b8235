"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected), twice: the first (cold) run includes compiling the
plan's generated code, the second is the warm session time reported in
``queries`` / ``value`` (cold times are reported in ``cold``). The
end-to-end pipeline writes every layer and artifact once; the
``silver_from_landed_bronze_*`` entries build silver from bronze stored as
Parquet (landed once, untimed), as production runs it. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeflow.plans.catalog import AS_OF_BRONZE, AS_OF_SERIES, QUERIES  # noqa: E402
from gaugeflow.session import build_session  # noqa: E402

HEADLINE = (
    "dedupe_keep_latest_window",
    "dedupe_keep_latest_agg",
    "silver_readings",
    "gold_series_30d",
    "gold_station_latest",
    "asof_24h",
    "lineage_flat",
    "trace_one",
    "forecast_points",
    "dq_results",
    "run_metadata",
    "newest_n_per_station",
)


def landed_inputs(spark, sf_dir: str, files: int) -> str:
    """The tables that the queries read, landed in several files as a lake holds
    them (not timed); one file of this size would be one task whatever the query."""
    out = tempfile.mkdtemp(prefix="gaugeflow-bench-in-")
    for name, n in (("events", files), ("supplier", 1)):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(n).write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, given = landed_inputs(spark, sf_dir, int(cpus)), sf_dir
    # Warm-up: JVM, codegen caches, file listing.
    QUERIES["silver_flag_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        for store in (cold, times):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[name] = round(time.perf_counter() - t0, 3)
    from gaugeflow.plans.pipeline import run_pipeline  # noqa: E402
    from gaugeflow.operators.silver import build_silver  # noqa: E402
    from gaugeflow.sources import derived  # noqa: E402

    # Production shape: bronze is a stored layer. Land it once (not timed),
    # then time the silver build (dedupe + typing + flags) from the files.
    landed = tempfile.mkdtemp(prefix="gaugeflow-bench-bronze-") + "/bronze"
    derived.bronze(spark, sf_dir).write.parquet(landed)
    for method in ("window", "agg"):
        for store in (cold, times):
            t0 = time.perf_counter()
            build_silver(spark.read.parquet(landed), method=method, with_build_stamp=False).write.format("noop").mode(
                "overwrite"
            ).save()
            store[f"silver_from_landed_bronze_{method}"] = round(time.perf_counter() - t0, 3)

    for store in (cold, times):
        out = tempfile.mkdtemp(prefix="gaugeflow-bench-")
        t0 = time.perf_counter()
        run_pipeline(spark, sf_dir, out, AS_OF_SERIES, AS_OF_BRONZE)
        store["pipeline_end_to_end"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(given.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cold": cold, "cold_total": round(sum(cold.values()), 3),
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
