"""Seconds of the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import SparkSession

from laddermill import registry
from laddermill.sources import roles

HEADLINE = (
    "civ_meta", "civ_meta_by_map", "civ_meta_openings", "matchups_1v1", "matchups_1v1_by_elo", "matchups_team", "benchmark_ageup", "benchmark_vils", "benchmark_ecotech", "civ_cube",
    "winner_comps", "winner_refs_ecotech", "winner_refs_meds", "map_meta", "backfill_candidates", "insert_new", "upsert_upgrade", "player_units", "production_series", "float_windows",
    "player_metrics", "bench_slice", "findings", "doc_civ_meta", "doc_civ_cube", "tier_list", "h2h", "dq_sequence", "schema_drift_union", "stream_ingest",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # starts the executors
    began = time.perf_counter()
    roles.keep(spark, sf_dir)  # once for all queries; its time is part of the total
    seconds = {"roles_written_once": round(time.perf_counter() - began, 3)}
    for name in HEADLINE:
        began = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale[1]) if scale else sf_dir}))


if __name__ == "__main__":
    main()
