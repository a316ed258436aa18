"""Times the headline queries and jobs; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from roadledger.operators.inventory import list_files, partition_inventory  # noqa: E402
from roadledger.plans import compaction  # noqa: E402
from roadledger.plans.refresh import RefreshConfig, refresh  # noqa: E402
from roadledger.plans.table_queries import AS_OF, Tables, all_queries  # noqa: E402
from roadledger.session import build_session, shared_folder  # noqa: E402

HEADLINE = (
    "driver_behavior_features", "driver_training_data", "score_weighted", "score_logistic",
    "current_driver_scores", "score_distribution", "telemetry_enriched", "crash_enriched",
    "emergency_response_queue", "high_gforce_events", "recent_high_gforce_events",
    "vehicle_behavior_summary", "top_vehicle_behavior", "crash_patterns", "crash_hotspots",
    "speeding_analysis", "device_health", "recent_crashes", "customer_risk_profile",
    "customer_risk_profile_fanout", "vehicle_safety", "vehicle_safety_fanout", "data_freshness",
    "row_counts", "data_completeness", "performance_probe", "new_data_gate", "dq_orphans",
    "dq_duplicates", "dq_domain", "train_accident_model",
)


def timed(work) -> tuple[float, object]:
    start = time.perf_counter()
    result = work()
    return round(time.perf_counter() - start, 3), result


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}

    def run(name: str) -> None:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    run("driver_behavior_features")  # starts the executors and warms the JVM
    for name in HEADLINE:
        seconds[name], _ = timed(lambda name=name: run(name))

    tables = Tables(spark, folder)
    base = tables.write_files(many=True)
    before = partition_inventory(list_files(spark, base)).agg(F.sum("files"), F.sum("bytes")).first()
    days = [str(r["date"]) for r in tables.telemetry.select("date").distinct().collect()]
    seconds["count_before_compaction"], rows = timed(lambda: spark.read.parquet(base).count())
    seconds["compaction"], result = timed(lambda: compaction.compact(spark, base, days, dry_run=False))
    after = partition_inventory(list_files(spark, base)).agg(F.sum("files"), F.sum("bytes")).first()
    seconds["count_after_compaction"], kept = timed(lambda: spark.read.parquet(base).count())
    assert rows == kept and compaction.succeeded(result)

    home = shared_folder(spark, "bench")
    for name, df in tables.core().items():
        df.write.parquet(f"{home}/core/{name}")
    config = RefreshConfig(telemetry=base, core=f"{home}/core", home=f"{home}/state")
    seconds["refresh"], _ = timed(
        lambda: refresh(spark, config, datetime.fromisoformat(AS_OF)).distribution.collect())
    seconds["refresh_with_retrain"], _ = timed(
        lambda: refresh(spark, config, datetime.fromisoformat(AS_OF), force=True).distribution.collect())

    print(json.dumps({
        "metric": "total seconds of headline queries and jobs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
        "compaction": {
            "files_before": before[0], "files_after": after[0],
            "mb_per_sec": round(before[1] / 1e6 / seconds["compaction"], 3),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
