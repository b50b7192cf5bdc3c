"""Hot-key check: do the operators stay balanced when one key holds a third of the rows?

Usage: python scripts/skew_check.py [sf_dir] [copies]

Derives skewed events from the given table (replicated ``copies`` times):
rows with event_id % 3 = 0 all belong to one vehicle, rows with
event_id % 3 = 1 all carry one instant (so one hour, and one sort key).  Then
runs the last-state report, the top-speed report, the silver sort and the
bronze write with Spark's event log in a fresh scratch folder, and prints per
stage: tasks, max and median records read / written per task, max and median
task time.  A balanced stage has max close to median.  The advisory
partition size is scaled down with the data so that AQE treats the hot hour
as large, as it would at full scale.
"""

from __future__ import annotations

import glob
import io
import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from telemetry_lake.operators import fastest_per_hour, to_bronze, to_silver, vin_last_state  # noqa: E402
from telemetry_lake.operators.stats import manufacturer_summary  # noqa: E402
from telemetry_lake.session import lake_session  # noqa: E402
from telemetry_lake.sources.bronze_store import write_bronze  # noqa: E402
from telemetry_lake.sources.fixtures import messages_from_events, read_table, replicate_events  # noqa: E402


def _events(path: str) -> list[dict]:
    import zstandard

    out = []
    for f in sorted(glob.glob(path + "/**/events_*", recursive=True)):
        raw = open(f, "rb")
        text = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                if f.endswith(".zstd") else io.TextIOWrapper(raw, encoding="utf-8"))
        out.extend(json.loads(line) for line in text)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    scratch = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    Path(f"{scratch}/events").mkdir()
    # The advisory partition size is scaled down with the data (64 MB is the
    # default for terabytes): a hot hour of ~60 MB must count as "large" here,
    # as a hot hour of terabytes does on a cluster.
    spark = lake_session(shuffle_partitions=32, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events",
        "spark.eventLog.compress": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m"})

    ev = replicate_events(read_table(spark, sf_dir, "events"), copies)
    hot = F.col("event_id") % 3
    skewed = ev.select(
        "event_id",
        F.when(hot == 1, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"),
        F.when(hot == 0, F.lit(7).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value", "props",
    )
    skewed.repartition(32).write.parquet(f"{scratch}/events.parquet")
    bronze = to_bronze(messages_from_events(spark.read.parquet(f"{scratch}/events.parquet")),
                       batch_id="b", fetched_at="f", ingested_at="i")
    silver = to_silver(bronze, "s", sort=False)

    runs = {
        "vin_last_state": lambda: vin_last_state(silver, "g").write.format("noop").mode("overwrite").save(),
        "fastest_per_hour": lambda: fastest_per_hour(silver, "g").write.format("noop").mode("overwrite").save(),
        "manufacturer_summary": lambda: manufacturer_summary(silver).write.format("noop").mode("overwrite").save(),
        "silver_sort": lambda: to_silver(bronze, "s").write.format("noop").mode("overwrite").save(),
        "bronze_write": lambda: write_bronze(bronze, f"{scratch}/bronze"),
    }
    for name, run in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        run()
        print(f"{name:24s} {time.time() - t0:6.2f}s", flush=True)
    spark.stop()

    group_of_job, stage_group = {}, {}
    tasks = defaultdict(list)
    for e in _events(f"{scratch}/events"):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = g
        elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            rd = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            rows_in = rd or m.get("Input Metrics", {}).get("Records Read", 0)
            out = m.get("Output Metrics", {}).get("Records Written", 0) or \
                m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
            tasks[e["Stage ID"]].append((rows_in, out, m.get("Executor Run Time", 0), bool(rd)))
    print(f"\n{'run':24s} {'stage':>5s} {'tasks':>5s} {'in max':>9s} {'in med':>9s} "
          f"{'out max':>9s} {'out med':>9s} {'ms max':>7s} {'ms med':>7s}")
    for stage in sorted(tasks):
        name = stage_group.get(stage)
        rows = tasks[stage]
        if name not in runs or len(rows) < 2:
            continue
        ins = [r[0] for r in rows]
        outs = [r[1] for r in rows]
        ms = [r[2] for r in rows]
        kind = "shuffle" if any(r[3] for r in rows) else "scan"
        print(f"{name:24s} {stage:5d} {len(rows):5d} {max(ins):9d} {int(statistics.median(ins)):9d} "
              f"{max(outs):9d} {int(statistics.median(outs)):9d} {max(ms):7d} {int(statistics.median(ms)):7d}  {kind}")


if __name__ == "__main__":
    main()
