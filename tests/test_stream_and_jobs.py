from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import to_bronze
from telemetry_lake.plans.jobs import LakeConfig, run_all, run_bronze, run_gold, run_silver
from telemetry_lake.sources.bronze_store import read_bronze
from telemetry_lake.sources.fixtures import read_messages
from telemetry_lake.sources.landing import write_landing
from telemetry_lake.sources.layers import gold_stats, latest_silver_path, list_reports
from telemetry_lake.streaming.incremental import run_stream_to_bronze

NOW = datetime(2024, 2, 1, 0, 0, 1)


@pytest.fixture()
def landing(spark, scratch, sf_dir):
    msgs = read_messages(spark, sf_dir).withColumn("page", F.floor(F.col("timestamp") / 86400000))
    return write_landing(msgs, scratch + "/landing", "page")


def test_stream_equals_batch(spark, scratch, sf_dir, landing):
    run_stream_to_bronze(spark, landing, scratch + "/bronze", scratch + "/ckpt",
                         max_files_per_trigger=4, batch_id="b", fetched_at="f",
                         ingested_at=NOW, timeout_s=300)
    got = read_bronze(spark, scratch + "/bronze")
    want = to_bronze(read_messages(spark, sf_dir), batch_id="b", fetched_at="f", ingested_at=NOW)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_stream_stamps_each_batch(spark, scratch, landing):
    run_stream_to_bronze(spark, landing, scratch + "/bronze", scratch + "/ckpt",
                         max_files_per_trigger=100, timeout_s=300)
    ids = {r.batch_id for r in read_bronze(spark, scratch + "/bronze").select("batch_id").distinct().collect()}
    assert all(i.startswith("stream_") for i in ids)


def test_full_run_and_reports(spark, scratch, landing):
    cfg = LakeConfig(landing_path=landing, bronze_path=scratch + "/bronze",
                     silver_path=scratch + "/silver", gold_path=scratch + "/gold")
    res = run_all(spark, cfg, now=NOW)
    assert res["status"] == "success"
    assert res["stages"]["bronze"]["records_fetched"] == 1000
    assert res["stages"]["silver"]["file_path"].endswith("vehicle_messages_cleaned_20240201_000001")
    assert spark.read.parquet(res["stages"]["gold"]["reports_generated"]["vin_last_state"]).count() == 15
    assert spark.read.parquet(res["stages"]["gold"]["reports_generated"]["velocity_analysis"]).count() == 874
    assert spark.read.parquet(res["stages"]["gold"]["reports_generated"]["sql_injection_report"]).count() == 28
    stats = {r.report: r.files for r in gold_stats(list_reports(spark, cfg.gold_path)).collect()}
    assert set(stats) == {"vin_last_state", "velocity_analysis", "sql_violating_messages_report"}
    # second silver run; gold picks the latest by name
    later = datetime(2024, 2, 2)
    assert run_silver(spark, cfg, now=later)["status"] == "success"
    assert latest_silver_path(spark, cfg.silver_path).endswith("20240202_000000")
    assert run_gold(spark, cfg, now=later)["status"] == "success"


def test_failure_contract(spark, scratch):
    import os

    os.makedirs(scratch + "/empty")
    cfg = LakeConfig(landing_path=scratch + "/empty", bronze_path=scratch + "/bronze",
                     silver_path=scratch + "/silver", gold_path=scratch + "/gold")
    assert run_bronze(spark, cfg)["status"] == "failed"
    assert run_silver(spark, cfg)["status"] == "failed"
    out = run_gold(spark, cfg)
    assert out["status"] == "failed" and "no finished silver run" in out["error"]
    with pytest.raises(RuntimeError, match="full run stopped"):
        run_all(spark, cfg)


def test_empty_bronze_refused(spark, scratch):
    from conftest import bronze_rows
    from telemetry_lake.sources.bronze_store import write_bronze

    write_bronze(bronze_rows(spark, [{"vin": "A"}]).limit(0), scratch + "/bronze")
    cfg = LakeConfig(landing_path="", bronze_path=scratch + "/bronze",
                     silver_path=scratch + "/silver", gold_path=scratch + "/gold")
    out = run_silver(spark, cfg)
    assert out["status"] == "failed" and "bronze holds no message" in out["error"]


def test_pattern_failure_only_warns(spark, scratch, landing):
    cfg = LakeConfig(landing_path=landing, bronze_path=scratch + "/bronze",
                     silver_path=scratch + "/silver", gold_path=scratch + "/gold", patterns=[])
    res = run_all(spark, cfg, now=NOW)
    assert res["stages"]["gold"]["reports_generated"]["sql_injection_report"] is None


def test_stream_restart_takes_only_new_files(spark, scratch):
    import json
    import os

    def land(name, vins):
        os.makedirs(f"{scratch}/land", exist_ok=True)
        with open(f"{scratch}/land/{name}.json", "w") as fh:
            fh.write(json.dumps([{"vin": v, "timestamp": 3_600_000 * i} for i, v in enumerate(vins)]))

    args = (spark, scratch + "/land", scratch + "/bronze", scratch + "/ckpt")
    kw = dict(batch_id="b", fetched_at="f", ingested_at=NOW, timeout_s=300)
    land("a", ["A1", "A2"])
    run_stream_to_bronze(*args, **kw)
    land("b", ["B1"])
    run_stream_to_bronze(*args, **kw)  # restarted from the checkpoint
    run_stream_to_bronze(*args, **kw)  # nothing new: no duplicates
    vins = sorted(r.vin for r in read_bronze(spark, scratch + "/bronze").collect())
    assert vins == ["A1", "A2", "B1"]


def test_stream_with_processing_time_trigger(spark, scratch, landing):
    from telemetry_lake.streaming.incremental import stream_to_bronze

    q = stream_to_bronze(spark, landing, scratch + "/bronze", scratch + "/ckpt",
                         batch_id="b", fetched_at="f", ingested_at=NOW, trigger_interval="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert read_bronze(spark, scratch + "/bronze").count() == 1000


def test_command_line_stages_and_stats(spark, scratch, landing, capsys):
    import json

    from telemetry_lake.__main__ import main

    args = ["--landing", landing, "--bronze", scratch + "/bronze", "--silver", scratch + "/silver",
            "--gold", scratch + "/gold"]
    assert main(args + ["--stage", "bronze", "--batch-id", "cli"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out)["records_fetched"] == 1000
    assert main(args + ["--stage", "silver"], spark=spark) == 0
    capsys.readouterr()
    assert main(args + ["--stage", "gold"], spark=spark) == 0
    capsys.readouterr()
    assert main(args + ["--stats"], spark=spark) == 0
    stats = json.loads(capsys.readouterr().out)
    assert stats["bronze"]["total_records"] == 1000 and stats["bronze"]["total_files"] >= 1
    assert stats["silver"]["total_records"] == 923
    assert stats["gold"]["total_reports"] == 3
    assert set(stats["gold"]["report_types"]) == {"vin_last_state", "velocity_analysis",
                                                  "sql_violating_messages_report"}
    # a failing stage: exit status 1, stage contract in the JSON
    assert main(["--root", scratch + "/nothing", "--stage", "silver"], spark=spark) == 1
    assert json.loads(capsys.readouterr().out)["status"] == "failed"


def test_bronze_stage_fetches_pages(spark, scratch):
    import json
    import os

    for page, n in enumerate([2, 2, 1]):
        os.makedirs(f"{scratch}/api/page={page}")
        with open(f"{scratch}/api/page={page}/body.json", "w") as fh:
            fh.write(json.dumps([{"vin": f"P{page}{i}", "timestamp": 1000 * i} for i in range(n)]))
    cfg = LakeConfig(landing_path=scratch + "/landing", bronze_path=scratch + "/bronze",
                     silver_path=scratch + "/silver", gold_path=scratch + "/gold",
                     api_url_template=f"file://{scratch}/api/page={{page}}", fetch_amount=6, page_size=2)
    out = run_bronze(spark, cfg, now=NOW)
    assert out["status"] == "success" and out["records_fetched"] == 5
    rows = read_bronze(spark, cfg.bronze_path).collect()
    assert sorted(r.vin for r in rows) == ["P00", "P01", "P10", "P11", "P20"]
    assert {r.fetch_timestamp for r in rows} == {NOW.isoformat()}


def _land(scratch, name, hours, per_hour=1):
    import json
    import os

    os.makedirs(f"{scratch}/land", exist_ok=True)
    with open(f"{scratch}/land/{name}.json", "w") as fh:
        fh.write(json.dumps([{"vin": f"{name}{h}-{i}", "timestamp": 3_600_000 * h + i}
                             for h in hours for i in range(per_hour)]))


def test_stream_and_batch_share_one_bronze(spark, scratch):
    from conftest import bronze_rows
    from telemetry_lake.sources.bronze_store import write_bronze

    args = (spark, scratch + "/land", scratch + "/bronze", scratch + "/ckpt")
    _land(scratch, "a", range(2))
    run_stream_to_bronze(*args, timeout_s=300)
    write_bronze(bronze_rows(spark, [{"vin": "batch", "timestamp": 1}]), scratch + "/bronze", mode="append")
    assert read_bronze(spark, scratch + "/bronze").count() == 3
    write_bronze(bronze_rows(spark, [{"vin": "batch", "timestamp": 1}]), scratch + "/bronze")
    _land(scratch, "b", range(1))
    run_stream_to_bronze(*args, timeout_s=300)
    assert sorted(r.vin for r in read_bronze(spark, scratch + "/bronze").collect()) == ["b0-0", "batch"]


def test_replayed_micro_batch_adds_nothing(spark, scratch):
    from conftest import bronze_rows
    from telemetry_lake.streaming.incremental import write_micro_batch

    rows = bronze_rows(spark, [{"vin": "A", "timestamp": 1}, {"vin": "B", "timestamp": None}])
    for number in (0, 10, 1, 1):
        write_micro_batch(rows, scratch + "/bronze", scratch + "/ckpt", number)
    assert read_bronze(spark, scratch + "/bronze").count() == 6


def test_stream_splits_a_busy_hour(spark, scratch):
    from telemetry_lake.sources.bronze_store import bronze_files

    _land(scratch, "a", [5], per_hour=20_000)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "16k")
    try:
        run_stream_to_bronze(spark, scratch + "/land", scratch + "/bronze", scratch + "/ckpt", timeout_s=300)
    finally:
        spark.conf.set(size, before)
    files = bronze_files(read_bronze(spark, scratch + "/bronze")).collect()
    assert sum(f.row_count for f in files) == 20_000 and len(files) >= 1


def test_append_of_the_landing_zone_is_refused(spark, scratch, landing):
    cfg = LakeConfig(landing_path=landing, bronze_path=scratch + "/bronze", silver_path=scratch + "/silver",
                     gold_path=scratch + "/gold", bronze_mode="append")
    out = run_bronze(spark, cfg)
    assert out["status"] == "failed" and "stream" in out["error"]


def test_report_in_three_parts_counts_once(spark, scratch):
    spark.range(30).repartition(3).write.parquet(scratch + "/gold/vin_last_state")
    row = gold_stats(list_reports(spark, scratch + "/gold")).first()
    assert (row.reports, row.files) == (1, 3)
