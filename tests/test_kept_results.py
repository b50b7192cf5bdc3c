"""Bucketed silver, footers, statistics and states kept per run."""

import pytest
from pyspark.sql import functions as F

from conftest import bronze_rows
from telemetry_lake.operators import fastest_per_hour, last_component_state, latest_message_per_vin, to_silver, vin_last_state
from telemetry_lake.operators.run_stats import append_stats, merged_stats, partial_stats
from telemetry_lake.operators.stats import bronze_stats
from telemetry_lake.operators.vehicle_state import merge_states, read_state, state_report, update_state, vehicle_state
from telemetry_lake.sources.bronze_store import read_bronze, write_bronze
from telemetry_lake.sources.buckets import bucket_sizes, open_bucketed_silver, read_bucketed_silver, write_bucketed_silver
from telemetry_lake.sources.footers import footer_partitions, footer_stats
from telemetry_lake.sources.landing import read_landing

HOUR = 3600 * 1000


def _rows(n=300):
    """A third of the rows are of one vehicle; ties, late rows and rows without time or states."""
    return [
        {"vin": "HOT" if i % 3 == 0 else f"V{i % 23}", "manufacturer": f"M{i % 5}", "velocity": float(i % 50) if i % 7 else None,
         "timestamp": None if i % 41 == 0 else (i * 7919 % 100) * HOUR // 8, "latitude": 1.0, "longitude": 2.0,
         "frontLeftDoorState": [None, "LOCKED", "UNLOCKED"][i % 4 % 3], "wipersState": [None, "ON"][i % 2]}
        for i in range(n)
    ]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_bucketed_silver_needs_no_shuffle_by_vehicle(spark, scratch):
    silver = to_silver(bronze_rows(spark, _rows()), "s", sort=False)
    path = write_bucketed_silver(silver, scratch, "20240101_000000", "by_vin_test", 8)
    stored = read_bucketed_silver(spark, path, "by_vin_test")
    report = vin_last_state(stored, "g")
    assert "Bucketed: true" in _plan(report) and "hashpartitioning" not in _plan(report)
    assert _sorted(report) == _sorted(vin_last_state(silver, "g"))
    joined = latest_message_per_vin(stored).hint("merge").join(
        last_component_state(stored, "wipers_state", "w"), "vin", "left")
    assert "hashpartitioning" not in _plan(joined)
    assert bucket_sizes(spark, path).agg(F.sum("files")).first()[0] >= bucket_sizes(spark, path).count() > 1
    # another session registers the folder under a name of its own
    open_bucketed_silver(spark, path, "by_vin_again")
    again = read_bucketed_silver(spark, path, "by_vin_again")
    assert "hashpartitioning" not in _plan(vin_last_state(again, "g")) and _sorted(again) == _sorted(silver)
    # a bucket too large for one task: the plain files, aggregated in every task first
    plain = read_bucketed_silver(spark, path, "by_vin_test", skew=0.5, small=0)
    assert "Bucketed: true" not in _plan(vin_last_state(plain, "g")) and _sorted(plain) == _sorted(silver)


def test_empty_bucketed_run(spark, scratch):
    silver = to_silver(bronze_rows(spark, []), "s", sort=False)
    path = write_bucketed_silver(silver, scratch, "20240101_000000", "by_vin_empty", 4)
    assert vin_last_state(read_bucketed_silver(spark, path, "by_vin_empty"), "g").count() == 0


def test_figures_from_footers_equal_a_scan(spark, scratch):
    path = write_bronze(bronze_rows(spark, _rows()), f"{scratch}/bronze")
    write_bronze(bronze_rows(spark, _rows(40)), path, mode="append")
    stats = footer_stats(spark, path)
    assert "min(timestamp)" in _plan(stats).split("BatchScan")[1] and "count(*)" in _plan(stats).split("BatchScan")[1]
    scan = bronze_stats(read_bronze(spark, path)).first()
    assert stats.first() == (scan.total_records, scan.earliest_message, scan.latest_message)
    want = read_bronze(spark, path).groupBy("partition_date", "partition_hour").agg(
        F.count(F.lit(1)).alias("message_count"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms"))
    assert _sorted(footer_partitions(spark, path)) == _sorted(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    only_timeless = write_bronze(bronze_rows(spark, [{"vin": "A"}, {"vin": "B"}]), f"{scratch}/timeless")
    assert footer_stats(spark, only_timeless).first() == (2, None, None)


def test_statistics_of_batches_merge(spark, scratch):
    parts = [bronze_rows(spark, part) for part in (_rows()[:100], _rows()[100:], [])]
    for number, part in enumerate(parts):
        append_stats(part, scratch, f"b{number}")
    append_stats(parts[0], scratch, "b0")  # a batch that is run again
    got = merged_stats(spark.read.parquet(scratch)).first()
    whole = bronze_rows(spark, _rows())
    exact = bronze_stats(whole).first()
    assert (got.total_records, got.unique_vehicles, got.earliest_message, got.latest_message) == tuple(exact)
    assert got == merged_stats(partial_stats(whole)).first()
    many = partial_stats(spark.range(200_000).select(
        F.concat(F.lit("v"), F.col("id")).alias("vin"), F.lit("m").alias("manufacturer"), F.lit(1.0).alias("velocity"),
        F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"), F.lit(None).cast("timestamp").alias("message_datetime")))
    assert abs(merged_stats(many).first().unique_vehicles - 200_000) < 200_000 * 0.03
    none = merged_stats(partial_stats(whole).limit(0)).first()
    assert (none.total_records, none.unique_vehicles, none.avg_velocity) == (0, 0, None)


def test_states_merge_in_any_order_and_again(spark, scratch):
    silver = to_silver(bronze_rows(spark, _rows()), "s", sort=False)
    want = vin_last_state(silver, "g").collect()
    parts = [silver.where(F.pmod(F.xxhash64("timestamp", "vin"), F.lit(3)) == k) for k in (2, 0, 1)]
    for part in [*parts, parts[1]]:
        update_state(spark, scratch, part, "20240101_000000")
        assert state_report(read_state(spark, scratch), "g").count() > 0
    assert state_report(read_state(spark, scratch), "g").collect() == want
    late_first = merge_states(*[vehicle_state(p) for p in reversed(parts)])
    assert state_report(late_first, "g").collect() == want
    update_state(spark, scratch, silver.limit(0), "20240102_000000")
    assert state_report(read_state(spark, scratch), "g").collect() == want
    broken = silver.withColumn("vin", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        update_state(spark, scratch, broken, "20240103_000000")
    assert state_report(read_state(spark, scratch), "g").collect() == want
    assert read_state(spark, f"{scratch}/none").count() == 0


def test_many_speeds_are_limited_before_the_only_exchange(spark):
    silver = to_silver(bronze_rows(spark, _rows()), "s", sort=False)
    plan = _plan(fastest_per_hour(silver, "g", k=2000))
    assert plan.count("hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2
    below = plan.split("hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "2000, Partial" in below


def test_empty_landing_files_are_found_by_number(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"page={n}").mkdir()
        (tmp_path / f"page={n}" / "a b.json").write_text('[{"vin": "V%d"}]' % n)
    assert read_landing(spark, str(tmp_path)).count() == 5
    (tmp_path / "page=3" / "empty one.json").write_text("")
    with pytest.raises(ValueError, match="page=3/empty one.json"):
        read_landing(spark, str(tmp_path))
