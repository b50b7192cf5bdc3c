from pyspark.sql import functions as F

from telemetry_lake.functions import gear_number, is_blank, zs_trim
from telemetry_lake.functions.time import (
    local_wall_clock, ntz_millis, partition_date, partition_hour, report_date, report_hour,
)


def test_zs_trim_strips_space_separators_not_tabs(spark):
    df = spark.createDataFrame([("  Ford　",), ("\tFord",), (" Ford ",), (None,)], "m string")
    got = [r[0] for r in df.select(zs_trim("m")).collect()]
    assert got == ["Ford", "\tFord", "Ford", None]


def test_blank_vin(spark):
    vals = ["", " ", " ", None, "\t", " A ", "A"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(is_blank("v")).collect()]
    assert got == [True, True, True, True, False, False, False]


def test_gear_map_exact(spark):
    vals = ["NEUTRAL", "REVERSE", "neutral", " NEUTRAL", "3", None]
    df = spark.createDataFrame([(v,) for v in vals], "g string")
    rows = df.select(gear_number("g").alias("n")).collect()
    assert [r.n for r in rows] == [0, -1, None, None, None, None]
    assert df.select(gear_number("g")).schema.fields[0].dataType.simpleString() == "int"


def _instant(spark, ms):
    return spark.createDataFrame([(ms,)], "ms long").select(F.timestamp_millis("ms").alias("t"))


def test_report_zone_shifts_date_and_hour(spark):
    # 2024-08-14 23:30 UTC is 02:30 on the 15th in Jerusalem (summer time).
    ms = 1723678200000  # 2024-08-14 23:30:00 UTC
    df = _instant(spark, ms)
    r = df.select(report_date("t").alias("d"), report_hour("t").alias("h"),
                  report_date("t", "Asia/Jerusalem").alias("dj"),
                  report_hour("t", "Asia/Jerusalem").alias("hj")).first()
    assert str(r.d) == "2024-08-14" and r.h == 23
    assert str(r.dj) == "2024-08-15" and r.hj == 2


def test_keys_do_not_depend_on_session_zone(spark):
    ms = 1710037800500  # 2024-03-10 02:30:00.5 UTC: inside New York's DST gap
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = _instant(spark, ms).select(
            partition_date("t").alias("d"), partition_hour("t").alias("h"),
            ntz_millis(local_wall_clock("t")).alias("back")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (str(r.d), r.h, r.back) == ("2024-03-10", "02", ms)


def test_hour_is_zero_padded(spark):
    r = _instant(spark, 9 * 3600 * 1000).select(partition_hour("t").alias("h")).first()
    assert r.h == "09"


def test_operators_independent_of_session_zone(spark, sf_dir):
    from telemetry_lake.operators import fastest_per_hour, to_bronze, to_silver, vin_last_state
    from telemetry_lake.sources.fixtures import read_messages

    def run():
        b = to_bronze(read_messages(spark, sf_dir), batch_id="b", fetched_at="f", ingested_at="i")
        s = to_silver(b, "s", sort=False)
        keys = sorted((str(r[0]), r[1], r[2]) for r in b.select(
            "partition_date", "partition_hour", "timestamp").collect())
        fast = sorted([(str(r.date_part), r.hour_part, r.velocity) for r in fastest_per_hour(
            s, "g", report_tz="Asia/Jerusalem").collect()], key=repr)
        last = sorted((r.vin, r.last_reported_timestamp, r.last_front_left_door_state)
                      for r in vin_last_state(s, "g").collect())
        return keys, fast, last

    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == run()
