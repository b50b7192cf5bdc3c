import pytest
from pyspark.sql import functions as F

from conftest import bronze_rows, raw_rows
from telemetry_lake.operators import to_bronze
from telemetry_lake.schemas import BRONZE
from telemetry_lake.sources.bronze_store import bronze_files, read_bronze, write_bronze

H9 = 9 * 3600 * 1000  # 1970-01-01 09:00 UTC


def test_schema_and_stamps(spark):
    df = bronze_rows(spark, [{"vin": "A", "timestamp": H9, "gearPosition": "NEUTRAL"}])
    assert df.schema == BRONZE or [f.name for f in df.schema] == BRONZE.fieldNames()
    r = df.first()
    assert r.gear_position == "NEUTRAL"
    assert r.batch_id == "b" and r.fetch_timestamp == "2024-01-01T00:00:00"
    assert r.ingestion_timestamp == "2024-01-01T00:00:01"
    assert (str(r.partition_date), r.partition_hour) == ("1970-01-01", "09")


def test_default_batch_id_and_missing_extra_fields(spark):
    from datetime import datetime

    raw = spark.createDataFrame([("A", 1, "x")], "vin string, timestamp long, foo string")
    df = to_bronze(raw, ingested_at=datetime(2024, 5, 6, 7, 8, 9))
    r = df.first()
    assert r.batch_id == "batch_20240506_070809"
    assert r.gear_position is None and "foo" not in df.columns
    assert r.ingestion_timestamp == "2024-05-06T07:08:09"
    assert to_bronze(raw, batch_id="", ingested_at=datetime(2024, 5, 6)).first().batch_id == "batch_20240506_000000"


def test_null_timestamp_gives_null_keys(spark):
    r = bronze_rows(spark, [{"vin": "A", "timestamp": None}]).first()
    assert r.message_datetime is None and r.partition_date is None and r.partition_hour is None


def test_round_trip_keeps_hour_text_and_null_keys(spark, scratch):
    df = bronze_rows(spark, [{"vin": "A", "timestamp": H9}, {"vin": "B", "timestamp": None}])
    path = write_bronze(df, scratch + "/bronze")
    import os

    dirs = sorted(os.listdir(path + "/partition_date=1970-01-01"))
    assert dirs == ["partition_hour=09"]
    assert "partition_date=__HIVE_DEFAULT_PARTITION__" in os.listdir(path)
    back = read_bronze(spark, path)
    got = sorted((r.vin, r.partition_hour, str(r.partition_date)) for r in back.collect())
    assert got == [("A", "09", "1970-01-01"), ("B", None, "None")]
    assert dict(back.dtypes)["partition_hour"] == "string"
    assert dict(back.dtypes)["partition_date"] == "date"
    assert read_bronze(spark, path, with_keys=False).columns == BRONZE.fieldNames()[:-2]
    files = bronze_files(back).collect()
    assert sum(r.row_count for r in files) == 2


def test_overwrite_and_append(spark, scratch):
    path = scratch + "/bronze"
    write_bronze(bronze_rows(spark, [{"vin": "A", "timestamp": H9}], batch_id="one"), path)
    write_bronze(bronze_rows(spark, [{"vin": "B", "timestamp": H9}], batch_id="two"), path)
    assert [r.batch_id for r in read_bronze(spark, path).collect()] == ["two"]
    write_bronze(bronze_rows(spark, [{"vin": "C", "timestamp": H9}], batch_id="three"), path, mode="append")
    assert sorted(r.batch_id for r in read_bronze(spark, path).collect()) == ["three", "two"]
    with pytest.raises(ValueError):
        write_bronze(bronze_rows(spark, [{"vin": "C"}]), path, mode="merge")


def test_date_range_prunes_partitions(spark, scratch):
    day = 86400 * 1000
    df = bronze_rows(spark, [{"vin": "A", "timestamp": 0}, {"vin": "B", "timestamp": 3 * day}])
    path = write_bronze(df, scratch + "/bronze")
    sel = read_bronze(spark, path, date_from="1970-01-02")
    assert [r.vin for r in sel.collect()] == ["B"]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "partition_date" in plan


def test_raw_rows_types(spark):
    df = raw_rows(spark, [{"vin": "A", "year": 2020}])
    assert dict(df.dtypes)["year"] == "bigint"
    assert df.select(F.col("year") + 1).first()[0] == 2021
