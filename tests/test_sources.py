import json
import os

import pytest
from pyspark.sql import functions as F

from telemetry_lake.sources.landing import read_landing, write_landing
from telemetry_lake.sources.paged import fetch_pages, plan_pages, read_pages


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_landing_array_pretty_printed(spark, scratch):
    msgs = [{"vin": "A", "timestamp": 1, "gearPosition": "NEUTRAL", "foo": 1},
            {"vin": 12, "year": 2020}]
    _write(scratch + "/l/a.json", "\n  " + json.dumps(msgs, indent=2))
    df = read_landing(spark, scratch + "/l", fetched_at="2024-01-01T00:00:00")
    rows = sorted(df.collect(), key=lambda r: r.vin)
    assert [r.vin for r in rows] == ["12", "A"]  # number in a text field becomes text
    assert rows[1].gearPosition == "NEUTRAL" and rows[0].gearPosition is None
    assert "foo" not in df.columns and rows[0].fetch_timestamp == "2024-01-01T00:00:00"


@pytest.mark.parametrize("body", [
    '{"vin": "A"}', '[{"vin": "A",', '[{"timestamp": "x"}]', '[{"vin": "A"}][{"vin": "B"}]', '[{"vin": "A"}] garbage',
    '[{"vin": "A"}]} x', '[{"vin": "A"}], 1', "", "  \n", "[null]", "[1]", '["a"]', "null",
])
def test_landing_errors(spark, scratch, body):
    _write(scratch + "/bad/x.json", body)
    with pytest.raises(Exception):
        read_landing(spark, scratch + "/bad").collect()


def test_landing_lines_and_files_round_trip(spark, scratch, sf_dir):
    from telemetry_lake.sources.fixtures import read_messages

    msgs = read_messages(spark, sf_dir).withColumn("page", F.floor(F.col("year") % 3))
    write_landing(msgs, scratch + "/files", "page")
    write_landing(msgs, scratch + "/lines", "page", file_per_page=False)
    a = read_landing(spark, scratch + "/files", multi_line=True, fetched_at="t")
    b = read_landing(spark, scratch + "/lines", multi_line=False, fetched_at="t")
    want = sorted(map(tuple, msgs.drop("page").withColumn("fetch_timestamp", F.lit("t")).collect()),
                  key=repr)
    assert sorted(map(tuple, a.collect()), key=repr) == want
    assert sorted(map(tuple, b.collect()), key=repr) == want


def test_plan_pages():
    assert plan_pages(0, 10) == [] and plan_pages(-3, 10) == []
    assert plan_pages(3, 0) == [1, 1, 1]
    assert plan_pages(25, 10) == [10, 10, 5]


def test_paged_source_stops_after_short_page(spark, scratch):
    for page, n in enumerate([3, 2, 3]):  # page 1 is short
        _write(f"{scratch}/api/page={page}/body.json",
               json.dumps([{"vin": f"P{page}-{i}", "timestamp": i} for i in range(n)]))
    fetch_pages(spark, f"file://{scratch}/api/page={{page}}", 9, 3, scratch + "/pages")
    vins = sorted(r.vin for r in read_pages(spark, scratch + "/pages").collect())
    assert vins == ["P0-0", "P0-1", "P0-2", "P1-0", "P1-1"]


def test_paged_source_rejects_non_list(spark, scratch):
    _write(f"{scratch}/api/page=0/body.json", '{"vin": "A"}')
    with pytest.raises(Exception):
        fetch_pages(spark, f"file://{scratch}/api/page={{page}}", 1, 1, scratch + "/pages")


def test_bronze_file_name_and_views(spark, scratch):
    from conftest import bronze_rows
    from telemetry_lake.sources.bronze_store import read_bronze, write_bronze
    from telemetry_lake.sources.layers import register_views, write_gold

    path = write_bronze(bronze_rows(spark, [{"vin": "A", "timestamp": 1}]), scratch + "/bronze")
    df = read_bronze(spark, path, with_file_name=True)
    assert df.first().filename.endswith(".parquet")
    assert read_bronze(spark, path, with_keys=False, with_file_name=True).columns[-1] == "filename"
    write_gold(df.select("vin"), scratch + "/gold", "vin_last_state")
    names = register_views(spark, path, scratch + "/silver", scratch + "/gold")
    assert names == ["bronze", "vin_last_state"]
    assert spark.sql("SELECT count(*) FROM bronze").first()[0] == 1


def test_replicate_events(spark, sf_dir):
    from telemetry_lake.sources.fixtures import read_table, replicate_events

    ev = read_table(spark, sf_dir, "events")
    grown = replicate_events(ev, 3)
    assert grown.count() == 3 * ev.count()
    assert grown.select("event_id").distinct().count() == 3 * ev.count()
    assert grown.columns == ev.columns


def test_nan_becomes_null_in_bronze(spark, scratch):
    from telemetry_lake.operators import to_bronze

    _write(scratch + "/nan/a.json", '[{"vin": "A", "velocity": NaN, "latitude": 1.5}]')
    raw = read_landing(spark, scratch + "/nan", fetched_at="t")
    assert str(raw.first().velocity) == "nan"
    r = to_bronze(raw, batch_id="b", ingested_at="i").first()
    assert r.velocity is None and r.latitude == 1.5


def test_paged_source_groups_pages_per_task(spark, scratch):
    for page, n in enumerate([3, 3, 3, 2, 3]):  # page 3 is short
        _write(f"{scratch}/api/page={page}/body.json",
               json.dumps([{"vin": f"P{page}-{i}", "timestamp": i} for i in range(n)]))
    url = f"file://{scratch}/api/page={{page}}"
    fetch_pages(spark, url, 15, 3, scratch + "/one", pages_per_partition=1)
    fetch_pages(spark, url, 15, 3, scratch + "/two", pages_per_partition=2)
    a = sorted(r.vin for r in read_pages(spark, scratch + "/one").collect())
    b = sorted(r.vin for r in read_pages(spark, scratch + "/two").collect())
    assert a == b and len(a) == 11 and "P4-0" not in a
    assert spark.read.parquet(scratch + "/two").rdd.getNumPartitions() >= 1


def test_page_amounts_match_plan():
    from telemetry_lake.sources.paged import _page_amount

    for total, size in [(25, 10), (30, 10), (1, 1), (7, 3), (1000, 1000)]:
        assert [_page_amount(p, total, size) for p in range(len(plan_pages(total, size)))] == plan_pages(total, size)


def _read_stored(spark, scratch, sizes, total, batch):
    import uuid

    from telemetry_lake.sources.paged import write_pages

    rows = [(p, json.dumps([{"vin": f"{p}-{i}"} for i in range(n)])) for p, n in enumerate(sizes)]
    path = f"{scratch}/{uuid.uuid4().hex}"
    write_pages(spark.createDataFrame(rows, "page int, body string"), path, total, batch)
    return sorted(r.vin for r in read_pages(spark, path).collect())


@pytest.mark.parametrize("sizes,total,batch,rows", [
    ([3, 0, 3], 9, 3, 3), ([5, 5, 5], 9, 3, 10), ([3, 3, 3], 9, 3, 9), ([0], 3, 3, 0), ([4, 2, 3], 9, 3, 6), ([], 0, 3, 0),
    ([3, 3], 9, 3, 6),
])
def test_paged_read_stops_where_the_loop_would(spark, scratch, sizes, total, batch, rows):
    assert len(_read_stored(spark, scratch, sizes, total, batch)) == rows


def test_running_totals_over_several_runs_of_pages(spark, scratch, monkeypatch):
    from telemetry_lake.sources import paged

    monkeypatch.setattr(paged, "RUN", 2)
    assert len(_read_stored(spark, scratch, [3, 4, 3, 3, 3, 3, 3], 21, 3)) == 22
    assert len(_read_stored(spark, scratch, [3, 3, 3, 3, 2, 3, 3], 21, 3)) == 14


def test_stored_page_with_trailing_text_is_refused(spark, scratch):
    from telemetry_lake.sources.paged import write_pages

    write_pages(spark.createDataFrame([(0, "[] x")], "page int, body string"), scratch + "/p", 3, 3)
    with pytest.raises(Exception):
        read_pages(spark, scratch + "/p").collect()
