"""Versioned datasets and the paged API as a stream."""

import json
import os

import pytest
from conftest import bronze_rows
from pyspark.sql import functions as F

from telemetry_lake.sources import versions
from telemetry_lake.sources.bronze_store import read_bronze, write_bronze
from telemetry_lake.sources.layers import list_reports, read_gold, write_gold
from telemetry_lake.sources.paged import fetch_pages, read_pages
from telemetry_lake.streaming.pages import stream_pages_to_bronze

STAMPS = dict(batch_id="b", fetched_at="2024-01-01T00:00:00", ingested_at="2024-01-01T00:00:01")


def respond(root, sizes, first=0):
    for page, n in enumerate(sizes, first):
        os.makedirs(f"{root}/api/page={page}", exist_ok=True)
        with open(f"{root}/api/page={page}/body.json", "w") as fh:
            fh.write(json.dumps([{"vin": f"{page}-{i}", "timestamp": 3_600_000 * i} for i in range(n)]))
    return f"file://{root}/api/page={{page}}"


def stream(spark, root, url, total, size, **kw):
    return stream_pages_to_bronze(spark, url, total, size, f"{root}/pages", f"{root}/bronze", f"{root}/ckpt", **STAMPS, **kw)


def vins(spark, root):
    return sorted(r.vin for r in read_bronze(spark, f"{root}/bronze").collect())


@pytest.mark.parametrize("sizes,total,per_batch", [
    ([3, 3, 2, 3, 3], 15, 2), ([3, 3, 3], 9, 1), ([3, 0, 3], 9, 1), ([5, 3, 3], 9, 3), ([3, 3, 1], 7, 100),
])
def test_stream_reads_what_the_paged_read_does(spark, scratch, sizes, total, per_batch):
    url = respond(scratch, sizes)
    out = stream(spark, scratch, url, total, 3, pages_per_batch=per_batch)
    fetch_pages(spark, url, total, 3, f"{scratch}/once")
    want = sorted(r.vin for r in read_pages(spark, f"{scratch}/once").collect())
    assert vins(spark, scratch) == want and out["ended"] and out["messages"] == len(want)


def test_stream_goes_on_after_a_failure(spark, scratch):
    url = respond(scratch, [2, 2])
    with pytest.raises(Exception):  # page 2 isn't there yet
        stream(spark, scratch, url, 8, 2, pages_per_batch=1)
    assert vins(spark, scratch) == ["0-0", "0-1", "1-0", "1-1"]
    os.remove(f"{scratch}/api/page=0/body.json")  # what is stored isn't asked for again
    respond(scratch, [2, 1], first=2)
    assert stream(spark, scratch, url, 8, 2, pages_per_batch=1) == {"pages": 4, "messages": 7, "ended": True}
    assert vins(spark, scratch) == ["0-0", "0-1", "1-0", "1-1", "2-0", "2-1", "3-0"]
    assert stream(spark, scratch, url, 8, 2)["ended"]  # nothing more
    assert len(vins(spark, scratch)) == 7


def test_stored_micro_batches_are_written_together(spark, scratch, monkeypatch):
    from telemetry_lake.streaming import pages as streamed

    url, writes, write = respond(scratch, [1, 1, 1]), [], streamed.write_micro_batch

    def fails(*args, **kw):
        writes.append(args[3])
        write(*args, **kw)
        raise OSError("lost after the files were written")

    monkeypatch.setattr(streamed, "write_micro_batch", fails)
    with pytest.raises(Exception):  # page 3 isn't there yet, and what is stored isn't marked as written
        stream(spark, scratch, url, 5, 1, pages_per_batch=1)
    monkeypatch.setattr(streamed, "write_micro_batch", lambda *a, **kw: (writes.append(a[3]), write(*a, **kw)))
    respond(scratch, [1, 1], first=3)
    for page in range(3):
        os.remove(f"{scratch}/api/page={page}/body.json")  # these aren't asked for again
    assert stream(spark, scratch, url, 5, 1, pages_per_batch=1) == {"pages": 5, "messages": 5, "ended": True}
    assert vins(spark, scratch) == [f"{page}-0" for page in range(5)]
    assert writes == [0, 0]  # five micro-batches, one write in each run
    assert len(read_bronze(spark, f"{scratch}/bronze").inputFiles()) == 1


def test_micro_batches_keep_their_own_stamps(spark, scratch):
    url = respond(scratch, [1, 1, 1])
    stream_pages_to_bronze(spark, url, 3, 1, f"{scratch}/pages", f"{scratch}/bronze", f"{scratch}/ckpt", pages_per_batch=1)
    rows = read_bronze(spark, f"{scratch}/bronze").orderBy("vin").collect()
    assert [r.fetch_timestamp for r in rows] == sorted({r.fetch_timestamp for r in rows}) and len(rows) == 3
    assert all(r.ingestion_timestamp == r.fetch_timestamp and r.batch_id.startswith("stream_") for r in rows)


def test_empty_first_page_and_no_amount(spark, scratch):
    url = respond(scratch, [0, 3])
    assert stream(spark, scratch, url, 6, 3) == {"pages": 2, "messages": 0, "ended": True}
    assert not os.path.exists(f"{scratch}/bronze")
    assert stream_pages_to_bronze(spark, url, 0, 3, f"{scratch}/p", f"{scratch}/b", f"{scratch}/c")["ended"]


def test_refused_page_fails_the_stream(spark, scratch):
    url = respond(scratch, [2, 2])
    with open(f"{scratch}/api/page=1/body.json", "w") as fh:
        fh.write('[{"vin": 1}, 7]')
    with pytest.raises(Exception):
        stream(spark, scratch, url, 4, 2)


def test_stored_pages_beyond_the_end_are_not_parsed(spark, scratch):
    url = respond(scratch, [3, 1, 3])
    with open(f"{scratch}/api/page=2/body.json", "w") as fh:
        fh.write("[not json")
    fetch_pages(spark, url, 9, 3, f"{scratch}/once")
    assert read_pages(spark, f"{scratch}/once").count() == 4


def test_replace_switches_versions(spark, scratch):
    path = f"{scratch}/bronze"
    rows = lambda *names: bronze_rows(spark, [{"vin": n, "timestamp": 1} for n in names])
    write_bronze(rows("A"), path, mode="replace")
    old = read_bronze(spark, path)
    first = versions.current_version(spark, path)
    write_bronze(rows("B", "C"), path, mode="replace")
    assert sorted(r.vin for r in read_bronze(spark, path).collect()) == ["B", "C"]
    assert [r.vin for r in old.collect()] == ["A"]  # a reader at work keeps its version
    bad = rows("D").withColumn("vin", F.raise_error(F.lit("fails")).cast("string"))
    with pytest.raises(Exception):
        write_bronze(bad, path, mode="replace")
    assert read_bronze(spark, path).count() == 2
    write_bronze(rows("E"), path, mode="replace")
    assert first not in os.listdir(path) and len([n for n in os.listdir(path) if n.startswith(versions.PREFIX)]) == 2
    write_bronze(rows("F"), path, mode="append")  # adds to the version that counts
    assert sorted(r.vin for r in read_bronze(spark, path).collect()) == ["E", "F"]


def test_root_without_pointer_is_its_own_version(spark, scratch):
    write_bronze(bronze_rows(spark, [{"vin": "A", "timestamp": 1}]), f"{scratch}/bronze")
    assert versions.current_version(spark, f"{scratch}/bronze") is None
    write_bronze(bronze_rows(spark, [{"vin": "B", "timestamp": 1}]), f"{scratch}/bronze", mode="replace")
    assert [r.vin for r in read_bronze(spark, f"{scratch}/bronze").collect()] == ["B"]


def test_gold_versions(spark, scratch):
    root = f"{scratch}/gold"
    for n, reports in ((1, ["vin_last_state", "velocity_analysis"]), (2, ["vin_last_state"])):
        version = versions.new_version(f"2024010{n}_000000")
        for report in reports:
            write_gold(spark.range(n), f"{root}/{version}", report)
        if n == 1:
            versions.publish(spark, root, version)
    assert read_gold(spark, root, "vin_last_state").count() == 1  # the second isn't published yet
    assert {r.report for r in list_reports(spark, root).collect()} == {"vin_last_state", "velocity_analysis"}
    versions.publish(spark, root, version)
    assert read_gold(spark, root, "vin_last_state").count() == 2
    assert {r.report for r in list_reports(spark, root).collect()} == {"vin_last_state"}
