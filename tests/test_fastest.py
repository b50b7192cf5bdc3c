from conftest import bronze_rows
from telemetry_lake.operators import fastest_per_hour, to_silver

HOUR = 3600 * 1000


def _fast(spark, rows, **kw):
    s = to_silver(bronze_rows(spark, rows), "s", sort=False)
    return fastest_per_hour(s, "g", **kw).collect()


def test_eleven_equal_speeds_give_ten_rows(spark):
    rows = [{"vin": f"V{i}", "timestamp": 5 * HOUR + i, "velocity": 90.0} for i in range(11)]
    out = _fast(spark, rows)
    assert len(out) == 10 and {r.velocity for r in out} == {90.0}
    assert {(str(r.date_part), r.hour_part) for r in out} == {("1970-01-01", 5)}


def test_null_speed_absent_and_null_hour_group(spark):
    rows = [
        {"vin": "A", "timestamp": HOUR, "velocity": None},
        {"vin": "A", "timestamp": HOUR, "velocity": 3.0},
        {"vin": "A", "timestamp": None, "velocity": 7.0},
    ]
    out = _fast(spark, rows)
    assert [(r.hour_part, r.velocity) for r in out] == [(1, 3.0), (None, 7.0)]


def test_top_k_per_hour_and_order(spark):
    rows = [{"vin": "A", "timestamp": h * HOUR + i, "velocity": float(i)}
            for h in (1, 2) for i in range(15)]
    out = _fast(spark, rows, k=3)
    assert [(r.hour_part, r.velocity) for r in out] == [
        (1, 14.0), (1, 13.0), (1, 12.0), (2, 14.0), (2, 13.0), (2, 12.0)]


def test_zone_moves_hour_to_next_day(spark):
    ms = 1723678200000  # 2024-08-14 23:30 UTC
    rows = [{"vin": "A", "timestamp": ms, "velocity": 1.0}]
    utc = _fast(spark, rows)[0]
    jlm = _fast(spark, rows, report_tz="Asia/Jerusalem")[0]
    assert (str(utc.date_part), utc.hour_part) == ("2024-08-14", 23)
    assert (str(jlm.date_part), jlm.hour_part) == ("2024-08-15", 2)


def test_plan_limits_before_exchange(spark):
    rows = [{"vin": "A", "timestamp": HOUR, "velocity": 1.0}]
    s = to_silver(bronze_rows(spark, rows), "s", sort=False)
    plan = fastest_per_hour(s, "g")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_more_speeds_than_the_group_limit(spark):
    rows = [{"vin": "A", "timestamp": HOUR + i, "velocity": float(i % 1400)} for i in range(3000)]
    s = to_silver(bronze_rows(spark, rows).repartition(5, "timestamp"), "s", sort=False)
    got = [r.velocity for r in fastest_per_hour(s, "g", k=2000).collect()]
    assert got == sorted((float(i % 1400) for i in range(3000)), reverse=True)[:2000]
