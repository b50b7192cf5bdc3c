import random

from conftest import bronze_rows
from telemetry_lake.operators.last_state import latest_state
from telemetry_lake.operators import (
    latest_row, last_non_null, to_silver, vin_last_state,
)


def _silver(spark, rows):
    return to_silver(bronze_rows(spark, rows), "s", sort=False)


def _state(spark, rows):
    out = vin_last_state(_silver(spark, rows), "g").collect()
    return {r.vin: (r.last_reported_timestamp, r.last_front_left_door_state, r.last_wipers_state)
            for r in out}


def test_state_older_than_last_message(spark):
    rows = [
        {"vin": "A", "timestamp": 1, "frontLeftDoorState": "LOCKED", "wipersState": "ON"},
        {"vin": "A", "timestamp": 2, "frontLeftDoorState": None, "wipersState": "OFF"},
    ]
    assert _state(spark, rows) == {"A": (2, "LOCKED", "OFF")}


def test_no_state_at_all_keeps_row(spark):
    assert _state(spark, [{"vin": "A", "timestamp": 5}]) == {"A": (5, None, None)}


def test_only_null_times(spark):
    rows = [{"vin": "A", "timestamp": None, "frontLeftDoorState": "LOCKED"}]
    assert _state(spark, rows) == {"A": (None, "LOCKED", None)}


def test_tie_takes_larger_state_every_run(spark):
    rows = [
        {"vin": "A", "timestamp": 7, "frontLeftDoorState": "LOCKED"},
        {"vin": "A", "timestamp": 7, "frontLeftDoorState": "UNLOCKED"},
    ]
    for _ in range(3):
        assert _state(spark, rows) == {"A": (7, "UNLOCKED", None)}


def test_vin_spelled_with_spaces_is_another_vehicle(spark):
    rows = [{"vin": " A ", "timestamp": 1}, {"vin": "A", "timestamp": 2}]
    assert set(_state(spark, rows)) == {" A ", "A"}


def test_report_order_and_columns(spark):
    rows = [{"vin": "A", "timestamp": 1}, {"vin": "B", "timestamp": 3}, {"vin": "C", "timestamp": None}]
    out = vin_last_state(_silver(spark, rows), "g")
    assert out.columns == ["vin", "last_reported_timestamp", "last_message_datetime",
                           "last_front_left_door_state", "last_wipers_state",
                           "report_generated_timestamp"]
    assert [r.vin for r in out.collect()] == ["B", "A", "C"]


def _by_hand(rows):
    """Last state by sorting each vehicle's rows; missing times come first, ties take the larger state."""
    for vin in {r.vin for r in rows}:
        own = [r for r in rows if r.vin == vin]

        def last(column):
            seen = [(r.timestamp if r.timestamp is not None else -1, r[column]) for r in own if r[column] is not None]
            return max(seen)[1] if seen else None

        newest = max(own, key=lambda r: -1 if r.timestamp is None else r.timestamp)
        yield (vin, newest.timestamp, newest.message_datetime, last("front_left_door_state"), last("wipers_state"), "g")


def test_aggregate_equals_rows_sorted_by_hand(spark):
    rnd = random.Random(7)
    doors = [None, "LOCKED", "UNLOCKED"]
    wipers = [None, "ON", "OFF"]
    rows = [
        {"vin": f"V{rnd.randrange(12)}",
         "timestamp": rnd.choice([None] + list(range(40))),
         "frontLeftDoorState": rnd.choice(doors), "wipersState": rnd.choice(wipers)}
        for _ in range(600)
    ]
    s = _silver(spark, rows)
    a = sorted(map(tuple, vin_last_state(s, "g").collect()))
    b = sorted(map(tuple, _by_hand(s.collect())))
    assert a == b


def test_generic_latest_row_and_last_non_null(spark):
    df = spark.createDataFrame(
        [("k", 1, "a", None), ("k", 2, "b", "x"), ("k", 3, None, None), ("j", None, "z", "y")],
        "key string, t int, v string, w string",
    )
    lr = {r.key: (r.t, r.v) for r in latest_row(df, ["key"], "t", ["v"]).collect()}
    assert lr == {"k": (3, None), "j": (None, "z")}
    ln = {r.key: (r.v, r.w) for r in last_non_null(df, ["key"], "t", ["v", "w"]).collect()}
    assert ln == {"k": ("b", "x"), "j": ("z", "y")}


def test_plan_reduces_by_hash_aggregate_before_its_first_exchange(spark):
    rows = [{"vin": "A", "timestamp": 1}]
    plan = vin_last_state(_silver(spark, rows), "g")._jdf.queryExecution().sparkPlan().toString()
    # (vin, door, wipers) by hash on the map side; the struct maxima run on that small result
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate" in lowest and "partial_max(message_datetime" in lowest


def test_latest_message_window_limits_before_exchange(spark):
    from telemetry_lake.operators import latest_message_per_vin

    rows = [{"vin": "A", "timestamp": 1}, {"vin": "A", "timestamp": 2}]
    df = latest_message_per_vin(_silver(spark, rows))
    assert [(r.vin, r.last_reported_timestamp) for r in df.collect()] == [("A", 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_reduced_form_equals_struct_maxima_of_all_rows(spark):
    rnd = random.Random(11)
    rows = [
        {"vin": f"V{rnd.randrange(15)}",
         "timestamp": rnd.choice([None] + [1000 * t for t in range(30)]),
         "frontLeftDoorState": rnd.choice([None, "LOCKED", "UNLOCKED", "AJAR"]),
         "wipersState": rnd.choice([None, "ON", "OFF"])}
        for _ in range(800)
    ]
    s = _silver(spark, rows)
    whole = latest_state(s, ["vin"], "message_datetime", ["timestamp"], ["front_left_door_state", "wipers_state"])
    a = sorted((r.vin, r.timestamp, r.message_datetime, r.front_left_door_state, r.wipers_state) for r in
               whole.na.fill("-").na.fill(-1).collect() if r.message_datetime is not None)
    out = vin_last_state(s, "g").na.fill("-").na.fill(-1)
    b = sorted((r.vin, r.last_reported_timestamp, r.last_message_datetime, r.last_front_left_door_state,
                r.last_wipers_state) for r in out.collect() if r.last_message_datetime is not None)
    assert a == b and len(a) == 15


def test_many_and_empty_states(spark):
    rows = [{"vin": "A", "timestamp": i, "frontLeftDoorState": f"S{i:03d}"} for i in range(300)]
    out = vin_last_state(_silver(spark, rows), "g")
    assert [(r.last_front_left_door_state, r.last_wipers_state) for r in out.collect()] == [("S299", None)]


def test_year_9999(spark):
    rows = [{"vin": "A", "timestamp": 253402300799000, "wipersState": "ON"}, {"vin": "A", "timestamp": 1, "wipersState": "OFF"}]
    assert _state(spark, rows) == {"A": (253402300799000, None, "ON")}
