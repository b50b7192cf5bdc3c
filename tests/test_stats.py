from conftest import bronze_rows
from telemetry_lake.operators import to_silver, vin_last_state
from telemetry_lake.operators import stats


def _silver(spark):
    rows = [
        {"vin": "A", "manufacturer": " Ford ", "timestamp": 1, "velocity": 10.0, "latitude": 10.0,
         "longitude": 20.0, "frontLeftDoorState": "LOCKED"},
        {"vin": "A", "manufacturer": "Ford", "timestamp": 2, "velocity": 20.0, "latitude": 123.0,
         "longitude": 20.0},
        {"vin": "B", "manufacturer": "Kia", "timestamp": 3, "velocity": None, "latitude": None,
         "longitude": 1.0, "gearPosition": "REVERSE"},
        {"vin": "C", "manufacturer": "Kia", "timestamp": None, "velocity": -1.0, "latitude": 0.0,
         "longitude": 0.0, "wipersState": "ON"},
    ]
    return to_silver(bronze_rows(spark, rows), "s", sort=False)


def test_silver_stats(spark):
    r = stats.silver_stats(_silver(spark)).first()
    assert (r.total_records, r.unique_vehicles, r.unique_manufacturers) == (4, 3, 2)
    assert r.avg_velocity == 9.67
    assert (r.records_with_valid_coords, r.records_with_valid_velocity) == (2, 2)
    assert r.valid_coords_percentage == 50.0


def test_flags_and_summary(spark):
    s = _silver(spark)
    flags = {(r.vin, r.timestamp): (r.has_valid_coordinates, r.has_valid_velocity)
             for r in stats.with_quality_flags(s).collect()}
    assert flags[("A", 1)] == (True, True) and flags[("A", 2)] == (False, True)
    assert flags[("B", 3)] == (False, False) and flags[("C", None)] == (True, False)
    summary = [tuple(r) for r in stats.manufacturer_summary(s).collect()]
    assert summary == [("Ford", 2, 1, 15.0, 20.0), ("Kia", 2, 2, -1.0, -1.0)]
    gears = {r.gear_position_numeric: r.message_count for r in stats.gear_counts(s).collect()}
    assert gears == {-1: 1, None: 3}


def test_bronze_and_last_state_stats(spark):
    b = stats.bronze_stats(bronze_rows(spark, [{"vin": "A", "timestamp": 5}, {"vin": None, "timestamp": 9}]))
    r = b.first()
    assert (r.total_records, r.unique_vehicles) == (2, 1)
    ls = stats.last_state_stats(vin_last_state(_silver(spark), "g")).first()
    assert tuple(ls) == (3, 1, 1)


def test_silver_stats_expands_only_reduced_rows_and_takes_no_rows(spark):
    s = _silver(spark)
    plan = stats.silver_stats(s)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    expand = next((i for i, x in enumerate(lines) if "Expand" in x), None)
    assert expand is None or any("Aggregate [vin" in x for x in lines[expand:])
    empty = stats.silver_stats(s.limit(0)).first()
    assert (empty.total_records, empty.unique_vehicles, empty.avg_velocity) == (0, 0, None)
