import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT)] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from telemetry_lake.session import lake_session

    s = lake_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF, "events.parquet").exists():
        pytest.skip("test tables not present")
    return SF


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def raw_rows(spark, rows):
    """Build a RAW-schema DataFrame from dicts (missing keys are NULL)."""
    from telemetry_lake.schemas import RAW

    data = [tuple(r.get(f.name) for f in RAW.fields) for r in rows]
    return spark.createDataFrame(data, RAW)


def bronze_rows(spark, rows, **kw):
    from telemetry_lake.operators import to_bronze

    kw.setdefault("batch_id", "b")
    kw.setdefault("fetched_at", "2024-01-01T00:00:00")
    kw.setdefault("ingested_at", "2024-01-01T00:00:01")
    return to_bronze(raw_rows(spark, rows), **kw)
