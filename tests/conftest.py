import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.session import local_session  # noqa: E402
from rivulet.sources.tables import Warehouse  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture(scope="session")
def data():
    return DATA


# --- small documents ---------------------------------------------------------

OLD = "2026-02-24T00:00:00+00:00"
NEW = "2026-02-25T00:00:00+00:00"
LEVEL = "L31-stage-15min-mAOD"
AMMONIUM = "L31-nh4-sonde-mgN"
TURBIDITY = ["L31-turb-bank-FTU", "L31-turb-raft-FTU", "L31-turb-raft-NTU"]
SEARCH = "station_search"


def dataset(parameter: str, measure: str) -> str:
    return f"readings_latest__{parameter}__{measure}"


def station(notation="L31", label="LOWER LOCK", **fields):
    return {"notation": notation, "label": label, "riverName": "WENDLE", **fields}


def offering(**fields):
    """A station that offers a water level, turbidity three times over, and ammonium."""
    by_parameter = {"Water Level": [LEVEL], "TURBIDITY": TURBIDITY, "Ammonium": [AMMONIUM]}
    measures = [
        {"@id": f"https://data.example/m/{name}", "parameter": parameter}
        for parameter, names in by_parameter.items()
        for name in reversed(names)
    ]
    offered = [{"@id": f"https://data.example/p/{p}"} for p in ("ammonium", "turbidity/", "water_level")]
    return station(measures=measures, observedProperty=offered, **fields)


def doc(*items) -> str:
    return json.dumps({"items": list(items)}, ensure_ascii=False)


def reading(when="2026-02-25T09:45:00Z", value=6.5, **fields):
    return {"dateTime": when, "value": value, **fields}


def landing(spark, *rows):
    """Rows (dataset, payload, ingested_at) as a landing frame, with ids from 1."""
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    return spark.createDataFrame(
        numbered, "id bigint, dataset string, payload string, ingested_at string"
    )


def dicts(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [row.asDict() for row in rows]
