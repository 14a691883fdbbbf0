import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from thermoflow.session import build_session  # noqa: E402

START = datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


@pytest.fixture
def readings(spark):
    """Readings from rows (room, source, second, temperature); the row number is the id."""
    def make(rows, ntz=True):
        kind = "timestamp_ntz" if ntz else "timestamp"
        data = [(room, source, at(second), temperature, i) for i, (room, source, second, temperature) in enumerate(rows)]
        schema = f"room_id string, source string, ts {kind}, temperature int, event_id bigint"
        return spark.createDataFrame(data, schema)

    return make


def in_order(tuples):
    """Sorted with NULLs last."""
    return sorted(tuples, key=lambda t: tuple((v is None, 0 if v is None else v) for v in t))


def rows(df, *columns):
    return in_order(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
