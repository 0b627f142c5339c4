from __future__ import annotations

import datetime
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tiffin.schemas import TableSpec  # noqa: E402
from tiffin.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, memory="4g", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze_rows(spark):
    """Bronze rows from dicts; columns left out are NULL."""

    def build(spec: TableSpec, *rows: dict):
        values = [tuple(_value(row.get(f.name)) for f in spec.fields) for row in rows]
        return spark.createDataFrame(values, spec.bronze_schema)

    return build


@pytest.fixture(scope="session")
def silver_rows(spark):
    def build(spec: TableSpec, *rows: dict):
        values = [tuple(_value(row.get(c)) for c in spec.silver_columns) for row in rows]
        return spark.createDataFrame(values, spec.silver_schema)

    return build


def _value(value):
    """Floats become decimals, ISO days become dates, ISO times become timestamps."""
    if isinstance(value, float):
        return Decimal(str(value))
    if isinstance(value, str) and len(value) == 10 and value[4:5] == "-":
        return datetime.date.fromisoformat(value)
    if isinstance(value, str) and len(value) == 19 and value[10:11] == " ":
        return datetime.datetime.fromisoformat(value)
    return value
