from __future__ import annotations

import math
import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from limpid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("tests", spark__checkpoint__dir=str(folder), spark__driver__memory="4g",
                            spark__sql__shuffle__partitions="3")
    yield session
    session.stop()


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def same(value, other) -> bool:
    if value is None or other is None or value is pd.NaT or other is pd.NaT or other is pd.NA:
        return _gap(value) and _gap(other)
    if isinstance(value, float) or isinstance(other, float):
        if _gap(value) or _gap(other):
            return _gap(value) and _gap(other)
        return math.isclose(float(value), float(other), rel_tol=1e-9, abs_tol=1e-9)
    return value == other


def _gap(value) -> bool:
    return value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value))


def assert_same_rows(df, expected: pd.DataFrame, key: str | list[str]) -> None:
    """Spark result against a pandas one, matched up by a unique key."""
    keys = [key] if isinstance(key, str) else key
    assert list(df.columns) == list(expected.columns)
    got = sorted(rows(df.select(*df.columns)), key=lambda r: _sortable(r, df.columns, keys))
    want = sorted(expected.itertuples(index=False, name=None), key=lambda r: _sortable(r, df.columns, keys))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for name, a, b in zip(df.columns, g, w):
            assert same(a, b), (name, g, w)


def _sortable(row, columns, keys):
    return tuple((_gap(v), "" if _gap(v) else v) for v in (row[columns.index(k)] for k in keys))


def table(spark, data: dict, schema: str, partitions: int = 3):
    names = [part.split()[0].strip("`") for part in schema.split(", ")]
    values = [[_clean(v) for v in data[n]] for n in names]
    return spark.createDataFrame(list(zip(*values)), schema).repartition(partitions)


def _clean(value):
    if hasattr(value, "item"):
        value = value.item()
    return None if value is pd.NA else value
