"""Inputs that once gave wrong answers: odd labels, missing order keys, repeated names and keys."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import limpid as lp
from limpid.functions.text import strip


@pytest.mark.parametrize("kind, labels", [
    ("double", [1e-5, 2.0, 1e7]), ("boolean", [False, True]), ("decimal(20,10)", [Decimal("0.0000000001"), Decimal("3")]),
    ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 2)])])
def test_pivot_labels_of_every_type(spark, kind, labels):
    rows = [(k, label, float(n + k)) for k in (1, 2) for n, label in enumerate(labels)] * 2
    table = spark.createDataFrame(rows, f"k long, label {kind}, v double")
    for how in ("mean", "min", "std", "median"):
        out = lp.pivot(table, "k", "label", "v", how).orderBy("k").collect()
        cells = [[r[n] for n in range(1, len(labels) + 1)] for r in out]
        assert len(out[0]) == len(labels) + 1
        if how == "std":
            assert cells == [[0.0] * len(labels)] * 2
        else:
            assert cells == [[float(n + k) for n in range(len(labels))] for k in (1, 2)]
    if kind == "double":
        given = lp.pivot(table, "k", "label", "v", "mean", labels=[1e7]).orderBy("k").collect()
        assert [r[1] for r in given] == [3.0, 4.0]


def test_missing_order_keys_keep_their_rows(spark):
    table = spark.createDataFrame([("a", None), ("b", 2), ("b", None), ("b", 1)], "g string, at int")
    first = {r.g: r.at for r in lp.drop_duplicates(table, subset=["g"], keep="first", order_by="at").collect()}
    last = {r.g: r.at for r in lp.drop_duplicates(table, subset=["g"], keep="last", order_by="at").collect()}
    assert first == {"a": None, "b": 1} and last == {"a": None, "b": None}


def test_transpose_needs_a_name_for_every_row(spark):
    for names in (["x", "x"], ["x", None]):
        with pytest.raises(ValueError):
            lp.transpose(spark.createDataFrame([(n, 1) for n in names], "name string, v int"), "name")


def test_repeated_mapping_keys_raise(spark):
    mapping = spark.createDataFrame([("x", "1"), ("x", "2")], "key string, value string")
    with pytest.raises(ValueError):
        lp.apply_map(spark.createDataFrame([("x",)], "c string"), "c", mapping)


def test_strip_takes_separator_controls(spark):
    text = "\x1c \x1f\ta\x1cb\xa0\x1e"
    assert spark.range(1).select(strip(F.lit(text)).alias("t")).first().t == text.strip()
