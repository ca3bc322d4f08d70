"""Exact quantiles, grouped medians, buckets and positions against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows, table
from limpid.functions.columns import as_number
from limpid.operators.aggregate import groupby_aggregate
from limpid.operators.outliers import Fences
from limpid.plans import quantiles as q
from limpid.plans.grouped_quantiles import grouped_median
from limpid.plans.ordering import Ordered, bucket_of, split_points, with_position

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(rng, n):
    third = np.where(rng.random(n) < 0.34, 7.0, rng.normal(size=n) * 100)
    return {
        "normal": rng.normal(size=n), "hot": third, "two": rng.choice([5.0, 6.0], n),
        "spread": np.exp(rng.normal(size=n) * 20), "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.integers(0, 9, n)),
        "none": np.full(n, np.nan), "constant": np.full(n, 3.5),
    }


@pytest.mark.parametrize("countable", [2, 40, 200_000])
def test_quantiles_are_exact_however_the_interval_is_found(spark, countable):
    data = columns(np.random.default_rng(3), 6000)
    df = table(spark, data, ", ".join(f"{c} double" for c in data), 5)
    found = q.exact_quantiles(df, {c: F.col(c) for c in data}, SHARES, countable=countable)
    for name, values in data.items():
        if name == "none":
            assert found[name] == [None] * len(SHARES)
        else:
            np.testing.assert_allclose(found[name], np.nanpercentile(values, [100 * p for p in SHARES]), rtol=1e-9)


def test_wrong_sketches_cost_time_but_not_exactness(spark, monkeypatch):
    monkeypatch.setattr(q, "_edges", lambda grid, share: (grid[0], grid[3]))
    values = np.random.default_rng(4).normal(size=3000)
    df = table(spark, {"x": values}, "x double")
    counted, read = [], q._read_ranks
    monkeypatch.setattr(q, "_read_ranks", lambda narrow, brackets: counted.extend(
        int(((values >= b.outer_low) & (values <= b.outer_high)).sum()) for b in brackets) or read(narrow, brackets))
    for countable in (50, 10_000):
        counted.clear()
        found = q.exact_quantiles(df, {"x": F.col("x")}, [0.5, 0.9], countable=countable)["x"]
        np.testing.assert_allclose(found, np.percentile(values, [50, 90]), rtol=1e-12)
        assert max(counted, default=0) <= countable


def test_counting_computes_the_given_expression_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    made = table(spark, {"k": rng.choice(["marker", "other"], 4000), "v": rng.normal(size=4000).round(2)}, "k string, v double")
    df = made.selectExpr("CASE WHEN k = 'marker' THEN v * 40 WHEN k = 'none' THEN NULL ELSE v END AS x", "1 AS one")
    capped = Fences.fit(df, "x").cap(df)
    plans, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: plans.append(
        self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    found = q.exact_quantiles(capped, {"x": as_number(capped, "x")}, [0.25, 0.5, 0.75], countable=4000)["x"]
    monkeypatch.undo()
    values = [r["x"] for r in capped.collect()]
    np.testing.assert_allclose(found, np.percentile(values, [25, 50, 75]), rtol=1e-12)
    counting = [p for p in plans if "Window" in p]
    # one scan for the values inside the intervals, one for their edges
    assert counting and all(p.count("= marker") == 2 for p in counting)


def test_places_of_doubles():
    numbers = [-np.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 0.1, 1e300, np.inf]
    assert [q._place(x) for x in numbers] == sorted(q._place(x) for x in numbers)
    assert [q._double_at(q._place(x)) for x in numbers] == numbers


@pytest.mark.parametrize("values", [[], [4.0], [1.0, 2.0], [None, 9.0, None]])
def test_tiny_columns(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = [v for v in values if v is not None]
    expected = [None] * 2 if not known else list(np.percentile(known, [25, 50]))
    assert q.exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5])["x"] == expected


@pytest.mark.parametrize("buckets", [1, 4, 60])
def test_grouped_median_with_a_hot_group(spark, buckets):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "hot", "hot", "b", "c"], 3000), "v": rng.normal(size=3000).round(2)})
    pdf.loc[pdf.g == "c", "v"] = np.nan
    pdf.loc[len(pdf)] = ["one", 4.25]
    df = table(spark, pdf.to_dict("list"), "g string, v double")
    found = dict(rows(grouped_median(df, ["g"], "v", "m", buckets=buckets)))
    expected = pdf.groupby("g").v.median()
    assert found.pop("c") is None
    assert found == pytest.approx(expected.dropna().to_dict())


def test_group_median_plans_agree(spark):
    rng = np.random.default_rng(6)
    df = table(spark, {"g": rng.integers(0, 5, 800), "v": rng.integers(0, 50, 800)}, "g long, v long")
    small = sorted(rows(groupby_aggregate(df, "g", "v", "median")))
    assert small == sorted(rows(groupby_aggregate(df, "g", "v", "median", distributed_median=True)))


@pytest.mark.parametrize("keys", [["k"], ["s"], ["t"], ["z", "k"], ["d", "s"]])
@pytest.mark.parametrize("buckets", [1, 3, 40, 200])
def test_positions_follow_the_key(spark, keys, buckets):
    rng = np.random.default_rng(7)
    order = rng.permutation(700)
    data = {"k": order * 1.5 - 300, "s": [f"it's \"{x:04d}\"" for x in order], "z": [1] * 700,
            "t": list(pd.Timestamp("2024-03-31") + pd.to_timedelta(order * 777, unit="s")), "d": list(order // 100)}
    data["t"] = [x.to_pydatetime() for x in data["t"]]
    df = table(spark, data, "k double, s string, z long, t timestamp_ntz, d long")
    got = with_position(df, keys, "place", buckets=buckets).toPandas().sort_values(keys)
    assert list(got["place"]) == list(range(1, 701))


def test_null_keys_come_first_in_buckets_too(spark):
    df = spark.createDataFrame([(None, "n")] + [(i, "v") for i in range(50)], "k long, v string")
    got = with_position(df, "k", "place", buckets=5).where("k IS NULL").collect()
    assert got[0]["place"] == 1


def test_both_bucket_searches_agree(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    few = split_points(df, ["k"], 30)
    many = split_points(df, ["k"], 45)
    assert len(few) <= 32 < len(many)
    for splits in (few, many):
        got = rows(df.select("k", bucket_of(df, ["k"], splits)))
        points = [int(s[0]) for s in splits]
        assert all(b == sum(p <= k for p in points) for k, b in got)


def test_buckets_are_balanced(spark):
    df = spark.range(4000).select((F.col("id") * F.col("id")).alias("k"))
    o = Ordered(df, "k", 10)
    sizes = [r["count"] for r in o.df.groupBy(o.bucket).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 3 * 4000 / 10


def test_rows_are_dealt_to_as_many_tasks_as_buckets(spark):
    df = table(spark, {"id": np.arange(2000)}, "id bigint")
    placed = Ordered(df, "id", 50)
    assert placed.buckets > 40
    plan = with_position(df, "id", "at", buckets=50)._jdf.queryExecution().optimizedPlan().toString()
    assert f"RepartitionByExpression [{placed.bucket}" in plan and f"], {placed.buckets}" in plan
    assert [r["at"] for r in with_position(df, "id", "at", buckets=50).orderBy("id").collect()] == list(range(1, 2001))
