from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

import limpid as lp
from conftest import assert_same_rows, rows, table

SCHEMA = "id long, a double, b double, s string"


def frame(seed=0, n=400, share=0.4):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "id": rng.permutation(n) * 3, "a": rng.normal(size=n).round(3), "b": rng.integers(0, 20, n).astype(float),
        "s": rng.choice(["x", "y", "z"], n)})
    for c in ("a", "b"):
        pdf.loc[rng.random(n) < share, c] = np.nan
    pdf["s"] = pdf["s"].astype(object).where(rng.random(n) > share, None)
    return pdf


def spark_of(spark, pdf, partitions=4):
    return table(spark, pdf.to_dict("list"), SCHEMA, partitions)


@pytest.mark.parametrize("options", [
    {}, {"how": "all", "subset": ["a", "b"]}, {"subset": "s"}, {"thresh": 3}, {"how": "all", "thresh": 4}, {"subset": []},
])
def test_drop_rows(spark, options):
    pdf = frame()
    wanted = dict(options)
    if "thresh" in wanted:
        wanted.pop("how", None)
    if wanted.get("subset") == "s":
        wanted["subset"] = ["s"]
    assert_same_rows(lp.drop_missing(spark_of(spark, pdf), **options), pdf.dropna(**wanted), "id")


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, None, float("nan"), "x"), (2, None, 1.0, "y")], "id long, n string, a double, s string")
    assert lp.drop_missing(df, axis=1).columns == ["id", "s"]
    assert lp.drop_missing(df, axis=1, how="all").columns == ["id", "a", "s"]
    assert lp.drop_missing(df, axis=1, thresh=1).columns == ["id", "a", "s"]
    assert lp.drop_missing(df.where("false"), axis=1).columns == df.columns


def test_fill_constant_is_cast_to_the_column(spark):
    df = spark.createDataFrame([(None, None, None, float("nan"))], "i long, s string, b boolean, d double")
    assert rows(lp.fill_missing_constant(df, "0", ["i", "s", "d"]))[0] == (0, "0", None, 0.0)
    assert rows(lp.fill_missing_constant(df, "true", "b"))[0][2] is True
    with pytest.raises(ValueError):
        lp.fill_missing_constant(df, "abc", "i")
    assert rows(lp.fill_missing_constant(df, 2.5, "i"))[0][0] == 2.5


@pytest.mark.parametrize("strategy", ["mean", "median"])
def test_fill_statistics(spark, strategy):
    pdf = frame(1)
    got = lp.fill_missing_statistic(spark_of(spark, pdf), strategy)
    want = pdf.copy()
    for c in ("id", "a", "b"):
        want[c] = want[c].fillna(getattr(want[c], strategy)()).astype(float)
    assert_same_rows(got, want, "id")


def test_fill_mode_takes_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame(
        [(10, "b"), (9, "b"), (10, "a"), (9, "a"), (None, None)], "n long, s string")
    assert (9, "a") in rows(lp.fill_missing_statistic(df, "mode"))
    assert rows(lp.fill_missing_statistic(df, "mode")).count((9, "a")) == 2


def test_columns_without_values_stay(spark):
    df = spark.createDataFrame([(None, None)], "n double, s string")
    assert rows(lp.fill_missing_statistic(df, "mean")) == [(None, None)]
    assert rows(lp.fill_missing_statistic(df, "mode")) == [(None, None)]
    assert lp.FillValues.fit(df, "mode").notes


def test_fitted_fill_on_another_table(spark):
    fitted = lp.FillValues.fit(spark.createDataFrame([(1.0,), (3.0,)], "x double"), "mean")
    assert rows(fitted.apply(spark.createDataFrame([(None,), (9.0,)], "x double"))) == [(2.0,), (9.0,)]


@pytest.mark.parametrize("buckets", [1, 3, 50])
@pytest.mark.parametrize("share", [0.4, 0.98, 1.0])
def test_carry(spark, buckets, share):
    pdf = frame(2, 300, share)
    ordered = pdf.sort_values("id")
    df = spark_of(spark, pdf)
    forward = lp.fill_missing_ffill(df, order_by="id", buckets=buckets)
    assert_same_rows(forward, ordered.ffill(), "id")
    backward = lp.fill_missing_bfill(df, ["a", "s"], order_by="id", buckets=buckets)
    want = ordered.copy()
    want[["a", "s"]] = want[["a", "s"]].bfill()
    assert_same_rows(backward, want, "id")


@pytest.mark.parametrize("buckets", [1, 3, 50])
@pytest.mark.parametrize("share", [0.5, 0.99, 1.0])
def test_interpolate_linear(spark, buckets, share):
    pdf = frame(3, 300, share)
    want = pdf.sort_values("id")
    want[["a", "b"]] = want[["a", "b"]].interpolate("linear")
    got = lp.interpolate_missing(spark_of(spark, pdf), ["a", "b", "s"], order_by="id", buckets=buckets)
    assert_same_rows(got, want, "id")


@pytest.mark.parametrize("buckets", [1, 4])
def test_interpolate_nearest(spark, buckets):
    values = [None, 1.0, None, None, 4.0, None, None, None, 8.0, None]
    df = table(spark, {"id": range(10), "v": values}, "id long, v double")
    got = [v for _, v in sorted(rows(lp.interpolate_missing(df, "v", "nearest", order_by="id", buckets=buckets)))]
    assert got == [None, 1.0, 1.0, 4.0, 4.0, 4.0, 4.0, 8.0, 8.0, None]
    with pytest.raises(ValueError):
        lp.interpolate_missing(df, "v", "cubic", order_by="id")


def test_order_is_required(spark):
    with pytest.raises(ValueError, match="order_by"):
        lp.fill_missing_ffill(spark_of(spark, frame()))


def test_impute_dispatch(spark):
    pdf = frame(4, 60)
    df = spark_of(spark, pdf)
    assert lp.impute(df, "drop").count() == len(pdf.dropna())
    assert_same_rows(lp.impute(df, "ffill", order_by="id"), pdf.sort_values("id").ffill(), "id")
    assert lp.impute(df, "custom", "s", value="?").where("s = '?'").count() == pdf.s.isna().sum()
    with pytest.raises(ValueError):
        lp.impute(df, "guess")


def series_frame(n=900):
    """A third of all rows in one series, many small series, missing series, gaps longer than a bucket."""
    rng = np.random.default_rng(5)
    pdf = frame(5, n, 0.5)
    pdf["s"] = [None if u < 0.1 else "hot" if u < 0.45 else f"u{int(u * 200)}" for u in rng.random(n)]
    pdf.loc[(pdf["s"] == "hot") & (pdf["id"] > 900) & (pdf["id"] < 1900), ["a", "b"]] = np.nan
    return pdf


@pytest.mark.parametrize("buckets", [1, 13])
def test_series_are_filled_on_their_own(spark, buckets):
    pdf = series_frame()
    df = spark_of(spark, pdf)
    by_series = pdf.sort_values("id").groupby("s", dropna=False)[["a", "b"]]
    for fill, want in ((lp.fill_missing_ffill, by_series.ffill()), (lp.fill_missing_bfill, by_series.bfill())):
        got = fill(df, order_by="id", partition_by="s", buckets=buckets)
        assert_same_rows(got, pdf.assign(a=want["a"], b=want["b"]), "id")
    for method in ("linear", "nearest"):
        got = lp.interpolate_missing(df, method=method, order_by="id", partition_by="s", buckets=buckets)
        kept = {r.id: (r.a, r.b) for r in got.collect()}
        for _, part in pdf.sort_values("id").groupby("s", dropna=False):
            for n, c in enumerate(("a", "b")):
                want = _interpolated(part[c].tolist(), method)
                have = [kept[i][n] for i in part["id"]]
                assert all((w is None) == (h is None) and (w is None or abs(w - h) < 1e-9) for w, h in zip(want, have))


def _interpolated(values, method):
    known = [i for i, v in enumerate(values) if not np.isnan(v)]
    out = []
    for i, v in enumerate(values):
        a, b = max((k for k in known if k <= i), default=None), min((k for k in known if k >= i), default=None)
        if not np.isnan(v):
            out.append(v)
        elif a is None or b is None:
            out.append(values[a] if a is not None and method == "linear" else None)
        elif method == "linear":
            out.append(values[a] + (values[b] - values[a]) / (b - a) * (i - a))
        else:
            out.append(values[a] if i - a <= b - i else values[b])
    return out


def test_series_by_two_columns_and_edges(spark):
    df = spark.createDataFrame([(1, "a", 1, 5.0), (2, "a", 1, None), (3, "a", 2, None), (4, None, 2, None), (5, None, 2, 7.0),
                                (6, None, None, None)], "id long, s string, t long, v double")
    got = lp.fill_missing_ffill(df, order_by="id", partition_by=["s", "t"], buckets=3).collect()
    assert {r.id: r.v for r in got} == {1: 5.0, 2: 5.0, 3: None, 4: None, 5: 7.0, 6: None}
    assert {r.id: r.t for r in got}[6] is None
    assert lp.fill_missing_bfill(df.where("false"), order_by="id", partition_by="s").count() == 0
    with pytest.raises(ValueError):
        lp.fill_missing_ffill(df, partition_by="s")


def test_a_hot_series_spans_many_buckets(spark):
    from limpid.plans.ordering import Segmented, with_series_position

    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' ELSE cast(id AS string) END AS s")
    parts = Segmented(df, "s", "id", 16)
    spread = parts.ordered.df.where("s = 'hot'").groupBy(parts.bucket).count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) < 600
    placed = with_series_position(df, "s", "id", "at", buckets=16)
    want = {i: (i // 3 * 2 + i % 3 if i % 3 else 1) for i in range(3000)}
    assert {r.id: r.at for r in placed.collect()} == want
