"""Select, group, pivot, join, stack, melt, transpose, profile, compare."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

import limpid as lp
from conftest import assert_same_rows, rows, table
from limpid.functions.columns import UnknownColumnError, resolve
from limpid.plans import joins


def people(seed=0, n=200):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": range(n), "g": rng.choice(["a", "b", "c", None], n), "h": rng.choice(["x", "y"], n),
                        "v": rng.normal(size=n).round(3)})
    pdf.loc[rng.random(n) < 0.3, "v"] = np.nan
    return pdf


SCHEMA = "id long, g string, h string, v double"


def spark_of(spark, pdf):
    return table(spark, pdf.to_dict("list"), SCHEMA)


def test_column_operators(spark):
    df = spark_of(spark, people())
    assert lp.select_columns(df, ["v", "id"]).columns == ["v", "id"]
    assert lp.drop_columns(df, "g").columns == ["id", "h", "v"]
    assert lp.rename_columns(df, {"g": "group", "zz": "q"}).columns == ["id", "group", "h", "v"]
    for bad in (lambda: lp.select_columns(df, ["zz"]), lambda: lp.drop_columns(df, ["g", "zz"])):
        with pytest.raises(UnknownColumnError):
            bad()
    assert resolve(df, ["v", "zz", "g"], numeric=True) == ["v"]
    assert resolve(df, []) == [] and resolve(df, "zz") == []


def test_odd_names(spark):
    df = spark.createDataFrame([(1, None, "q"), (2, 3.0, "q")], "`a.b` long, `my col` double, `t``k` string")
    assert lp.missing_summary(df).collect()[0][0] == "my col"
    assert lp.fill_missing_ffill(df, order_by="a.b").count() == 2
    assert lp.add_rank(df, "a.b").columns[-1] == "a.b_Rank"
    assert lp.drop_duplicates(df, "t`k", order_by="a.b").collect()[0][0] == 1
    assert lp.melt(df, "a.b").select("variable").distinct().count() == 2
    assert lp.unique_value_counts(df, "a.b").count() == 2


@pytest.mark.parametrize("func", ["mean", "sum", "count", "min", "max", "std", "median"])
def test_groups_and_pivots(spark, func):
    pdf = people(1)
    pdf.loc[pdf.g == "c", "v"] = np.nan
    df = spark_of(spark, pdf)
    want = pdf.groupby(["g", "h"])["v"].agg(func).reset_index().rename(columns={"v": f"v_{func}"})
    assert_same_rows(lp.groupby_aggregate(df, ["g", "h"], "v", func), want, ["g", "h"])
    want = pdf.pivot_table(index="g", columns="h", values="v", aggfunc=func).reset_index()
    assert_same_rows(lp.pivot(df, "g", "h", "v", func), want, "g")


def test_group_target_is_coerced(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), ("a", "3"), (None, "9")], "g string, v string")
    assert rows(lp.groupby_aggregate(df, "g", "v", "sum")) == [("a", 4.0)]
    with pytest.raises(TypeError):
        lp.pivot(df, "g", "g", "v", "mean")
    with pytest.raises(ValueError):
        lp.groupby_aggregate(df, "g", "v", "mad")
    with pytest.raises(ValueError, match="more than 1"):
        lp.pivot(df, "g", "v", "v", "count", max_values=1)


def test_pivot_label_types(spark):
    df = spark.createDataFrame([("r", True, 1.5, 1), ("r", False, 2.0, 2)], "r string, b boolean, d double, v long")
    assert lp.pivot(df, "r", "b", "v", "sum").columns == ["r", "False", "True"]
    assert lp.pivot(df, "r", "d", "v", "sum").columns == ["r", "1.5", "2.0"]
    assert rows(lp.pivot(df, "r", "d", "v", "sum", labels=[2.0, 7.0])) == [("r", 2, None)]


def test_value_counts(spark):
    pdf = people()
    got = dict(rows(lp.unique_value_counts(spark_of(spark, pdf), "g")))
    assert got == pdf.g.value_counts().to_dict()


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("split", [None, True])
def test_merge(spark, how, split):
    left = pd.DataFrame({"k": ["a", "a", "b", None, "z"], "v": [1, 2, 3, 4, 5], "l": [0] * 5})
    right = pd.DataFrame({"k": ["a", "b", "b", None, None, "q"], "v": [10, 20, 30, 40, 50, 60]})
    l, r = (table(spark, p.to_dict("list"), s) for p, s in (
        (left, "k string, v long, l long"), (right, "k string, v long")))
    got = lp.merge_with(l, r, "k", how, split_outer=split)
    assert_same_rows(got, left.merge(right, on="k", how=how), ["k", "v_x", "v_y"])


def test_merge_checks(spark):
    a, b = spark.createDataFrame([(1,)], "k long"), spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError):
        lp.merge_with(a, b, "k")
    with pytest.raises(ValueError):
        lp.merge_with(a, a, "k", "cross")
    both = spark.createDataFrame([(float("nan"), 1), (None, 2)], "k double, v int")
    assert lp.merge_with(both, both, "k").count() == 4


def test_hot_keys_are_noticed(spark, monkeypatch):
    hot = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    even = spark.range(3000).selectExpr("id AS k", "id * 2 AS w")
    assert joins.has_hot_key(hot, ["k"]) and not joins.has_hot_key(even, ["k"])
    monkeypatch.setattr(joins, "SKEW_CHECK_BYTES", 0)
    got = lp.merge_with(even, hot, "k", "left")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftOuter" not in plan
    assert got.count() == even.join(hot, "k", "left").count()


def test_concat(spark):
    a = pd.DataFrame({"i": [1, 2], "x": ["p", "q"], "m": [1, 2]})
    b = pd.DataFrame({"i": [3], "y": [0.5], "m": ["t"]})
    got = lp.concat_with(table(spark, a.to_dict("list"), "i long, x string, m long"),
                         table(spark, b.to_dict("list"), "i long, y double, m string"))
    assert got.columns == ["i", "x", "m", "y"]
    assert sorted(rows(got), key=lambda r: r[0]) == [(1, "p", "1", None), (2, "q", "2", None), (3, None, "t", 0.5)]
    left, right = (spark.createDataFrame([(1, "a"), (2, "b")], f"i long, {n} string") for n in "pq")
    assert sorted(rows(lp.concat_with(left, right.where("i = 2"), 1, on="i")), key=str) == [(1, "a", None), (2, "b", "b")]
    with pytest.raises(ValueError):
        lp.concat_with(left, right, 1)


def test_melt_and_transpose(spark):
    pdf = pd.DataFrame({"id": [1, 2], "a": [1.0, None], "b": [3.0, 4.0]})
    df = table(spark, pdf.to_dict("list"), "id long, a double, b double")
    assert_same_rows(lp.melt(df, "id"), pdf.melt(id_vars="id"), ["id", "variable"])
    mixed = spark.createDataFrame([(1, 2, "t")], "id long, n long, s string")
    assert sorted(rows(lp.melt(mixed, "id"))) == [(1, "n", "2"), (1, "s", "t")]
    flipped = lp.transpose(lp.numeric_summary(df), "column")
    assert flipped.columns == ["index", "a", "b", "id"] and flipped.count() == 5
    with pytest.raises(ValueError):
        lp.transpose(df, "id", max_rows=1)


def test_filter(spark):
    df = spark.createDataFrame([(1, "IT"), (5, None), (9, "HR")], "`my age` int, d string")
    assert lp.filter_query(df, "`my age` > 3 and not (d <=> 'HR')").count() == 1
    assert lp.filter_query(df, "d not in ('HR')").count() == 1


def test_profile(spark):
    pdf = people(2)
    df = spark_of(spark, pdf)
    assert rows(lp.basic_info(df)) == [(200, 4, 800, 2)]
    gaps = pdf.isna().sum()
    assert dict(rows(lp.missing_summary(df))) == gaps[gaps > 0].to_dict()
    share = (gaps / len(pdf) * 100).round(2)
    assert dict(rows(lp.missing_percent(df))) == pytest.approx(share[share > 0].to_dict())
    assert dict(rows(lp.unique_counts(df))) == pdf.nunique().to_dict()
    assert dict(rows(lp.unique_counts(df, approximate=0.01)))["g"] == 3
    for column, mean, median, std, low, high in rows(lp.numeric_summary(df)):
        s = pdf[column]
        assert (mean, median, std, low, high) == pytest.approx((s.mean(), s.median(), s.std(ddof=0), s.min(), s.max()))
    described = {r["column"]: r for r in lp.describe(df).collect()}
    want = pdf.describe(include="all")
    for c in ("id", "v"):
        got = described[c]
        names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
        assert [got[n] for n in names] == pytest.approx([want[c][n] for n in names.values()])
    counts = pdf.g.value_counts()
    assert described["g"]["unique"] == 3 and described["g"]["freq"] == counts.iloc[0]
    assert described["g"]["top"] in counts.index[counts == counts.iloc[0]]


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a long, s string")
    assert rows(lp.basic_info(df)) == [(0, 2, 0, 2)]
    assert rows(lp.missing_percent(df)) == []
    assert sorted(rows(lp.unique_counts(df))) == [("a", 0), ("s", 0)]
    assert rows(lp.numeric_summary(df)) == [("a", None, None, None, None, None)]
    assert lp.describe(df).count() == 2
    assert any("rows=0" in line for line in lp.report_text(lp.full_report(df), df.columns))


def test_report(spark):
    df = spark_of(spark, people(3))
    text = "\n".join(lp.report_text(lp.full_report(df), df.columns))
    for part in ("[shape]", "rows=200", "[missing]", "[duplicates]", "duplicate_rows=0", "mean="):
        assert part in text


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(8)
    before, after = rng.integers(0, 100, 500) / 5.0, rng.integers(0, 60, 400) / 5.0
    got = lp.histogram_comparison(table(spark, {"x": before}, "x double"), table(spark, {"x": after}, "x double"), "x")
    edges = np.histogram_bin_edges(np.concatenate([before, after]), bins=20)
    for side, data in (("before", before), ("after", after)):
        counts = [r["count"] for r in got.where(f"side = '{side}'").orderBy("bin").collect()]
        assert counts == list(np.histogram(data, bins=edges)[0])
    one = spark.createDataFrame([(4.0,)], "x double")
    flat = lp.histogram_comparison(one, one, "x").where("count > 0").collect()
    assert [(r["lower"], r["upper"]) for r in flat] == [(4.0, 4.05)] * 2
    none = spark.createDataFrame([("t",)], "x string")
    assert lp.histogram_comparison(none, none, "x").agg({"upper": "max", "count": "sum"}).collect()[0][1] in (0, 1.0)


def test_boxplot(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["side"]: r for r in lp.boxplot_comparison(df, df.where("x < 50"), "x").collect()}
    assert tuple(got["before"])[1:] == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert got["after"]["n_fliers"] == 0
    assert rows(lp.boxplot_fliers(df, "x")) == [(100.0,)]
    assert lp.boxplot_comparison(df.where("x > 1000"), df, "x").collect()[0]["q1"] is None


def test_correlation(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=100), "c": [2.0] * 100})
    pdf["b"] = pdf.a * 2 + rng.normal(size=100)
    pdf.loc[::7, "b"] = np.nan
    got = {(a, b): r for a, b, r in rows(lp.correlation_matrix(table(spark, pdf.to_dict("list"), "a double, c double, b double")))}
    want = pdf.corr()
    assert len(got) == 9
    for (a, b), r in got.items():
        assert (r is None) if "c" in (a, b) else r == pytest.approx(want.loc[a, b])
    assert rows(lp.correlation_matrix(spark.createDataFrame([(1, "x")], "a int, s string"))) == []


def test_breakdown_and_plottable(spark):
    df = spark.createDataFrame([(1, "x", True, "7")], "a int, s string, b boolean, n string").selectExpr("*", "current_date() AS d")
    assert dict(rows(lp.dtype_breakdown(df))) == {"numeric": 1, "text/categorical": 2, "boolean": 1, "datetime": 1}
    assert rows(lp.is_plottable(df, "n")) == [("n", True)] and rows(lp.is_plottable(df, "s")) == [("s", False)]


def test_before_after(spark):
    before = spark.createDataFrame([(1, None), (1, None), (2, 5)], "a long, b long")
    got = {(m, c): (x, y) for m, c, x, y in rows(lp.before_after(before, lp.drop_missing(before).drop("a")))}
    assert got == {("rows", None): (3, 1), ("duplicate_rows", None): (1, 0), ("missing", "a"): (0, None), ("missing", "b"): (2, 0)}


def test_many_columns_share_one_matrix_of_moments(spark):
    rng = np.random.default_rng(11)
    size, n = 200, 120
    values = rng.normal(size=(n, size)) * rng.choice([1e-6, 1.0, 1e9], size) + rng.choice([0.0, 5.0, 1e6], size)
    values[rng.random((n, size)) < 0.2] = np.nan
    values[:, 3], values[:, 4], values[:, 5] = 7.25, np.nan, values[:, 6] * 2 + 1
    pdf = pd.DataFrame(values, columns=[f"c{i}" for i in range(size)])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), ", ".join(f"c{i} double" for i in range(size)))
    got = {(r.column_a, r.column_b): r.corr for r in lp.correlation_matrix(df.repartition(4)).collect()}
    assert len(got) == size * size
    exact = values.astype(np.longdouble)  # pandas itself is off by 5e-6 where an offset is 10^12 deviations
    for i in range(size):
        for j in range(i, size):
            both = ~np.isnan(values[:, i]) & ~np.isnan(values[:, j])
            x, y = (exact[both, k] - (exact[both, k].mean() if both.any() else 0) for k in (i, j))
            spread = np.sqrt((x * x).sum() * (y * y).sum())
            w = float((x * y).sum() / spread) if spread else None
            a, b = got[f"c{i}", f"c{j}"], got[f"c{j}", f"c{i}"]
            assert a == b and (a is None) == (w is None) and (w is None or abs(a - w) < 1e-9), (i, j, a, w)
    # the paired aggregates lose digits where an offset is that large, so columns without one are compared
    plain = [f"c{i}" for i in range(7, size) if np.nanstd(values[:, i]) > 1e-3 * abs(np.nanmean(values[:, i]))]
    few = df.select("c3", "c4", *plain[:4])
    one, two = ({(r.column_a, r.column_b): r.corr for r in lp.correlation_matrix(few, paired=p).collect()} for p in (0, 9))
    assert all((one[k] is None) == (two[k] is None) and (one[k] is None or abs(one[k] - two[k]) < 1e-9) for k in two)
    assert {r.corr for r in lp.correlation_matrix(few.where("false"), paired=0).collect()} == {None}


def test_distinct_counts_of_whole_numbers_by_marks(spark):
    import datetime
    edge = [0, -1, 63, 64, -64, -65, 2**63 - 1, -2**63, 7, 7, None]
    df = spark.createDataFrame([(v, None if v is None else max(min(v, 127), -128), datetime.date(1970, 1, 1) + datetime.timedelta(days=(v or 0) % 999),
                                 str(v)) for v in edge], "a long, b byte, d date, s string")
    got = {r.column: r.n_unique for r in lp.unique_counts(df).collect()}
    rows = df.collect()
    assert got == {c: len({r[c] for r in rows} - {None}) for c in df.columns}
    wide = spark.range(50_000).selectExpr("id", "id % 1000 AS k")
    from limpid.plans.frequencies import _marked_words
    assert {r.column: r.n_unique for r in _marked_words(wide, ["id", "k"]).collect()} == {"id": 50_000, "k": 1000}


def test_one_pass_of_labels_keeps_its_limit(spark):
    df = spark.createDataFrame([(n % 5, f"v{n % 3}", n) for n in range(60)] + [(None, None, 60)], "a int, b string, c int")
    assert lp.OneHot.fit(df, ["a", "b"]).values == {"a": (0, 1, 2, 3, 4), "b": ("v0", "v1", "v2")}
    with pytest.raises(ValueError, match="'c' has more than 10"):
        lp.OneHot.fit(df, ["a", "b", "c"], 10)
    assert lp.OneHot.fit(df.where("false"), ["a", "b"]).values == {"a": (), "b": ()}


def test_a_profile_of_parts_is_that_of_the_whole(spark, tmp_path):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.integers(0, 40, 300), "x": rng.normal(1e6, 3, 300).round(2), "s": rng.choice(["a", "b", "long " * 30], 300)})
    pdf.loc[rng.random(300) < 0.2, "x"] = np.nan
    pdf["s"] = pdf["s"].astype(object).where(rng.random(300) < 0.8, None)
    df = table(spark, {**pdf.to_dict("list"), "e": [None] * 300}, "k long, x double, s string, e int")
    state = lp.ProfileState(spark, f"{tmp_path}/state")
    with pytest.raises(ValueError):
        state.report()
    for part in (df.where("k < 3"), df.where("k >= 3 AND k < 30"), df.where("k >= 30"), df.where("false")):
        state.add(part)
    assert len(state.parts()) == 4

    def values(report):
        out = {}
        for r in report.collect():
            number = r.section == "numeric" and r.value is not None
            out[r.section, r.column, r.metric] = round(float(r.value), 6) if number else r.value
        return out
    assert values(state.report()) == values(lp.full_report(df))
    state.add(df.select("k", "x", df["k"].cast("string").alias("s"), "e").limit(0))
    lp.ProfileState(spark, f"{tmp_path}/state").add(df.select(df["k"].cast("string").alias("k"), "x", "s", "e"))
    with pytest.raises(TypeError):
        state.report()
