"""A chain on another table: learned values stay, sizes, hot keys and row checks are looked at anew."""

import pytest

import limpid as lp
from limpid.operators import aggregate
from limpid.plans import joins


def rows(df):
    return [tuple(r) for r in df.collect()]


def letters(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, s string")


def test_label_codes_are_those_of_the_fitted_table(spark):
    chain = lp.Chain(letters(spark, ["x", "y", None]), order_by="id").label_encode("s")
    assert sorted(rows(chain.df)) == [(0, 0), (1, 1), (2, -1)]
    other = chain.apply_to(letters(spark, ["y", "new", "x", None]))
    assert sorted(rows(other)) == [(0, 1), (1, -1), (2, 0), (3, -1)]


def test_label_codes_apply_to_a_table_with_many_values(spark):
    chain = lp.Chain(letters(spark, ["v7", "v3"]), order_by="id").label_encode("s")
    many = spark.range(3000).selectExpr("id", "concat('v', id) s")
    known = chain.apply_to(many).where("s >= 0")
    assert sorted(rows(known)) == [(3, 1), (7, 0)]


def test_sample_is_checked_against_each_table(spark):
    chain = lp.Chain(spark.range(100).toDF("id"), order_by="id").sample_rows(50)
    assert chain.apply_to(spark.range(60).toDF("id")).count() == 50
    with pytest.raises(ValueError, match="cannot sample"):
        chain.apply_to(spark.range(10).toDF("id"))


@pytest.mark.parametrize("fitted_small", [True, False])
def test_median_across_the_size_limit(spark, monkeypatch, fitted_small):
    df = spark.range(60).selectExpr("id", "id % 3 g", "cast(id * id as double) v")
    monkeypatch.setattr(aggregate, "is_small", lambda table: fitted_small)
    chain = lp.Chain(df).groupby_aggregate("g", "v", "median")
    expected = sorted(rows(lp.Chain(df.where("id < 40")).groupby_aggregate("g", "v", "median").df))
    monkeypatch.setattr(aggregate, "is_small", lambda table: not fitted_small)
    assert sorted(rows(chain.apply_to(df.where("id < 40")))) == expected


@pytest.mark.parametrize("limits", [(1 << 60, -1), (-1, 1 << 60)])
def test_outer_join_across_the_size_limit(spark, monkeypatch, limits):
    left = spark.range(50).selectExpr("id % 2 k", "id a")
    right = spark.range(30).selectExpr("id % 3 k", "id b")
    monkeypatch.setattr(joins, "SKEW_CHECK_BYTES", limits[0])
    chain = lp.Chain(left).fill_missing_statistic("mean", "a").merge_with(right, "k", "outer")
    part = left.where("a < 20")
    expected = sorted(rows(lp.Chain(part).fill_missing_statistic("mean", "a").merge_with(right, "k", "outer").df))
    monkeypatch.setattr(joins, "SKEW_CHECK_BYTES", limits[1])
    assert sorted(rows(chain.apply_to(part))) == expected
