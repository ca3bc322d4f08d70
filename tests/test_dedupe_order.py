from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

import limpid as lp
from conftest import assert_same_rows, rows, table
from limpid.operators import rank


def frame(n=300, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": rng.permutation(n), "g": rng.choice(["hot", "hot", "b", None], n), "v": rng.integers(0, 6, n) / 2})
    pdf.loc[rng.random(n) < 0.2, "v"] = np.nan
    return pdf


def spark_of(spark, pdf):
    return table(spark, pdf.to_dict("list"), "id long, g string, v double", 4)


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_subset_duplicates(spark, keep):
    pdf = frame()
    want = pdf.sort_values("id").drop_duplicates(["g", "v"], keep=keep)
    assert_same_rows(lp.drop_duplicates(spark_of(spark, pdf), ["g", "v"], keep, order_by="id"), want, "id")


def test_long_texts_are_told_apart(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, None), (5, None)], "id long, t string")
    assert sorted(r[0] for r in rows(lp.drop_duplicates(df, "t", order_by="id"))) == [1, 2, 4]
    assert rows(lp.duplicate_count(df.select("t"))) == [(2,)]
    assert rows(lp.unique_counts(df.select("t"))) == [("t", 2)]


def test_whole_row_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.0), (3, float("nan")), (3, None)], "a long, b double")
    assert sorted(rows(lp.drop_duplicates(df))) == [(1, None), (2, 1.0), (3, None)]
    assert rows(lp.drop_duplicates(df, keep=False)) == [(2, 1.0)]
    assert rows(lp.duplicate_count(df)) == [(2,)]
    assert rows(lp.duplicate_count(df.where("false"))) == [(0,)]
    with pytest.raises(ValueError, match="unknown"):
        lp.drop_duplicates(df, "nope")


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("buckets", [1, 4, 30])
def test_rank(spark, ascending, buckets):
    pdf = frame(seed=1)
    want = pdf.copy()
    want["v_Rank"] = want["v"].rank(ascending=ascending)
    assert_same_rows(lp.add_rank(spark_of(spark, pdf), "v", ascending=ascending, buckets=buckets), want, "id")


def test_rank_of_text_into_the_same_column(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id long, s string")
    got = dict(rows(lp.add_rank(df, "s", "s", ascending=True).select("id", "s")))
    assert got == {1: 2.5, 2: 1.0, 3: None, 4: 2.5}


def test_sort_puts_missing_last_both_ways(spark):
    pdf = frame(80)
    for ascending in ([True, True], [True, False], [False, False]):
        got = [r[0] for r in rows(lp.sort_values(spark_of(spark, pdf), ["g", "v"], ascending, order_by="id"))]
        want = pdf.sort_values("id").sort_values(["g", "v"], ascending=ascending, kind="stable")["id"]
        assert got == list(want)
    unkeyed = [r[2] for r in rows(lp.sort_values(spark_of(spark, pdf), "v")) if r[2] == r[2] and r[2] is not None]
    assert unkeyed == sorted(pdf["v"].dropna())


@pytest.mark.parametrize("heap", [100_000, 3])
@pytest.mark.parametrize("largest", [True, False])
def test_top_n(spark, monkeypatch, heap, largest):
    monkeypatch.setattr(rank, "HEAP_ROWS", heap)
    pdf = frame(120, 2).sort_values("id")
    pick = pdf.nlargest if largest else pdf.nsmallest
    for n in (1, 10, 110):
        want = list(pick(n, "v")["id"])
        want += [i for i in pdf["id"][pdf["v"].isna()] if i not in want][: n - len(want)]
        got = [r[0] for r in rows(lp.top_n(spark_of(spark, pdf), "v", n, largest, order_by="id"))]
        assert sorted(got) == sorted(want)
    with pytest.raises(TypeError):
        lp.top_n(spark_of(spark, pdf), "g", 3, order_by="id")


@pytest.mark.parametrize("heap", [100_000, 3])
def test_sample_is_exact_and_stable(spark, monkeypatch, heap):
    monkeypatch.setattr(rank, "HEAP_ROWS", heap)
    pdf = frame()
    one = {r[0] for r in rows(lp.sample_rows(spark_of(spark, pdf), 20, 1, order_by="id"))}
    two = {r[0] for r in rows(lp.sample_rows(spark_of(spark, pdf).repartition(9), 20, 1, order_by="id"))}
    other = {r[0] for r in rows(lp.sample_rows(spark_of(spark, pdf), 20, 2, order_by="id"))}
    assert len(one) == 20 and one == two and one != other
    with pytest.raises(ValueError):
        lp.sample_rows(spark_of(spark, pdf), 301, order_by="id")


@pytest.mark.parametrize("small", [100_000, 1])
def test_label_encode(spark, small):
    pdf = frame(200, 3).sort_values("id")
    want = pdf.copy()
    for c in ("g", "v"):
        want[c] = pd.factorize(want[c])[0]
    assert_same_rows(lp.label_encode(spark_of(spark, pdf), ["g", "v"], order_by="id", small=small), want, "id")


def test_label_encode_with_a_composite_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (0, 9, "c"), (2, 0, "a")], "x long, y long, s string")
    got = {(r[0], r[1]): r[2] for r in rows(lp.label_encode(df, "s", order_by=["x", "y"]))}
    assert got == {(0, 9): 0, (1, 1): 1, (1, 2): 2, (2, 0): 1}


def test_only_suspects_are_grouped(spark):
    import random
    r = random.Random(3)
    rows = [(n, r.choice([None, 0.0, -0.0, float("nan"), 1.5, 2.5]), r.choice([None, "", "x" * 80, "y"]), r.randint(0, 400)) for n in range(400)]
    rows += [(1000 + n, None, "hot", 1) for n in range(200)] + rows[:30]
    df = spark.createDataFrame(rows, "id long, a double, s string, k int").repartition(5)
    for subset in (["a", "s"], ["k"], "s", ["s", "k", "a"]):
        for keep in ("first", "last", False):
            plain, split = (lp.drop_duplicates(df.dropDuplicates(["id"]), subset, keep, order_by="id", suspects_only=s) for s in (False, True))
            assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect())), (subset, keep)
    for keep in ("first", False):
        plain, split = (lp.drop_duplicates(df, keep=keep, suspects_only=s) for s in (False, True))
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect()))
    assert lp.drop_duplicates(df.where("false"), suspects_only=True).count() == 0
    with pytest.raises(ValueError):
        lp.drop_duplicates(df, "k", "some", suspects_only=True)


def test_rows_that_are_alone_are_not_shuffled(spark):
    from limpid.operators.dedupe import split_repeated
    df = spark.range(20_000).selectExpr("id", "concat('row ', id) AS s").union(spark.range(50).selectExpr("id", "concat('row ', id) AS s"))
    alone, others = split_repeated(df, ["id", "s"])
    assert others.count() < 120 and alone.count() + others.count() == 20_050
    assert others.groupBy("id", "s").count().where("count = 2").count() == 50
    plan = alone._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanged and not any("s#" in line for line in exchanged)
