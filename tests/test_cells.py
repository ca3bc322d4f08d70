"""Types, text, dates, numbers, outliers, validation, encodings, derived columns."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import limpid as lp
from conftest import assert_same_rows, rows, table
from limpid.functions import records as rec
from limpid.functions.dates import java_date_pattern


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def values(df):
    return [r[1] for r in sorted(rows(df), key=lambda r: r[0])]


def test_to_numeric(spark):
    texts = ["1", " 7 ", "1e3", "inf", "-Infinity", "nan", "1,200", "N/A", "", None, "1d", "2.5f", "0x10", ".5", "5.", "+3"]
    got = values(lp.to_numeric(column(spark, texts), "c"))
    assert got == [1.0, 7.0, 1000.0, math.inf, -math.inf] + [None] * 8 + [0.5, 5.0, 3.0]
    with pytest.raises(Exception, match="cannot read as a number"):
        lp.to_numeric(column(spark, ["1", "x"]), "c", errors="raise").collect()
    assert values(lp.to_numeric(column(spark, ["1", None]), "c", errors="raise")) == [1.0, None]


DATES = {
    "2021-03-15": (2021, 3, 15), "2021/3/5": (2021, 3, 5), "15/03/2021": (2021, 3, 15), "03/15/2021": (2021, 3, 15),
    "10-01-2024": (2024, 10, 1), "31-12-2024": (2024, 12, 31), "March 5, 2021": (2021, 3, 5), "Mar 5, 2021": (2021, 3, 5),
    "5 March 2021": (2021, 3, 5), "2024": (2024, 1, 1), " 2024-02-29 ": (2024, 2, 29),
}


def test_to_datetime(spark):
    got = values(lp.to_datetime(column(spark, list(DATES)), "c"))
    assert [(d.year, d.month, d.day) for d in got] == list(DATES.values())
    junk = ["32/13/2020", "not-a-date", "", None, "2023-02-29", "12345", "13-13-2020"]
    assert values(lp.to_datetime(column(spark, junk), "c")) == [None] * len(junk)
    timed = values(lp.to_datetime(column(spark, ["2021-03-15 10:20:30", "2021-03-15T10:20:30.5"]), "c"))
    assert timed == [dt.datetime(2021, 3, 15, 10, 20, 30), dt.datetime(2021, 3, 15, 10, 20, 30, 500000)]


def test_everyday_date_spellings(spark):
    when = dt.datetime
    texts = {
        "15/03/2021 10:30": when(2021, 3, 15, 10, 30), "2021/03/15 10:00": when(2021, 3, 15, 10), "2021.03.15": when(2021, 3, 15),
        "20210315": when(2021, 3, 15), "05-Mar-2021": when(2021, 3, 5), "3/5/21": when(2021, 3, 5), "March 5 2021": when(2021, 3, 5),
        "Mar 5, 2021 10:00 AM": when(2021, 3, 5, 10), "2021-03-15 12:01 AM": when(2021, 3, 15, 0, 1), "1/2/69": when(1969, 1, 2),
        "1/2/68 9:05:07.25 p.m.": when(2068, 1, 2, 21, 5, 7, 250000), "5 Sept 2020": when(2020, 9, 5), "Jan 12, 10": when(2010, 1, 12),
        "jan. 26, 69 21:55": when(1969, 1, 26, 21, 55), "50-12-6": when(2050, 12, 6), "Foo 5, 2020": None, "2024/01-05": None,
        "Foo 5, 2021": None, "12:30": None, "2021-03-15 25:00": None, "1/2/2021 13:00 PM": None, "20211301": None}
    assert values(lp.to_datetime(column(spark, list(texts)), "c")) == list(texts.values())
    swapped = column(spark, ["3/5/21", "3.5.2021 10:00", "13.5.2021 10:00", "5 May 2021"])
    assert [d.month for d in values(lp.to_datetime(swapped, "c", dayfirst=True))] == [5] * 4
    assert rows(lp.ambiguous_dates(swapped, "c")) == [("c", 2)]


def test_day_first_and_ambiguity(spark):
    df = column(spark, ["10-01-2024", "25/01/2024", "01/25/2024", "07/07/2024"])
    assert [d.month for d in values(lp.to_datetime(df, "c", dayfirst=True))] == [1, 1, 1, 7]
    assert rows(lp.ambiguous_dates(df, "c")) == [("c", 1)]


def test_convert_types(spark):
    df = spark.createDataFrame(
        [(1.0, 1.5, "1", "1.5", "true", "x", None), (2.0, None, None, "2", "False", "1", None)],
        "a double, b double, c string, d string, e string, f string, g string")
    kinds = dict(lp.convert_types(df).dtypes)
    assert kinds == {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "string", "f": "string", "g": "string"}
    kinds = dict(lp.convert_types(df, infer_text=True).dtypes)
    assert (kinds["c"], kinds["d"], kinds["e"], kinds["f"], kinds["g"]) == ("bigint", "double", "boolean", "string", "string")


TEXTS = ["  hello ", "\t tab\n", " nbsp ", "o'brien mc-donald 3rd", "ÉCOLE élan", "x", "", None]


def python(values, f):
    return [None if v is None else f(v) for v in values]


def test_text(spark):
    df = column(spark, TEXTS)
    assert values(lp.strip_whitespace(df)) == python(TEXTS, str.strip)
    for case in ("lower", "upper", "title", "capitalize"):
        assert values(lp.change_case(df, "c", case)) == python(TEXTS, getattr(str, case))
    assert values(lp.strip_whitespace(df, [])) == TEXTS
    with pytest.raises(ValueError):
        lp.change_case(df, "c", "shout")


@pytest.mark.parametrize("pattern, into", [
    (r"[aeiou]", ""), (r"(\w)(\w)", r"\2\1"), (r"(?P<first>\w)\w", r"\g<first>$"), (r"l+", r"\g<0>!"), (r"\s", "\\\\"),
])
def test_replace_text_regex(spark, pattern, into):
    df = pd.Series(["hello world", "a.b$c", "", None], dtype=object)
    want = df.str.replace(pattern, into, regex=True)
    got = values(lp.replace_text(column(spark, list(df)), "c", pattern, into))
    assert got == [None if v is None or v != v else v for v in want]


def test_replace_text_literal(spark):
    assert values(lp.replace_text(column(spark, ["a.b$1", "axb"]), "c", ".b", "$1\\", regex=False)) == ["a$1\\$1", "axb"]


def numbers(seed=0, n=300):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"i": range(n), "x": rng.normal(size=n), "y": rng.integers(0, 50, n).astype(float)})
    pdf.loc[::17, "x"] *= 30
    pdf.loc[::11, "y"] = np.nan
    pdf.loc[5, "y"] = 4000
    return pdf


def spark_numbers(spark, pdf):
    return table(spark, pdf.to_dict("list"), "i long, x double, y double")


def fences(s, factor=1.5):
    q1, q3 = np.nanpercentile(s, [25, 75])
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def test_outliers(spark):
    pdf = numbers()
    df = spark_numbers(spark, pdf)
    lo, hi = fences(pdf.x)
    (found,) = rows(lp.detect_outliers_iqr(df, "x"))
    assert found[:2] == ("x", int(((pdf.x < lo) | (pdf.x > hi)).sum()))
    assert found[2:] == pytest.approx((lo, hi))
    want = pdf.copy()
    for c in ("x", "y"):
        want[c] = want[c].clip(*fences(want[c]))
    assert_same_rows(lp.cap_outliers_iqr(df, ["x", "y"]), want, "i")
    left = pdf
    for c in ("x", "y"):
        lo, hi = fences(left[c])
        left = left[left[c].isna() | left[c].between(lo, hi)]
    assert_same_rows(lp.remove_outliers_iqr(df, ["x", "y"]), left, "i")
    z = (pdf.x - pdf.x.mean()) / pdf.x.std(ddof=0)
    assert rows(lp.detect_outliers_zscore(df, "x", 2.0)) == [("x", int((z.abs() > 2).sum()))]


def test_outliers_of_nothing(spark):
    constant = column(spark, [3.0, 3.0], "double")
    assert rows(lp.detect_outliers_zscore(constant, "c")) == [("c", 0)]
    empty = column(spark, [None], "double")
    assert rows(lp.detect_outliers_iqr(empty, "c")) == [("c", 0, None, None)]
    assert values(lp.cap_outliers_iqr(empty, "c")) == [None]
    with pytest.raises(TypeError):
        lp.detect_outliers_iqr(column(spark, ["1"]), "c")


def test_validation(spark):
    df = column(spark, ["ab1", "1ab", None, "abc"])
    assert rows(lp.validate_regex(df, "c", "[a-z]+")) == [("c", 2)]
    assert rows(lp.validate_regex(df, "c", "x|a")) == [("c", 2)]
    ints = column(spark, [-1, 0, 5, 9, None], "int")
    assert rows(lp.validate_range(ints, "c", 0, 5)) == [("c", 2)]
    clipped = lp.clip_to_range(ints, "c", 0, 5)
    assert values(clipped) == [0, 0, 5, 5, None] and dict(clipped.dtypes)["c"] == "int"
    assert values(lp.clip_to_range(ints, "c", 0.5, 5)) == [0.5, 0.5, 5.0, 5.0, None]
    assert values(lp.invalidate(ints, "c", F.col("c") >= 0)) == [None, 0, 5, 9, None]


def test_conditional(spark):
    df = column(spark, [1.0, 5.0, None, float("nan")], "double")
    for op, want in ((">", [0, 1, 0, 0]), ("<=", [1, 1, 0, 0]), ("==", [0, 1, 0, 0]), ("!=", [1, 0, 1, 1])):
        limit = 4 if op == ">" else 5
        got = [r[2] for r in sorted(rows(lp.conditional_column(df, "n", "c", op, limit, 1, 0)))]
        assert got == want, op
    mixed = lp.conditional_column(df, "n", "c", ">", 2, "big", 0)
    assert [r[2] for r in sorted(rows(mixed))] == ["0", "big", "0", "0"]
    text = column(spark, ["a", None])
    assert [r[2] for r in sorted(rows(lp.conditional_column(text, "n", "c", "!=", 3.0, 1, 0)))] == [1, 1]
    with pytest.raises(TypeError):
        lp.conditional_column(text, "n", "c", ">", 3.0, 1, 0)
    assert lp.parse_compare_value("8e1") == 80.0 and lp.parse_compare_value("HR") == "HR"


def test_math(spark):
    df = spark.createDataFrame([(1, 2, 0.5, "a"), (0, 0, 0.0, "b"), (-3, 0, None, None)], "a long, b long, d double, s string")
    assert [r[-1] for r in rows(lp.math_column(df, "n", "a", "/", "b"))] == [0.5, None, None]
    ieee = [r[-1] for r in rows(lp.math_column(df, "n", "a", "/", "b", div0="ieee"))]
    assert ieee[0] == 0.5 and math.isnan(ieee[1]) and ieee[2] == -math.inf
    assert [r[-1] for r in rows(lp.math_column(df, "n", "a", "*", "b"))] == [2, 0, 0]
    assert [r[-1] for r in rows(lp.math_column(df, "n", "a", "-", "d"))] == [0.5, 0.0, None]
    assert [r[-1] for r in rows(lp.math_column(df, "n", "s", "+", "s"))] == ["aa", "bb", None]
    with pytest.raises(TypeError):
        lp.math_column(df, "n", "s", "+", 1)


def test_maps_and_replacement(spark):
    df = spark.createDataFrame([("a", -1, -1.0), ("-1", 2, None), (None, None, 2.5)], "s string, i long, d double")
    assert [r[0] for r in rows(lp.apply_map(df, "s", {"a": "A"}))] == ["A", None, None]
    big = spark.createDataFrame([("a", 10), ("z", 11)], "k string, v int")
    assert sorted(rows(lp.apply_map(df, "s", big, "m").select("s", "m")), key=str) == [("-1", None), ("a", 10), (None, None)]
    many = {str(i): i for i in range(-1500, 1500)}
    assert sorted(rows(lp.apply_map(df, "s", many).select("s")), key=str) == [(-1,), (None,), (None,)]
    assert rows(lp.replace_values(df, -1, None)) == [("a", None, None), ("-1", 2, None), (None, None, 2.5)]
    assert rows(lp.replace_values(df, "a", 0))[0] == ("0", -1, -1.0)
    assert rows(lp.replace_values(df, None, "gap"))[2] == ("gap", None, 2.5)
    assert rows(lp.replace_values(df, float("nan"), 0))[2] == (None, 0, 2.5)
    with pytest.raises(TypeError):
        lp.replace_values(df, -1, "minus")


def test_one_hot(spark):
    pdf = pd.DataFrame({"i": [1, 2, 3, 4], "s": ["b", "a", None, "b"], "t": ["x", "y", "y", "x"]})
    df = table(spark, pdf.to_dict("list"), "i long, s string, t string")
    assert_same_rows(lp.one_hot_encode(df, ["s", "t"]), pd.get_dummies(pdf, columns=["s", "t"], dtype=int), "i")
    with pytest.raises(ValueError, match="more than 1"):
        lp.one_hot_encode(df, "s", max_values=1)
    assert "s_a" in lp.OneHot.fit(df, "s").apply(df.where("i = 1")).columns


def test_date_parts_and_formats(spark):
    df = lp.to_datetime(column(spark, ["2024-02-29 13:05:09", "2023-01-01", None]), "c")
    got = sorted(rows(lp.extract_date_parts(df, "c").drop("c")))
    assert got == [(0, 2024, 2, 29, 3), (1, 2023, 1, 1, 6), (2, None, None, None, None)]
    fmt = "%d/%m/%Y it's %H:%M:%S %A %a %B %b %j %y %I%p %%"
    want = [d.strftime(fmt) for d in (dt.datetime(2024, 2, 29, 13, 5, 9), dt.datetime(2023, 1, 1))] + [None]
    assert values(lp.format_dates(df, "c", fmt)) == want
    with pytest.raises(ValueError):
        java_date_pattern("%Q")
    with pytest.raises(TypeError):
        lp.extract_date_parts(column(spark, ["x"]), "c")


def test_record_fields(spark):
    phones = {"+91-98765 43210": "+91-9876543210", "09876543210": "+91-9876543210", "9876543210": "+91-9876543210",
              "12345": None, "9876543210123": None, "": None, None: None, "919876543210": "+91-9876543210"}
    df = column(spark, list(phones))
    assert values(df.select("i", rec.phone(F.col("c")))) == list(phones.values())
    emails = {" A.B@Example.com ": "a.b@example.com", "not-an-email": None, "user@.com": "user@.com", "user@example": None,
              "user @example.com": None, None: None}
    df = column(spark, list(emails))
    got = values(df.select("i", rec.email(F.col("c"))))
    assert got[:2] == ["a.b@example.com", None] and got[3:] == [None, None, None]
    df = column(spark, [" Hr", "HR", "other", None])
    assert values(df.select("i", rec.category(F.col("c"), {"hr": "HR"}))) == ["HR", "HR", "Unknown", "Unknown"]
    assert values(df.select("i", rec.category(F.col("c"), {"hr": "HR"}, None))) == ["HR", "HR", None, None]
