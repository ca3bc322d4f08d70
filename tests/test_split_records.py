"""Files whose records span lines, read in splits, against the reading in one task."""

from __future__ import annotations

import csv
import json
import random

import pytest

import limpid as lp
from limpid.sources.split_records import csv_records, json_records

CELLS = ["", "plain", "a,b", 'say "x"', "two\nlines", "\n", "\n\n", '"', '""', 'end"\n', "é, ü", " padded ", "x\r\ny", "N/A", "7", "{}", "}{"]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def table(seed, n=150):
    r = random.Random(seed)
    return [[str(k), *(r.choice(CELLS) * r.choice([1, 1, 1, 40]) for _ in range(3))] for k in range(n)]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_in_splits_equals_csv_in_one_task(spark, tmp_path, small_splits, ending):
    for seed in range(3):
        with open(f"{tmp_path}/{seed}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=ending)
            out.writerows([["id", "a b", "c", "d"], *table(seed)])
    path = [f"{tmp_path}/{seed}.csv" for seed in range(3)]
    whole, split = (lp.read_text_table(spark, path, split=s) for s in (False, True))
    assert split.columns == whole.columns
    if ending == "\n":  # the other reading turns the line breaks of cells into plain ones as well
        assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert spark.read.text(path[0]).rdd.getNumPartitions() > 5
    want = {(str(k), a, b, c) for k, a, b, c in table(0)}
    plain = lp.read_csv(spark, path[0], split=True, infer=False, missing_markers=None)
    assert {tuple("" if v is None else v for v in r) for r in plain.collect()} == want


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    long = "line of text, with \"quotes\"\n" * 200
    with open(f"{tmp_path}/a.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["k", "t"], ["1", long], ["2", "x"], ["3", long + "end"]])
    assert csv_records(spark, f"{tmp_path}/a.csv").select("block").distinct().count() >= 2
    assert {r.k: r.t for r in lp.read_csv(spark, f"{tmp_path}/a.csv", split=True, schema="k long, t string").collect()} == {
        1: long, 2: "x", 3: long + "end"}
    with open(f"{tmp_path}/head.csv", "w") as f:
        f.write("k,t\n")
    assert lp.read_csv(spark, f"{tmp_path}/head.csv", split=True, schema="k long, t string").count() == 0


def test_typed_csv_in_splits(spark, tmp_path, small_splits):
    df = spark.range(300).selectExpr("id", "id / 7 AS x", "CASE WHEN id % 5 = 0 THEN 'N/A' ELSE concat('v', id) END AS s")
    lp.write_csv(df.coalesce(1), f"{tmp_path}/t")
    whole, split = (lp.read_csv(spark, f"{tmp_path}/t", split=s) for s in (False, True))
    assert split.dtypes == whole.dtypes
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


RECORDS = [{"id": k, "t": t * n, "n": None if k % 3 else k / 2, "in": {"a": [k, {"b": "}"}], "t": t}}
           for k, (t, n) in enumerate((t, n) for t in [*CELLS, '\\"', "\\", "\\\\", 'a"}', "[{", "]", '{"x": "}"}', "\t"] for n in (1, 30))]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_in_splits(spark, tmp_path, small_splits, indent):
    for name, part in (("a", RECORDS), ("b", RECORDS[:7]), ("c", []), ("d", RECORDS[3:4])):
        with open(f"{tmp_path}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(part, f, indent=indent, ensure_ascii=indent is None)
    path = [f"{tmp_path}/{n}.json" for n in "abcd"]
    columns = ["id", "t", "n"]
    whole, split = (lp.read_json(spark, path, columns=columns, infer=False, split=s) for s in (False, True))
    assert split.columns == columns
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    texts = [json.loads(r.text) for r in json_records(spark, path[0]).collect()]
    assert sorted(texts, key=lambda t: t["id"]) == RECORDS
    assert json_records(spark, path[0]).select("block").distinct().count() > 5
    assert lp.read_json(spark, path[0], schema="id long, n double", split=True).where("id = 6").first().n == 3.0
    with pytest.raises(ValueError):
        lp.read_json(spark, path[0], split=True)


def test_split_rows_know_their_order(spark, tmp_path, small_splits):
    rows = [[str(n), "two\nlines " * (n % 4), str(n / 4)] for n in range(400)]
    with open(f"{tmp_path}/a.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["k", "t", "x"], *rows])
    read = lp.read_csv(spark, f"{tmp_path}/a.csv", split=True, file_order=True)
    assert read.columns == ["k", "t", "x", *lp.FILE_ORDER]
    assert [r.k for r in read.orderBy(*lp.FILE_ORDER).collect()] == list(range(400))
    typed = lp.read_csv(spark, f"{tmp_path}/a.csv", split=True, file_order=True, schema="k long")
    assert typed.columns == ["k", *lp.FILE_ORDER]
    with open(f"{tmp_path}/a.json", "w") as f:
        json.dump([{"k": k, "t": t} for k, t, _ in rows], f)
    back = lp.read_json(spark, f"{tmp_path}/a.json", split=True, file_order=True, schema="k long, t string")
    assert [r.k for r in back.orderBy(*lp.FILE_ORDER).collect()] == list(range(400))
    with pytest.raises(ValueError):
        lp.read_csv(spark, f"{tmp_path}/a.csv", file_order=True)
