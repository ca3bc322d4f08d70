"""Select, filter, derive, group, pivot, join, encode."""

from __future__ import annotations

import limpid as lp
from pyspark.sql import functions as F

from workload.base import DIRTY_ORDERS_CTE, dirty_orders, table

DIRTY = f"WITH {DIRTY_ORDERS_CTE} "
ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

AGGREGATES = {
    "mean": "avg(o_totalprice)", "sum": "coalesce(sum(o_totalprice), 0)", "count": "count(o_totalprice)",
    "min": "min(o_totalprice)", "max": "max(o_totalprice)", "std": "stddev_samp(o_totalprice)",
    "median": "median(o_totalprice)",
}


def _group(func, **options):
    name = f"o_totalprice_{func}"

    def run(spark, sf):
        out = lp.groupby_aggregate(dirty_orders(spark, sf), ["o_orderstatus", "o_orderpriority"], "o_totalprice", func, **options)
        return out if func == "count" else out.withColumn(name, F.round(name, 3))

    value = AGGREGATES[func] if func == "count" else f"round({AGGREGATES[func]}, 3)"
    return run, (DIRTY + f"SELECT o_orderstatus, o_orderpriority, {value} AS {name} FROM dirty_orders "
                 "WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2")


def _pivot(func):
    def run(spark, sf):
        out = lp.pivot(dirty_orders(spark, sf), "o_orderpriority", "o_orderstatus", "o_totalprice", func)
        return out if func == "count" else out.withColumns({s: F.round(s, 3) for s in STATUSES})

    cells = ", ".join(
        (f"max(CASE WHEN o_orderstatus = '{s}' THEN v END) AS {s}" if func == "count" else
         f"round(max(CASE WHEN o_orderstatus = '{s}' THEN v END), 3) AS {s}") for s in STATUSES)
    return run, (DIRTY + f"SELECT o_orderpriority, {cells} FROM (SELECT o_orderpriority, o_orderstatus, {AGGREGATES[func]} AS v "
                 "FROM dirty_orders WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2) WHERE v IS NOT NULL GROUP BY 1")


def customers(spark, sf):
    """Customers under the order's key name, one of them without a key, names that clash with orders."""
    return table(spark, sf, "customer").selectExpr(
        "CASE WHEN c_custkey = 7 THEN NULL ELSE c_custkey * 2 END AS o_custkey",
        "c_acctbal AS o_totalprice", "c_mktsegment")


CUSTOMERS = ("customers AS (SELECT CASE WHEN c_custkey = 7 THEN NULL ELSE c_custkey * 2 END AS "
             "o_custkey, c_acctbal AS o_totalprice, c_mktsegment FROM customer)")


def _merge(how, **options):
    keyword = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "outer": "FULL JOIN"}[how]

    def run(spark, sf):
        left = lp.select_columns(dirty_orders(spark, sf), ["o_orderkey", "o_custkey", "o_totalprice"])
        return lp.merge_with(left, customers(spark, sf), "o_custkey", how, **options)

    return run, (DIRTY + f", {CUSTOMERS} SELECT l.o_orderkey, coalesce(l.o_custkey, r.o_custkey) AS o_custkey, "
                 f"l.o_totalprice AS o_totalprice_x, r.o_totalprice AS o_totalprice_y, r.c_mktsegment FROM dirty_orders l "
                 f"{keyword} customers r ON l.o_custkey IS NOT DISTINCT FROM r.o_custkey")


def stacked(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS code")
    people = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_nationkey AS code", "c_name AS name")
    return lp.concat_with(orders, people)


def pasted(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    people = table(spark, sf, "customer").selectExpr("c_custkey AS o_orderkey", "c_name")
    return lp.concat_with(orders, people, axis=1, on="o_orderkey")


def melted(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return lp.melt(lines, ["l_orderkey"], ["l_quantity", "l_discount", "l_tax"])


def melted_mixed(spark, sf):
    return lp.melt(dirty_orders(spark, sf), "o_orderkey")


def transposed(spark, sf):
    report = lp.groupby_aggregate(dirty_orders(spark, sf), "o_orderstatus", "o_totalprice", "count")
    return lp.transpose(report, "o_orderstatus")


def mapped_by_table(spark, sf):
    names = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return lp.apply_map(table(spark, sf, "customer"), "c_nationkey", names, "nation")


def conditional(spark, sf):
    df = lp.conditional_column(dirty_orders(spark, sf), "size", "o_totalprice", ">",
                               lp.parse_compare_value("250000"), "Large", "Small")
    df = lp.conditional_column(df, "other", "o_orderstatus", "!=", "F", 1, 0)
    return lp.conditional_column(df, "exact", "o_orderstatus", "==", "F", 1, 0)


def arithmetic(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus")
    df = lp.math_column(df, "gross", "l_quantity", "*", "l_extendedprice")
    df = lp.math_column(df, "ratio", "l_quantity", "/", "l_discount")
    df = lp.math_column(df, "next_line", "l_linenumber", "+", 1)
    df = lp.math_column(df, "flags", "l_returnflag", "+", "l_linestatus")
    df = lp.math_column(df, "less", "l_extendedprice", "-", 0.5)
    return df.withColumns({"gross": F.round("gross", 3), "ratio": F.round("ratio", 4), "less": F.round("less", 3)})


ONE_HOT = ", ".join(f"coalesce(o_orderstatus = '{s}', false)::int AS \"o_orderstatus_{s}\"" for s in STATUSES) + ", " + ", ".join(
    f"(o_orderpriority = '{p}')::int AS \"o_orderpriority_{p}\"" for p in PRIORITIES)

QUERIES = {
    "select_columns": (
        lambda spark, sf: lp.select_columns(table(spark, sf, "orders"), ["o_totalprice", "o_orderkey"]),
        "SELECT o_totalprice, o_orderkey FROM orders"),
    "drop_columns": (
        lambda spark, sf: lp.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_custkey"]),
        "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"),
    "rename_columns": (
        lambda spark, sf: lp.rename_columns(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "name", "nope": "x"}),
        "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "filter_query": (
        lambda spark, sf: lp.filter_query(
            dirty_orders(spark, sf), "(`o_totalprice` > 100000 and o_orderstatus in ('F', 'O')) or not (o_custkey <=> 11)"
            " and o_orderpriority == '1-URGENT'"),
        DIRTY + f"SELECT {ALL} FROM dirty_orders WHERE (o_totalprice > 100000 AND o_orderstatus IN ('F', 'O')) OR "
        "o_custkey IS DISTINCT FROM 11 AND o_orderpriority = '1-URGENT'"),
    "conditional_column": (
        conditional, DIRTY + f"SELECT {ALL}, CASE WHEN o_totalprice > 250000 THEN 'Large' ELSE 'Small' END AS size, "
        "(o_orderstatus IS DISTINCT FROM 'F')::int AS other, coalesce(o_orderstatus = 'F', false)::int AS exact FROM dirty_orders"),
    "math_column": (
        arithmetic, "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, "
        "round(l_quantity * l_extendedprice, 3) AS gross, CASE WHEN l_discount = 0 THEN NULL ELSE round(l_quantity / l_discount, 4) "
        "END AS ratio, l_linenumber::bigint + 1 AS next_line, l_returnflag || l_linestatus AS flags, "
        "round(l_extendedprice - 0.5, 3) AS less FROM lineitem"),
    **{f"group_{f}": _group(f) for f in AGGREGATES},
    "group_median_distributed": _group("median", distributed_median=True),
    **{f"pivot_{f}": _pivot(f) for f in ("mean", "sum", "count", "max")},
    "value_counts": (
        lambda spark, sf: lp.unique_value_counts(dirty_orders(spark, sf), "o_custkey"),
        DIRTY + "SELECT o_custkey, count(*) AS count FROM dirty_orders WHERE o_custkey IS NOT NULL GROUP BY 1"),
    "melt": (
        melted, " UNION ALL ".join(
            f"SELECT l_orderkey, '{c}' AS variable, {c} AS value FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax"))),
    "melt_mixed_types": (
        melted_mixed, DIRTY + " UNION ALL ".join(
            f"SELECT o_orderkey, '{c}' AS variable, cast({c} AS varchar) AS value FROM dirty_orders"
            for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
        # a date and time in text: the fraction of a second only where there is one
        + " UNION ALL SELECT o_orderkey, 'o_orderdate', regexp_replace(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), "
        "'\\.?0*$', '') FROM dirty_orders"),
    "transpose": (
        transposed, DIRTY + "SELECT 'o_totalprice_count' AS \"index\", " + ", ".join(
            f"cast(count(o_totalprice) FILTER (WHERE o_orderstatus = '{s}') AS varchar) AS {s}" for s in STATUSES) + " FROM dirty_orders"),
    "merge_inner": _merge("inner"),
    "merge_left": _merge("left"),
    "merge_right": _merge("right"),
    "merge_outer": _merge("outer"),
    "merge_outer_split": _merge("outer", split_outer=True),
    "concat_rows": (
        stacked, "SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS code, cast(NULL AS varchar) AS name FROM orders "
        "UNION ALL SELECT c_custkey, NULL, cast(c_nationkey AS varchar), c_name FROM customer"),
    "concat_columns": (
        pasted, "SELECT coalesce(o_orderkey, c_custkey) AS o_orderkey, o_totalprice, c_name FROM orders FULL JOIN customer "
        "ON o_orderkey = c_custkey"),
    "apply_map": (
        lambda spark, sf: lp.apply_map(dirty_orders(spark, sf), "o_orderstatus", {"F": "Filled", "O": "Open"}, "status"),
        DIRTY + f"SELECT {ALL}, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' END AS status FROM dirty_orders"),
    "apply_map_table": (
        mapped_by_table, "SELECT customer.*, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"),
    "replace_values": (
        lambda spark, sf: lp.replace_values(lp.replace_values(dirty_orders(spark, sf), "F", None), 11, -1),
        DIRTY + "SELECT CASE WHEN o_orderkey = 11 THEN -1 ELSE o_orderkey END AS o_orderkey, CASE WHEN o_custkey = 11 THEN -1 ELSE "
        "o_custkey END AS o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, CASE WHEN o_totalprice = 11 THEN -1 ELSE "
        "o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
    "one_hot_encode": (
        lambda spark, sf: lp.one_hot_encode(
            dirty_orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_orderstatus", "o_orderpriority"]),
        DIRTY + f"SELECT o_orderkey, {ONE_HOT} FROM dirty_orders"),
    "extract_date_parts": (
        lambda spark, sf: lp.extract_date_parts(table(spark, sf, "events").select("event_id", "ts"), "ts"),
        "SELECT event_id, ts, year(ts)::int AS \"ts_Year\", month(ts)::int AS \"ts_Month\", day(ts)::int AS \"ts_Day\", "
        "(isodow(ts) - 1)::int AS \"ts_Weekday\" FROM events"),
    "format_dates": (
        lambda spark, sf: lp.format_dates(table(spark, sf, "events").select("event_id", "ts"), "ts", "%a %d %B %Y, %H:%M:%S at %y/%j"),
        "SELECT event_id, strftime(ts, '%a %d %B %Y, %H:%M:%S at %y/%j') AS ts FROM events"),
}
