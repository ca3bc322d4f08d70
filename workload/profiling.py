"""Profile reports."""

from __future__ import annotations

import limpid as lp
from pyspark.sql import functions as F

from workload.base import COPIED_ORDERS, DIRTY_ORDERS_CTE, copied_orders, dirty_orders, output_root, table

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
NUMERIC = ("o_orderkey", "o_custkey", "o_totalprice")


def _per_column(columns, select, source="dirty_orders") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns)


def _rounded(df, *names, places=4):
    return df.withColumns({n: F.round(n, places) for n in names})


STATS = ("round(avg({c}), 4) AS mean, round(median(cast({c} AS double)), 4) AS median, "
         "round(stddev_pop({c}), 4) AS std, cast(min({c}) AS double) AS min, cast(max({c}) AS double) AS max")

MISSING = _per_column(ORDER_COLUMNS, "count(*) - count({c}) AS missing, count(*) AS rows")

DESCRIBE_NUMBER = (
    "count({c}) AS count, cast(NULL AS bigint) AS \"unique\", cast(NULL AS varchar) AS top, "
    "cast(NULL AS bigint) AS freq, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    "cast(min({c}) AS double) AS min, round(quantile_cont(cast({c} AS double), 0.25), 4) AS p25, "
    "round(quantile_cont(cast({c} AS double), 0.5), 4) AS p50, "
    "round(quantile_cont(cast({c} AS double), 0.75), 4) AS p75, cast(max({c}) AS double) AS max")
DESCRIBE_TEXT = (
    "(SELECT count({c}) FROM dirty_orders) AS count, (SELECT count(DISTINCT {c}) FROM dirty_orders) AS \"unique\", "
    "{top} AS top, n AS freq, cast(NULL AS double) AS mean, cast(NULL AS double) AS std, "
    "cast(NULL AS double) AS min, cast(NULL AS double) AS p25, cast(NULL AS double) AS p50, "
    "cast(NULL AS double) AS p75, cast(NULL AS double) AS max")


def _describe_text(c: str, top: str = "v") -> str:
    return (f"SELECT '{c}' AS \"column\", {DESCRIBE_TEXT.format(c=c, top=top)} FROM (SELECT {c} AS v, count(*) AS n "
            f"FROM dirty_orders WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)")


def _report_values(section: str, column: str, metric: str, value: str, source: str) -> str:
    return (f"SELECT '{section}' AS section, {column} AS \"column\", '{metric}' AS metric, "
            f"{value} AS value FROM ({source})")


TYPE_NAME = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END")


def rounded_report(report):
    """The report with its fractions to four places, as engines print doubles in different ways."""
    return report.withColumn("value", F.expr(
        "CASE WHEN section = 'numeric' THEN cast(cast(cast(value AS double) AS decimal(24, 4)) AS string) ELSE value END"))


def report(spark, sf):
    return rounded_report(lp.full_report(dirty_orders(spark, sf)))


def appended(spark, sf):
    """The state of the earlier orders and that of the others, merged, make the profile of all."""
    orders, first = dirty_orders(spark, sf), F.col("o_orderpriority") < "3"
    state = lp.ProfileState(spark, f"{output_root(spark)}/profile")
    state.add(orders.where(first))
    state.add(orders.where(~first))
    return rounded_report(state.report())


def _numeric_metrics() -> list[str]:
    exact = {"mean": "avg({c})", "median": "median(cast({c} AS double))", "std": "stddev_pop({c})", "min": "min({c})",
             "max": "max({c})"}
    return [f"SELECT 'numeric' AS section, '{c}' AS \"column\", '{m}' AS metric, cast(cast({e.format(c=c)} AS decimal(24, 4)) "
            f"AS varchar) AS value FROM dirty_orders" for c in NUMERIC for m, e in exact.items()]


REPORT_SQL = " UNION ALL ".join([
    _report_values("shape", "cast(NULL AS varchar)", "rows", "cast(n AS varchar)", "SELECT count(*) AS n FROM dirty_orders"),
    _report_values("shape", "cast(NULL AS varchar)", "columns", "'6'", "SELECT 1"),
    _report_values("shape", "cast(NULL AS varchar)", "total_cells", "cast(n AS varchar)",
                   "SELECT count(*) * 6 AS n FROM dirty_orders"),
    _report_values("types", "column_name", "dtype", TYPE_NAME, "SELECT * FROM (DESCRIBE orders)"),
    _report_values("missing", "\"column\"", "missing", "cast(missing AS varchar)", f"SELECT * FROM ({MISSING}) WHERE missing > 0"),
    _report_values("missing", "\"column\"", "percent", "cast(round(missing * 100.0::double / rows, 2) AS varchar)",
                   f"SELECT * FROM ({MISSING}) WHERE missing > 0"),
    _report_values("duplicates", "cast(NULL AS varchar)", "duplicate_rows", "cast(n AS varchar)",
                   "SELECT (SELECT count(*) FROM dirty_orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_orders)) AS n"),
    _report_values("unique", "\"column\"", "unique", "cast(n AS varchar)",
                   _per_column(ORDER_COLUMNS, "count(DISTINCT {c}) AS n")),
    *_numeric_metrics(),
])

QUERIES = {
    "basic_info": (
        lambda spark, sf: lp.basic_info(table(spark, sf, "lineitem")),
        "SELECT count(*) AS rows, 11 AS columns, count(*) * 11 AS total_cells, 2 AS dimensions FROM lineitem"),
    "dtypes_summary": (
        lambda spark, sf: lp.dtypes_summary(table(spark, sf, "orders")),
        f"SELECT column_name AS \"column\", {TYPE_NAME} AS dtype FROM (DESCRIBE orders)"),
    "missing_summary": (
        lambda spark, sf: lp.missing_summary(dirty_orders(spark, sf)),
        f"WITH {DIRTY_ORDERS_CTE} SELECT \"column\", missing FROM ({MISSING}) WHERE missing > 0"),
    "missing_percent": (
        lambda spark, sf: lp.missing_percent(dirty_orders(spark, sf)),
        f"WITH {DIRTY_ORDERS_CTE} SELECT \"column\", round(missing * 100.0::double / rows, 2) AS percent "
        f"FROM ({MISSING}) WHERE missing > 0"),
    "duplicate_count": (
        lambda spark, sf: lp.duplicate_count(copied_orders(spark, sf)),
        f"WITH c AS ({COPIED_ORDERS}) SELECT (SELECT count(*) FROM c) - "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM c)) AS duplicate_rows"),
    "unique_counts": (
        lambda spark, sf: lp.unique_counts(table(spark, sf, "lineitem")),
        _per_column(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
                    "count(DISTINCT {c}) AS n_unique", "lineitem")),
    "unique_counts_documents": (
        lambda spark, sf: lp.unique_counts(table(spark, sf, "documents")),
        _per_column(("doc_id", "text", "lang", "source", "n_chars"), "count(DISTINCT {c}) AS n_unique", "documents")),
    "numeric_summary": (
        lambda spark, sf: _rounded(lp.numeric_summary(dirty_orders(spark, sf)), "mean", "median", "std"),
        f"WITH {DIRTY_ORDERS_CTE} " + _per_column(NUMERIC, STATS)),
    "describe": (
        lambda spark, sf: _rounded(lp.describe(dirty_orders(spark, sf)), "mean", "std", "p25", "p50", "p75"),
        f"WITH {DIRTY_ORDERS_CTE} " + " UNION ALL ".join(
            [_per_column(NUMERIC, DESCRIBE_NUMBER)]
            + ["SELECT * FROM (" + _describe_text(c, "v" if c != "o_orderdate" else "strftime(v, '%Y-%m-%d %H:%M:%S')") + ")"
               for c in ("o_orderstatus", "o_orderdate", "o_orderpriority")])),
    "profile_appended": (appended, f"WITH {DIRTY_ORDERS_CTE} {REPORT_SQL}"),
    "full_report": (report, f"WITH {DIRTY_ORDERS_CTE} {REPORT_SQL}"),
}
