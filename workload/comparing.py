"""Before/after comparison and chart data."""

from __future__ import annotations

import limpid as lp
from pyspark.sql import functions as F

from workload.base import (
    COPIED_ORDERS, DIRTY_ORDERS_CTE, SPIKED_ORDERS_CTE, copied_orders, dirty_orders, spiked_orders, table,
)
from workload.cleaning import FENCES

SPIKED = f"WITH {SPIKED_ORDERS_CTE}, {FENCES}, capped AS (SELECT CASE WHEN price < lo THEN lo WHEN price > hi THEN hi " \
         "ELSE price END AS price FROM spiked, fences) "
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _capped(spark, sf):
    before = spiked_orders(spark, sf)
    return before, lp.cap_outliers_iqr(before, "price")


def histogram(spark, sf):
    before, after = _capped(spark, sf)
    return lp.histogram_comparison(before, after, "price").withColumns({n: F.round(n, 3) for n in ("lower", "upper")})


HISTOGRAM_SQL = SPIKED + (
    ", sides AS (SELECT 'before' AS side, price FROM spiked WHERE price IS NOT NULL UNION ALL SELECT 'after', price FROM capped "
    "WHERE price IS NOT NULL), lims AS (SELECT min(price) AS lo, max(price) AS hi FROM sides), "
    "edges AS (SELECT i AS bin, lo + i * ((hi - lo) / 20) AS lower, CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 20) "
    "END AS upper FROM lims, range(20) t(i)) "
    "SELECT s.side, cast(bin AS int) AS bin, round(lower, 3) AS lower, round(upper, 3) AS upper, (SELECT count(*) FROM sides x "
    "WHERE x.side = s.side AND x.price >= lower AND (x.price < upper OR (bin = 19 AND x.price <= upper))) AS count "
    "FROM edges, (VALUES ('before'), ('after')) s(side)")


def boxplot(spark, sf):
    before, after = _capped(spark, sf)
    names = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return lp.boxplot_comparison(before, after, "price").withColumns({n: F.round(n, 3) for n in names})


def _box_sql(side, source):
    return (f"SELECT '{side}' AS side, count(price) AS n, round(any_value(q1), 3) AS q1, round(any_value(m), 3) AS median, "
            "round(any_value(q3), 3) AS q3, round(min(price) FILTER (WHERE price >= q1 - 1.5 * (q3 - q1)), 3) AS whisker_low, "
            "round(max(price) FILTER (WHERE price <= q3 + 1.5 * (q3 - q1)), 3) AS whisker_high, "
            "count(*) FILTER (WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS n_fliers "
            f"FROM {source}, (SELECT quantile_cont(price, 0.25) AS q1, median(price) AS m, quantile_cont(price, 0.75) AS q3 FROM {source})")


LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def correlations(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS l_quantity",
        "CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_extendedprice END AS l_extendedprice", "l_discount", "l_tax")
    return lp.correlation_matrix(lines).withColumn("corr", F.round("corr", 6))


CORRELATION_SQL = (
    "WITH l AS (SELECT CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_linestatus = 'F' "
    "THEN NULL ELSE l_extendedprice END AS l_extendedprice, l_discount, l_tax FROM lineitem) " + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM l"
        for a in LINE_NUMBERS for b in LINE_NUMBERS))


MOMENT_COLUMNS = {
    **{c: c for c in LINE_NUMBERS},
    "net": "l_extendedprice * (1 - l_discount)",
    "large": "CASE WHEN l_quantity > 25 THEN l_extendedprice END",
    "same": "CASE WHEN l_returnflag = 'R' THEN 7.0 END",
    "far": "1000000000 + l_tax * 100",
    "none": "CASE WHEN l_quantity < 0 THEN l_tax END",
}


def moments(spark, sf):
    """Nine columns, gaps, a constant and an empty one among them, by the one matrix that wide tables use."""
    lines = table(spark, sf, "lineitem").selectExpr(*[f"cast({e} AS double) AS {c}" for c, e in MOMENT_COLUMNS.items()])
    return lp.correlation_matrix(lines, paired=0).withColumn("corr", F.round("corr", 6))


def _moment_sql(a, b):
    # a constant has no correlation, whatever rounding makes of its deviation
    spread = " OR ".join(f"max({x}) FILTER ({y} IS NOT NULL) = min({x}) FILTER ({y} IS NOT NULL)" for x, y in ((a, b), (b, a)))
    value = f"CASE WHEN count({a}) FILTER ({b} IS NOT NULL) = 0 OR {spread} THEN NULL ELSE round(corr({a}, {b}), 6) END"
    return f"SELECT '{a}' AS column_a, '{b}' AS column_b, {value} AS corr FROM l"


MOMENT_SQL = ("WITH l AS (SELECT " + ", ".join(f"cast({e} AS double) AS {c}" for c, e in MOMENT_COLUMNS.items()) + " FROM lineitem) "
              + " UNION ALL ".join(_moment_sql(a, b) for a in MOMENT_COLUMNS for b in MOMENT_COLUMNS))


def _snapshot_sql(source, columns, name):
    parts = [f"SELECT 'rows' AS metric, cast(NULL AS varchar) AS \"column\", (SELECT count(*) FROM {source}) AS {name}",
             f"SELECT 'duplicate_rows', NULL, (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))"]
    parts += [f"SELECT 'missing', '{c}', (SELECT count(*) - count({c}) FROM {source})" for c in columns]
    return " UNION ALL ".join(parts)


def before_after(spark, sf):
    before = copied_orders(spark, sf).withColumn("o_totalprice", F.expr("CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END"))
    after = lp.fill_missing_constant(lp.remove_duplicates(before), 0, "o_totalprice")
    return lp.before_after(before, after)


BEFORE_AFTER_SQL = (
    "WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS "
    f"o_totalprice, o_orderdate, o_orderpriority FROM ({COPIED_ORDERS})), a AS (SELECT DISTINCT o_orderkey, o_custkey, "
    "o_orderstatus, coalesce(o_totalprice, 0) AS o_totalprice, o_orderdate, o_orderpriority FROM b) "
    f"SELECT x.metric, x.\"column\", x.before, y.after FROM ({_snapshot_sql('b', ORDER_COLUMNS, 'before')}) x JOIN "
    f"({_snapshot_sql('a', ORDER_COLUMNS, 'after')}) y ON x.metric = y.metric AND x.\"column\" IS NOT DISTINCT FROM y.\"column\"")


def audited(spark, sf):
    """A chain run once, with the counts its steps left in the audit."""
    chain = (lp.Chain(dirty_orders(spark, sf), order_by="o_orderkey")
             .drop_missing(subset="o_custkey")
             .fill_missing_constant("?", "o_orderstatus")
             .filter_query("o_orderstatus <> 'F'"))
    chain.run(lambda df: df.write.format("noop").mode("overwrite").save())
    return chain.audit()


AUDIT_SQL = (
    f"WITH {DIRTY_ORDERS_CTE}, s1 AS (SELECT * FROM dirty_orders WHERE o_custkey IS NOT NULL), s2 AS (SELECT * REPLACE "
    "(coalesce(o_orderstatus, '?') AS o_orderstatus) FROM s1), s3 AS (SELECT * FROM s2 WHERE o_orderstatus <> 'F'), "
    "c AS (" + " UNION ALL ".join(
        f"SELECT {i} AS step, count(*) AS n, count(*) * 6 - count(o_orderkey) - count(o_custkey) - count(o_orderstatus) - "
        f"count(o_totalprice) - count(o_orderdate) - count(o_orderpriority) AS gaps FROM {s}"
        for i, s in enumerate(("dirty_orders", "s1", "s2", "s3"))) + ") "
    "SELECT b.step, ['drop_missing', 'fill_missing_constant', 'filter_query'][b.step] AS operator, "
    "['{\"args\": [], \"subset\": \"o_custkey\"}', '{\"args\": [\"?\", \"o_orderstatus\"]}', "
    "'{\"args\": [\"o_orderstatus <> ''F''\"]}'][b.step] AS params, a.n AS rows_before, "
    "b.n AS rows_after, a.gaps AS missing_before, b.gaps AS missing_after FROM c a JOIN c b ON b.step = a.step + 1")

QUERIES = {
    "missing_values_bar": (
        lambda spark, sf: lp.missing_values_bar(spiked_orders(spark, sf)),
        f"WITH {SPIKED_ORDERS_CTE} SELECT 'price' AS \"column\", count(*) - count(price) AS missing FROM spiked"),
    "histogram_comparison": (histogram, HISTOGRAM_SQL),
    "boxplot_comparison": (boxplot, SPIKED + _box_sql("before", "spiked") + " UNION ALL " + _box_sql("after", "capped")),
    "boxplot_fliers": (
        lambda spark, sf: lp.boxplot_fliers(spiked_orders(spark, sf), "price"),
        SPIKED + "SELECT price AS flier FROM spiked, fences WHERE price < lo OR price > hi"),
    "dtype_breakdown": (
        lambda spark, sf: lp.dtype_breakdown(table(spark, sf, "orders")),
        "SELECT CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' WHEN column_type = 'TIMESTAMP' THEN "
        "'datetime' ELSE 'text/categorical' END AS family, cast(count(*) AS int) AS n_columns FROM (DESCRIBE orders) GROUP BY 1"),
    "correlation_matrix": (correlations, CORRELATION_SQL),
    "correlation_moments": (moments, MOMENT_SQL),
    "is_plottable": (
        lambda spark, sf: lp.is_plottable(table(spark, sf, "orders"), "o_orderpriority"),
        "SELECT 'o_orderpriority' AS \"column\", count(try_cast(o_orderpriority AS double)) > 0 AS plottable FROM orders"),
    "before_after": (before_after, BEFORE_AFTER_SQL),
    "action_log": (audited, AUDIT_SQL),
}
