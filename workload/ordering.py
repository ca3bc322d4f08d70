"""Operators that depend on row order, and ranking, sorting, sampling."""

from __future__ import annotations

import limpid as lp
from limpid.plans.ordering import with_position
from pyspark.sql import functions as F

from workload.base import DIRTY_ORDERS_CTE, GAPPY_EVENTS_CTE, dirty_orders, gappy_events, output_root, table

GAPPY = f"WITH {GAPPY_EVENTS_CTE} "
DIRTY = f"WITH {DIRTY_ORDERS_CTE} "
ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
FORWARD = "last_value({c} IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING)"
BACKWARD = "first_value({c} IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _carry_sql(frame):
    return (GAPPY + f"SELECT event_id, {frame.format(c='user_id')} AS user_id, event_type, {frame.format(c='value')} AS value "
            "FROM gappy")


NEIGHBOURS = (
    "numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS p FROM gappy), "
    "near AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER up AS p0, "
    "last_value(value IGNORE NULLS) OVER up AS v0, "
    "first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER down AS p1, "
    "first_value(value IGNORE NULLS) OVER down AS v1 FROM numbered "
    "WINDOW up AS (ORDER BY p ROWS UNBOUNDED PRECEDING), "
    "down AS (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


def _interpolated(expr):
    return (GAPPY + f", {NEIGHBOURS} SELECT event_id, user_id, event_type, round(CASE WHEN value IS NOT NULL THEN value "
            f"ELSE {expr} END, 8) AS value FROM near")


def _impute(strategy, columns):
    def run(spark, sf):
        out = lp.impute(gappy_events(spark, sf), strategy, columns, order_by="event_id")
        return out.withColumn("value", F.round("value", 8)) if strategy == "interpolate" else out
    return run


LINEAR = "CASE WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0 ELSE (v1 - v0) / (p1 - p0) * (p - p0) + v0 END"


def _interpolate(method):
    def run(spark, sf):
        out = lp.interpolate_missing(gappy_events(spark, sf), "value", method, order_by="event_id")
        return out.withColumn("value", F.round("value", 8))
    return run


def _by_user(fill):
    return lambda spark, sf: fill(gappy_events(spark, sf), "value", order_by="event_id", partition_by="user_id")


def _by_user_sql(frame):
    inside = frame.format(c="value").replace("(ORDER BY", "(PARTITION BY user_id ORDER BY")
    return GAPPY + f"SELECT event_id, user_id, event_type, {inside} AS value FROM gappy"


def interpolate_by_user(spark, sf):
    return _by_user(lp.interpolate_missing)(spark, sf).withColumn("value", F.round("value", 8))


def _rank_sql(direction):
    # average rank on ties: the smallest rank of the tie and half of the others
    return (DIRTY + f"SELECT {ALL}, CASE WHEN o_custkey IS NOT NULL THEN rank() OVER (PARTITION BY o_custkey IS NULL "
            f"ORDER BY o_custkey {direction}) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0::double END AS "
            "o_custkey_Rank FROM dirty_orders")


def positions(spark, sf):
    """All rows with the place each took in the sorted files: written once, so that the numbers are of one sort."""
    out = lp.sort_values(dirty_orders(spark, sf), ["o_orderstatus", "o_totalprice"], [True, False], order_by="o_orderkey")
    path = f"{output_root(spark)}/sorted"
    out.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    return with_position(spark.read.parquet(path), "at", "place").drop("at")


QUERIES = {
    "ffill": (lambda spark, sf: lp.fill_missing_ffill(gappy_events(spark, sf), ["user_id", "value"], order_by="event_id"),
              _carry_sql(FORWARD)),
    "bfill": (lambda spark, sf: lp.fill_missing_bfill(gappy_events(spark, sf), ["user_id", "value"], order_by="event_id"),
              _carry_sql(BACKWARD)),
    "interpolate_linear": (
        _interpolate("linear"),
        _interpolated(LINEAR)),
    "ffill_by_user": (_by_user(lp.fill_missing_ffill), _by_user_sql(FORWARD)),
    "bfill_by_user": (_by_user(lp.fill_missing_bfill), _by_user_sql(BACKWARD)),
    "interpolate_by_user": (interpolate_by_user, _interpolated(LINEAR).replace(" OVER (ORDER BY event_id)", " OVER series")
                            .replace("(ORDER BY p ROWS", "(PARTITION BY user_id ORDER BY p ROWS")
                            .replace("AS p FROM gappy)", "AS p FROM gappy WINDOW series AS (PARTITION BY user_id ORDER BY event_id))")),
    "impute_ffill": (_impute("ffill", ["user_id", "value"]), _carry_sql(FORWARD)),
    "impute_bfill": (_impute("bfill", ["user_id", "value"]), _carry_sql(BACKWARD)),
    "impute_interpolate": (_impute("interpolate", "value"), _interpolated(LINEAR)),
    "interpolate_nearest": (
        _interpolate("nearest"),
        _interpolated("CASE WHEN p0 IS NULL OR p1 IS NULL THEN NULL WHEN p - p0 <= p1 - p THEN v0 ELSE v1 END")),
    "sort_values": (
        positions, DIRTY + f"SELECT {ALL}, row_number() OVER (ORDER BY o_orderstatus NULLS LAST, o_totalprice DESC NULLS "
        "LAST, o_orderkey) AS place FROM dirty_orders"),
    "top_n_largest": (
        lambda spark, sf: lp.top_n(dirty_orders(spark, sf), "o_totalprice", 100, order_by="o_orderkey"),
        DIRTY + f"SELECT {ALL} FROM dirty_orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100"),
    "top_n_smallest": (
        lambda spark, sf: lp.top_n(dirty_orders(spark, sf), "o_custkey", 100, largest=False, order_by="o_orderkey"),
        DIRTY + f"SELECT {ALL} FROM dirty_orders ORDER BY o_custkey NULLS LAST, o_orderkey LIMIT 100"),
    "sample_rows": (
        lambda spark, sf: lp.sample_rows(table(spark, sf, "orders"), 200, 42, order_by="o_orderkey"),
        f"SELECT {ALL} FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 200"),
    "add_rank": (lambda spark, sf: lp.add_rank(dirty_orders(spark, sf), "o_custkey"), _rank_sql("DESC")),
    "add_rank_ascending": (
        lambda spark, sf: lp.add_rank(dirty_orders(spark, sf), "o_custkey", ascending=True), _rank_sql("ASC")),
    "label_encode": (
        lambda spark, sf: lp.label_encode(
            dirty_orders(spark, sf), ["o_orderstatus", "o_custkey"], order_by="o_orderkey"),
        DIRTY + ", a AS (SELECT o_orderstatus AS k, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS code FROM dirty_orders "
        "WHERE o_orderstatus IS NOT NULL GROUP BY 1), b AS (SELECT o_custkey AS k, row_number() OVER (ORDER BY "
        "min(o_orderkey)) - 1 AS code FROM dirty_orders WHERE o_custkey IS NOT NULL GROUP BY 1) "
        "SELECT o_orderkey, coalesce(b.code, -1) AS o_custkey, coalesce(a.code, -1) AS o_orderstatus, o_totalprice, "
        "o_orderdate, o_orderpriority FROM dirty_orders LEFT JOIN a ON o_orderstatus = a.k LEFT JOIN b ON o_custkey = b.k"),
}
