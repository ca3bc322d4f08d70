"""Dirty versions of the driver tables, written once and read by both engines.

The tables are clean, so gaps, outliers, text noise and copies are put in by
expressions over their own columns.  All rows stay in; the expressions are
plain SQL that Spark and the checking engine read alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(expressions: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in expressions.items()) + f" FROM {source}"


DIRTY_ORDERS = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_custkey END",
    "o_orderstatus": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderstatus END",
    "o_totalprice": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN NULL ELSE o_totalprice END",
    "o_orderdate": "o_orderdate",
    "o_orderpriority": "o_orderpriority",
}
DIRTY_ORDERS_CTE = f"dirty_orders AS ({_select(DIRTY_ORDERS, 'orders')})"

#: Prices with extreme values on one kind of order.
SPIKED_ORDERS = {
    "o_orderkey": "o_orderkey",
    "o_orderpriority": "o_orderpriority",
    "price": "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice * 40 "
             "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE o_totalprice END",
    "custkey": "o_custkey",
}
SPIKED_ORDERS_CTE = f"spiked AS ({_select(SPIKED_ORDERS, 'orders')})"

#: A sensor-like series with irregular gaps.
GAPPY_EVENTS = {
    "event_id": "event_id",
    "user_id": "CASE WHEN event_type = 'view' THEN NULL ELSE user_id END",
    "event_type": "event_type",
    "value": "CASE WHEN event_type IN ('error', 'signup', 'view') THEN NULL ELSE value END",
}
GAPPY_EVENTS_CTE = f"gappy AS ({_select(GAPPY_EVENTS, 'events')})"

#: Numbers stored as text in the usual bad spellings.
PRICE_TEXT = ("CASE WHEN o_orderpriority = '1-URGENT' THEN concat('  ', cast(o_totalprice AS string), ' ') "
              "WHEN o_orderpriority = '2-HIGH' THEN concat('1,', cast(o_totalprice AS string)) "
              "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'N/A' "
              "WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN '1e3' "
              "ELSE cast(o_totalprice AS string) END")
#: Text with padding, a tab and mixed case.
NOISY_TEXT = ("CASE WHEN o_orderstatus = 'P' THEN concat('  ', lower(o_orderpriority), chr(9)) "
              "WHEN o_orderstatus = 'F' THEN concat(o_orderpriority, ' o''brien') ELSE o_orderpriority END")


def dirty_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in DIRTY_ORDERS.items()])


def spiked_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in SPIKED_ORDERS.items()])


def gappy_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in GAPPY_EVENTS.items()])


def priced_text(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{PRICE_TEXT} AS price_text")


def noisy_text(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{NOISY_TEXT} AS label")


NOISY_CTE = f"noisy AS (SELECT o_orderkey, {NOISY_TEXT} AS label FROM orders)"
PRICED_CTE = f"priced AS (SELECT o_orderkey, {PRICE_TEXT} AS price_text FROM orders)"

#: Every urgent order twice.
COPIED_ORDERS = "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"


def copied_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.unionByName(orders.where("o_orderpriority = '1-URGENT'"))


def output_root(spark: SparkSession) -> str:
    """Where queries that write files put them: the shared folder of the session, or its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/output-{uuid.uuid4().hex}"
