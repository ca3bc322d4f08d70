"""Missing values, duplicates, types, text, outliers, validation."""

from __future__ import annotations

import limpid as lp
from pyspark.sql import functions as F

from workload.base import (
    COPIED_ORDERS, DIRTY_ORDERS_CTE, NOISY_CTE, PRICED_CTE, SPIKED_ORDERS_CTE, copied_orders, dirty_orders,
    noisy_text, priced_text, spiked_orders, table,
)

DIRTY = f"WITH {DIRTY_ORDERS_CTE} "
SPIKED = f"WITH {SPIKED_ORDERS_CTE} "
ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
FENCES = ("fences AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT "
          "quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM spiked))")
PRICE = "o_orderkey, o_orderpriority, {price} AS price, custkey"


def _money(df, *names):
    return df.withColumns({n: F.round(n, 4) for n in names})


def fill(strategy, columns):
    return lambda spark, sf: lp.fill_missing_statistic(dirty_orders(spark, sf), strategy, columns)


def _fill_sql(expr):
    return (DIRTY + f"SELECT o_orderkey, o_custkey, o_orderstatus, round(coalesce(o_totalprice, (SELECT {expr} FROM "
            "dirty_orders)), 4) AS o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders")


def _mode(c):
    return (f"(SELECT {c} FROM dirty_orders WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


def dated_text(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", F.expr(
        "CASE WHEN o_orderstatus = 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd') "
        "WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'MMMM d, yyyy') "
        "WHEN o_orderpriority = '2-HIGH' THEN date_format(o_orderdate, 'dd-MM-yyyy') "
        "WHEN o_orderpriority = '5-LOW' THEN 'not-a-date' "
        "ELSE date_format(o_orderdate, 'dd/MM/yyyy') END").alias("date_text"))


DATED_CTE = ("dated AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') "
             "WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%B %-d, %Y') "
             "WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%d-%m-%Y') "
             "WHEN o_orderpriority = '5-LOW' THEN 'not-a-date' "
             "ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_text FROM orders)")


def _strptimes(*formats):
    return "coalesce(" + ", ".join(f"try_strptime(date_text, '{f}')" for f in formats) + ")"


MONTH_FIRST = _strptimes("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%B %d, %Y")
DAY_FIRST = _strptimes("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y", "%m-%d-%Y", "%B %d, %Y")
TITLE = ("array_to_string(list_transform(regexp_extract_all(lower(label), '[a-z]+|[^a-z]+'), "
         "lambda p: upper(p[1]) || p[2:]), '')")


def _case(kind):
    return lambda spark, sf: lp.change_case(noisy_text(spark, sf), "label", kind)


def mixed_numbers(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_quantity", "l_discount", "cast(l_linenumber AS string) AS line_text",
        "CASE WHEN l_returnflag = 'A' THEN 'true' ELSE 'false' END AS flag_text", "l_linestatus")


#: By the last digit of the key; those with a time of day keep it.
SPELLINGS = ("dd/MM/yyyy HH:mm", "yyyy/MM/dd HH:mm", "yyyy.MM.dd", "yyyyMMdd", "dd-MMM-yyyy", "d/M/yy", "MMMM d yyyy",
             "MMM d, yyyy hh:mm a", "dd.MM.yy HH:mm:00", "yyyy-MM-dd h:mm a")


def spelled_dates(spark, sf):
    moment = F.expr("timestampadd(MINUTE, cast(o_orderkey % 1440 AS int), o_orderdate)")
    spelled = F.lit(None).cast("string")
    for digit, spelling in enumerate(SPELLINGS):
        spelled = F.when(F.col("o_orderkey") % 10 == digit, F.date_format(moment, spelling)).otherwise(spelled)
    return table(spark, sf, "orders").select("o_orderkey", spelled.alias("spelled"))


QUERIES = {
    "drop_missing_any": (
        lambda spark, sf: lp.drop_missing(dirty_orders(spark, sf)),
        DIRTY + f"SELECT {ALL} FROM dirty_orders WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL "
        "AND o_totalprice IS NOT NULL"),
    "drop_missing_all_subset": (
        lambda spark, sf: lp.drop_missing(dirty_orders(spark, sf), how="all", subset=["o_custkey", "o_orderstatus"]),
        DIRTY + f"SELECT {ALL} FROM dirty_orders WHERE o_custkey IS NOT NULL OR o_orderstatus IS NOT NULL"),
    "drop_missing_thresh": (
        lambda spark, sf: lp.drop_missing(dirty_orders(spark, sf), thresh=6),
        DIRTY + f"SELECT {ALL} FROM dirty_orders WHERE (o_custkey IS NOT NULL)::int + (o_orderstatus IS NOT NULL)::int "
        "+ (o_totalprice IS NOT NULL)::int + 3 >= 6"),
    "drop_missing_columns": (
        lambda spark, sf: lp.drop_missing(dirty_orders(spark, sf), axis=1),
        "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders"),
    "fill_constant": (
        lambda spark, sf: lp.fill_missing_constant(
            lp.fill_missing_constant(dirty_orders(spark, sf), "0", ["o_custkey", "o_totalprice"]), "Unknown", "o_orderstatus"),
        DIRTY + "SELECT o_orderkey, coalesce(o_custkey, 0) AS o_custkey, coalesce(o_orderstatus, 'Unknown') AS o_orderstatus, "
        "coalesce(o_totalprice, 0.0) AS o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
    "fill_mean": (lambda spark, sf: _money(fill("mean", "o_totalprice")(spark, sf), "o_totalprice"),
                  _fill_sql("avg(o_totalprice)")),
    "fill_median": (lambda spark, sf: _money(fill("median", "o_totalprice")(spark, sf), "o_totalprice"),
                    _fill_sql("median(o_totalprice)")),
    "fill_mode": (
        fill("mode", ["o_custkey", "o_orderstatus"]),
        DIRTY + f"SELECT o_orderkey, coalesce(o_custkey, {_mode('o_custkey')}) AS o_custkey, coalesce(o_orderstatus, "
        f"{_mode('o_orderstatus')}) AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
    "impute_mean": (lambda spark, sf: _money(lp.impute(dirty_orders(spark, sf), "mean", "o_totalprice"), "o_totalprice"),
                    _fill_sql("avg(o_totalprice)")),
    "impute_median": (lambda spark, sf: _money(lp.impute(dirty_orders(spark, sf), "median", "o_totalprice"), "o_totalprice"),
                      _fill_sql("median(o_totalprice)")),
    "impute_mode": (
        lambda spark, sf: lp.impute(dirty_orders(spark, sf), "mode", "o_orderstatus"),
        DIRTY + f"SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, {_mode('o_orderstatus')}) AS o_orderstatus, "
        "o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
    "impute_dispatch": (
        lambda spark, sf: lp.impute(lp.impute(dirty_orders(spark, sf), "custom", "o_orderstatus", value="?"), "drop"),
        DIRTY + "SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, '?') AS o_orderstatus, o_totalprice, o_orderdate, "
        "o_orderpriority FROM dirty_orders WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL"),
    "drop_duplicates_rows": (
        lambda spark, sf: lp.remove_duplicates(copied_orders(spark, sf)), f"SELECT DISTINCT * FROM ({COPIED_ORDERS})"),
    "drop_duplicates_rows_none": (
        lambda spark, sf: lp.drop_duplicates(copied_orders(spark, sf), keep=False),
        "SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'"),
    "drop_duplicates_first": (
        lambda spark, sf: lp.drop_duplicates(table(spark, sf, "documents"), "text", "first", order_by="doc_id"),
        "SELECT doc_id, text, lang, source, n_chars FROM documents "
        "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"),
    "drop_duplicates_last": (
        lambda spark, sf: lp.drop_duplicates(
            dirty_orders(spark, sf), ["o_custkey", "o_orderstatus"], "last", order_by="o_orderkey"),
        DIRTY + f"SELECT {ALL} FROM dirty_orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus "
        "ORDER BY o_orderkey DESC) = 1"),
    "drop_duplicates_none": (
        lambda spark, sf: lp.drop_duplicates(table(spark, sf, "documents"), "text", False),
        "SELECT doc_id, text, lang, source, n_chars FROM documents QUALIFY count(*) OVER (PARTITION BY text) = 1"),
    "drop_duplicates_suspects": (
        lambda spark, sf: lp.drop_duplicates(table(spark, sf, "documents"), "text", "first", order_by="doc_id", suspects_only=True),
        "SELECT doc_id, text, lang, source, n_chars FROM documents "
        "QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"),
    "drop_duplicates_rows_suspects": (
        lambda spark, sf: lp.drop_duplicates(copied_orders(spark, sf), suspects_only=True), f"SELECT DISTINCT * FROM ({COPIED_ORDERS})"),
    "convert_types": (
        lambda spark, sf: lp.convert_types(mixed_numbers(spark, sf)),
        "SELECT l_orderkey, cast(l_quantity AS bigint) AS l_quantity, l_discount, cast(l_linenumber AS varchar) AS line_text, "
        "CASE WHEN l_returnflag = 'A' THEN 'true' ELSE 'false' END AS flag_text, l_linestatus FROM lineitem"),
    "convert_types_text": (
        lambda spark, sf: lp.convert_types(mixed_numbers(spark, sf), infer_text=True),
        "SELECT l_orderkey, cast(l_quantity AS bigint) AS l_quantity, l_discount, cast(l_linenumber AS bigint) AS line_text, "
        "l_returnflag = 'A' AS flag_text, l_linestatus FROM lineitem"),
    "to_numeric": (
        lambda spark, sf: lp.to_numeric(priced_text(spark, sf), "price_text"),
        f"WITH {PRICED_CTE} SELECT o_orderkey, CASE WHEN price_text LIKE '%,%' THEN NULL ELSE "
        "try_cast(trim(price_text) AS double) END AS price_text FROM priced"),
    "to_datetime": (
        lambda spark, sf: lp.to_datetime(dated_text(spark, sf), "date_text"),
        f"WITH {DATED_CTE} SELECT o_orderkey, {MONTH_FIRST} AS date_text FROM dated"),
    "to_datetime_dayfirst": (
        lambda spark, sf: lp.to_datetime(dated_text(spark, sf), "date_text", dayfirst=True),
        f"WITH {DATED_CTE} SELECT o_orderkey, {DAY_FIRST} AS date_text FROM dated"),
    "to_datetime_spellings": (
        lambda spark, sf: lp.to_datetime(spelled_dates(spark, sf), "spelled", dayfirst=True),
        "SELECT o_orderkey, date_trunc(CASE WHEN o_orderkey % 10 IN (0, 1, 7, 8, 9) THEN 'minute' ELSE 'day' END, o_orderdate "
        "+ to_minutes(o_orderkey % 1440)) AS spelled FROM orders"),
    "ambiguous_dates": (
        lambda spark, sf: lp.ambiguous_dates(dated_text(spark, sf), "date_text"),
        "SELECT 'date_text' AS \"column\", count(*) AS ambiguous_count FROM orders WHERE o_orderstatus <> 'P' AND "
        "o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') AND day(o_orderdate) <= 12 "
        "AND day(o_orderdate) <> month(o_orderdate)"),
    "strip_whitespace": (
        lambda spark, sf: lp.strip_whitespace(noisy_text(spark, sf)),
        f"WITH {NOISY_CTE} SELECT o_orderkey, regexp_replace(label, '^\\s+|\\s+$', '', 'g') AS label FROM noisy"),
    "strip_whitespace_documents": (
        lambda spark, sf: lp.strip_whitespace(table(spark, sf, "documents").selectExpr(
            "doc_id", "concat(chr(9), ' ', text, chr(10), '  ') AS text"), "text").selectExpr("doc_id", "md5(text) AS text"),
        "SELECT doc_id, md5(regexp_replace(text, '^[\\s]+|[\\s]+$', '', 'g')) AS text FROM documents"),
    "change_case_lower": (_case("lower"), f"WITH {NOISY_CTE} SELECT o_orderkey, lower(label) AS label FROM noisy"),
    "change_case_upper": (_case("upper"), f"WITH {NOISY_CTE} SELECT o_orderkey, upper(label) AS label FROM noisy"),
    "change_case_title": (_case("title"), f"WITH {NOISY_CTE} SELECT o_orderkey, {TITLE} AS label FROM noisy"),
    "change_case_capitalize": (
        _case("capitalize"), f"WITH {NOISY_CTE} SELECT o_orderkey, upper(label[1]) || lower(label[2:]) AS label FROM noisy"),
    "replace_text_regex": (
        lambda spark, sf: lp.replace_text(noisy_text(spark, sf), "label", r"(\d)-([A-Za-z]+)", r"\2$\1"),
        f"WITH {NOISY_CTE} SELECT o_orderkey, regexp_replace(label, '(\\d)-([A-Za-z]+)', '\\2$\\1', 'g') AS label FROM noisy"),
    "replace_text_literal": (
        lambda spark, sf: lp.replace_text(noisy_text(spark, sf), "label", "-L", ".$1", regex=False),
        f"WITH {NOISY_CTE} SELECT o_orderkey, replace(label, '-L', '.$1') AS label FROM noisy"),
    "detect_outliers_iqr": (
        lambda spark, sf: _money(lp.detect_outliers_iqr(spiked_orders(spark, sf), "price"), "lower", "upper"),
        SPIKED + f", {FENCES} SELECT 'price' AS \"column\", count(*) FILTER (WHERE price < lo OR price > hi) AS count, "
        "round(any_value(lo), 4) AS lower, round(any_value(hi), 4) AS upper FROM spiked, fences"),
    "cap_outliers_iqr": (
        lambda spark, sf: _money(lp.cap_outliers_iqr(spiked_orders(spark, sf), "price"), "price"),
        SPIKED + f", {FENCES} SELECT " + PRICE.format(
            price="round(CASE WHEN price < lo THEN lo WHEN price > hi THEN hi ELSE price END, 4)") + " FROM spiked, fences"),
    "remove_outliers_iqr": (
        lambda spark, sf: lp.remove_outliers_iqr(spiked_orders(spark, sf), ["price", "custkey"]),
        SPIKED + f", {FENCES}, one AS (SELECT spiked.* FROM spiked, fences WHERE price IS NULL OR price BETWEEN lo AND hi), "
        "f2 AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT "
        "quantile_cont(custkey::double, 0.25) AS q1, quantile_cont(custkey::double, 0.75) AS q3 FROM one)) "
        "SELECT o_orderkey, o_orderpriority, price, custkey FROM one, f2 WHERE custkey IS NULL OR custkey BETWEEN lo AND hi"),
    "detect_outliers_zscore": (
        lambda spark, sf: lp.detect_outliers_zscore(spiked_orders(spark, sf), "price"),
        SPIKED + "SELECT 'price' AS \"column\", count(*) FILTER (WHERE abs(price - m) / s > 3) AS count FROM spiked, "
        "(SELECT avg(price) AS m, stddev_pop(price) AS s FROM spiked)"),
    "validate_regex": (
        lambda spark, sf: lp.validate_regex(noisy_text(spark, sf), "label", r"\d-[A-Z ]+"),
        f"WITH {NOISY_CTE} SELECT 'label' AS \"column\", count(*) FILTER (WHERE NOT coalesce(regexp_matches(label, "
        "'^(?:\\d-[A-Z ]+)'), false)) AS invalid FROM noisy"),
    "validate_range": (
        lambda spark, sf: lp.validate_range(dirty_orders(spark, sf), "o_totalprice", 5000, 400000),
        DIRTY + "SELECT 'o_totalprice' AS \"column\", count(*) FILTER (WHERE o_totalprice < 5000 OR o_totalprice > 400000) "
        "AS invalid FROM dirty_orders"),
    "clip_to_range": (
        lambda spark, sf: lp.clip_to_range(dirty_orders(spark, sf), "o_totalprice", 5000.5, 400000),
        DIRTY + "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_totalprice < 5000.5 THEN 5000.5 WHEN o_totalprice > "
        "400000 THEN 400000 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
    "invalidate": (
        lambda spark, sf: lp.invalidate(dirty_orders(spark, sf), "o_totalprice", F.col("o_totalprice") >= 5000),
        DIRTY + "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_totalprice >= 5000 THEN o_totalprice END AS "
        "o_totalprice, o_orderdate, o_orderpriority FROM dirty_orders"),
}
