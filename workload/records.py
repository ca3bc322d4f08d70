"""The record-cleaning job on employee-like records derived from the orders."""

from __future__ import annotations

import limpid as lp
from limpid.domains import DEPARTMENTS, EMPLOYEES
from pyspark.sql import DataFrame

from workload.base import table


def raw_records_sql(day, slashed, named, dashed) -> str:
    """Dirty text records; the four arguments print the order date in a dialect's own words."""
    one = f"""
        SELECT cast(o_orderkey AS string) AS Employee_ID,
          CASE o_orderpriority
            WHEN '1-URGENT' THEN concat('  clerk o''neil ', cast(o_custkey AS string), ' ')
            WHEN '2-HIGH' THEN concat('CLERK MC-DONALD ', cast(o_custkey AS string))
            WHEN '5-LOW' THEN CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('clerk ', cast(o_custkey AS string)) END
            ELSE concat('Clerk ', cast(o_custkey AS string)) END AS Name,
          CASE o_orderpriority
            WHEN '1-URGENT' THEN 'Hr' WHEN '2-HIGH' THEN 'human resources' WHEN '3-MEDIUM' THEN ' it '
            WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'F' THEN 'SALES' ELSE 'Finance' END
            ELSE CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'logistics' END END AS Department,
          CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 'clerk at orders'
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'clerk@.test'
            WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'clerk@orders'
            WHEN o_orderpriority = '2-HIGH' THEN concat(' Clerk.', cast(o_custkey AS string), '@Orders.TEST ')
            ELSE concat('clerk', cast(o_custkey AS string), '@orders.test') END AS Email,
          CASE WHEN o_orderpriority = '1-URGENT' THEN concat('+91-', substring(phone, 1, 5), ' ', substring(phone, 6, 5))
            WHEN o_orderpriority = '2-HIGH' THEN concat('0', phone)
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN '4711'
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL
            WHEN o_orderpriority = '5-LOW' THEN concat(phone, '123') ELSE phone END AS Phone,
          CASE WHEN o_orderpriority = '1-URGENT' THEN {day} WHEN o_orderpriority = '2-HIGH' THEN {slashed}
            WHEN o_orderpriority = '3-MEDIUM' THEN {named} WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {dashed}
            WHEN o_orderstatus = 'F' THEN '41/15/1995' ELSE NULL END AS Date_of_Joining,
          CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN concat('1,', cast(o_totalprice AS string))
            WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN '-1250.5'
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN '750000000'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN NULL
            ELSE cast(o_totalprice AS string) END AS Salary,
          CASE WHEN o_orderpriority = '1-URGENT' THEN cast(1 + o_custkey % 5 AS string) WHEN o_orderpriority = '2-HIGH' THEN '-2'
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'unrated'
            WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN '11' ELSE '4' END AS Rating
        FROM (SELECT *, concat('9', lpad(cast(o_orderkey AS string), 9, '0')) AS phone FROM orders) o"""
    return f"{one} UNION ALL SELECT * FROM ({one}) again WHERE Department = 'Finance'"


def raw_records(spark, sf_dir) -> DataFrame:
    sql = raw_records_sql("date_format(o_orderdate, 'yyyy-MM-dd')", "date_format(o_orderdate, 'dd/MM/yyyy')",
                          "date_format(o_orderdate, 'MMMM d, yyyy')", "date_format(o_orderdate, 'dd-MM-yyyy')")
    return spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))


RAW_SQL = raw_records_sql("strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%d/%m/%Y')",
                          "strftime(o_orderdate, '%B %-d, %Y')", "strftime(o_orderdate, '%d-%m-%Y')")

_DATE = "coalesce(" + ", ".join(f"try_strptime(Date_of_Joining, '{f}')" for f in (
    "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%B %d, %Y")) + ")"
_DEPARTMENT = "CASE lower(trim(Department)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEPARTMENTS.items()) + " ELSE 'Unknown' END"
_TITLE = ("array_to_string(list_transform(regexp_extract_all(lower(trim(Name)), '[a-z]+|[^a-z]+'), "
          "lambda p: upper(p[1]) || p[2:]), '')")

PARSED_SQL = f"""
    raw AS ({RAW_SQL}), folded AS (SELECT DISTINCT * FROM raw),
    digits AS (SELECT *, regexp_replace(Phone, '[^0-9]', '', 'g') AS d,
        try_cast(replace(Salary, ',', '') AS double) AS s, try_cast(Rating AS double) AS r FROM folded WHERE Name IS NOT NULL),
    parsed AS (SELECT Employee_ID, {_TITLE} AS Name, {_DEPARTMENT} AS Department,
        CASE WHEN regexp_full_match(lower(trim(Email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}') THEN lower(trim(Email)) END AS Email,
        '+91-' || CASE WHEN length(d) = 12 AND d LIKE '91%' THEN d[3:] WHEN length(d) = 11 AND d LIKE '0%' THEN d[2:]
            WHEN length(d) = 10 THEN d END AS Phone,
        strftime({_DATE}, '%Y-%m-%d') AS Date_of_Joining,
        CASE WHEN s >= 0 THEN s END AS s, CASE WHEN r BETWEEN 1 AND 5 THEN r END AS r FROM digits),
    fence AS (SELECT q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont(s, 0.25) AS q1, quantile_cont(s, 0.75) AS q3 FROM parsed)),
    capped AS (SELECT * EXCLUDE (s), CASE WHEN s > hi THEN hi ELSE s END AS s FROM parsed, fence),
    fill AS (SELECT median(s) AS ms, trunc(median(r)) AS mr FROM capped)"""

CLEANED_SQL = f"""WITH {PARSED_SQL} SELECT Employee_ID, Name, Department, Email, Phone, Date_of_Joining,
    cast(round_even(coalesce(s, ms), 0) AS bigint) AS Salary, cast(coalesce(r, mr) AS bigint) AS Rating FROM capped, fill"""

_SWAPPABLE = "^(\\d{1,2})[/-](\\d{1,2})[/-]\\d{4}$"
AUDIT_SQL = f"""WITH {PARSED_SQL}, f AS (SELECT * FROM folded WHERE Name IS NOT NULL)
    SELECT 'rows_in' AS metric, cast(count(*) AS double) AS value FROM raw
    UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM raw) - (SELECT count(*) FROM folded)
    UNION ALL SELECT 'rows_dropped', count(*) FROM folded WHERE Name IS NULL
    UNION ALL SELECT 'rows_out', count(*) FROM f
    UNION ALL SELECT 'Department raw_labels', count(DISTINCT Department) + max((Department IS NULL)::int) FROM f
    UNION ALL SELECT 'Department unmapped', count(*) FROM parsed WHERE Department = 'Unknown'
    UNION ALL SELECT 'Email missing_before', count(*) - count(Email) FROM f
    UNION ALL SELECT 'Email invalid_or_missing', count(*) - count(Email) FROM parsed
    UNION ALL SELECT 'Phone missing_before', count(*) - count(Phone) FROM f
    UNION ALL SELECT 'Phone invalid_or_missing', count(*) - count(Phone) FROM parsed
    UNION ALL SELECT 'Date_of_Joining missing_before', count(*) - count(Date_of_Joining) FROM f
    UNION ALL SELECT 'Date_of_Joining invalid_or_missing', count(*) - count(Date_of_Joining) FROM parsed
    UNION ALL SELECT 'Date_of_Joining ambiguous', count(*) FROM (
        SELECT try_cast(regexp_extract(trim(Date_of_Joining), '{_SWAPPABLE}', 1) AS int) AS a,
        try_cast(regexp_extract(trim(Date_of_Joining), '{_SWAPPABLE}', 2) AS int) AS b FROM f)
        WHERE a BETWEEN 1 AND 12 AND b BETWEEN 1 AND 12 AND a <> b
    UNION ALL SELECT 'Salary negative', count(*) FROM digits WHERE s < 0
    UNION ALL SELECT 'Salary capped', count(*) FROM parsed, fence WHERE s > hi
    UNION ALL SELECT 'Salary imputed', count(*) - count(s) FROM parsed
    UNION ALL SELECT 'Salary upper_fence', round(hi, 3) FROM fence
    UNION ALL SELECT 'Salary median', round(ms, 3) FROM fill
    UNION ALL SELECT 'Rating out_of_range', count(*) FROM digits WHERE r NOT BETWEEN 1 AND 5
    UNION ALL SELECT 'Rating imputed', count(*) - count(r) FROM parsed
    UNION ALL SELECT 'Rating median', mr FROM fill"""


def cleaned(spark, sf_dir) -> DataFrame:
    return lp.clean_records(raw_records(spark, sf_dir), EMPLOYEES).table


def audit(spark, sf_dir) -> DataFrame:
    job = lp.clean_records(raw_records(spark, sf_dir), EMPLOYEES)
    return job.audit().selectExpr(
        "CASE WHEN `column` IS NULL THEN metric ELSE concat(`column`, ' ', metric) END AS metric", "round(value, 3) AS value")


QUERIES = {
    "record_cleaning": (cleaned, CLEANED_SQL),
    "record_cleaning_audit": (audit, AUDIT_SQL),
}
