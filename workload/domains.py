"""The record-cleaning job on patients, products and applicants derived from the tables.

The raw records are one SQL text that both engines read; the checking SQL is put together from the same rules, in
the checking engine's own words.
"""

from __future__ import annotations

import limpid as lp
from limpid.domains import APPLICANTS, PATIENTS, PRODUCTS
from limpid.operators.records import RecordRules, parsed_names
from pyspark.sql import DataFrame

from workload.base import table


def _choice(key: str, *values: str | None) -> str:
    """One of some texts, by a whole number."""
    cases = " ".join(f"WHEN {n} THEN " + ("NULL" if v is None else f"'{v}'") for n, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


def _date(key: str) -> str:
    """Dates in four spellings, some that aren't any, some missing."""
    year, month, day = f"cast(2015 + {key} % 9 AS string)", f"lpad(cast(1 + {key} % 12 AS string), 2, '0')", f"lpad(cast(1 + {key} % 28 AS string), 2, '0')"
    return (f"CASE {key} % 7 WHEN 0 THEN concat({year}, '-', {month}, '-', {day}) WHEN 1 THEN concat({month}, '/', {day}, '/', {year}) "
            f"WHEN 2 THEN concat({day}, '-', {month}, '-', {year}) WHEN 3 THEN concat({year}, '/', {month}, '/', {day}) "
            f"WHEN 4 THEN 'not-a-date' WHEN 5 THEN NULL ELSE concat('March ', cast(1 + {key} % 28 AS string), ', ', {year}) END")


def _phone(key: str) -> str:
    plain = f"concat('9', lpad(cast({key} AS string), 9, '0'))"
    return (f"CASE {key} % 5 WHEN 0 THEN {plain} WHEN 1 THEN concat('+91-', substring({plain}, 1, 5), ' ', substring({plain}, 6, 5)) "
            f"WHEN 2 THEN concat('0', {plain}) WHEN 3 THEN '12345' ELSE NULL END")


PATIENT_ROWS = f"""SELECT cast(c_custkey AS string) AS Patient_ID,
    CASE c_mktsegment WHEN 'BUILDING' THEN concat('  ', lower(c_name), ' o''hara ') WHEN 'MACHINERY' THEN NULL ELSE upper(c_name) END AS Name,
    CASE c_nationkey WHEN 3 THEN NULL WHEN 4 THEN 'forty' ELSE cast(c_nationkey * 7 - 20 AS string) END AS Age,
    {_choice("c_nationkey", "M", " male", "FEMALE", "f ", None, "other")} AS Gender,
    {_choice("c_custkey", "o+", "O Positive", "AB -", " b+", "A negative", "unknown type", None)} AS Blood_Group,
    {_choice("c_custkey", "type 2 Diabetes", "ASTHMA", " migraine ", "Flu", None)} AS Diagnosis,
    {_phone("c_custkey")} AS Phone, {_date("c_custkey")} AS Admission_Date,
    CASE c_nationkey WHEN 1 THEN concat('1,', cast(100 + c_custkey % 800 AS string), '.5') WHEN 2 THEN '99999999' WHEN 5 THEN NULL
        ELSE cast(c_acctbal AS string) END AS Bill_Amount
    FROM customer"""
PRODUCT_ROWS = f"""SELECT cast(p_partkey AS string) AS Product_ID,
    CASE WHEN p_size = 7 THEN NULL WHEN p_size < 20 THEN upper(p_name) ELSE concat(' ', p_name) END AS Product_Name,
    {_choice("p_size", "Elec.", "electronics", "APPAREL", "Home and Kitchen", "home & kitchen ", "toys", None)} AS Category,
    CASE WHEN p_size = 9 THEN NULL WHEN p_size = 10 THEN 'free' WHEN p_size = 11 THEN '₹99999999' WHEN p_size = 12 THEN '-5'
        WHEN p_size < 30 THEN concat('₹', cast(p_retailprice AS string)) ELSE cast(p_retailprice AS string) END AS Price,
    {_choice("p_partkey", "1", "4", "5", "0", "6", "-1", "N/A", "3", None)} AS Rating,
    CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN concat('1,', cast(100 + p_partkey % 900 AS string)) ELSE cast(p_partkey % 500 AS string) END AS Reviews_Count,
    {_choice("p_partkey", "sellerA", "BESTDEALS", "QuickKart ", None)} AS Seller, {_date("p_partkey")} AS Listed_Date
    FROM part"""
APPLICANT_ROWS = f"""SELECT cast(o_orderkey AS string) AS Applicant_ID,
    CASE o_orderstatus WHEN 'P' THEN concat('  mary-ann ', cast(o_custkey AS string)) ELSE concat('MR. X ', cast(o_custkey AS string)) END AS Name,
    CASE o_orderstatus WHEN 'P' THEN 'not-an-email' WHEN 'F' THEN concat(' Applicant', cast(o_custkey AS string), '@Mail.Example.COM ')
        ELSE concat('user ', cast(o_custkey AS string), '@example.com') END AS Email,
    {_phone("o_custkey")} AS Phone,
    {_choice("o_custkey", "B.Tech", "btech", "Bachelor of Technology", " MBA", "phd", None)} AS Degree,
    {_choice("o_orderkey", "IIT DELHI", "anna university", "Elsewhere", None)} AS University,
    {_choice("o_custkey", "3 years", "Fresher", " fresher", "12 Years", "0", "many", None)} AS Experience_Years,
    {_date("o_custkey")} AS Applied_Date,
    {_choice("o_orderkey", "selected", "On Hold", "on_hold", "REJECTED", "withdrawn", None)} AS Status
    FROM orders"""


def raw_sql(rows: str, key: str) -> str:
    """The records, those of one label twice."""
    return f"{rows} UNION ALL SELECT * FROM ({rows}) again WHERE {key}"


def _text(name: str) -> str:
    return f"trim({name})"


def _number(name: str) -> str:
    return f"try_cast(replace(replace({name}, ',', ''), '₹', '') AS double)"


def _parsed(name: str, rules: RecordRules) -> str:
    """One field in the checking engine's words, before caps and fills."""
    if name in rules.names:
        return (f"array_to_string(list_transform(regexp_extract_all(lower({_text(name)}), '[a-z]+|[^a-z]+'), "
                f"lambda p: upper(p[1]) || p[2:]), '')")
    if name in rules.categories:
        whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.categories[name].items())
        return f"CASE lower({_text(name)}) {whens} ELSE '{rules.unknown}' END"
    if name in rules.emails:
        plain = f"lower({_text(name)})"
        return f"CASE WHEN regexp_full_match({plain}, '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}') THEN {plain} END"
    if name in rules.phones:
        d = f"regexp_replace({name}, '[^0-9]', '', 'g')"
        return (f"'+91-' || CASE WHEN length({d}) = 12 AND {d} LIKE '91%' THEN {d}[3:] WHEN length({d}) = 11 AND {d} LIKE '0%' "
                f"THEN {d}[2:] WHEN length({d}) = 10 THEN {d} END")
    if name in rules.dates:
        forms = ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%B %d, %Y")
        return "strftime(coalesce(" + ", ".join(f"try_strptime({name}, '{f}')" for f in forms) + "), '%Y-%m-%d')"
    if name in rules.amounts or name in rules.plain_amounts:
        return f"CASE WHEN {_number(name)} >= 0 THEN {_number(name)} END"
    if name in rules.scores or name in rules.ranges:
        low, high = {**rules.scores, **rules.ranges}[name]
        return f"CASE WHEN try_cast({name} AS double) BETWEEN {low} AND {high} THEN try_cast({name} AS double) END"
    if name in rules.counts:
        whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.counts[name].items())
        return f"CASE lower({_text(name)}) {whens} ELSE try_cast(regexp_extract({_text(name)}, '^(\\d+)', 1) AS bigint) END"
    return name


def _finished(name: str, rules: RecordRules) -> str:
    if name in rules.amounts:
        return f"cast(round_even(coalesce(CASE WHEN {name} > hi_{name} THEN hi_{name} ELSE {name} END, mid_{name}), 0) AS bigint) AS {name}"
    if name in rules.plain_amounts:
        return f"cast(round_even({name}, 0) AS bigint) AS {name}"
    if name in rules.scores:
        return f"cast(coalesce({name}, trunc(mid_{name})) AS bigint) AS {name}"
    if name in rules.ranges:
        return f"cast(trunc({name}) AS bigint) AS {name}"
    return name


def cleaned_sql(raw: str, rules: RecordRules, key: str) -> str:
    names = [key, *parsed_names(rules)]
    present = " AND ".join(f"{n} IS NOT NULL" for n in rules.required) or "true"
    fits = [f"quantile_cont({n}, 0.75) + 1.5 * (quantile_cont({n}, 0.75) - quantile_cont({n}, 0.25)) AS hi_{n}, median({n}) AS mid_{n}"
            for n in rules.amounts] + [f"median({n}) AS mid_{n}" for n in rules.scores]
    fit = f", fit AS (SELECT {', '.join(fits)} FROM parsed)" if fits else ""
    return (f"WITH raw AS ({raw}), parsed AS (SELECT {', '.join(f'{_parsed(n, rules)} AS {n}' for n in names)} "
            f"FROM (SELECT DISTINCT * FROM raw) WHERE {present}){fit} "
            f"SELECT {', '.join(_finished(n, rules) for n in names)} FROM parsed{', fit' if fits else ''}")


def _job(source: str, rows: str, again: str, rules: RecordRules, key: str):
    raw = raw_sql(rows, again)

    def run(spark, sf_dir) -> DataFrame:
        df = spark.sql(raw.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))
        return lp.clean_records(df, rules).table

    return run, cleaned_sql(raw, rules, key)


QUERIES = {
    "patient_cleaning": _job("customer", PATIENT_ROWS, "Gender = 'M'", PATIENTS, "Patient_ID"),
    "product_cleaning": _job("part", PRODUCT_ROWS, "Seller = 'BESTDEALS'", PRODUCTS, "Product_ID"),
    "applicant_cleaning": _job("orders", APPLICANT_ROWS, "Status = 'On Hold'", APPLICANTS, "Applicant_ID"),
}
