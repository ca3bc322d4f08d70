"""Writing the tables in every format and reading them back."""

from __future__ import annotations

import limpid as lp
from limpid.streaming.clean_stream import clean_stream, write_stream
from pyspark.sql import functions as F

from workload.base import DIRTY_ORDERS_CTE, GAPPY_EVENTS, GAPPY_EVENTS_CTE, dirty_orders, gappy_events, output_root, table
from workload.profiling import MISSING, REPORT_SQL as PROFILE_SQL, rounded_report

ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def round_trip(fmt, **options):
    def run(spark, sf):
        path = f"{output_root(spark)}/orders.{fmt}"
        lp.write_table(dirty_orders(spark, sf), path)
        back = lp.select_columns(lp.read_table(spark, path, **options), ALL.split(", "))
        return lp.to_datetime(back, "o_orderdate")
    return run


def csv_as_text(spark, sf):
    path = f"{output_root(spark)}/orders.csv"
    lp.write_csv(dirty_orders(spark, sf), path)
    return lp.read_text_table(spark, path)


def csv_markers(spark, sf):
    """Text markers for "no value" must come back as missing and leave the numbers typed."""
    path = f"{output_root(spark)}/marked.csv"
    marked = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus = 'P' THEN 'N/A' WHEN o_orderstatus = 'F' THEN 'null' ELSE "
        "cast(o_totalprice AS string) END AS price", "concat(o_orderpriority, ', \"', o_orderstatus, '\"') AS note")
    lp.write_csv(marked, path)
    return lp.read_csv(spark, path)


def converted(spark, sf):
    root = output_root(spark)
    lp.write_csv(dirty_orders(spark, sf), f"{root}/in.csv")
    lp.convert(spark, f"{root}/in.csv", {"json": f"{root}/out.jsonl", "xml": f"{root}/out.xml"})
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string")
    parts = [lp.read_table(spark, f"{root}/out.jsonl", schema=schema),
             lp.to_datetime(lp.select_columns(lp.read_table(spark, f"{root}/out.xml"), ALL.split(", ")), "o_orderdate")]
    return lp.concat_with(parts[0], parts[1])


def documents_csv(spark, sf):
    """Long texts with line breaks and quotes survive a CSV round trip, read by as many tasks as the files have splits."""
    path = f"{output_root(spark)}/documents.csv"
    lp.write_csv(table(spark, sf, "documents"), path)
    back = lp.read_csv(spark, path, split=True, schema=DOCUMENTS)
    return back.selectExpr("doc_id", "md5(text) AS text", "lang", "source", "n_chars")


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def json_array(spark, sf):
    """Files that each hold one array of records, texts with quotes and line breaks in them, read in splits."""
    path = f"{output_root(spark)}/arrays"
    records = table(spark, sf, "documents").select(
        F.expr("doc_id div 500").alias("part"), F.struct("doc_id", F.expr("concat('{\"', text, '\"}')").alias("text"), "lang", "source",
                                                         "n_chars").alias("record"))
    arrays = records.groupBy("part").agg(F.to_json(F.collect_list("record")).alias("value"))
    arrays.write.partitionBy("part").text(path)
    back = lp.read_json(spark, path, split=True, schema=DOCUMENTS)
    return back.selectExpr("doc_id", "md5(text) AS text", "lang", "source", "n_chars")


def report_sink(spark, sf):
    """The profile, the audit and the number of text lines as they are found in the written report."""
    folder = f"{output_root(spark)}/report"
    df = dirty_orders(spark, sf)
    chain = lp.Chain(df).drop_missing(subset="o_custkey")
    chain.run(lambda kept: kept.write.format("noop").mode("overwrite").save())
    report = lp.full_report(df)
    lp.write_report(report, chain.audit(), folder, lines=lp.report_text(report, df.columns))
    form = "section string, column string, metric string, value string"
    audit = spark.read.json(f"{folder}/audit").selectExpr(
        "'audit' AS section", "operator AS column",
        "inline(array(struct('rows_before' AS metric, cast(rows_before AS string) AS value), "
        "struct('rows_after' AS metric, cast(rows_after AS string) AS value)))")
    lines = spark.read.text(f"{folder}/text").selectExpr(
        "'text' AS section", "cast(NULL AS string) AS column", "'missing_lines' AS metric",
        "value").where("value LIKE '%missing=%'").selectExpr("section", "column", "metric", "trim(value) AS value")
    return rounded_report(spark.read.schema(form).json(f"{folder}/profile")).unionByName(audit).unionByName(lines)


REPORT_SQL = f"WITH {DIRTY_ORDERS_CTE} {PROFILE_SQL}" + """
    UNION ALL SELECT 'audit', 'drop_missing', 'rows_before', cast(count(*) AS varchar) FROM dirty_orders
    UNION ALL SELECT 'audit', 'drop_missing', 'rows_after', cast(count(o_custkey) AS varchar) FROM dirty_orders
    UNION ALL SELECT 'text', NULL, 'missing_lines', "column" || ': missing=' || missing || ', percent=' ||
    cast(round(missing * 100.0::double / rows, 2) AS varchar) FROM (""" + f"{MISSING}) WHERE missing > 0"


def stream_cleaning(spark, sf):
    """A chain fitted on the table, applied to the same files as a stream."""
    events = gappy_events(spark, sf)
    chain = (lp.Chain(events).fill_missing_statistic("mean", "value").change_case("event_type", "upper")
             .filter_query("user_id IS NOT NULL"))
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    dirty = stream.selectExpr(*[f"{e} AS {n}" for n, e in GAPPY_EVENTS.items()])
    root = output_root(spark)
    write_stream(clean_stream(chain, dirty), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").withColumn("value", F.round("value", 4))


STREAM_SQL = (f"WITH {GAPPY_EVENTS_CTE} SELECT event_id, user_id, upper(event_type) AS event_type, round(coalesce(value, "
              "(SELECT avg(value) FROM gappy)), 4) AS value FROM gappy WHERE user_id IS NOT NULL")

PLAIN = f"WITH {DIRTY_ORDERS_CTE} SELECT {ALL} FROM dirty_orders"
QUERIES = {
    "csv_round_trip": (round_trip("csv"), PLAIN),
    "csv_as_text": (
        csv_as_text, f"WITH {DIRTY_ORDERS_CTE} SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS "
        "o_custkey, o_orderstatus, cast(o_totalprice AS varchar) AS o_totalprice, "
        "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority FROM dirty_orders"),
    "csv_markers": (
        csv_markers, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS price, "
        "o_orderpriority || ', \"' || o_orderstatus || '\"' AS note FROM orders"),
    "csv_documents": (
        documents_csv, "SELECT doc_id, md5(text) AS text, lang, source, n_chars FROM documents"),
    "json_array_read": (
        json_array, "SELECT doc_id, md5('{\"' || text || '\"}') AS text, lang, source, n_chars FROM documents"),
    "json_round_trip": (round_trip("jsonl"), PLAIN),
    "xml_round_trip": (round_trip("xml"), PLAIN),
    "parquet_round_trip": (round_trip("parquet"), PLAIN),
    "orc_round_trip": (round_trip("orc"), PLAIN),
    "report_sink": (report_sink, REPORT_SQL),
    "stream_cleaning": (stream_cleaning, STREAM_SQL),
    "convert_formats": (converted, f"{PLAIN} UNION ALL SELECT {ALL} FROM dirty_orders"),
}
