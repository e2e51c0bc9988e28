"""Queries of planning from a schema and from observed values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from quayload.operators import planning
from quayload.plans.registry import query, table
from quayload.plans.sqltext import utf16
from quayload.policy import PlanOptions
from quayload.sources.shapes import source

_SIZED = "CASE WHEN greatest(coalesce(max({u}), 0), 1) > 4000 THEN 'nvarchar(max)' " \
         "ELSE 'nvarchar(' || greatest(coalesce(max({u}), 0), 1)::VARCHAR || ')' END"


def _text(table_name: str, column: str) -> str:
    return f"(SELECT {_SIZED.format(u=utf16(column))} FROM {table_name})"


_REASON = "nested has no target type"


@query("plan_columns", f"""
WITH r(table_name, field_index, field_name, source_type, target_type, code, reason) AS (
  SELECT 'documents', 0, 'doc_id', 'int64', 'bigint', NULL, NULL UNION ALL
  SELECT 'documents', 1, 'text', 'utf8', {_text('documents', 'text')}, NULL, NULL UNION ALL
  SELECT 'documents', 2, 'lang', 'utf8', {_text('documents', 'lang')}, NULL, NULL UNION ALL
  SELECT 'documents', 3, 'source', 'utf8', {_text('documents', 'source')}, NULL, NULL UNION ALL
  SELECT 'documents', 4, 'n_chars', 'int64', 'bigint', NULL, NULL UNION ALL
  SELECT 'embeddings', 0, 'vec_id', 'int64', 'bigint', NULL, NULL UNION ALL
  SELECT 'embeddings', 1, 'embedding', 'nested', NULL, 'UnsupportedArrowType', '{_REASON}' UNION ALL
  SELECT 'embeddings', 2, 'label', 'int32', 'int', NULL, NULL UNION ALL
  SELECT 'events', 0, 'event_id', 'int64', 'bigint', NULL, NULL UNION ALL
  SELECT 'events', 1, 'ts', 'timestamp(us)', 'datetime2(3)', NULL, NULL UNION ALL
  SELECT 'events', 2, 'user_id', 'int64', 'bigint', NULL, NULL UNION ALL
  SELECT 'events', 3, 'event_type', 'utf8', {_text('events', 'event_type')}, NULL, NULL UNION ALL
  SELECT 'events', 4, 'value', 'float64', 'float(53)', NULL, NULL UNION ALL
  SELECT 'events', 5, 'props', 'utf8', {_text('events', 'props')}, NULL, NULL)
SELECT *, split_part(target_type, '(', 1) AS target_family, true AS nullable FROM r""")
def plan_columns(spark, sf_dir) -> DataFrame:
    options = PlanOptions(string="observed", timestamp=3)
    reports = [
        planning.plan_report(table(spark, sf_dir, name), options).withColumn("table_name", F.lit(name))
        for name in ("documents", "embeddings", "events")
    ]
    return reduce(DataFrame.unionByName, reports)


@query("observed_nvarchar", f"""
SELECT 'text' AS field_name, max({utf16('text')}) AS max_units, {_SIZED.format(u=utf16('text'))} AS target_type FROM documents
UNION ALL SELECT 'tag', max({utf16("(lang || '😀')")}), {_SIZED.format(u=utf16("(lang || '😀')"))} FROM documents
UNION ALL SELECT 'source', max({utf16('source')}), {_SIZED.format(u=utf16('source'))} FROM documents""")
def observed_nvarchar(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("text", F.concat("lang", F.lit("😀")).alias("tag"), "source")
    return planning.observed_nvarchar(df, ["text", "tag", "source"])


@query("observed_varbinary", """
SELECT 'body' AS field_name, min(octet_length(encode(text))) AS min_bytes, max(octet_length(encode(text))) AS max_bytes,
       CASE WHEN max(octet_length(encode(text))) > 8000 THEN 'varbinary(max)'
            ELSE 'varbinary(' || max(octet_length(encode(text)))::VARCHAR || ')' END AS target_type FROM documents
UNION ALL SELECT 'digest', 16, 16, 'binary(16)' FROM (SELECT count(*) FROM documents)
UNION ALL SELECT 'origin', min(octet_length(encode(source))), max(octet_length(encode(source))),
       CASE WHEN min(octet_length(encode(source))) = max(octet_length(encode(source))) THEN 'binary(' ELSE 'varbinary(' END
       || max(octet_length(encode(source)))::VARCHAR || ')' FROM documents""")
def observed_varbinary(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(
        F.encode("text", "UTF-8").alias("body"), F.unhex(F.md5("text")).alias("digest"),
        F.encode("source", "UTF-8").alias("origin"))
    return planning.observed_varbinary(df, ["body", "digest", "origin"])


@query("date64_midnight_proof", """
SELECT 'shipped' AS field_name, count(l_shipdate) AS value_count,
       count(*) FILTER (epoch_ms(l_shipdate) % 86400000 <> 0) AS off_midnight,
       CASE WHEN count(*) FILTER (epoch_ms(l_shipdate) % 86400000 <> 0) = 0 THEN 'date' ELSE 'datetime2(3)' END AS target_type
FROM lineitem
UNION ALL
SELECT 'noted', count(*), count(*) FILTER ((epoch_ms(l_shipdate) + l_partkey % 100) % 86400000 <> 0),
       CASE WHEN count(*) FILTER ((epoch_ms(l_shipdate) + l_partkey % 100) % 86400000 <> 0) = 0 THEN 'date' ELSE 'datetime2(3)' END
FROM lineitem""")
def date64_midnight_proof(spark, sf_dir):
    seconds = (F.hour("l_shipdate") * 60 + F.minute("l_shipdate")) * 60 + F.second("l_shipdate")
    millis = (F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * 86_400 + seconds) * 1000
    df = table(spark, sf_dir, "lineitem").select(
        source(millis, "shipped", "date64"), source(millis + F.col("l_partkey") % 100, "noted", "date64"))
    return planning.midnight_proof(df, ["shipped", "noted"])


def _shape_sql(name: str, digits: str, scale: int) -> str:
    trimmed = f"ltrim({digits}, '-0')"
    left = f"coalesce(max(CASE WHEN {trimmed} = '' THEN 0 ELSE greatest(length({trimmed}) - {scale}, 0) END), 0)"
    right = (f"coalesce(max(CASE WHEN {trimmed} = '' THEN 0 ELSE "
             f"greatest({scale} - (length({trimmed}) - length(rtrim({trimmed}, '0'))), 0) END), 0)")
    return (f"SELECT '{name}' AS field_name, {left}::BIGINT AS integer_digits, {right}::BIGINT AS fraction_digits, "
            f"CASE WHEN {left} + {right} <= 38 THEN 'decimal(' || greatest({left} + {right}, 1)::VARCHAR || ',' || {right}::VARCHAR || ')' END AS target_type, "
            f"CASE WHEN {left} + {right} > 38 THEN 'DecimalOutOfRange' END AS code FROM s")


@query("observed_decimal_shape", f"""
WITH s AS (SELECT round(l_extendedprice * 100)::BIGINT::VARCHAR AS cents,
                  (-(l_quantity::BIGINT) * 1000)::VARCHAR AS quantity,
                  (l_orderkey + 1)::VARCHAR || repeat('3', 40) AS huge FROM lineitem)
{_shape_sql('cents', 'cents', 2)} UNION ALL {_shape_sql('quantity', 'quantity', 4)} UNION ALL {_shape_sql('huge', 'huge', 5)}""")
def observed_decimal_shape(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string").alias("cents"),
        (-F.col("l_quantity").cast("bigint") * 1000).cast("string").alias("quantity"),
        F.concat((F.col("l_orderkey") + 1).cast("string"), F.repeat(F.lit("3"), 40)).alias("huge"))
    return planning.observed_decimal_shape(df, {"cents": 2, "quantity": 4, "huge": 5})


@query("null_profile", """
SELECT 'value' AS field_name, false AS nullable, count(*) AS row_count, count(*) FILTER (event_id % 53 = 0) AS null_count,
       CASE WHEN count(*) FILTER (event_id % 53 = 0) > 0 THEN 'NullInNonNullableColumn' END AS code FROM events
UNION ALL SELECT 'props', true, count(*), count(*) FILTER (event_id % 7 = 0), NULL FROM events
UNION ALL SELECT 'user_id', false, count(*), count(*) FILTER (user_id IS NULL), NULL FROM events""")
def null_profile(spark, sf_dir):
    key = F.col("event_id")
    df = table(spark, sf_dir, "events").select(
        F.when(key % 53 != 0, F.col("value")).alias("value"), F.when(key % 7 != 0, F.col("props")).alias("props"), "user_id")
    return planning.null_profile(df, {"value": True, "props": False, "user_id": True})
