"""Queries of load bytes and packing, and the readiness report that uses them all."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayload.operators import conform, packing, sizing
from quayload.operators.planning import plan_schema
from quayload.plans.registry import query, table
from quayload.plans.sqltext import utf16
from quayload.policy import LoadPlan, PlannedColumn, PlanOptions, SourceType, TargetType
from quayload.sources.batching import batches_by_key
from quayload.sources.shapes import shaped

DOC_BATCH = 64
DOC_LIMIT = 65_536

DOCUMENT_PLAN = LoadPlan((
    PlannedColumn(0, "doc_id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "text", True, SourceType("utf8"), TargetType("nvarchar")),
    PlannedColumn(2, "lang", True, SourceType("utf8"), TargetType("nvarchar", length=4)),
    PlannedColumn(3, "source", True, SourceType("utf8"), TargetType("nvarchar", length=20)),
    PlannedColumn(4, "n_chars", True, SourceType("int64"), TargetType("bigint")),
))


def documents(spark, sf_dir):
    """Documents in batches, with some NULLs."""
    key = F.col("doc_id")
    df = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(key % 17 != 0, F.col("text")).alias("text"), F.when(key % 19 != 0, F.col("lang")).alias("lang"),
        "source", F.when(key % 23 != 0, F.col("n_chars")).alias("n_chars"))
    return batches_by_key(df, "doc_id", DOC_BATCH)


_TEXT, _LANG, _SRC = f"2 * {utf16('text')}", f"2 * {utf16('lang')}", f"2 * {utf16('source')}"
DOCUMENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, doc_id // {DOC_BATCH} AS batch_id, CASE WHEN doc_id % 17 <> 0 THEN text END AS text,
                  CASE WHEN doc_id % 19 <> 0 THEN lang END AS lang, source, CASE WHEN doc_id % 23 <> 0 THEN n_chars END AS n_chars
           FROM documents),
     c AS (SELECT *, 8 AS id_b,
                  CASE WHEN text IS NULL THEN 8 ELSE 12 + {_TEXT} + CASE WHEN length(text) > 0 THEN 4 ELSE 0 END END AS text_b,
                  CASE WHEN lang IS NULL THEN 2 ELSE 2 + {_LANG} END AS lang_b,
                  CASE WHEN source IS NULL THEN 2 ELSE 2 + {_SRC} END AS source_b,
                  CASE WHEN n_chars IS NULL THEN 1 ELSE 9 END AS n_b FROM d),
     r AS (SELECT *, (1 + id_b + text_b + lang_b + source_b + n_b)::BIGINT AS row_bytes FROM c)
"""


@query("cell_bytes", DOCUMENTS + """
SELECT 0 AS field_index, 'doc_id' AS field_name, 'bigint' AS target_type, sum(id_b)::BIGINT AS cell_bytes, 0::BIGINT AS null_cells FROM r
UNION ALL SELECT 1, 'text', 'nvarchar(max)', sum(text_b)::BIGINT, count(*) FILTER (text IS NULL) FROM r
UNION ALL SELECT 2, 'lang', 'nvarchar(4)', sum(lang_b)::BIGINT, count(*) FILTER (lang IS NULL) FROM r
UNION ALL SELECT 3, 'source', 'nvarchar(20)', sum(source_b)::BIGINT, count(*) FILTER (source IS NULL) FROM r
UNION ALL SELECT 4, 'n_chars', 'bigint', sum(n_b)::BIGINT, count(*) FILTER (n_chars IS NULL) FROM r""")
def cell_bytes(spark, sf_dir):
    return sizing.column_bytes(documents(spark, sf_dir), DOCUMENT_PLAN)


def _typed(index, name, target, value, null_size, rule="false"):
    return (f"SELECT {index} AS field_index, '{name}' AS field_name, '{target}' AS target_type, "
            f"sum(CASE WHEN {rule} THEN {null_size} ELSE {value} END)::BIGINT AS cell_bytes, "
            f"count(*) FILTER ({rule}) AS null_cells FROM events")


@query("cell_bytes_typed", " UNION ALL ".join([
    _typed(0, "transaction_id", "bigint", 9, 1), _typed(1, "account_id", "int", 5, 1),
    _typed(2, "amount", "decimal(18,4)", 6, 1), _typed(3, "fee", "decimal(12,4)", 6, 1, "event_id % 11 = 0"),
    _typed(4, "trade_date", "date", 4, 1), _typed(5, "posted_at_ms", "datetime2(3)", 8, 1),
    _typed(6, "approved", "bit", 2, 1, "event_id % 17 = 0"), _typed(7, "digest", "binary(16)", 18, 2),
    _typed(8, "blob", "varbinary(64)", "2 + event_id % 60", 2, "event_id % 29 = 0"),
    _typed(9, "at", "time(7)", 6, 1), _typed(10, "moment", "datetimeoffset(7)", 11, 1), _typed(11, "ratio", "real", 5, 1),
    _typed(12, "spread", "decimal(38,4)", "CASE WHEN event_id % 34 <= 4 THEN 6 WHEN event_id % 34 <= 14 THEN 10 "
           "WHEN event_id % 34 <= 23 THEN 14 ELSE 18 END", 1),
]))
def cell_bytes_typed(spark, sf_dir):
    key = F.col("event_id")
    df = shaped(table(spark, sf_dir, "events"), "event_id", "decimal_temporal", ["event_id", "value"])
    df = df.select(
        *df.columns, F.unhex(F.md5(key.cast("string"))).alias("digest"),
        F.when(key % 29 != 0, F.encode(F.repeat(F.lit("x"), (key % 60).cast("int")), "UTF-8")).alias("blob"),
        (key * 100).alias("at"), F.timestamp_micros(key).alias("moment"), F.col("value").cast("float").alias("ratio"),
        F.concat(F.lit("-1"), F.repeat(F.lit("0"), (key % 34).cast("int"))).cast("decimal(38,4)").alias("spread"))
    base = plan_schema(df.drop("event_id", "value", "digest", "blob", "at", "moment", "ratio", "spread").schema, PlanOptions(timestamp=3))
    extra = (
        ("digest", SourceType("fixed_binary", length=16), TargetType("binary", length=16)),
        ("blob", SourceType("binary"), TargetType("varbinary", length=64)),
        ("at", SourceType("time", unit="ns"), TargetType("time", precision=7)),
        ("moment", SourceType("timestamp", unit="us", zone="UTC"), TargetType("datetimeoffset", precision=7)),
        ("ratio", SourceType("float32"), TargetType("real")),
        ("spread", SourceType("decimal", precision=38, scale=4), TargetType("decimal", precision=38, scale=4)),
    )
    columns = tuple(
        PlannedColumn(c.index, c.name, True, c.source, c.target) for c in base.columns
    ) + tuple(PlannedColumn(len(base.columns) + i, n, True, s, t) for i, (n, s, t) in enumerate(extra))
    return sizing.column_bytes(df, LoadPlan(columns))


@query("row_bytes", DOCUMENTS + "SELECT doc_id, row_bytes FROM r")
def row_bytes(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", sizing.row_bytes(DOCUMENT_PLAN).alias("row_bytes"))


@query("payload_bytes", DOCUMENTS + """
SELECT batch_id, count(*) AS row_count, sum(row_bytes)::BIGINT AS payload_bytes, max(row_bytes) AS max_row_bytes
FROM r GROUP BY batch_id""")
def payload_bytes(spark, sf_dir):
    return sizing.batch_bytes(documents(spark, sf_dir), DOCUMENT_PLAN, "batch_id")


def _packed(batch: str, limit: int) -> str:
    return DOCUMENTS + f"""
   , n AS (SELECT *, {batch} AS b, row_number() OVER (PARTITION BY {batch} ORDER BY doc_id) - 1 AS i FROM r),
     g(b, i, range_no, open_bytes, row_bytes) AS (
       SELECT b, i, 0::BIGINT, row_bytes, row_bytes FROM n WHERE i = 0
       UNION ALL
       SELECT n.b, n.i, CASE WHEN g.open_bytes + n.row_bytes > {limit} THEN g.range_no + 1 ELSE g.range_no END,
              CASE WHEN g.open_bytes + n.row_bytes > {limit} THEN n.row_bytes ELSE g.open_bytes + n.row_bytes END, n.row_bytes
       FROM g JOIN n ON n.b IS NOT DISTINCT FROM g.b AND n.i = g.i + 1),
     ranges AS (SELECT b AS batch_id, range_no, min(i) AS start_row, count(*) AS row_count,
                       sum(row_bytes)::BIGINT AS range_bytes FROM g GROUP BY b, range_no)
"""


def document_ranges(spark, sf_dir):
    sized = documents(spark, sf_dir).select("batch_id", "doc_id", sizing.row_bytes(DOCUMENT_PLAN).alias("row_bytes"))
    # Batches are cut by a unique key, so none has more rows than the cut allows.
    return packing.pack_ranges(sized, "batch_id", ["doc_id"], "row_bytes", DOC_LIMIT, DOC_BATCH)


@query("pack_ranges", _packed("batch_id", DOC_LIMIT) + "SELECT * FROM ranges")
def pack_ranges(spark, sf_dir):
    return document_ranges(spark, sf_dir)


@query("pack_ranges_unbounded", _packed("nullif(lang, 'fr')", DOC_LIMIT) + "SELECT * FROM ranges")
def pack_ranges_unbounded(spark, sf_dir):
    """One batch per language, one of them NULL: a batch may hold most of the table."""
    sized = documents(spark, sf_dir).select(
        F.nullif("lang", F.lit("fr")).alias("batch_id"), "doc_id", sizing.row_bytes(DOCUMENT_PLAN).alias("row_bytes"))
    return packing.pack_ranges(sized, "batch_id", ["doc_id"], "row_bytes", DOC_LIMIT)


@query("range_bytes", _packed("batch_id", DOC_LIMIT) + """
SELECT batch_id, count(*) AS ranges, sum(row_count)::BIGINT AS row_count, sum(range_bytes)::BIGINT AS payload_bytes,
       max(range_bytes) AS max_range_bytes FROM ranges GROUP BY batch_id""")
def range_bytes(spark, sf_dir):
    return packing.range_summary(document_ranges(spark, sf_dir), "batch_id")


@query("load_counters", _packed("batch_id", DOC_LIMIT) + f"""
SELECT (SELECT count(*) FROM r) AS row_count,
       (SELECT count(DISTINCT batch_id) + count(DISTINCT batch_id) FILTER (batch_id % 4 = 1) FROM r) AS batches,
       (SELECT count(*) FROM ranges) AS row_ranges, (SELECT sum(row_bytes)::BIGINT FROM r) AS encoded_bytes,
       (SELECT max(range_bytes) FROM ranges) AS max_range_bytes,
       (SELECT (coalesce(sum({_TEXT}), 0) + coalesce(sum({_LANG}), 0) + coalesce(sum({_SRC}), 0))::BIGINT FROM r) AS text_bytes,
       0::BIGINT AS binary_bytes,
       (SELECT count(*) FILTER (text IS NULL) + count(*) FILTER (lang IS NULL) + count(*) FILTER (n_chars IS NULL) FROM r) AS null_cells""")
def load_counters(spark, sf_dir):
    """Counters of a load, in which some batches had no rows."""
    rows = documents(spark, sf_dir)
    ids = rows.select("batch_id").distinct()
    sent = ids.unionByName(ids.where("batch_id % 4 = 1").select((-F.col("batch_id")).alias("batch_id")))
    return sizing.load_counters(rows, DOCUMENT_PLAN, "batch_id", ["doc_id"], DOC_LIMIT, sent, DOC_BATCH)


LINE_BATCH = 256
LINE_PLAN = LoadPlan((
    PlannedColumn(0, "l_orderkey", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "l_partkey", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(2, "l_suppkey", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(3, "l_linenumber", False, SourceType("int32"), TargetType("int")),
    PlannedColumn(4, "l_quantity", True, SourceType("float64"), TargetType("float", precision=53)),
    PlannedColumn(5, "l_extendedprice", True, SourceType("float64"), TargetType("float", precision=53)),
    PlannedColumn(6, "l_returnflag", False, SourceType("utf8"), TargetType("nvarchar", length=1)),
    PlannedColumn(7, "l_shipdate", False, SourceType("timestamp", unit="us"), TargetType("datetime2", precision=0)),
))


_LINES = f"""
WITH RECURSIVE s AS (SELECT l_orderkey // {LINE_BATCH} AS batch_id, l_orderkey, l_linenumber,
                  CASE WHEN l_partkey % 997 = 0 THEN 1 ELSE 0 END + CASE WHEN l_suppkey % 991 = 7 AND l_linenumber = 3 THEN 1 ELSE 0 END AS bad,
                  CASE WHEN l_partkey % 997 = 0 THEN 1 ELSE 9 END + CASE WHEN l_suppkey % 991 = 7 AND l_linenumber = 3 THEN 2 ELSE 4 END
                  + 1 + 8 + 8 + 8 + 4 + 9 + 7 AS row_bytes
           FROM lineitem),
     v AS (SELECT batch_id, count(*) AS row_count, count(*) FILTER (bad > 0) AS bad_rows, sum(bad)::BIGINT AS violations,
                  sum(row_bytes)::BIGINT AS payload_bytes, max(row_bytes)::BIGINT AS max_row_bytes, sum(bad) = 0 AS accepted
           FROM s GROUP BY batch_id)
"""
LINE_LIMIT = 16_384


def lines_conformed(spark, sf_dir):
    """``lineitem`` by batches of keys, with rare values that break a rule."""
    part, faulty = F.col("l_partkey"), (F.col("l_suppkey") % 991 == 7) & (F.col("l_linenumber") == 3)
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.when(part % 997 == 0, F.lit("NaN").cast("double")).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(faulty, F.lit("RR")).otherwise(F.col("l_returnflag")).alias("l_returnflag"), "l_shipdate")
    return conform.conform_table(batches_by_key(df, "l_orderkey", LINE_BATCH), LINE_PLAN, ["batch_id"])


@query("load_readiness", _LINES + "SELECT * FROM v")
def load_readiness(spark, sf_dir):
    """Is ``lineitem`` ready to load? One projection, one aggregate per batch."""
    rows = lines_conformed(spark, sf_dir)
    sized = rows.withColumn("row_bytes", sizing.row_bytes(LINE_PLAN))
    return sized.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("error_count") > 0).alias("bad_rows"),
        F.sum("error_count").alias("violations"),
        F.sum("row_bytes").alias("payload_bytes"),
        F.max("row_bytes").alias("max_row_bytes"),
        (F.sum("error_count") == 0).alias("accepted"),
    )


@query("load_readiness_ranges", _LINES + f"""
   , n AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY l_orderkey, l_linenumber, row_bytes) - 1 AS i FROM s),
     g(b, i, range_no, open_bytes) AS (
       SELECT batch_id, i, 0::BIGINT, row_bytes::BIGINT FROM n WHERE i = 0
       UNION ALL
       SELECT n.batch_id, n.i, CASE WHEN g.open_bytes + n.row_bytes > {LINE_LIMIT} THEN g.range_no + 1 ELSE g.range_no END,
              CASE WHEN g.open_bytes + n.row_bytes > {LINE_LIMIT} THEN n.row_bytes ELSE g.open_bytes + n.row_bytes END::BIGINT
       FROM g JOIN n ON n.batch_id = g.b AND n.i = g.i + 1),
     k AS (SELECT b, max(range_no) + 1 AS ranges, max(open_bytes) AS max_range_bytes FROM g GROUP BY b)
SELECT v.*, CASE WHEN accepted THEN ranges ELSE 0 END AS ranges, CASE WHEN accepted THEN max_range_bytes ELSE 0 END AS max_range_bytes
FROM v JOIN k ON k.b = v.batch_id""")
def load_readiness_ranges(spark, sf_dir):
    """The same, with the ranges that accepted batches are sent in."""
    return sizing.readiness(lines_conformed(spark, sf_dir), LINE_PLAN, "batch_id", ["l_orderkey", "l_linenumber"], LINE_LIMIT)
