"""Queries of sources, sinks, batching, generated shapes and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayload.operators import reconcile
from quayload.functions import temporal
from quayload.plans.registry import query, table
from quayload.plans.sqltext import datetime2, fdiv, fmod
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType
from quayload.session import shared_path
from quayload.sources import batching, datasets, sinks
from quayload.sources.shapes import shaped
from quayload.streaming.load import stream_load


@query("read_dataset", "SELECT doc_id, lang, n_chars FROM documents")
def read_dataset(spark, sf_dir):
    return datasets.read_dataset(spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang", "n_chars"])


@query("write_dataset", "SELECT * FROM events")
def write_dataset(spark, sf_dir):
    path = shared_path(spark, "dataset")
    datasets.write_dataset(table(spark, sf_dir, "events"), path, 4096)
    return datasets.read_dataset(spark, path)


@query("dataset_summary", """
WITH b AS (SELECT DISTINCT event_id // 1024 AS batch_id FROM events), e AS (SELECT -1 - batch_id AS batch_id FROM b WHERE batch_id % 3 = 0)
SELECT count(*) AS row_count, (SELECT count(*) FROM b) + (SELECT count(*) FROM e) AS batch_count,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_id // 1024)) AS largest_batch FROM events""")
def dataset_summary(spark, sf_dir):
    """Some batches were written without rows."""
    rows = batching.batches_by_key(table(spark, sf_dir, "events"), "event_id", 1024)
    empty = rows.select("batch_id").distinct().where("batch_id % 3 = 0").select((-1 - F.col("batch_id")).alias("batch_id"))
    return datasets.dataset_summary(rows, "batch_id", rows.select("batch_id").distinct().unionByName(empty))


@query("chunk_batches", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_rank,
       (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS batch_id FROM orders""")
def chunk_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return batching.chunk_batches(rows, ["o_orderdate", "o_orderkey"], 1000).drop("o_orderdate")


@query("chunk_batches_hot_key", """
SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS row_rank,
       (row_number() OVER (ORDER BY l_returnflag) - 1) // 4096 AS batch_id FROM lineitem""")
def chunk_batches_hot_key(spark, sf_dir):
    """Three key values only: rows of one key are still cut over many tasks."""
    return batching.chunk_batches(table(spark, sf_dir, "lineitem").select("l_returnflag"), ["l_returnflag"], 4096)


SHIPMENT_PLAN = LoadPlan((
    PlannedColumn(0, "event_id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "ts", False, SourceType("timestamp", unit="us"), TargetType("datetime2", precision=4)),
    PlannedColumn(2, "event_type", False, SourceType("utf8"), TargetType("nvarchar", length=16)),
    PlannedColumn(3, "value", False, SourceType("float64"), TargetType("float", precision=53)),
))
_INC = datetime2("t", 4)[1]
_DAY = datetime2("t", 4)[0]
LOADED = f"""
WITH s AS (SELECT event_id, event_type, value, epoch_us(ts)::HUGEINT * 10 AS t FROM events),
     d AS (SELECT *, {_DAY} AS day, {_INC} AS inc FROM s)
SELECT event_id, event_type, value,
       strftime(DATE '0001-01-01' + day::INTEGER, '%Y-%m-%d') || 'T' || printf('%02d:%02d:%02d.%04d', (inc // 36000000)::BIGINT,
              (inc // 600000 % 60)::BIGINT, (inc // 10000 % 60)::BIGINT, (inc % 10000)::BIGINT) AS ts FROM d"""


def planned(df, *more):
    """The planned columns in the plan's order: a load refuses any other shape."""
    return df.select(*[c.name for c in SHIPMENT_PLAN.columns], *more)


@query("table_load", LOADED)
def table_load(spark, sf_dir):
    """Conform, append, read back; times are stored as exact text."""
    target = shared_path(spark, "table")
    sinks.table_load(planned(table(spark, sf_dir, "events")), SHIPMENT_PLAN, target)
    return spark.read.parquet(target)


@query("staged_load", """
SELECT *, CASE WHEN o_orderpriority < '3' THEN 'urgent' ELSE 'later' END AS load_id FROM orders""")
def staged_load(spark, sf_dir):
    """Two loads published; one of them twice, the later attempt counts."""
    target = shared_path(spark, "published")
    orders = table(spark, sf_dir, "orders")
    urgent = orders.where("o_orderpriority < '3'")
    later = orders.where("o_orderpriority >= '3'")
    sinks.staged_load(later.withColumn("o_totalprice", F.lit(0.0)), target, "later")
    sinks.staged_load(urgent, target, "urgent")
    sinks.staged_load(later, target, "later")
    return sinks.read_published(spark, target, urgent.schema)


@query("stream_load", "SELECT event_id, event_type, value, ts FROM (" + LOADED + ") WHERE event_id % 331 <> 0")
def stream_load_query(spark, sf_dir):
    """The good rows of a stream; rows with a non-finite value go to diagnostics."""
    out = _streamed(spark, sf_dir)
    return spark.read.parquet(f"{out}/table/rows").select("event_id", "event_type", "value", "ts")


@query("stream_load_diagnostics", """
SELECT event_id, 'error' AS severity, 'NonFiniteFloat' AS code, 3 AS field_index, 'value' AS field_name
FROM events WHERE event_id % 331 = 0""")
def stream_load_diagnostics(spark, sf_dir):
    out = _streamed(spark, sf_dir)
    return spark.read.parquet(f"{out}/table/diagnostics").select(
        F.col("row_key").alias("event_id"), "severity", "code", "field_index", "field_name")


def _streamed(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    value = F.when(F.col("event_id") % 331 == 0, F.lit("Infinity").cast("double")).otherwise(F.col("value"))
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("value", value).withColumn("row_key", F.col("event_id"))
    out = shared_path(spark, "stream")
    stream_load(planned(stream, "row_key"), SHIPMENT_PLAN, f"{out}/table", f"{out}/progress", ["row_key"]).awaitTermination()
    return out


@query("target_row_count", "SELECT count(*) AS row_count FROM orders")
def target_row_count(spark, sf_dir):
    target = shared_path(spark, "counted")
    table(spark, sf_dir, "orders").write.parquet(target)
    return sinks.file_target_count(spark, target)


_LOAD_OF = "CASE WHEN event_id // 500 % 7 <> 3 THEN event_id // 500 END"


@query("count_reconcile", f"""
WITH s AS (SELECT {_LOAD_OF} AS load_id, CASE WHEN event_id % 1999 = 5 THEN {_LOAD_OF} + 1 ELSE {_LOAD_OF} END AS landed FROM events),
     u AS (SELECT load_id, 1 AS w, 0 AS f FROM s UNION ALL SELECT landed, 0, 1 FROM s)
SELECT load_id, sum(w)::BIGINT AS rows_written, sum(f)::BIGINT AS rows_found, sum(w) = sum(f) AS matches FROM u GROUP BY load_id""")
def count_reconcile(spark, sf_dir):
    """A target where single rows landed under another load, told by its counts; some loads have no id."""
    path = shared_path(spark, "reconciled")
    load = F.call_function("div", F.col("event_id"), F.lit(500))
    sent = table(spark, sf_dir, "events").withColumn("load_id", F.when(load % 7 != 3, load))
    astray = F.when(F.col("event_id") % 1999 == 5, F.col("load_id") + 1).otherwise(F.col("load_id"))
    sent.withColumn("load_id", astray).write.parquet(path)
    return reconcile.count_reconcile(sent, spark.read.parquet(path), "load_id")


@query("sentinel_count", """
SELECT count(*) AS row_count, count(*) FILTER (event_id % 400 <> 3) AS sentinel_rows,
       count(*) = count(*) FILTER (event_id % 400 <> 3) AS all_rows_match FROM events""")
def sentinel_count(spark, sf_dir):
    rows = shaped(table(spark, sf_dir, "events"), "event_id", "string_heavy_unicode", ["event_id"])
    damaged = F.when(F.col("event_id") % 400 == 3, F.concat(F.lit("?"), "tenant")).otherwise(F.col("tenant"))
    return reconcile.sentinel_count(rows.select(damaged.alias("tenant")), "tenant", 0x79DF, 0x6237)


@query("roundtrip_diff", """
WITH a AS (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL),
     b AS (SELECT * REPLACE (CASE WHEN l_partkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
                             CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag) FROM lineitem),
     c AS (SELECT *, -count(*) AS n FROM b GROUP BY ALL),
     d AS (SELECT * EXCLUDE (n), sum(n)::BIGINT AS balance FROM (SELECT * FROM a UNION ALL SELECT * FROM c) GROUP BY ALL HAVING sum(n) <> 0)
SELECT * EXCLUDE (balance), greatest(balance, 0) AS missing, greatest(-balance, 0) AS unexpected FROM d""")
def roundtrip_diff(spark, sf_dir):
    """All columns of a table and of its reloaded copy, in which some rows have changed."""
    source = table(spark, sf_dir, "lineitem")
    part, path = F.col("l_partkey"), shared_path(spark, "reloaded")
    source.withColumn("l_quantity", F.when(part % 97 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).withColumn(
        "l_returnflag", F.when(part % 101 != 0, F.col("l_returnflag"))).write.parquet(path)
    return reconcile.roundtrip_diff(source, spark.read.parquet(path))


@query("roundtrip_same", """
SELECT * EXCLUDE (n), n AS missing, 0::BIGINT AS unexpected FROM (SELECT *, count(*) AS n FROM lineitem WHERE l_orderkey = 1 GROUP BY ALL)""")
def roundtrip_same(spark, sf_dir):
    """A copy in another order that lacks the rows of one key: their leaves are compared, the others are not."""
    source, path = table(spark, sf_dir, "lineitem"), shared_path(spark, "reloaded")
    source.where("l_orderkey <> 1").repartition("l_suppkey").write.parquet(path)
    return reconcile.roundtrip_diff(source, spark.read.parquet(path))


_KEYED = "(SELECT CASE WHEN o_orderkey % 997 <> 6 OR o_orderkey > 997 THEN o_orderkey END AS o_orderkey, o_orderkey AS k FROM orders)"


@query("writer_parity", f"""
SELECT o_orderkey, 'differs' AS state, 'o_totalprice' AS field_name FROM {_KEYED} WHERE k % 101 = 0 AND k % 333 <> 0
UNION ALL SELECT o_orderkey, 'differs', 'o_orderstatus' FROM {_KEYED} WHERE (k % 103 = 0 OR o_orderkey IS NULL) AND k % 333 <> 0
UNION ALL SELECT o_orderkey, 'only_left', '*' FROM {_KEYED} WHERE k % 333 = 0
UNION ALL SELECT -1 - o_orderkey, 'only_right', '*' FROM {_KEYED} WHERE k % 333 = 0""")
def writer_parity(spark, sf_dir):
    """All columns of two loads; the key of one row is NULL in both."""
    key = F.col("o_orderkey")
    unnamed = (key % 997 == 6) & (key <= 997)
    orders = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.when(key % 2 == 0, F.col("o_orderstatus")))
    left = orders.withColumn("o_orderkey", F.when(~unnamed, key))
    right = orders.select(
        F.when(unnamed, None).when(key % 333 == 0, -1 - key).otherwise(key).alias("o_orderkey"),
        F.when(key % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when((key % 103 == 0) | unnamed, F.lit("?")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        *[c for c in orders.columns if c not in ("o_orderkey", "o_totalprice", "o_orderstatus")])
    return reconcile.writer_parity(left, right, ["o_orderkey"])


@query("expected_vs_actual", f"""
WITH s AS (SELECT event_id, epoch_us(ts) AS us FROM events),
     v AS (SELECT event_id, ({fdiv('us + 500', 1000)})::BIGINT AS rounded, ({fdiv('us', 1000)})::BIGINT AS cut FROM s)
SELECT event_id, ({fdiv('rounded', 86400000)} + 719162)::INTEGER AS actual_day, ({fmod('rounded', 86400000)})::BIGINT AS actual_increments,
       ({fdiv('cut', 86400000)} + 719162)::INTEGER AS expected_day, ({fmod('cut', 86400000)})::BIGINT AS expected_increments
FROM v WHERE rounded <> cut""")
def expected_vs_actual(spark, sf_dir):
    """Rounded milliseconds against an expectation that cuts them off."""
    events = table(spark, sf_dir, "events")
    value = temporal.datetime2(temporal.instant_from_ntz(F.col("ts")), 3).value
    actual = events.select("event_id", value["day"].alias("day"), value["increments"].alias("increments"))
    cut = F.date_trunc("MILLISECOND", F.col("ts"))
    millis = ((F.hour("ts") * 60 + F.minute("ts")) * 60 + F.second("ts")).cast("bigint") * 1000 + (
        F.extract(F.lit("SECOND"), cut.cast("timestamp_ntz")) * 1000).cast("bigint") % 1000
    expected = events.select(
        "event_id", (F.unix_date(F.col("ts").cast("date")) + 719_162).alias("day"), millis.alias("increments"))
    return reconcile.expected_vs_actual(actual, expected, "event_id", ["day", "increments"])
