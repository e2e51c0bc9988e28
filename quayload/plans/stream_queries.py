"""Queries of streams: loads by batches and metric deltas, over several micro-batches each.

A table arrives in four parts; after each one the stream goes on from its checkpoint, so
every part is a micro-batch and every query a stream restarted three times. For loads, parts
are quarters of the ids, so batches at their borders run over two of them; a thousandth of
the rows comes with the last part, whatever its id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayload.operators import conform, telemetry
from quayload.plans import telemetry_queries as metrics
from quayload.plans.quality_queries import EVENTS_PLAN, STORED, events_with_faults, faults_sql
from quayload.plans.registry import query, table
from quayload.session import shared_path
from quayload.streaming.batches import BatchTarget, file_stream, stream_batches
from quayload.streaming.deltas import SnapshotRule, SnapshotState, stream_deltas

PARTS = 4
_BATCH = "CASE WHEN batch_id <> 2 THEN batch_id END"


def arriving(df, arrives, path, go_on):
    """Append ``df`` part by part to ``path``, in the order of ``arrives``, and let the stream ``go_on`` after each."""
    for part in range(PARTS):
        df.where(arrives == part).write.mode("append").parquet(path)
        go_on(file_stream(df.sparkSession, path, df.schema)).awaitTermination()


def arrival(spark, sf_dir):
    """Quarter of the id range, but the last one for every thousandth row."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    quarter = F.call_function("div", F.col("event_id") * PARTS, F.lit(last + 1))
    return F.when(F.col("event_id") % 1000 == 7, F.lit(PARTS - 1)).otherwise(quarter)


def loaded_batches(spark, sf_dir) -> BatchTarget:
    """Events by batches, those of one batch without its id."""
    rows = events_with_faults(spark, sf_dir).withColumn("batch_id", F.expr(_BATCH))
    rows = rows.select("batch_id", *(c.name for c in EVENTS_PLAN.columns))
    out = shared_path(spark, "batch-stream")
    arriving(rows, arrival(spark, sf_dir), f"{out}/source",
             lambda stream: stream_batches(stream, EVENTS_PLAN, "batch_id", f"{out}/target", f"{out}/progress"))
    return BatchTarget(spark, rows.schema, EVENTS_PLAN, "batch_id", f"{out}/target")


#: ``last_seen``: the last micro-batch that still belongs to the batch, as one without its rows ends it.
_STREAMED = faults_sql(_BATCH) + f"""
, q AS (SELECT event_id, event_id * {PARTS} // (SELECT max(event_id) + 1 FROM events) AS quarter FROM events),
  a AS (SELECT s.batch_id, event_id, CASE WHEN event_id % 1000 = 7 THEN {PARTS - 1} ELSE quarter END AS arrives FROM src s JOIN q USING (event_id)),
  p AS (SELECT batch_id, max(arrives) FILTER (event_id % 1000 <> 7 OR arrives = {PARTS - 1}) AS any_last,
               max(arrives) FILTER (event_id % 1000 <> 7) AS regular FROM a GROUP BY batch_id),
  w AS (SELECT a.*, coalesce(event_id % 1000 = 7 AND regular < {PARTS - 2}, false) AS late,
               CASE WHEN regular < {PARTS - 2} THEN regular ELSE any_last END AS last_seen
        FROM a JOIN p ON p.batch_id IS NOT DISTINCT FROM a.batch_id),
  v AS (SELECT w.batch_id, any_value(last_seen) AS last_seen, count(*) AS row_count, count(b.event_id) AS bad
        FROM w LEFT JOIN (SELECT DISTINCT event_id FROM bad) b USING (event_id) WHERE NOT late GROUP BY w.batch_id)
"""


@query("stream_batch_rows", _STREAMED + STORED + """
SELECT w.batch_id, e.event_id, e.ts, e.user_id, e.event_type, e.value FROM stored e JOIN w USING (event_id)
JOIN v ON v.batch_id IS NOT DISTINCT FROM w.batch_id WHERE NOT late AND bad = 0""")
def stream_batch_rows(spark, sf_dir):
    """Rows of the batches that a stream has accepted."""
    return conform.loadable(loaded_batches(spark, sf_dir).accepted_rows(), EVENTS_PLAN)


@query("stream_batch_stats", _STREAMED + """
SELECT batch_id, row_count, sum(row_count) OVER o::BIGINT AS rows_written, count(*) OVER o AS batches_written
FROM v WHERE bad = 0 WINDOW o AS (ORDER BY last_seen, batch_id NULLS FIRST)""")
def stream_batch_stats(spark, sf_dir):
    """Rows and batches accepted so far, in the order in which batches ended."""
    return loaded_batches(spark, sf_dir).running_stats()


@query("stream_batch_late", _STREAMED + f"""
SELECT batch_id, event_id, arrives::BIGINT AS version FROM w WHERE late""")
def stream_batch_late(spark, sf_dir):
    """Rows that came after their batch had ended."""
    return loaded_batches(spark, sf_dir).late_rows().select("batch_id", "event_id", "version")


def deltas_of(spark, samples, arrives, rule: SnapshotRule, idle: str):
    """Deltas of a stream with the rows of ``samples``, a tenth of which come in an order of their own."""
    out = shared_path(spark, "delta-stream")
    arriving(samples, arrives, f"{out}/source", lambda stream: stream_deltas(stream, rule, f"{out}/target", f"{out}/progress", idle))
    return SnapshotState(spark, samples.schema, rule, f"{out}/target").deltas()


def _out_of_order(part, odd):
    return F.when(odd, PARTS - 1 - part).otherwise(part)


def _by_day():
    """Micro-batches of about eight days; a tenth of the rows comes in reverse, long after its key has timed out."""
    return _out_of_order(F.call_function("div", F.dayofmonth("ts") - 1, F.lit(8)), F.col("event_id") % 10 == 0)


@query("stream_wait_deltas", metrics.WAIT_DELTAS)
def stream_wait_deltas(spark, sf_dir):
    rows = metrics.waits(spark, sf_dir).select("*", "taken.*").drop("taken")
    rule = SnapshotRule(("load_id", "wait_type"), tuple(telemetry.WAIT_COUNTERS), ("ts", "event_id"), "ts", "initial")
    return telemetry.active_waits(deltas_of(spark, rows, _by_day(), rule, "3 DAYS"))


@query("stream_connection_deltas", metrics.CONNECTION_DELTAS)
def stream_connection_deltas(spark, sf_dir):
    rows = metrics.connections(spark, sf_dir).select("*", "taken.*").drop("taken")
    attributes = (*telemetry.CONNECTION_KEY, "last_read", "last_write")
    rule = SnapshotRule(("load_id",), ("num_reads", "num_writes"), ("ts", "event_id"), "ts", None, attributes)
    return deltas_of(spark, rows, _by_day(), rule, "3 DAYS")


@query("stream_file_io_deltas", metrics.FILE_DELTAS)
def stream_file_io_deltas(spark, sf_dir):
    rows = metrics.files(spark, sf_dir).select("*", "taken.*").drop("taken")
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rule = SnapshotRule(("file_id",), tuple(telemetry.FILE_COUNTERS), order, "l_shipdate", "initial", ("logical_name", "file_type"))
    arrives = _out_of_order(F.least(F.lit(PARTS - 1), F.greatest(F.lit(0), F.call_function("div", F.year("l_shipdate") - 1992, F.lit(2)))), F.col("l_partkey") % 10 == 0)
    return deltas_of(spark, rows, arrives, rule, "30 DAYS")
