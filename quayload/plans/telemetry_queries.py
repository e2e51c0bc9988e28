"""Queries over load metrics. The metric tables come from ``events``: a user is a
load, an event type a wait type, a row one snapshot; suppliers stand for files."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayload.operators import telemetry
from quayload.plans.registry import query, table
from quayload.session import shared_path
from quayload.streaming import samples as sampling

LOAD = ["load_id"]


def cents():
    return F.round(F.col("value") * 100).cast("bigint")


def waits(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_id"), F.col("event_type").alias("wait_type"), F.dayofmonth("ts").alias("repeat_index"),
        F.struct("ts", "event_id").alias("taken"), (F.dayofmonth("ts") <= 10).alias("initial"),
        (key % 3).alias("phase"), (key % 100 - 20).alias("waiting_tasks_count"), (cents() % 5000 - 1000).alias("wait_time_ms"),
        (key % 7).alias("signal_wait_time_ms"))


WAITS = """
WITH w AS (SELECT user_id AS load_id, event_type AS wait_type, day(ts)::INTEGER AS repeat_index, ts, event_id, day(ts) <= 10 AS initial,
                  event_id % 3 AS phase, event_id % 100 - 20 AS waiting_tasks_count,
                  round(value * 100)::BIGINT % 5000 - 1000 AS wait_time_ms, event_id % 7 AS signal_wait_time_ms FROM events)
"""


WAIT_DELTAS = WAITS + """
, f AS (SELECT * FROM w WHERE initial QUALIFY row_number() OVER (PARTITION BY load_id, wait_type ORDER BY ts DESC, event_id DESC) = 1),
  l AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY load_id, wait_type ORDER BY ts DESC, event_id DESC) = 1),
  d AS (SELECT l.load_id, l.wait_type, l.waiting_tasks_count - coalesce(f.waiting_tasks_count, 0) AS waiting_tasks_count,
               l.wait_time_ms - coalesce(f.wait_time_ms, 0) AS wait_time_ms,
               l.signal_wait_time_ms - coalesce(f.signal_wait_time_ms, 0) AS signal_wait_time_ms
        FROM l LEFT JOIN f USING (load_id, wait_type))
SELECT * FROM d WHERE waiting_tasks_count > 0 OR wait_time_ms > 0"""


@query("wait_deltas", WAIT_DELTAS)
def wait_deltas(spark, sf_dir):
    rows = waits(spark, sf_dir).withColumn("taken", telemetry.packed_order(F.col("taken.ts"), F.col("taken.event_id")))
    return telemetry.active_waits(telemetry.snapshot_deltas(
        rows, ["load_id", "wait_type"], telemetry.WAIT_COUNTERS, "taken", "initial"))


def files(spark, sf_dir):
    """One counter row per shipment: a supplier's file, which has another name every year."""
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("file_id"), F.concat(F.lit("file_"), F.col("l_suppkey"), F.lit("_"), F.year("l_shipdate")).alias("logical_name"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit("LOG")).otherwise(F.lit("ROWS")).alias("file_type"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").alias("taken"),
        (F.year("l_shipdate") <= 1995).alias("initial"),
        F.col("l_orderkey").alias("read_count"), price.alias("read_bytes"), F.col("l_linenumber").cast("bigint").alias("read_stall_ms"),
        F.col("l_partkey").alias("write_count"), (price * 2).alias("write_bytes"), F.col("l_quantity").cast("bigint").alias("write_stall_ms"))


FILES = """
WITH x AS (SELECT l_suppkey AS file_id, 'file_' || l_suppkey::VARCHAR || '_' || year(l_shipdate)::VARCHAR AS logical_name,
                  CASE WHEN l_suppkey % 10 = 0 THEN 'LOG' ELSE 'ROWS' END AS file_type, year(l_shipdate) <= 1995 AS initial,
                  l_orderkey AS read_count, round(l_extendedprice * 100)::BIGINT AS read_bytes, l_linenumber::BIGINT AS read_stall_ms,
                  l_partkey AS write_count, round(l_extendedprice * 100)::BIGINT * 2 AS write_bytes, l_quantity::BIGINT AS write_stall_ms,
                  l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM lineitem)
"""
_FILE_EDGE = ("QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY l_shipdate DESC, l_orderkey DESC, "
              "l_linenumber DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) = 1")


FILE_DELTAS = FILES + f"""
, f AS (SELECT * FROM x WHERE initial {_FILE_EDGE}), l AS (SELECT * FROM x {_FILE_EDGE})
SELECT l.file_id, l.logical_name, l.file_type, {', '.join(f'l.{c} - coalesce(f.{c}, 0) AS {c}' for c in telemetry.FILE_COUNTERS)}
FROM l LEFT JOIN f USING (file_id)"""


@query("file_io_deltas", FILE_DELTAS)
def file_io_deltas(spark, sf_dir):
    return telemetry.snapshot_deltas(
        files(spark, sf_dir), ["file_id"], telemetry.FILE_COUNTERS, "taken", "initial", ["logical_name", "file_type"])


@query("wait_deltas_two_tables", WAITS + """
, n AS (SELECT * REPLACE (CASE WHEN load_id % 50 <> 3 THEN load_id END AS load_id) FROM w),
  f AS (SELECT * FROM n WHERE initial QUALIFY row_number() OVER (PARTITION BY load_id, wait_type ORDER BY ts, event_id) = 1),
  l AS (SELECT * FROM n WHERE NOT initial QUALIFY row_number() OVER (PARTITION BY load_id, wait_type ORDER BY ts DESC, event_id DESC) = 1),
  d AS (SELECT l.load_id, l.wait_type, l.waiting_tasks_count - coalesce(f.waiting_tasks_count, 0) AS waiting_tasks_count,
               l.wait_time_ms - coalesce(f.wait_time_ms, 0) AS wait_time_ms,
               l.signal_wait_time_ms - coalesce(f.signal_wait_time_ms, 0) AS signal_wait_time_ms
        FROM l LEFT JOIN f ON l.load_id IS NOT DISTINCT FROM f.load_id AND l.wait_type = f.wait_type)
SELECT * FROM d WHERE waiting_tasks_count > 0 OR wait_time_ms > 0""")
def wait_deltas_two_tables(spark, sf_dir):
    """Snapshots before and after a load kept in tables of their own; those of some loads have no load id."""
    rows, keys = waits(spark, sf_dir), ["load_id", "wait_type"]
    rows = rows.withColumn("load_id", F.when(F.col("load_id") % 50 != 3, F.col("load_id")))
    first = telemetry.first_snapshot(rows.where("initial"), keys, telemetry.WAIT_COUNTERS, "taken")
    last = telemetry.last_snapshot(rows.where("not initial"), keys, telemetry.WAIT_COUNTERS, "taken")
    return telemetry.wait_deltas(first, last, LOAD)


@query("file_io_deltas_two_tables", FILES + f"""
, l AS (SELECT * FROM x {_FILE_EDGE}), f AS (SELECT * FROM x WHERE initial {_FILE_EDGE})
SELECT l.file_id, l.logical_name, l.file_type, {', '.join(f'l.{c} - coalesce(f.{c}, 0) AS {c}' for c in telemetry.FILE_COUNTERS)}
FROM l LEFT JOIN f USING (file_id)""")
def file_io_deltas_two_tables(spark, sf_dir):
    rows, names = files(spark, sf_dir), ["logical_name", "file_type"]
    first = telemetry.last_snapshot(rows.where("initial"), ["file_id"], telemetry.FILE_COUNTERS, "taken")
    last = telemetry.last_snapshot(rows, ["file_id"], telemetry.FILE_COUNTERS, "taken", names)
    return telemetry.file_io_deltas(first, last, [])


def connections(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_id"), F.struct("ts", "event_id").alias("taken"), F.dayofmonth("ts").alias("phase"),
        F.when(key % 2 == 0, F.lit("TCP")).otherwise(F.lit("Shared memory")).alias("net_transport"),
        F.lit("TSQL").alias("protocol_type"), F.when(key % 3 == 0, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("encrypt_option"),
        F.lit(4096).alias("net_packet_size"), key.alias("num_reads"), (key * 2).alias("num_writes"),
        F.when(key % 5 != 0, F.col("ts")).alias("last_read"), F.when(key % 7 != 0, F.col("ts")).alias("last_write"))


CONNECTIONS = """
WITH c AS (SELECT user_id AS load_id, ts, event_id, day(ts)::INTEGER AS phase,
                  CASE WHEN event_id % 2 = 0 THEN 'TCP' ELSE 'Shared memory' END AS net_transport, 'TSQL' AS protocol_type,
                  CASE WHEN event_id % 3 = 0 THEN 'TRUE' ELSE 'FALSE' END AS encrypt_option, 4096::INTEGER AS net_packet_size,
                  event_id AS num_reads, event_id * 2 AS num_writes,
                  CASE WHEN event_id % 5 <> 0 THEN ts END AS last_read, CASE WHEN event_id % 7 <> 0 THEN ts END AS last_write FROM events)
"""


CONNECTION_DELTAS = CONNECTIONS + """
, f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY load_id ORDER BY ts, event_id) = 1),
  l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY load_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT l.load_id, l.net_transport, l.protocol_type, l.encrypt_option, l.net_packet_size, l.num_reads - f.num_reads AS num_reads,
       l.num_writes - f.num_writes AS num_writes, l.last_read, l.last_write FROM l JOIN f USING (load_id)"""


@query("connection_deltas", CONNECTION_DELTAS)
def connection_deltas(spark, sf_dir):
    return telemetry.connection_deltas(connections(spark, sf_dir), LOAD, "taken")


@query("merge_waits", WAITS + """
SELECT wait_type, sum(waiting_tasks_count)::BIGINT AS waiting_tasks_count, sum(wait_time_ms)::BIGINT AS wait_time_ms,
       sum(signal_wait_time_ms)::BIGINT AS signal_wait_time_ms FROM w GROUP BY wait_type""")
def merge_waits(spark, sf_dir):
    return telemetry.report_order(telemetry.merge_waits(waits(spark, sf_dir)), "waits")


# Name and type of the first snapshot.
_FIRST_FILE = ", ".join(
    f"arg_min({c}, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)) AS {c}" for c in ("logical_name", "file_type"))
_FILE_SUMS = ", ".join(f"sum({c})::BIGINT AS {c}" for c in telemetry.FILE_COUNTERS)


@query("merge_file_io", FILES + f"""
SELECT file_id, {_FIRST_FILE}, {_FILE_SUMS} FROM x GROUP BY file_id""")
def merge_file_io(spark, sf_dir):
    return telemetry.report_order(telemetry.merge_file_io(files(spark, sf_dir), "taken"), "files")


_CONNECTION_MERGE = """
SELECT {extra} net_transport, protocol_type, encrypt_option, net_packet_size, sum(num_reads)::BIGINT AS num_reads,
       sum(num_writes)::BIGINT AS num_writes,
       arg_max({{'v': last_read}}, (ts, event_id)).v AS last_read, arg_max({{'v': last_write}}, (ts, event_id)).v AS last_write
FROM c GROUP BY ALL"""


@query("merge_connections", CONNECTIONS + _CONNECTION_MERGE.format(extra=""))
def merge_connections(spark, sf_dir):
    return telemetry.merge_connections(connections(spark, sf_dir), "taken")


@query("phase_wait_deltas", WAITS + """
SELECT phase, wait_type, sum(waiting_tasks_count)::BIGINT AS waiting_tasks_count, sum(wait_time_ms)::BIGINT AS wait_time_ms,
       sum(signal_wait_time_ms)::BIGINT AS signal_wait_time_ms FROM w GROUP BY phase, wait_type""")
def phase_wait_deltas(spark, sf_dir):
    return telemetry.merge_waits(waits(spark, sf_dir), ["phase"])


@query("phase_file_io_deltas", FILES + f"""
SELECT year(l_shipdate)::INTEGER AS phase, file_id, {_FIRST_FILE}, {_FILE_SUMS}
FROM x GROUP BY ALL""")
def phase_file_io_deltas(spark, sf_dir):
    rows = files(spark, sf_dir).withColumn("phase", F.year("taken.l_shipdate"))
    return telemetry.merge_file_io(rows, "taken", ["phase"])


@query("phase_connection_deltas", CONNECTIONS + _CONNECTION_MERGE.format(extra="phase,"))
def phase_connection_deltas(spark, sf_dir):
    return telemetry.merge_connections(connections(spark, sf_dir), "taken", ["phase"])


@query("sample_distribution", """
WITH s AS (SELECT user_id AS load_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS status,
                  CASE WHEN event_id % 3 <> 0 THEN 'wait_' || (event_id % 4)::VARCHAR END AS wait_type,
                  CASE WHEN event_id % 7 = 0 THEN 'task_' || (event_id % 2)::VARCHAR END AS task_wait FROM events),
     k AS (SELECT load_id, 'request_status' AS kind, coalesce(status, '<no request>') AS value FROM s
           UNION ALL SELECT load_id, 'request_wait', CASE WHEN status IS NULL THEN '<no request>' ELSE coalesce(wait_type, '<none>') END FROM s
           UNION ALL SELECT load_id, 'task_wait', task_wait FROM s WHERE task_wait IS NOT NULL)
SELECT load_id, kind, value, count(*) AS samples FROM k GROUP BY ALL""")
def sample_distribution(spark, sf_dir):
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_id"), F.when(key % 5 != 0, F.col("event_type")).alias("status"),
        F.when(key % 3 != 0, F.concat(F.lit("wait_"), (key % 4).cast("string"))).alias("wait_type"),
        F.when(key % 7 == 0, F.concat(F.lit("task_"), (key % 2).cast("string"))).alias("task_wait"))
    return telemetry.sample_distribution(rows, LOAD)


@query("sample_coverage", """
WITH s AS (SELECT event_type || '_' || user_id::VARCHAR AS phase, day(ts)::INTEGER AS repeat_index, event_id * 250 AS elapsed_start,
                  event_id * 250 + round(value * 100)::BIGINT AS elapsed_end, ts, event_id FROM events)
SELECT phase, arg_min(repeat_index, (ts, event_id)) AS first_repeat_index, arg_min(elapsed_start, (ts, event_id)) AS first_elapsed_start,
       arg_min(elapsed_end, (ts, event_id)) AS first_elapsed_end, arg_max(repeat_index, (ts, event_id)) AS last_repeat_index,
       arg_max(elapsed_start, (ts, event_id)) AS last_elapsed_start, arg_max(elapsed_end, (ts, event_id)) AS last_elapsed_end
FROM s GROUP BY phase""")
def sample_coverage(spark, sf_dir):
    start = F.col("event_id") * 250
    rows = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_"), "user_id").alias("phase"), F.dayofmonth("ts").alias("repeat_index"),
        start.alias("elapsed_start"), (start + cents()).alias("elapsed_end"),
        telemetry.packed_order(F.col("ts"), F.col("event_id")).alias("taken"))
    return telemetry.sample_coverage(rows, "taken")


PAGES = ["row_count", "in_row_pages", "lob_pages", "row_overflow_pages", "used_pages"]


@query("page_totals", """
SELECT o_custkey AS table_id, count(*) AS row_count, sum(o_orderkey % 9)::BIGINT AS in_row_pages,
       coalesce(sum(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 5 END), 0)::BIGINT AS lob_pages,
       0::BIGINT AS row_overflow_pages, sum(round(o_totalprice)::BIGINT // 8192)::BIGINT AS used_pages
FROM orders GROUP BY o_custkey""")
def page_totals(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("table_id"), F.lit(1).alias("row_count"), (key % 9).alias("in_row_pages"),
        F.when(key % 4 == 0, key % 5).alias("lob_pages"), F.lit(None).cast("bigint").alias("row_overflow_pages"),
        F.call_function("div", F.round("o_totalprice").cast("bigint"), F.lit(8192)).alias("used_pages"))
    return telemetry.page_totals(rows, PAGES, ["table_id"])


@query("file_stats_join", FILES + f"""
, t AS (SELECT file_id, {_FILE_SUMS} FROM x GROUP BY file_id)
SELECT t.file_id, s_name AS logical_name, 'nation_' || s_nationkey::VARCHAR AS file_type, {', '.join(telemetry.FILE_COUNTERS)}
FROM t JOIN supplier ON s_suppkey = t.file_id""")
def file_stats_join(spark, sf_dir):
    stats = telemetry.page_totals(files(spark, sf_dir), telemetry.FILE_COUNTERS, ["file_id"])
    catalog = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("file_id"), F.col("s_name").alias("logical_name"),
        F.concat(F.lit("nation_"), "s_nationkey").alias("file_type"))
    return telemetry.file_stats_join(stats, catalog)


@query("throughput", """
WITH r AS (SELECT o_custkey AS load_id, sum(o_orderkey % 1000)::BIGINT AS rows_written,
                  sum(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE round(o_totalprice)::BIGINT END)::BIGINT AS elapsed_us
           FROM orders GROUP BY o_custkey)
SELECT *, CASE WHEN elapsed_us <> 0 THEN rows_written * 1000000.0::DOUBLE / elapsed_us::DOUBLE END AS rows_per_second FROM r""")
def throughput(spark, sf_dir):
    elapsed = F.when(F.col("o_custkey") % 10 == 0, F.lit(0)).otherwise(F.round("o_totalprice").cast("bigint"))
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("load_id")).agg(
        F.sum(F.col("o_orderkey") % 1000).alias("rows_written"), F.sum(elapsed).alias("elapsed_us"))
    return telemetry.throughput(runs)


@query("backend_compare", """
SELECT o_orderpriority AS backend, sum(o_orderkey % 1000)::BIGINT AS rows_written, sum(o_orderkey % 1000 - o_custkey % 2)::BIGINT AS validated_rows,
       sum(round(o_totalprice)::BIGINT)::BIGINT AS write_us,
       sum(o_orderkey % 1000)::BIGINT * 1000000.0::DOUBLE / sum(round(o_totalprice)::BIGINT)::DOUBLE AS rows_per_second
FROM orders GROUP BY o_orderpriority""")
def backend_compare(spark, sf_dir):
    written = F.col("o_orderkey") % 1000
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("backend"), written.alias("rows_written"),
        (written - F.col("o_custkey") % 2).alias("validated_rows"), F.round("o_totalprice").cast("bigint").alias("write_us"))
    return telemetry.backend_compare(runs)


PHASES = {"signup": "setup", "view": "write", "click": "finish", "purchase": "validate", "error": "cleanup"}


@query("timing_totals", "SELECT user_id AS load_id, " + ", ".join(
    f"coalesce(sum(CASE WHEN event_type = '{event}' THEN round(value * 100)::BIGINT END), 0)::BIGINT AS {phase}"
    for event, phase in PHASES.items()) + " FROM events GROUP BY user_id")
def timing_totals(spark, sf_dir):
    phase = F.coalesce(*[F.when(F.col("event_type") == event, F.lit(name)) for event, name in PHASES.items()])
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_id"), phase.alias("phase"), cents().alias("elapsed_us"))
    return telemetry.timing_totals(rows, list(PHASES.values()), LOAD)


@query("merge_counters", """
SELECT user_id AS load_id, sum(event_id)::BIGINT AS rows_sent, sum(round(value * 100)::BIGINT)::BIGINT AS encoded_bytes,
       max(round(value * 100)::BIGINT) AS max_range_bytes, max(event_id % 977) AS max_packet_bytes,
       arg_max(event_id % 4096, (ts, event_id)) AS buffered_after_last FROM events GROUP BY user_id""")
def merge_counters(spark, sf_dir):
    key = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("load_id"), key.alias("rows_sent"), cents().alias("encoded_bytes"), cents().alias("max_range_bytes"),
        (key % 977).alias("max_packet_bytes"), (key % 4096).alias("buffered_after_last"),
        telemetry.packed_order(F.col("ts"), key).alias("taken"))
    return telemetry.merge_counters(
        rows, LOAD, ["rows_sent", "encoded_bytes"], ["max_range_bytes", "max_packet_bytes"], ["buffered_after_last"], "taken")


@query("stream_samples", """
WITH s AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, round(value * 100)::BIGINT AS cents FROM events),
     m AS (SELECT max(ts) - INTERVAL 10 SECOND AS mark FROM events)
SELECT epoch_us(window_start) AS window_start_us, event_type, count(*) AS samples, sum(cents)::BIGINT AS value_sum, max(cents) AS value_max
FROM s, m GROUP BY ALL HAVING window_start + INTERVAL 1 HOUR <= any_value(mark)""")
def stream_samples(spark, sf_dir):
    """Windows closed by the watermark; the last open ones are not reported."""
    schema = table(spark, sf_dir, "events").schema
    # A file source reads NTZ; event time must be an instant. Values are UTC.
    micros = (F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000_000
              + (F.hour("ts") * 60 + F.minute("ts")).cast("bigint") * 60_000_000
              + (F.extract(F.lit("SECOND"), F.col("ts")) * 1_000_000).cast("bigint"))
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select(
        F.timestamp_micros(micros).alias("at"), "event_type", cents().alias("cents"))
    windows = sampling.window_samples(stream, "at", ["event_type"], "cents", "1 hour", "10 seconds")
    out = shared_path(spark, "samples")
    sampling.sampled_to(windows, f"{out}/windows", f"{out}/state").awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{out}/windows").select(
        F.unix_micros("window_start").alias("window_start_us"), "event_type", "samples", "value_sum", "value_max")
