"""Aggregates over tables of load metrics.

Snapshots are rows, (load, phase, repeat, order, keys..., counters...). First and
last snapshots come from ``min_by`` and ``max_by``, which combine on the map side,
so a load with most of the samples needs no special care. Results are not sorted:
ordering belongs to the reader of a report (:func:`report_order`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayload.functions.exact import saturated_difference, saturated_sum

WAIT_COUNTERS = ["waiting_tasks_count", "wait_time_ms", "signal_wait_time_ms"]
FILE_COUNTERS = ["read_count", "read_bytes", "read_stall_ms", "write_count", "write_bytes", "write_stall_ms"]
CONNECTION_KEY = ["net_transport", "protocol_type", "encrypt_option", "net_packet_size"]


def wait_deltas(first: DataFrame, last: DataFrame, load: list[str]) -> DataFrame:
    """Last minus first counter per wait type; unseen before counts from 0."""
    keys = [*load, "wait_type"]
    deltas = _deltas(first, last, keys, WAIT_COUNTERS, [])
    return active_waits(deltas)


def file_io_deltas(first: DataFrame, last: DataFrame, load: list[str]) -> DataFrame:
    """Six counters per file; every file of the last snapshot is kept."""
    return _deltas(first, last, [*load, "file_id"], FILE_COUNTERS, ["logical_name", "file_type"])


def packed_order(time: Column, tie: Column) -> Column:
    """A time and a whole number that tells equal times apart, as one decimal that sorts like both.

    Decimals and numbers have a fixed width, so aggregates that pick a row by this order
    update their buffers in place and hash; an order made of a struct makes them sort.
    """
    day, moment = F.unix_date(time.cast("date")).cast("bigint"), time.cast("timestamp_ntz")
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    micros = day * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")
    above = micros.cast("decimal(18,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)")
    return (above + tie.cast("decimal(19,0)") + F.lit(str(1 << 63)).cast("decimal(19,0)")).cast("decimal(38,0)")


def snapshot_deltas(samples: DataFrame, keys: list[str], counters: list[str], order: str, initial: str,
                    attributes: list[str] | None = None) -> DataFrame:
    """Last minus initial counters per key from one table of snapshots, in one pass.

    The initial snapshot of a key is its latest row where ``initial`` holds, the
    last one its latest row of all; both are kept by one aggregate. Without attributes
    and with an order of fixed width (:func:`packed_order`) that is a hash aggregate.
    """
    if not attributes and isinstance(samples.schema[order].dataType, (T.NumericType, T.DatetimeType)):
        at_first = F.when(F.col(initial), F.col(order))
        edges = samples.groupBy(*keys).agg(
            *[F.max_by(c, order).alias(f"__l_{c}") for c in counters], *[F.max_by(c, at_first).alias(f"__f_{c}") for c in counters])
        return edges.select(*keys, *[
            saturated_difference(F.col(f"__l_{c}"), F.coalesce(F.col(f"__f_{c}"), F.lit(0))).alias(c) for c in counters])
    kept = F.struct(*(attributes or []), *counters)
    before = F.struct(*counters)
    edges = samples.groupBy(*keys).agg(
        F.max_by(kept, order).alias("l"),
        F.max_by(F.when(F.col(initial), before), F.when(F.col(initial), F.col(order))).alias("f"),
    )
    return edges.select(
        *keys, *[F.col(f"l.{c}").alias(c) for c in attributes or []],
        *[saturated_difference(F.col(f"l.{c}"), F.coalesce(F.col(f"f.{c}"), F.lit(0))).alias(c) for c in counters],
    )


def active_waits(deltas: DataFrame) -> DataFrame:
    """Wait types that occurred at all."""
    return deltas.where("waiting_tasks_count > 0 or wait_time_ms > 0")


def connection_deltas(snapshots: DataFrame, load: list[str], order: str) -> DataFrame:
    """Reads and writes between the first and last snapshot; attributes of the last."""
    attributes = [*CONNECTION_KEY, "last_read", "last_write"]
    at_last = F.max_by(F.struct(*attributes, "num_reads", "num_writes"), order).alias("l")
    at_first = F.min_by(F.struct("num_reads", "num_writes"), order).alias("f")
    return snapshots.groupBy(*load).agg(at_first, at_last).select(
        *load, *[F.col(f"l.{c}").alias(c) for c in CONNECTION_KEY],
        saturated_difference(F.col("l.num_reads"), F.col("f.num_reads")).alias("num_reads"),
        saturated_difference(F.col("l.num_writes"), F.col("f.num_writes")).alias("num_writes"),
        F.col("l.last_read").alias("last_read"), F.col("l.last_write").alias("last_write"),
    )


def first_snapshot(samples: DataFrame, keys: list[str], counters: list[str], order: str,
                   attributes: list[str] | None = None) -> DataFrame:
    """The earliest row per key."""
    return _edge(samples, keys, [*(attributes or []), *counters], order, F.min_by)


def last_snapshot(samples: DataFrame, keys: list[str], counters: list[str], order: str,
                  attributes: list[str] | None = None) -> DataFrame:
    """The latest row per key."""
    return _edge(samples, keys, [*(attributes or []), *counters], order, F.max_by)


def merge_waits(deltas: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Sums over repeats per wait type."""
    return deltas.groupBy(*(extra or []), "wait_type").agg(
        *[saturated_sum(F.col(c)).alias(c) for c in WAIT_COUNTERS]
    )


def merge_file_io(deltas: DataFrame, order: str, extra: list[str] | None = None) -> DataFrame:
    """Sums over repeats per file id; name and type of the first repeat."""
    return deltas.groupBy(*(extra or []), "file_id").agg(
        F.min_by("logical_name", order).alias("logical_name"),
        F.min_by("file_type", order).alias("file_type"),
        *[saturated_sum(F.col(c)).alias(c) for c in FILE_COUNTERS],
    )


def merge_connections(deltas: DataFrame, order: str, extra: list[str] | None = None) -> DataFrame:
    """Sums per four-part key; last read and write of the latest repeat."""
    return deltas.groupBy(*(extra or []), *CONNECTION_KEY).agg(
        saturated_sum(F.col("num_reads")).alias("num_reads"),
        saturated_sum(F.col("num_writes")).alias("num_writes"),
        F.max_by(F.struct("last_read", "last_write"), order).alias("latest"),
    ).select("*", "latest.*").drop("latest")


def sample_distribution(samples: DataFrame, load: list[str]) -> DataFrame:
    """Samples by kind and value: request status, request wait, task wait."""
    has_request = F.col("status").isNotNull()
    nothing = F.lit("<no request>")
    status = F.struct(F.lit("request_status").alias("kind"),
                      F.when(has_request, F.col("status")).otherwise(nothing).alias("value"))
    wait = F.struct(
        F.lit("request_wait").alias("kind"),
        F.when(~has_request, nothing).otherwise(F.coalesce("wait_type", F.lit("<none>"))).alias("value"),
    )
    task = F.when(F.col("task_wait").isNotNull(),
                  F.struct(F.lit("task_wait").alias("kind"), F.col("task_wait").alias("value")))
    return (
        samples.select(*load, F.inline(F.array_compact(F.array(status, wait, task))))
        .groupBy(*load, "kind", "value")
        .agg(F.count(F.lit(1)).alias("samples"))
    )


def sample_coverage(samples: DataFrame, order: str) -> DataFrame:
    """Per phase the repeat and elapsed bounds of the first and last sample.

    Numbers are picked one by one, which with an order of fixed width (:func:`packed_order`)
    is a hash aggregate.
    """
    return samples.groupBy("phase").agg(*[
        pick(c, order).alias(f"{label}_{c}")
        for pick, label in ((F.min_by, "first"), (F.max_by, "last"))
        for c in ("repeat_index", "elapsed_start", "elapsed_end")
    ])


def page_totals(pages: DataFrame, counters: list[str], group: list[str] | None = None) -> DataFrame:
    """Sums of counters, 0 where there is nothing to sum."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counters]
    return pages.groupBy(*group).agg(*sums) if group else pages.agg(*sums)


def file_stats_join(stats: DataFrame, catalog: DataFrame) -> DataFrame:
    """Counters with the name and type of their file.

    The planner picks the join by measured size; nothing is forced.
    """
    return stats.join(catalog, "file_id").select(
        "file_id", "logical_name", "file_type", *[c for c in stats.columns if c != "file_id"]
    )


def throughput(runs: DataFrame, rows: str = "rows_written", elapsed_us: str = "elapsed_us") -> DataFrame:
    """Rows per second; NULL when no time has passed."""
    return runs.withColumn(
        "rows_per_second",
        F.try_divide(F.col(rows) * F.lit(1_000_000.0), F.col(elapsed_us).cast("double")),
    )


def backend_compare(runs: DataFrame) -> DataFrame:
    """One row per backend: rows, validated rows, write time, rows per second."""
    totals = runs.groupBy("backend").agg(
        F.sum("rows_written").alias("rows_written"),
        F.sum("validated_rows").alias("validated_rows"),
        F.sum("write_us").alias("write_us"),
    )
    return throughput(totals, "rows_written", "write_us")


def timing_totals(timings: DataFrame, phases: list[str], group: list[str]) -> DataFrame:
    """Elapsed time per phase as columns; the phases are given, so no extra scan."""
    return (
        timings.groupBy(*group).pivot("phase", phases)
        .agg(F.sum("elapsed_us")).na.fill(0, phases)
    )


def merge_counters(counters: DataFrame, group: list[str], sums: list[str], maxima: list[str],
                   last: list[str], order: str) -> DataFrame:
    """Sums, maxima and last values of counter rows in one aggregate."""
    return counters.groupBy(*group).agg(
        *[saturated_sum(F.col(c)).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in maxima],
        *[F.max_by(c, order).alias(c) for c in last],
    )


def report_order(df: DataFrame, kind: str) -> DataFrame:
    """The order of a printed report: waits by time, files by type and name."""
    if kind == "waits":
        return df.orderBy(F.desc("wait_time_ms"), "wait_type")
    return df.orderBy("file_type", "logical_name", "file_id")


def _edge(samples, keys, columns, order, pick) -> DataFrame:
    return samples.groupBy(*keys).agg(pick(F.struct(*columns), order).alias("__edge")).select(*keys, "__edge.*")


def _deltas(first, last, keys, counters, attributes) -> DataFrame:
    before = first.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[F.col(c).alias(f"__first_{c}") for c in counters])
    # A key without a load, or without a name, meets its own first snapshot.
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    return last.join(before, same, "left").select(
        *keys, *attributes,
        *[saturated_difference(F.col(c), F.coalesce(f"__first_{c}", F.lit(0))).alias(c) for c in counters],
    )
