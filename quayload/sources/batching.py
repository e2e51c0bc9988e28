"""Batches of at most n rows, in order, without pulling the rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quayload.functions.exact import floor_div
from quayload.session import ensure_checkpoint_dir, partitions_for

#: Spark's generated ids hold the partition above this many bits of row number.
ROW_BITS = 33


def batches_by_key(df: DataFrame, key: str, rows: int, name: str = "batch_id") -> DataFrame:
    """Batches of a dense integer key: no shuffle, no order needed.

    ``rows`` bounds a batch only where the key is unique, which the caller has to know;
    rows of a repeated key share a batch. :func:`chunk_batches` bounds batches of any rows.
    """
    _positive(rows)
    return df.withColumn(name, floor_div(F.col(key).cast("bigint"), rows))


def in_sequence(df: DataFrame, order: list[str], name: str = "__sequence",
                partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with a sequence number.

    The number is the partition above ``ROW_BITS`` bits and the row in it below.
    Rows equal in ``order`` are told apart by where they were read, so one key
    with a third of all rows is split over partitions like any other stretch of
    the table. The result is checkpointed: its partitions are what the numbers
    refer to, so they must not be cut anew when a task is run again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    tie = "__read_position"
    return (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(partitions or partitions_for(df), *order, tie)
        .sortWithinPartitions(*order, tie)
        .drop(tie)
        .withColumn(name, _row_in_partition())
        .checkpoint()
    )


def _row_in_partition():
    """Generated ids, refused where a partition has more rows than they leave room for."""
    number = F.monotonically_increasing_id()
    last = F.lit((1 << ROW_BITS) - 1).cast("bigint")
    full = F.raise_error(F.lit("a sort partition has too many rows to number: use more partitions")).cast("bigint")
    return F.when(number.bitwiseAND(last) == last, full).otherwise(number)


def with_rank(df: DataFrame, order: list[str], name: str = "row_rank") -> DataFrame:
    """Global row number from 0 by ``order``.

    Counts per partition are as many rows as there are partitions; their running
    sums are joined back as offsets, so that join may be a broadcast.
    """
    numbered = in_sequence(df, order).withColumn("__part", F.shiftright("__sequence", ROW_BITS))
    counts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    within = F.col("__sequence").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        numbered.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + within)
        .drop("__part", "__offset", "__sequence")
    )


def chunk_batches(df: DataFrame, order: list[str], rows: int, name: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``rows`` rows by ``order``; the last one may be short."""
    _positive(rows)
    ranked = with_rank(df, order)
    return ranked.withColumn(name, floor_div(F.col("row_rank"), rows))


def _positive(rows: int) -> None:
    if rows < 1:
        raise ValueError("a batch holds at least one row")
