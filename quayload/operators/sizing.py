"""Load bytes of cells, rows and batches."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from quayload.functions import checks
from quayload.operators import packing
from quayload.policy import LoadPlan, PlannedColumn
from quayload.session import written

# Bytes of a required value per target kind.
FIXED_BYTES = {"bit": 1, "tinyint": 1, "smallint": 2, "int": 4, "real": 4, "bigint": 8, "float": 8, "datetime": 8}


def decimal_bytes(column: Column, precision: int, scale: int) -> Column:
    """Bytes of a decimal's digits: they follow the digits of the value itself."""
    size = F.lit(16)
    for digits, width in ((28, 12), (19, 8), (9, 4)):
        if precision <= digits:
            size = F.lit(width)
            continue
        limit = Decimal(1).scaleb(digits - scale)
        # Two comparisons: the absolute value of a wide negative decimal is rounded.
        inside = (column < F.lit(limit)) & (column > F.lit(-limit))
        size = F.when(inside, F.lit(width)).otherwise(size)
    return size


def time_bytes(precision: int) -> int:
    """Bytes of a time of day."""
    return 3 if precision <= 2 else 4 if precision <= 4 else 5


def cell_bytes(planned: PlannedColumn, column: Column) -> Column:
    """Bytes of one cell; ``column`` holds the conformed value."""
    target = planned.target
    if target.kind in FIXED_BYTES:
        size = FIXED_BYTES[target.kind]
        if not planned.nullable:
            return F.lit(size).cast("bigint")
        return _or_null(column, F.lit(1 + size), 1)
    if target.kind == "decimal":
        return _or_null(column, decimal_bytes(column, target.precision, target.scale) + 2, 1)
    if target.kind == "date":
        return _or_null(column, F.lit(1 + 3), 1)
    if target.kind in ("time", "datetime2", "datetimeoffset"):
        extra = {"time": 0, "datetime2": 3, "datetimeoffset": 5}[target.kind]
        return _or_null(column, F.lit(1 + time_bytes(target.precision) + extra), 1)
    if target.kind == "binary":
        return _or_null(column, F.lit(2 + target.length), 2)
    payload = payload_bytes_of(planned, column)
    if target.length is not None:
        return _or_null(column, payload + 2, 2)
    chunk = F.when(payload > 0, F.lit(4)).otherwise(F.lit(0))
    return _or_null(column, payload + 12 + chunk, 8)


def payload_bytes_of(planned: PlannedColumn, column: Column) -> Column:
    """Bytes of the text or binary value itself."""
    if planned.target.kind == "nvarchar":
        return checks.utf16_units(column) * 2
    return F.octet_length(column)


def row_bytes(plan: LoadPlan) -> Column:
    """Bytes of a row: one for the row itself and its cells."""
    total = F.lit(1).cast("bigint")
    for planned in plan.columns:
        total = total + cell_bytes(planned, F.col(f"`{planned.column_name}`"))
    return total


def column_bytes(df: DataFrame, plan: LoadPlan) -> DataFrame:
    """Bytes and NULLs per column, from one aggregate."""
    aggregates, rows = [], []
    for i, planned in enumerate(plan.columns):
        column = F.col(f"`{planned.column_name}`")
        aggregates += [F.sum(cell_bytes(planned, column)).alias(f"b{i}"),
                       F.count_if(column.isNull()).alias(f"n{i}")]
        rows.append(F.struct(
            F.lit(planned.index).alias("field_index"),
            F.lit(planned.column_name).alias("field_name"),
            F.lit(planned.target.sql).alias("target_type"),
            F.coalesce(F.col(f"b{i}"), F.lit(0)).alias("cell_bytes"),
            F.col(f"n{i}").alias("null_cells"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def batch_bytes(df: DataFrame, plan: LoadPlan, batch: str) -> DataFrame:
    """Rows, bytes and the largest row of every batch."""
    return df.select(batch, row_bytes(plan).alias("row_bytes")).groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("row_bytes").alias("payload_bytes"),
        F.max("row_bytes").alias("max_row_bytes"),
    )


def content_counters(df: DataFrame, plan: LoadPlan) -> list[Column]:
    """Aggregates of text bytes, binary bytes and NULL cells."""
    text, binary, nulls = (F.lit(0).cast("bigint") for _ in range(3))
    for planned in plan.columns:
        column = F.col(f"`{planned.column_name}`")
        nulls = nulls + F.when(column.isNull(), F.lit(1)).otherwise(F.lit(0))
        if planned.target.kind == "nvarchar":
            text = text + F.coalesce(payload_bytes_of(planned, column), F.lit(0))
        elif planned.target.kind == "varbinary":
            binary = binary + F.coalesce(payload_bytes_of(planned, column), F.lit(0))
    return [text.alias("text_bytes"), binary.alias("binary_bytes"), nulls.alias("null_cells")]


def _or_null(column: Column, size: Column, null_size: int) -> Column:
    return F.when(column.isNull(), F.lit(null_size)).otherwise(size).cast("bigint")


def load_counters(df: DataFrame, plan: LoadPlan, batch: str, order: list[str], limit: int = packing.DEFAULT_LIMIT,
                  batches: DataFrame | None = None, batch_rows: int | None = None) -> DataFrame:
    """One row: rows, batches, ranges, encoded bytes, largest range, text bytes, binary bytes, NULL cells.

    The rows are read and measured once; ranges and sums are taken from their sizes, which
    are written. ``batches`` names every batch that was sent, also those without rows.
    """
    content = ["text_bytes", "binary_bytes", "null_cells"]
    keys = list(dict.fromkeys([batch, *order]))
    sizes = written(df.select(*keys, row_bytes(plan).alias("__bytes"), *content_counters(df, plan)), "row-sizes")
    totals = sizes.agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("__bytes"), F.lit(0)).alias("encoded_bytes"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in content))
    named = sizes.select(batch) if batches is None else sizes.select(batch).unionByName(batches.select(batch))
    counted = named.distinct().agg(F.count(F.lit(1)).alias("batches"))
    ranges = packing.pack_ranges(sizes, batch, order, "__bytes", limit, batch_rows).agg(
        F.count(F.lit(1)).alias("row_ranges"), F.coalesce(F.max("range_bytes"), F.lit(0)).alias("max_range_bytes"))
    # Single rows made one: each column is known to one of them only.
    parts = totals.unionByName(counted, allowMissingColumns=True).unionByName(ranges, allowMissingColumns=True)
    names = ["row_count", "batches", "row_ranges", "encoded_bytes", "max_range_bytes", *content]
    return parts.agg(*(F.max(c).alias(c) for c in names))


def readiness(conformed: DataFrame, plan: LoadPlan, batch: str, order: list[str], limit: int = packing.DEFAULT_LIMIT,
              batch_rows: int | None = None) -> DataFrame:
    """Per batch rows, bad rows, violations, bytes, the verdict, and the ranges an accepted batch is sent in.

    ``order`` puts the rows of a batch in a row; rows it leaves equal are ordered by size.
    A rejected batch is sent in no range.
    """
    keys = list(dict.fromkeys([batch, *order]))
    sizes = written(conformed.select(*keys, "error_count", row_bytes(plan).alias("__bytes")), "row-sizes")
    verdicts = sizes.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("error_count") > 0).alias("bad_rows"),
        F.sum("error_count").alias("violations"), F.sum("__bytes").alias("payload_bytes"), F.max("__bytes").alias("max_row_bytes"))
    verdicts = verdicts.withColumn("accepted", F.col("bad_rows") == 0)
    packed = packing.pack_ranges(sizes.drop("error_count"), batch, [*order, "__bytes"], "__bytes", limit, batch_rows)
    ranges = packing.range_summary(packed, batch).select(F.col(batch).alias("__batch"), "ranges", "max_range_bytes")
    none = F.lit(0).cast("bigint")
    return verdicts.join(ranges, F.col(batch).eqNullSafe(F.col("__batch")), "left").drop("__batch").withColumns({
        c: F.when(F.col("accepted"), F.col(c)).otherwise(none) for c in ("ranges", "max_range_bytes")})
