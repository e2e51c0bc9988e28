"""Violations as rows, batches accepted or rejected, rows set aside, running statistics.

Everything groups on the batch with aggregates that combine on the map side, so
a batch that holds a third of all rows still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayload import policy as P
from quayload.functions.exact import floor_div
from quayload.policy import MAX_NAME_LENGTH
from quayload.session import written


MESSAGES = {
    P.NULL_VALUE: "NULL in a column that takes none",
    P.TOO_LONG: "value is longer than the column",
    P.NON_FINITE: "value is not a finite number",
    P.INTEGER_RANGE: "integer is out of range",
    P.DECIMAL_RANGE: "decimal has too many digits",
    P.TIMESTAMP_RANGE: "date or time is out of range",
    P.TIMEZONE: "time zone has no usable offset",
    P.LOSSY: "value would lose precision",
    P.TYPE_MISMATCH: "value does not have the planned type",
    P.SCHEMA_MISMATCH: "schema differs from the plan",
}


def diagnostics(conformed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per violation, with the key columns of its row."""
    return conformed.where("error_count > 0").select(*keys, F.inline("errors"))


def with_messages(violations: DataFrame) -> DataFrame:
    """A sentence for every violation, for people who read the report."""
    parts = [F.when(F.col("code") == code, F.lit(text)) for code, text in MESSAGES.items()]
    sentence = F.coalesce(*parts, F.lit("value does not fit the planned column"))
    return violations.withColumn("message", F.concat(F.lit("column "), "field_name", F.lit(": "), sentence))


def first_violation(violations: DataFrame, batch: str, row: str, by_column: bool = False) -> DataFrame:
    """The first bad cell of every batch.

    Rows first, then columns; ``by_column`` turns that around. A ``min`` over a
    struct keeps one candidate per task and batch.
    """
    position = ["field_index", row] if by_column else [row, "field_index"]
    carried = [*position, "field_name", "code"]
    first = F.min(F.struct(*carried)).alias("first")
    return violations.groupBy(batch).agg(first).select(
        batch, F.col(f"first.{row}").alias(row), "first.field_index", "first.field_name", "first.code"
    )


def batch_outcomes(conformed: DataFrame, batch: str, batches: DataFrame | None = None) -> DataFrame:
    """Rows, bad rows and violations per batch.

    ``batches`` names every batch that was sent, in column ``batch``; one without rows is
    an outcome of zeros. Without it only batches with rows are known.
    """
    seen = conformed.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("error_count") > 0).alias("bad_rows"),
        F.sum("error_count").alias("violations"),
    )
    if batches is None:
        return seen
    sent = batches.select(F.col(batch).alias("__sent")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("row_count", "bad_rows", "violations")]
    joined = sent.join(seen, F.col("__sent").eqNullSafe(F.col(batch)), "full_outer")
    # A batch nobody announced is still an outcome.
    return joined.select(F.when(F.col("row_count").isNull(), F.col("__sent")).otherwise(F.col(batch)).alias(batch), *counts)


def accepted_batches(conformed: DataFrame, batch: str, batches: DataFrame | None = None) -> DataFrame:
    """Batches without any violation."""
    return batch_outcomes(conformed, batch, batches).where("bad_rows = 0").select(batch, "row_count")


def rejected_batches(conformed: DataFrame, batch: str) -> DataFrame:
    """Batches with a violation; none of their rows may be loaded."""
    return batch_outcomes(conformed, batch).where("bad_rows > 0")


def accepted_rows(conformed: DataFrame, batch: str) -> DataFrame:
    """Rows of accepted batches; rows without a batch id are one batch.

    The rejected batch ids are few against the rows but grow with the data, so
    no broadcast is forced: the planner decides by their measured size.
    """
    bad = conformed.where("error_count > 0").select(F.col(batch).alias("__bad")).distinct()
    return conformed.join(bad, F.col(batch).eqNullSafe(F.col("__bad")), "left_anti").drop("error_count", "errors")


def quarantine(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without ``errors``, and bad rows with their codes."""
    return (
        conformed.where("error_count = 0").drop("error_count", "errors"),
        conformed.where("error_count > 0").withColumn("codes", F.array_distinct(F.col("errors.code"))),
    )


def summary(violations: DataFrame) -> DataFrame:
    """Counts per code and field."""
    return violations.groupBy("code", "field_name").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("severity") == "error").alias("error_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"),
    )


def overall_summary(violations: DataFrame) -> DataFrame:
    """One row: counts, and the distinct codes and fields, both of bounded number."""
    parts = summary(violations)
    return parts.agg(
        F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("error_count"),
        F.coalesce(F.sum("warning_count"), F.lit(0)).alias("warning_count"),
        F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codes"),
        F.array_join(F.array_sort(F.collect_set("field_name")), ",").alias("field_names"),
    )


def running_totals(df: DataFrame, order: str, values: list[str], block: int = 1 << 16) -> DataFrame:
    """Running sums of ``values`` by an integer ``order``, by prefix sums of several levels.

    Ids are cut into blocks of ``block``, blocks into blocks of blocks, until one block
    is left; each level is an aggregate of the one below, and its running sums inside a
    block are the offsets of the level below. No window holds more than ``block`` ids, so
    sparse ids and ids of any range do. ``df`` is written once and read from there.
    Rows without id come first and count for all that follow.
    """
    rows = written(df, "running-totals")
    smallest, largest = rows.agg(F.min(order), F.max(order)).first()
    lowest, span = (0, 1) if smallest is None else (smallest // block, largest // block - smallest // block + 1)
    here = F.coalesce(floor_div(F.col(order).cast("bigint"), block) - F.lit(lowest), F.lit(0)).cast("bigint")
    keyed = rows.withColumn("__known", F.col(order).isNotNull()).withColumn("__b1", here)
    levels = [keyed]
    while True:
        n = len(levels)
        sums = [F.sum(v if n == 1 else f"__sum_{v}").alias(f"__sum_{v}") for v in values]
        above = levels[-1].groupBy("__known", f"__b{n}").agg(*sums)
        if span <= block:
            break
        span = -(-span // block)
        levels.append(above.withColumn(f"__b{n + 1}", floor_div(F.col(f"__b{n}"), block)))
    # The top has at most ``block`` rows, and one more for rows without id.
    inside = Window.partitionBy("__known").orderBy(f"__b{n}").rowsBetween(Window.unboundedPreceding, -1)
    unknown = above.where("not __known").select(F.lit(True).alias("__known"), *(F.col(f"__sum_{v}").alias(f"__first_{v}") for v in values))
    offsets = above.join(unknown, "__known", "left").select(
        "__known", f"__b{n}",
        *(sum((F.coalesce(c, F.lit(0)) for c in (F.sum(f"__sum_{v}").over(inside), F.col(f"__first_{v}"))), F.lit(0)).alias(f"__before_{v}") for v in values),
    )
    for n in range(len(levels) - 1, 0, -1):
        inside = Window.partitionBy("__known", f"__b{n + 1}").orderBy(f"__b{n}").rowsBetween(Window.unboundedPreceding, -1)
        offsets = levels[n].join(offsets, ["__known", f"__b{n + 1}"]).select(
            "__known", f"__b{n}",
            *((F.coalesce(F.sum(f"__sum_{v}").over(inside), F.lit(0)) + F.col(f"__before_{v}")).alias(f"__before_{v}") for v in values),
        )
    inside = Window.partitionBy("__known", "__b1").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return keyed.join(offsets, ["__known", "__b1"]).select(
        *(F.col(c) for c in df.columns),
        *((F.sum(v).over(inside) + F.col(f"__before_{v}")).alias(f"{v}_so_far") for v in values),
    )


def running_load_stats(conformed: DataFrame, batch: str, batches: DataFrame | None = None) -> DataFrame:
    """Rows and batches accepted so far after each accepted batch, those without rows included if ``batches`` names them.

    The conformed rows are read once: what is summed up are the outcomes, one row per
    batch. A batch without id comes first.
    """
    accepted = accepted_batches(conformed, batch, batches)
    counted = accepted.withColumn("batch_count", F.lit(1).cast("bigint"))
    return running_totals(counted, batch, ["row_count", "batch_count"]).select(
        batch, "row_count",
        F.col("row_count_so_far").alias("rows_written"),
        F.col("batch_count_so_far").alias("batches_written"),
    )


def failure_phases(violations: DataFrame, batch: str) -> DataFrame:
    """Schema validation when every code of the batch is a schema mismatch."""
    only_schema = F.bool_and(F.col("code") == P.SCHEMA_MISMATCH)
    return violations.groupBy(batch).agg(
        F.count(F.lit(1)).alias("violations"),
        F.when(only_schema, F.lit("batch_schema_validation"))
        .otherwise(F.lit("value_conversion")).alias("phase"),
    )


def name_audit(names: DataFrame, name: str) -> DataFrame:
    """Whether each text can be a column name, and its bracket-quoted form."""
    column = F.col(name)
    problem = (
        F.when(column == "", F.lit("empty"))
        .when(column.rlike(r"\p{Cc}"), F.lit("control_character"))
        .when(F.char_length(column) > MAX_NAME_LENGTH, F.lit("too_long"))
    )
    return names.withColumn("problem", problem).withColumn(
        "quoted", F.when(problem.isNull(), bracket_quoted(column))
    )


def bracket_quoted(column: Column) -> Column:
    return F.concat(F.lit("["), F.replace(column, F.lit("]"), F.lit("]]")), F.lit("]"))
