"""All columns of a table in one projection, with the violations beside them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayload import policy as P
from quayload.functions import checks, temporal, zones
from quayload.functions.checks import Checked, code_when, no_code
from quayload.functions.hold import Hold, Holder, inline
from quayload.policy import LoadPlan, PlannedColumn, PlanOptions

#: Type of the ``errors`` column.
ERRORS_TYPE = "array<struct<severity:string,code:string,field_index:int,field_name:string>>"

#: Carrier of each integer target in Spark.
CARRIERS = {"bit": "boolean", "tinyint": "smallint", "smallint": "smallint", "int": "int", "bigint": "bigint"}

#: Unsigned sources whose carriers are wider and signed, by bits.
UNSIGNED = {"uint16": 16, "uint32": 32}


def conform_column(planned: PlannedColumn, options: PlanOptions, column: Column | None = None,
                   hold: Holder = inline) -> Checked:
    """Value and code of one planned column, including the NULL rule."""
    source = F.col("`" + planned.name.replace("`", "``") + "`") if column is None else column
    return checks.not_null(_value_rule(planned, options, source, hold), source, planned.nullable, hold)


def conform_table(df: DataFrame, plan: LoadPlan, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns as they are, the conformed columns, ``error_count`` and ``errors``.

    ``errors`` is an array of (severity, code, field_index, field_name) in column
    order. Whoever only asks whether a row is good reads ``error_count``; the
    array is then pruned from the plan. All is projection, so column pruning still
    reaches the scan.

    A frame whose columns are not the planned ones is not converted: every row has a
    ``SchemaMismatch`` for each column that is missing or has another type, and no other
    violation. Its value there is NULL. Columns that are not planned do not matter.
    """
    wrong = schema_mismatches(df.schema, plan)
    if wrong:
        return _mismatched(df, plan, keep, wrong)
    return _conformed(df, plan, keep)


def schema_mismatches(schema: T.StructType, plan: LoadPlan) -> list[PlannedColumn]:
    """Planned columns that a frame lacks, has twice, or has with a type that cannot carry them."""
    fields: dict[str, list[T.StructField]] = {}
    for field in schema.fields:
        fields.setdefault(field.name, []).append(field)
    return [c for c in plan.columns if len(found := fields.get(c.name, [])) != 1 or not P.carries(found[0], c.source)]


def _mismatched(df: DataFrame, plan: LoadPlan, keep: list[str] | None, wrong: list[PlannedColumn]) -> DataFrame:
    lost = {c.name for c in wrong}
    # Kept columns stay as they came, also those that are planned with another type.
    have = [F.col(f"`{n}`") for n in dict.fromkeys([*(keep or []), *(c.name for c in plan.columns if c.name not in lost)])]
    nothing = [F.lit(None).cast(P.carrier_of(c.source)).alias(c.name) for c in wrong if c.name not in (keep or [])]
    usable = LoadPlan(tuple(c for c in plan.columns if c.name not in lost or c.name not in (keep or [])), plan.options)
    issues = [diagnostic(F.lit(P.SCHEMA_MISMATCH), c.index, c.name) for c in wrong]
    rows = _conformed(df.select(*have, *nothing), usable, keep)
    return rows.withColumn("error_count", F.lit(len(issues))).withColumn("errors", F.array(*issues).cast(ERRORS_TYPE))


def _conformed(df: DataFrame, plan: LoadPlan, keep: list[str] | None) -> DataFrame:
    kept, hold = [F.col(name) for name in keep or []], Hold()
    conformed = [(c, conform_column(c, plan.options, hold=hold)) for c in plan.columns]
    codes = [(c, checked.code) for c, checked in conformed if not checked.never_fails(c)]
    values = [
        checked.value.alias(c.column_name) for c, checked in conformed if c.column_name not in (keep or [])
    ]
    return hold.add_to(df).select(
        *kept, *values, error_count(codes).alias("error_count"), errors(codes).alias("errors")
    )


def error_count(codes: list[tuple[PlannedColumn, Column]]) -> Column:
    """Number of violations of a row."""
    total = F.lit(0)
    for _, code in codes:
        total = total + F.when(code.isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return total


def errors(codes: list[tuple[PlannedColumn, Column]]) -> Column:
    """Violations of a row; built only for rows that have one."""
    none = F.array().cast(ERRORS_TYPE)
    if not codes:
        return none
    parts = [
        F.when(code.isNotNull(), F.array(diagnostic(code, c.index, c.name))).otherwise(none) for c, code in codes
    ]
    return F.when(error_count(codes) > 0, F.concat(*parts)).otherwise(none)


def conform_columns(df: DataFrame, plan: LoadPlan, keep: list[str] | None = None) -> DataFrame:
    """Value and ``<name>_code`` of every planned column, side by side."""
    columns, hold = [], Hold()
    for planned in plan.columns:
        checked = conform_column(planned, plan.options, hold=hold)
        columns += [checked.value.alias(planned.column_name),
                    checked.code.cast("string").alias(f"{planned.column_name}_code")]
    return hold.add_to(df).select(*(keep or []), *columns)


def diagnostic(code: Column, index: int, name: str) -> Column:
    """One violation of a row."""
    return F.struct(
        F.lit("error").alias("severity"),
        code.alias("code"),
        F.lit(index).alias("field_index"),
        F.lit(name).alias("field_name"),
    )


def loadable(df: DataFrame, plan: LoadPlan) -> DataFrame:
    """Conformed columns in forms a sink takes: split times become text."""
    columns = []
    for c in plan.columns:
        column = F.col("`" + c.column_name.replace("`", "``") + "`")
        if c.target.kind == "datetime2":
            column = F.when(column.isNotNull(), temporal.datetime2_text(column, c.target.precision))
        elif c.target.kind == "datetimeoffset":
            column = F.when(column.isNotNull(), temporal.datetimeoffset_text(column))
        elif c.target.kind == "datetime":
            column = F.when(column.isNotNull(), temporal.datetime_text(column))
        elif c.target.kind == "time":
            column = temporal.time_text(column, c.target.precision)
        elif c.target.kind == "date":
            column = temporal.date_text(column)
        columns.append(column.alias(c.column_name))
    extra = [name for name in df.columns if name not in {c.column_name for c in plan.columns}]
    return df.select(*extra, *columns)


def instant_of(planned: PlannedColumn, options: PlanOptions, column: Column,
               hold: Holder = inline) -> temporal.Instant:
    """Instant of a timestamp column, whatever carries it in Spark."""
    source = planned.source
    if source.kind == "date64":
        return temporal.instant_from_units(column, "ms", hold)
    if source.unit == "ns":
        return temporal.instant_from_nanos(column, options.nanosecond, hold)
    if source.unit == "us" and source.zone is None:
        return temporal.instant_from_ntz(column, hold)
    if source.unit == "us":
        return temporal.instant_from_timestamp(column, hold)
    return temporal.instant_from_units(column, source.unit, hold)


def _value_rule(planned: PlannedColumn, options: PlanOptions, column: Column, hold: Holder) -> Checked:
    source, target = planned.source, planned.target
    if source.kind == "uint64":
        if target.kind == "decimal":
            return checks.uint64_as_decimal(column, hold)
        return checks.uint64_as_bigint(column, hold)
    if target.kind == "tinyint":
        return checks.tinyint(column, hold)
    if source.kind in UNSIGNED:
        return checks.unsigned(column, UNSIGNED[source.kind], CARRIERS[target.kind], hold)
    if target.kind in CARRIERS:
        return checks.widen(column, CARRIERS[target.kind])
    if target.kind == "real":
        return checks.finite(column, "float", hold)
    if target.kind == "float":
        return checks.finite(column, "double", hold)
    if target.kind == "nvarchar":
        return checks.nvarchar(column, target.length, hold)
    if target.kind == "varbinary":
        return checks.varbinary(column, target.length, hold)
    if target.kind == "binary":
        return checks.fixed_binary(column, target.length, hold)
    if target.kind == "decimal":
        return _decimal_rule(planned, column, hold)
    if target.kind == "date":
        return temporal.date64_midnight(column, hold) if source.kind == "date64" else temporal.date_number(column, hold)
    if target.kind == "time":
        return temporal.time_of_day(column, source.unit, options.nanosecond, hold)
    if target.kind == "datetime2":
        return temporal.datetime2(_utc_instant(planned, options, column, hold), target.precision, hold)
    if target.kind == "datetime":
        return temporal.datetime_fragments(_utc_instant(planned, options, column, hold), options.datetime_rounding, hold)
    if target.kind == "datetimeoffset":
        return _offset_rule(planned, options, column, hold)
    return Checked(F.lit(None), code_when(column.isNotNull(), P.TYPE_MISMATCH))


def _utc_instant(planned: PlannedColumn, options: PlanOptions, column: Column, hold: Holder) -> temporal.Instant:
    """Instant whose zone only has to be valid: the value is stored in UTC."""
    instant = instant_of(planned, options, column, hold)
    if not planned.source.zone:
        return instant
    code = zones.zone_code(planned.source.zone)
    return replace(instant, code=code if instant.code is None else F.coalesce(code, instant.code))


def _decimal_rule(planned: PlannedColumn, column: Column, hold: Holder) -> Checked:
    source, target = planned.source, planned.target
    if max(source.scale, 0) != target.scale:
        return Checked(
            F.lit(None).cast(f"decimal({target.precision},{target.scale})"),
            code_when(column.isNotNull(), P.SCHEMA_MISMATCH),
        )
    if source.kind == "wide_decimal":
        return checks.wide_decimal(column, target.precision, source.scale, hold)
    if source.scale < 0:
        return checks.negative_scale_decimal(column, target.precision, -source.scale, hold)
    return checks.decimal(column, target.precision, target.scale, hold)


def _offset_rule(planned: PlannedColumn, options: PlanOptions, column: Column, hold: Holder) -> Checked:
    source = planned.source
    instant = instant_of(planned, options, column, hold)
    if source.unit == "us":
        moment = column
    else:
        # Offsets change on whole seconds, so the second of the instant decides.
        seconds = instant.day * 86_400 + F.call_function("div", instant.ticks, F.lit(10_000_000).cast("bigint"))
        in_range = instant.day.between(-temporal.EPOCH_DAY_FROM_0001, temporal.MAX_DAY_FROM_0001)
        moment = F.timestamp_seconds(F.when(in_range, seconds))
    offset = zones.named_offset(moment, source.zone, hold)
    code = F.coalesce(offset.code, no_code())
    return temporal.datetimeoffset(instant, offset.minutes, code, hold)
