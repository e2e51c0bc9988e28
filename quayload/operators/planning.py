"""Target columns from a schema, and from the values seen where a policy needs them.

All observations of a table are taken in one aggregate without grouping: each
task reduces its rows to one row, so the shuffle carries one row per task.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quayload import policy as P
from quayload.functions import checks
from quayload.functions.exact import floor_mod
from quayload.policy import (
    LoadPlan, PlanIssue, PlannedColumn, PlanningError, PlanOptions, SourceType, TargetType,
)

INTEGER_TARGETS = {
    "boolean": "bit", "int8": "smallint", "int16": "smallint", "int32": "int", "int64": "bigint",
    "uint8": "tinyint", "uint16": "int", "uint32": "bigint",
}


def name_problem(name: str) -> str | None:
    """Why a text cannot be a column name, if so."""
    if not name:
        return "empty name"
    if any(ord(ch) < 32 or 127 <= ord(ch) < 160 for ch in name):
        return "control character in name"
    if len(name) > P.MAX_NAME_LENGTH:
        return f"name longer than {P.MAX_NAME_LENGTH} characters"
    return None


def plan_field(index: int, field: T.StructField, options: PlanOptions,
               observed: dict | None = None) -> PlannedColumn | PlanIssue:
    """Target of one field, or the reason it has none.

    ``observed`` holds values of :func:`observation_columns` by ``(index, statistic)``.
    """
    source = P.source_type_of(field)
    problem = name_problem(field.name)
    if problem:
        return PlanIssue(index, field.name, P.IDENTIFIER_INVALID, problem)
    target = _target_of(index, source, options, observed)
    if isinstance(target, TargetType):
        return PlannedColumn(index, field.name, field.nullable, source, target)
    code, message = target
    return PlanIssue(index, field.name, code, message)


def plan_schema(schema: T.StructType, options: PlanOptions = PlanOptions(),
                observed: dict | None = None) -> LoadPlan:
    """Plan every field; all fields that fail are reported in one error."""
    outcome = [plan_field(i, f, options, observed) for i, f in enumerate(schema.fields)]
    issues = [item for item in outcome if isinstance(item, PlanIssue)]
    if issues:
        raise PlanningError(issues)
    return LoadPlan(tuple(outcome), options)


def plan_table(df: DataFrame, options: PlanOptions = PlanOptions()) -> LoadPlan:
    """Plan with one pass over the data where a policy asks for observed values."""
    needed = observation_columns(df.schema, options)
    observed: dict = {}
    if needed:
        names = list(needed)
        row = df.agg(*[needed[key].alias(f"o{i}") for i, key in enumerate(names)]).first()
        observed = {key: row[i] for i, key in enumerate(names)}
    return plan_schema(df.schema, options, observed)


def observation_columns(schema: T.StructType, options: PlanOptions) -> dict[tuple[int, str], Column]:
    """The aggregates the policies of ``options`` need."""
    needed: dict[tuple[int, str], Column] = {}
    for index, field in enumerate(schema.fields):
        source, column = P.source_type_of(field), F.col(_quoted(field.name))
        if source.kind in P.STRING_FAMILY and options.string == "observed":
            needed[index, "units"] = F.max(checks.utf16_units(column))
        elif source.kind in P.BINARY_FAMILY and options.binary == "observed":
            needed[index, "shortest"] = F.min(F.octet_length(column))
            needed[index, "longest"] = F.max(F.octet_length(column))
        elif source.kind == "date64" and options.date64 == "midnight":
            needed[index, "midnight"] = F.coalesce(
                F.bool_and(floor_mod(column.cast("bigint"), 86_400_000) == 0), F.lit(True)
            )
    return needed


def plan_report(df: DataFrame, options: PlanOptions = PlanOptions()) -> DataFrame:
    """One row per column: source, target text, nullability, or code and reason.

    The report stays a DataFrame: planning rules that need no values are written
    out as literals, the others as expressions over the aggregated row.
    """
    needed = observation_columns(df.schema, options)
    labels = {key: f"o{i}" for i, key in enumerate(needed)}
    aggregates = [column.alias(labels[key]) for key, column in needed.items()]
    stats = df.agg(F.count(F.lit(1)).alias("row_count"), *aggregates)
    rows = [
        _report_row(index, field, options, {k[1]: F.col(v) for k, v in labels.items() if k[0] == index})
        for index, field in enumerate(df.schema.fields)
    ]
    return stats.select(F.inline(F.array(*rows)))


def observed_nvarchar(df: DataFrame, columns: list[str], limit: int = 4000) -> DataFrame:
    """Smallest nvarchar(n) per text column; ``max`` beyond ``limit``; n is at least 1."""
    stats = df.agg(*[F.max(checks.utf16_units(F.col(c))).alias(f"o{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(
            F.lit(c).alias("field_name"),
            F.coalesce(F.col(f"o{i}"), F.lit(0)).cast("bigint").alias("max_units"),
            _observed_text("nvarchar", F.col(f"o{i}"), limit).alias("target_type"),
        )
        for i, c in enumerate(columns)
    ]
    return stats.select(F.inline(F.array(*rows)))


def observed_varbinary(df: DataFrame, columns: list[str], limit: int = 8000) -> DataFrame:
    """Smallest varbinary(n) per column; binary(n) where all values have n bytes."""
    aggregates = []
    for i, c in enumerate(columns):
        size = F.octet_length(F.col(c))
        aggregates += [F.min(size).alias(f"lo{i}"), F.max(size).alias(f"hi{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("field_name"),
            F.coalesce(F.col(f"lo{i}"), F.lit(0)).cast("bigint").alias("min_bytes"),
            F.coalesce(F.col(f"hi{i}"), F.lit(0)).cast("bigint").alias("max_bytes"),
            _observed_binary(F.col(f"lo{i}"), F.col(f"hi{i}"), limit).alias("target_type"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def midnight_proof(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per millisecond-date column: values, values off midnight, the target."""
    aggregates = []
    for i, c in enumerate(columns):
        off = floor_mod(F.col(c).cast("bigint"), 86_400_000) != 0
        aggregates += [F.count(c).alias(f"n{i}"), F.count_if(off).alias(f"bad{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("field_name"),
            F.col(f"n{i}").alias("value_count"),
            F.col(f"bad{i}").alias("off_midnight"),
            F.when(F.col(f"bad{i}") == 0, F.lit("date")).otherwise(F.lit("datetime2(3)")).alias("target_type"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def observed_decimal_shape(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Digits needed left and right of the point, from unscaled integer text.

    ``columns`` maps a text column of unscaled integers to its scale; a negative
    scale adds zeros on the left side.
    """
    aggregates, rows = [], []
    for i, (c, scale) in enumerate(columns.items()):
        digits = F.ltrim(F.col(c), F.lit("+-0"))
        size = F.length(digits)
        trailing = size - F.length(F.rtrim(digits, F.lit("0")))
        zero = size == 0
        left = F.when(zero, F.lit(0)).otherwise(F.greatest(size - scale, F.lit(0)))
        right = F.when(zero, F.lit(0)).otherwise(F.greatest(F.lit(scale) - trailing, F.lit(0)))
        aggregates += [F.max(left).alias(f"l{i}"), F.max(right).alias(f"r{i}")]
        left_max = F.coalesce(F.col(f"l{i}"), F.lit(0)).cast("bigint")
        right_max = F.coalesce(F.col(f"r{i}"), F.lit(0)).cast("bigint")
        precision = F.greatest(left_max + right_max, F.lit(1).cast("bigint"))
        fits = precision <= P.MAX_DECIMAL_PRECISION
        rows.append(F.struct(
            F.lit(c).alias("field_name"),
            left_max.alias("integer_digits"),
            right_max.alias("fraction_digits"),
            F.when(fits, F.concat(
                F.lit("decimal("), precision.cast("string"), F.lit(","), right_max.cast("string"), F.lit(")")
            )).alias("target_type"),
            F.when(~fits, F.lit(P.DECIMAL_RANGE)).alias("code"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, required: dict[str, bool]) -> DataFrame:
    """NULL count per column against its declared nullability (True = required)."""
    aggregates = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(required)]
    rows = [
        F.struct(
            F.lit(c).alias("field_name"),
            F.lit(not must).alias("nullable"),
            F.col("row_count"),
            F.col(f"n{i}").alias("null_count"),
            F.when(F.lit(must) & (F.col(f"n{i}") > 0), F.lit(P.NULL_VALUE)).alias("code"),
        )
        for i, (c, must) in enumerate(required.items())
    ]
    stats = df.agg(F.count(F.lit(1)).alias("row_count"), *aggregates)
    return stats.select(F.inline(F.array(*rows)))


def create_table_sql(plan: LoadPlan, table: str, schema: str | None = None) -> str:
    """``CREATE TABLE`` text of a plan, for the database that will hold the table."""
    target = ".".join(bracket_quote(part) for part in (schema, table) if part)
    lines = [
        f"    {bracket_quote(c.column_name)} {c.target.sql} {'NULL' if c.nullable else 'NOT NULL'}"
        for c in plan.columns
    ]
    return f"CREATE TABLE {target} (\n" + ",\n".join(lines) + "\n);"


def bracket_quote(name: str) -> str:
    """A checked name in brackets, with ``]`` doubled."""
    problem = name_problem(name)
    if problem:
        raise ValueError(problem)
    return "[" + name.replace("]", "]]") + "]"


def _target_of(index: int, source: SourceType, options: PlanOptions, observed: dict | None):
    kind = source.kind
    if kind in INTEGER_TARGETS:
        return TargetType(INTEGER_TARGETS[kind])
    if kind in ("float16", "float32"):
        return TargetType("real")
    if kind == "float64":
        return TargetType("float", precision=53)
    if kind == "date32":
        return TargetType("date")
    if kind == "uint64":
        if options.uint64 == "reject":
            return P.POLICY_REQUIRED, "uint64 needs the decimal or the bigint policy"
        return TargetType("decimal", precision=20, scale=0) if options.uint64 == "decimal" else TargetType("bigint")
    if kind in P.STRING_FAMILY:
        return _sized("nvarchar", options.string, options.observed_limit, index, "units", observed)
    if kind in P.BINARY_FAMILY:
        return _observed_binary_target(options, index, observed)
    if kind == "fixed_binary":
        if not 1 <= (source.length or 0) <= P.MAX_BINARY_LENGTH:
            return P.UNSUPPORTED_TYPE, f"binary(n) takes 1..{P.MAX_BINARY_LENGTH} bytes"
        return TargetType("binary", length=source.length)
    if kind in ("decimal", "wide_decimal"):
        if kind == "wide_decimal" and options.wide_decimal == "reject":
            return P.POLICY_REQUIRED, "a wide decimal needs the downcast policy"
        return _decimal_target(source.precision, source.scale, options)
    if kind == "time":
        return TargetType("time", precision={"s": 0, "ms": 3, "us": 6, "ns": 7}[source.unit])
    if kind == "date64":
        if options.date64 == "datetime2":
            return TargetType("datetime2", precision=3)
        if observed is None or (index, "midnight") not in observed:
            return P.OBSERVATION_REQUIRED, "a millisecond date needs its values to be midnight"
        if observed[index, "midnight"]:
            return TargetType("date")
        return P.LOSSY, "values off midnight do not fit a date"
    if kind == "timestamp":
        return _timestamp_target(source, options)
    return P.UNSUPPORTED_TYPE, f"{kind} has no target type"


def _sized(kind, setting, limit, index, statistic, observed):
    if setting == "max":
        return TargetType(kind)
    if setting != "observed":
        return TargetType(kind, length=setting)
    if observed is None or (index, statistic) not in observed:
        return P.OBSERVATION_REQUIRED, f"an observed {kind} needs values"
    length = max(observed[index, statistic] or 0, 1)
    return TargetType(kind, length=length if length <= limit else None)


def _observed_binary_target(options, index, observed):
    if options.binary != "observed":
        return _sized("varbinary", options.binary, options.observed_binary_limit, index, "longest", observed)
    target = _sized("varbinary", "observed", options.observed_binary_limit, index, "longest", observed)
    if isinstance(target, TargetType) and target.length:
        low, high = observed[index, "shortest"], observed[index, "longest"]
        if low is not None and low == high and low > 0:
            return replace(target, kind="binary")
    return target


def _decimal_target(precision, scale, options):
    if precision < 1:
        return P.DECIMAL_RANGE, "decimal needs at least one digit"
    if scale < 0:
        if options.decimal == "reject":
            return P.POLICY_REQUIRED, "a negative scale needs the normalize policy"
        precision, scale = precision - scale, 0
    if precision > P.MAX_DECIMAL_PRECISION:
        return P.DECIMAL_RANGE, f"more than {P.MAX_DECIMAL_PRECISION} digits"
    if scale > precision:
        return P.DECIMAL_RANGE, "scale exceeds precision"
    return TargetType("decimal", precision=precision, scale=scale)


def _timestamp_target(source, options):
    if source.zone and options.timezone == "reject":
        return P.POLICY_REQUIRED, "a timestamp with zone needs a timezone policy"
    if source.zone and options.timezone == "offset":
        return TargetType("datetimeoffset", precision=7)
    if options.timestamp == "datetime":
        return TargetType("datetime")
    if not 0 <= options.timestamp <= 7:
        return P.POLICY_REQUIRED, "datetime2 takes a precision of 0..7"
    return TargetType("datetime2", precision=options.timestamp)


def _report_row(index, field, options, observed) -> Column:
    source = P.source_type_of(field)
    text, code, message = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    if "units" in observed and not name_problem(field.name):
        text = _observed_text("nvarchar", observed["units"], options.observed_limit)
    elif "longest" in observed and not name_problem(field.name):
        text = _observed_binary(observed["shortest"], observed["longest"], options.observed_binary_limit)
    elif "midnight" in observed and not name_problem(field.name):
        text = F.when(observed["midnight"], F.lit("date"))
        code = F.when(~observed["midnight"], F.lit(P.LOSSY))
        message = F.when(~observed["midnight"], F.lit("values off midnight do not fit a date"))
    else:
        outcome = plan_field(index, field, options)
        if isinstance(outcome, PlannedColumn):
            text = F.lit(outcome.target.sql)
        else:
            code, message = F.lit(outcome.code), F.lit(outcome.message)
    return F.struct(
        F.lit(index).alias("field_index"),
        F.lit(field.name).alias("field_name"),
        F.lit(source.text).alias("source_type"),
        F.substring_index(text, "(", 1).alias("target_family"),
        text.alias("target_type"),
        F.lit(field.nullable).alias("nullable"),
        code.alias("code"),
        message.alias("reason"),
    )


def _observed_text(kind: str, length: Column, limit: int) -> Column:
    size = F.greatest(F.coalesce(length, F.lit(0)), F.lit(1))
    return F.when(size > limit, F.lit(f"{kind}(max)")).otherwise(
        F.concat(F.lit(f"{kind}("), size.cast("string"), F.lit(")"))
    )


def _observed_binary(low: Column, high: Column, limit: int) -> Column:
    fixed = (low == high) & (low > 0) & (low <= limit)
    return F.when(fixed, F.concat(F.lit("binary("), low.cast("string"), F.lit(")"))).otherwise(
        _observed_text("varbinary", high, limit)
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
