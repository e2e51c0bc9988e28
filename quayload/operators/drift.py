"""Planned columns against actual columns, over catalogs of many tables.

A catalog row is (table_id, ordinal, name, type, nullable, precision, scale).
Both sides are large and unique on (table_id, ordinal): one full outer join,
shuffled on that key, with every difference turned into a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayload import policy as P
from quayload.policy import BINARY_FAMILY, STRING_FAMILY, LoadPlan, PlanIssue

CATALOG_SCHEMA = (
    "table_id string, ordinal long, name string, type string, nullable boolean, precision int, scale int"
)


def plan_mismatches(schema: T.StructType, plan: LoadPlan, check_nullability: bool = True) -> list[PlanIssue]:
    """How one schema differs from a plan: the first difference of every field.

    The check made while writing leaves nullability to the values.
    """
    issues = []
    fields, columns = schema.fields, plan.columns
    if len(fields) != len(columns):
        issues.append(PlanIssue(
            min(len(fields), len(columns)), "", P.SCHEMA_MISMATCH,
            f"{len(fields)} fields, but {len(columns)} planned columns"))
    for position, (field, planned) in enumerate(zip(fields, columns)):
        found, wanted = P.source_type_of(field), planned.source
        if planned.index != position:
            reason = f"planned for position {planned.index}, found at {position}"
        elif field.name != planned.name:
            reason = f"found name {field.name}"
        elif found != wanted and not _one_family(found.kind, wanted.kind):
            reason = f"found type {found.text}, planned {wanted.text}"
        elif check_nullability and field.nullable != planned.nullable:
            reason = f"found nullable {field.nullable}, planned {planned.nullable}"
        else:
            continue
        issues.append(PlanIssue(position, planned.name, P.SCHEMA_MISMATCH, reason))
    return issues


def plan_catalog(spark: SparkSession, plan: LoadPlan, table_id: str) -> DataFrame:
    """The target columns of a plan as catalog rows."""
    rows = [
        (table_id, i, c.column_name, c.target.kind, c.nullable, c.target.precision if c.target.kind == "decimal" else None,
         c.target.scale if c.target.kind == "decimal" else None)
        for i, c in enumerate(plan.columns)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def paired(planned: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with ``p_`` and ``a_`` columns beside the key."""
    left = planned.select(*keys, *[F.col(c).alias(f"p_{c}") for c in planned.columns if c not in keys],
                          F.lit(True).alias("p_there"))
    right = actual.select(*keys, *[F.col(c).alias(f"a_{c}") for c in actual.columns if c not in keys],
                          F.lit(True).alias("a_there"))
    return left.join(right, keys, "full_outer")


def schema_drift(planned: DataFrame, actual: DataFrame, check_nullability: bool = True) -> DataFrame:
    """The first difference of every column: missing, extra, name, type, nullability."""
    both = F.col("p_there") & F.col("a_there")
    same_family = _interchangeable(F.col("p_type"), F.col("a_type"))
    reason = (
        F.when(F.col("a_there").isNull(), F.lit("missing_column"))
        .when(F.col("p_there").isNull(), F.lit("extra_column"))
        .when(_differs("name"), F.lit("name"))
        .when(_differs("type") & ~F.coalesce(same_family, F.lit(False)), F.lit("type"))
    )
    if check_nullability:
        reason = reason.when(both & _differs("nullable"), F.lit("nullability"))
    return (
        paired(planned, actual, ["table_id", "ordinal"])
        .withColumn("reason", reason)
        .where("reason is not null")
        .select("table_id", "ordinal", F.col("p_name").alias("planned_name"),
                F.col("a_name").alias("actual_name"), "reason")
    )


def target_drift(planned: DataFrame, actual: DataFrame) -> DataFrame:
    """Every difference between plan and target, several per column if need be.

    Columns are paired by position; the target carries the ordinal it claims.
    """
    p, a = F.col("p_there").isNotNull(), F.col("a_there").isNotNull()
    differences = F.array_compact(F.array(
        F.when(~(p & a), F.lit("column_count")),
        F.when(p & a & ~F.col("a_claimed_ordinal").eqNullSafe(F.col("ordinal")), F.lit("ordinal")),
        F.when(p & a & _differs("name"), F.lit("name")),
        F.when(p & a & _differs("nullable"), F.lit("nullability")),
    ))
    return paired(planned, actual, ["table_id", "ordinal"]).select(
        "table_id", "ordinal", F.explode(differences).alias("difference")
    )


def target_type_drift(planned: DataFrame, actual: DataFrame) -> DataFrame:
    """Exact target type, and precision and scale of decimals."""
    both = F.col("p_there") & F.col("a_there")
    decimal = F.col("p_type") == "decimal"
    known = F.col("a_precision").isNotNull() & F.col("a_scale").isNotNull()
    same_shape = (F.col("p_precision") == F.col("a_precision")) & (F.col("p_scale") == F.col("a_scale"))
    # A plain datetime target takes the nullable datetime encoding.
    differences = F.array_compact(F.array(
        F.when(both & _differs("type"), F.lit("type")),
        F.when(both & decimal & ~known, F.lit("decimal_shape_unknown")),
        F.when(both & decimal & known & ~same_shape, F.lit("decimal_shape")),
    ))
    return paired(planned, actual, ["table_id", "ordinal"]).select(
        "table_id", "ordinal",
        F.col("p_type").alias("planned_type"), F.col("a_type").alias("actual_type"),
        F.explode(differences).alias("difference"),
    )


def _differs(what: str) -> Column:
    """Planned and actual are not the same; metadata that is not known is a difference."""
    return ~F.col(f"p_{what}").eqNullSafe(F.col(f"a_{what}"))


def _one_family(left: str, right: str) -> bool:
    return any(left in family and right in family for family in (STRING_FAMILY, BINARY_FAMILY))


def _interchangeable(left: Column, right: Column) -> Column:
    return (left.isin(*STRING_FAMILY) & right.isin(*STRING_FAMILY)) | (
        left.isin(*BINARY_FAMILY) & right.isin(*BINARY_FAMILY)
    )
