"""A frame that is not the planned one is told as violations, before any value is converted."""

import pytest
from pyspark.sql import functions as F, types as T

from quayload import policy as P
from quayload.operators import conform, quality
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType

PLAN = LoadPlan((
    PlannedColumn(0, "id", False, SourceType("int32"), TargetType("int")),
    PlannedColumn(1, "name", True, SourceType("utf8"), TargetType("nvarchar", length=3)),
))


def codes(df):
    return [[(e["code"], e["field_index"], e["field_name"]) for e in r["errors"]] for r in df.collect()]


def test_another_type_is_not_cast(spark):
    """A double under an int32 plan is not cut to an integer, and its long name is not judged."""
    df = spark.createDataFrame([(1.9, "much too long"), (2.0, None)], "id double, name string")
    got = conform.conform_table(df, PLAN)
    assert codes(got) == [[("SchemaMismatch", 0, "id")]] * 2
    assert [r["id"] for r in got.collect()] == [None, None] and got.where("error_count = 1").count() == 2
    assert {r["phase"] for r in quality.failure_phases(quality.diagnostics(got.withColumn("b", F.lit(1)), ["b"]), "b").collect()} == {"batch_schema_validation"}


def test_missing_and_doubled_columns(spark):
    missing = spark.createDataFrame([("ab",)], "name string")
    assert codes(conform.conform_table(missing, PLAN)) == [[("SchemaMismatch", 0, "id")]]
    everything = spark.createDataFrame([(1,)], "z int")
    assert codes(conform.conform_table(everything, PLAN)) == [[("SchemaMismatch", 0, "id"), ("SchemaMismatch", 1, "name")]]
    doubled = spark.createDataFrame([(1, 2, "a")], "id int, k int, name string").withColumnRenamed("k", "id")
    assert codes(conform.conform_table(doubled, PLAN)) == [[("SchemaMismatch", 0, "id")]]


def test_kept_columns_and_further_ones(spark):
    df = spark.createDataFrame([("x", "ab", 5)], "id string, name string, batch int")
    got = conform.conform_table(df, PLAN, ["batch", "id"])
    assert got.columns == ["batch", "id", "name", "error_count", "errors"] and got.first()["id"] == "x"
    assert codes(got) == [[("SchemaMismatch", 0, "id")]]
    good = spark.createDataFrame([(1, "ab", 5)], "id int, name string, other int")
    assert conform.conform_table(good, PLAN).first()["error_count"] == 0


def test_values_are_judged_where_the_schema_fits(spark):
    good = spark.createDataFrame([(1, "abcd"), (None, "a")], "id int, name string")
    got = conform.conform_table(good, PLAN)
    assert codes(got) == [[("ValueTooLong", 1, "name")], [("NullInNonNullableColumn", 0, "id")]]


CASES = [
    ("int8", None, "tinyint", True), ("int8", None, "smallint", False), ("int32", None, "bigint", False), ("int64", None, "bigint", True),
    ("uint8", None, "smallint", True), ("uint8", None, "bigint", True), ("uint16", None, "smallint", False), ("uint16", None, "int", True),
    ("uint64", None, "decimal(20,0)", True), ("uint64", None, "decimal(20,2)", False), ("uint64", None, "string", False),
    ("float64", None, "float", False), ("float32", None, "float", True), ("utf8", None, "string", True), ("utf8", None, "binary", False),
    ("date64", None, "bigint", True), ("date64", None, "date", False), ("date32", None, "date", True), ("time", "ns", "bigint", True),
    ("timestamp", "us", "timestamp_ntz", True), ("timestamp", "us", "timestamp", False), ("timestamp", "ns", "bigint", True),
    ("timestamp", "s", "timestamp_ntz", False), ("boolean", None, "boolean", True), ("boolean", None, "int", False),
]


@pytest.mark.parametrize(("kind", "unit", "spark_type", "fits"), CASES)
def test_carriers(kind, unit, spark_type, fits):
    field = T.StructType.fromDDL(f"v {spark_type}").fields[0]
    assert P.carries(field, SourceType(kind, unit=unit)) is fits


def test_decimals_and_declared_types():
    dec = lambda p, s: T.StructField("v", T.DecimalType(p, s))
    assert P.carries(dec(10, 2), SourceType("decimal", precision=10, scale=2)) and not P.carries(dec(10, 3), SourceType("decimal", precision=10, scale=2))
    assert P.carries(dec(10, 0), SourceType("decimal", precision=10, scale=-2))
    declared = T.StructField("v", T.LongType(), metadata={P.SOURCE_TYPE_KEY: "time(ns)"})
    assert P.carries(declared, SourceType("time", unit="ns")) and not P.carries(declared, SourceType("int64"))


def test_mismatched_batches_are_rejected(spark):
    df = spark.createDataFrame([(1, 1.5, "a"), (2, 2.5, "b")], "b int, id double, name string")
    got = conform.conform_table(df, PLAN, ["b"])
    assert quality.accepted_rows(got, "b").count() == 0 and quality.rejected_batches(got, "b").count() == 2
