"""Planning rules, policies and the text of targets."""

import pytest
from pyspark.sql import functions as F, types as T

from quayload import policy as P
from quayload.operators import planning
from quayload.policy import PlanningError, PlanOptions, SOURCE_TYPE_KEY


def schema_of(kind, name="c", spark_type=None):
    return T.StructType([T.StructField(name, spark_type or T.LongType(), True, {SOURCE_TYPE_KEY: kind})])


@pytest.mark.parametrize("kind, options, target", [
    ("boolean", {}, "bit"), ("int8", {}, "smallint"), ("int16", {}, "smallint"), ("int32", {}, "int"), ("int64", {}, "bigint"),
    ("uint8", {}, "tinyint"), ("uint16", {}, "int"), ("uint32", {}, "bigint"), ("float16", {}, "real"), ("float32", {}, "real"),
    ("float64", {}, "float(53)"), ("utf8", {}, "nvarchar(max)"), ("utf8", {"string": 40}, "nvarchar(40)"),
    ("binary", {}, "varbinary(max)"), ("binary", {"binary": 16}, "varbinary(16)"), ("fixed_binary(16)", {}, "binary(16)"),
    ("uint64", {"uint64": "decimal"}, "decimal(20,0)"), ("uint64", {"uint64": "bigint"}, "bigint"),
    ("large_utf8", {}, "nvarchar(max)"), ("utf8_view", {"string": 7}, "nvarchar(7)"), ("large_binary", {}, "varbinary(max)"),
    ("binary_view", {"binary": 9}, "varbinary(9)"), ("decimal32(9,2)", {}, "decimal(9,2)"), ("decimal256(30,0)", {}, "decimal(30,0)"),
    ("decimal(9,2)", {}, "decimal(9,2)"), ("decimal(38,38)", {}, "decimal(38,38)"), ("wide_decimal(30,0)", {}, "decimal(30,0)"),
    ("decimal(3,-2)", {"decimal": "normalize"}, "decimal(5,0)"), ("date32", {}, "date"),
    ("date64", {"date64": "datetime2"}, "datetime2(3)"), ("time(s)", {}, "time(0)"), ("time(ms)", {}, "time(3)"),
    ("time(us)", {}, "time(6)"), ("time(ns)", {}, "time(7)"), ("timestamp(ms)", {}, "datetime2(7)"),
    ("timestamp(ms)", {"timestamp": 3}, "datetime2(3)"), ("timestamp(ns)", {"timestamp": "datetime"}, "datetime"),
    ("timestamp(us,UTC)", {"timezone": "offset"}, "datetimeoffset(7)"),
    ("timestamp(us,UTC)", {"timezone": "utc", "timestamp": 4}, "datetime2(4)"),
])
def test_targets(kind, options, target):
    plan = planning.plan_schema(schema_of(kind), PlanOptions(**options))
    assert plan.columns[0].target.sql == target


@pytest.mark.parametrize("kind, options, code", [
    ("uint64", {}, P.POLICY_REQUIRED), ("utf8", {"string": "observed"}, P.OBSERVATION_REQUIRED),
    ("binary", {"binary": "observed"}, P.OBSERVATION_REQUIRED), ("date64", {}, P.OBSERVATION_REQUIRED),
    ("fixed_binary(0)", {}, P.UNSUPPORTED_TYPE), ("fixed_binary(8001)", {}, P.UNSUPPORTED_TYPE),
    ("decimal(3,-2)", {}, P.POLICY_REQUIRED), ("decimal(37,-2)", {"decimal": "normalize"}, P.DECIMAL_RANGE),
    ("decimal(39,0)", {}, P.DECIMAL_RANGE), ("decimal(0,0)", {}, P.DECIMAL_RANGE), ("decimal(4,5)", {}, P.DECIMAL_RANGE),
    ("wide_decimal(30,0)", {"wide_decimal": "reject"}, P.POLICY_REQUIRED), ("timestamp(us,UTC)", {}, P.POLICY_REQUIRED),
    ("timestamp(us)", {"timestamp": 8}, P.POLICY_REQUIRED), ("duration", {}, P.UNSUPPORTED_TYPE), ("null", {}, P.UNSUPPORTED_TYPE),
])
def test_refusals(kind, options, code):
    with pytest.raises(PlanningError) as error:
        planning.plan_schema(schema_of(kind), PlanOptions(**options))
    assert [i.code for i in error.value.issues] == [code]


def test_all_bad_columns_are_reported_together():
    schema = T.StructType([
        T.StructField("list", T.ArrayType(T.IntegerType())), T.StructField("good", T.IntegerType()),
        T.StructField("", T.IntegerType()), T.StructField("x" * 129, T.IntegerType()),
        T.StructField("when", T.TimestampType()), T.StructField("gap", T.DayTimeIntervalType())])
    with pytest.raises(PlanningError) as error:
        planning.plan_schema(schema)
    assert [(i.index, i.code) for i in error.value.issues] == [
        (0, P.UNSUPPORTED_TYPE), (2, P.IDENTIFIER_INVALID), (3, P.IDENTIFIER_INVALID), (4, P.POLICY_REQUIRED), (5, P.UNSUPPORTED_TYPE)]


def test_plan_from_observed_values(spark):
    df = spark.createDataFrame(
        [("a😀", b"\x01\x02", b"\x01", 0), (None, b"\x03\x04", b"\x01\x02\x03", 86_400_000)],
        "text string, fixed binary, varying binary, day long")
    day = F.col("day").alias("day", metadata={SOURCE_TYPE_KEY: "date64"})
    df = df.select("text", "fixed", "varying", day)
    options = PlanOptions(string="observed", binary="observed")
    plan = planning.plan_table(df, options)
    assert [c.target.sql for c in plan.columns] == ["nvarchar(3)", "binary(2)", "varbinary(3)", "date"]
    report = planning.plan_report(df, options).orderBy("field_index").collect()
    assert [r["target_type"] for r in report] == [c.target.sql for c in plan.columns]
    off = df.select("text", "fixed", "varying", (F.col("day") + 1).alias("day", metadata={SOURCE_TYPE_KEY: "date64"}))
    with pytest.raises(PlanningError):
        planning.plan_table(off, options)
    assert planning.plan_report(off, options).where("field_name = 'day'").first()["code"] == P.LOSSY


def test_long_text_becomes_max(spark):
    df = spark.createDataFrame([("x" * 50,)], "t string")
    assert planning.plan_table(df, PlanOptions(string="observed", observed_limit=49)).columns[0].target.sql == "nvarchar(max)"


def test_create_table_text():
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("a]b", T.StringType())])
    text = planning.create_table_sql(planning.plan_schema(schema), "orders", "dbo")
    assert text == "CREATE TABLE [dbo].[orders] (\n    [id] bigint NOT NULL,\n    [a]]b] nvarchar(max) NULL\n);"


def test_bad_policy_is_refused():
    with pytest.raises(ValueError):
        PlanOptions(uint64="maybe")


def test_schema_against_plan():
    from quayload.operators.drift import plan_mismatches

    base = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    plan = planning.plan_schema(base)
    assert plan_mismatches(base, plan) == []
    view = T.StructType([base.fields[0], T.StructField("b", T.StringType(), True, {SOURCE_TYPE_KEY: "utf8_view"})])
    assert plan_mismatches(view, plan) == []
    nullable = T.StructType([T.StructField("a", T.LongType(), True), base.fields[1]])
    assert [i.index for i in plan_mismatches(nullable, plan)] == [0]
    assert plan_mismatches(nullable, plan, check_nullability=False) == []
    for fields in ([base.fields[0]], [base.fields[1], base.fields[0]], [T.StructField("a", T.IntegerType(), False), base.fields[1]]):
        issues = plan_mismatches(T.StructType(fields), plan)
        assert issues and all(i.code == P.SCHEMA_MISMATCH for i in issues)


def test_plan_as_catalog_has_no_drift_against_itself(spark):
    from quayload.operators import drift

    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("d", T.DecimalType(9, 2))])
    catalog = drift.plan_catalog(spark, planning.plan_schema(schema), "t")
    actual = catalog.withColumn("claimed_ordinal", F.col("ordinal"))
    assert drift.target_drift(catalog, actual).count() == 0 and drift.target_type_drift(catalog, actual).count() == 0
    widened = actual.withColumn("scale", F.lit(3))
    assert [r["difference"] for r in drift.target_type_drift(catalog, widened).collect()] == ["decimal_shape"]
