"""Loads into tables: append, all-or-nothing publish, JDBC, and counting the target."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from quayload.operators import conform, drift, quality, reconcile
from quayload.policy import LoadPlan
from quayload.session import ensure_checkpoint_dir

MANIFEST_SCHEMA = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("attempt_no", T.LongType()),
    T.StructField("rows_written", T.LongType()),
])


class PlanMismatch(ValueError):
    """What is to be loaded, or its target, is not what the plan says."""


def require_plan(df: DataFrame, plan: LoadPlan, keep: list[str] | None = None) -> None:
    """Refuse a DataFrame that differs from the plan, before a row is read.

    Columns of ``keep`` that are not planned travel beside the plan; any other column
    must be planned, in the plan's order, with its name and type. Nullability is left
    to the values.
    """
    planned = {c.name for c in plan.columns}
    fields = [f for f in df.schema.fields if f.name in planned or f.name not in (keep or [])]
    issues = drift.plan_mismatches(T.StructType(fields), plan, check_nullability=False)
    if issues:
        raise PlanMismatch("; ".join(f"{i.name or i.index}: {i.message}" for i in issues))


def require_target(rows: DataFrame, target: str) -> None:
    """Refuse an append whose columns are not those of the target, if there is one."""
    found = _schema_of(rows.sparkSession, target)
    if found is None:
        return
    have = [(f.name, f.dataType.simpleString()) for f in found.fields]
    want = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    if have != want:
        raise PlanMismatch(f"the target has columns {have}, the load {want}")


def _schema_of(spark: SparkSession, target: str) -> T.StructType | None:
    try:
        return spark.read.parquet(target).schema
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def guarded(df: DataFrame, plan: LoadPlan, keep: list[str] | None = None) -> DataFrame:
    """Conformed rows ready for a sink; a violation raises in its task while rows are written."""
    require_plan(df, plan, keep)
    conformed = conform.conform_table(df, plan, keep)
    problem = F.element_at("errors", 1)
    refused = F.raise_error(F.concat(problem["code"], F.lit(" in column "), problem["field_name"]))
    # The check sits in a written column: as a filter it would be pushed down and
    # conform every row twice.
    first = plan.columns[0].column_name
    guard = F.when(F.col("error_count") > 0, refused).otherwise(F.col(f"`{first}`"))
    return conform.loadable(conformed.withColumn(first, guard).drop("error_count", "errors"), plan)


def table_load(df: DataFrame, plan: LoadPlan, target: str, keep: list[str] | None = None) -> None:
    """Conform and append to a file target; a violation fails the whole load.

    The check rides along in the write, so no second pass over the source is needed and
    nothing is committed. A schema that is not the plan's, or a target with other columns,
    is refused first.
    """
    rows = guarded(df, plan, keep)
    require_target(rows, target)
    rows.write.mode("append").parquet(target)


def staged_load(df: DataFrame, target: str, load_id: str, rows_due: int | None = None) -> int:
    """Write a load so that readers see all of it or nothing.

    ``rows_due`` is the number of rows the load must have, if the caller knows it: another
    number is an error before anything is visible.

    Rows go to a folder of this attempt below ``data``; only the attempt's own random
    name is in the path, the load's id is in the manifest. Rows are counted where they
    landed, against the count observed while writing, and only then one small manifest
    row makes them visible. A load that is repeated, or that dies half-way and runs
    again, replaces its earlier attempt for readers: attempts of a load are numbered,
    and two that took the same number at once are an error for the later one.
    """
    attempt = uuid.uuid4().hex
    staging = f"{target}/data/attempt={attempt}"
    spark = df.sparkSession
    number = _last_attempt(spark, target, load_id) + 1
    seen = Observation("staged_load")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(staging)
    expected = int(seen.get["rows"])
    found = spark.read.schema(df.schema).parquet(staging).count()
    reconcile.require_reconciled(expected, found, staging)
    if rows_due is not None:
        reconcile.require_reconciled(rows_due, found, staging)
    if _last_attempt(spark, target, load_id) >= number:
        raise RuntimeError(f"another attempt of load {load_id!r} was published meanwhile")
    row = spark.createDataFrame([(load_id, attempt, number, expected)], MANIFEST_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{target}/manifest")
    return expected


def _last_attempt(spark: SparkSession, target: str, load_id: str) -> int:
    if _schema_of(spark, f"{target}/manifest") is None:
        return 0
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/manifest")
    last = manifest.where(F.col("load_id").eqNullSafe(F.lit(load_id))).agg(F.max("attempt_no")).first()[0]
    return last or 0


@dataclass(frozen=True)
class BatchLoad:
    """What a load by batches wrote and refused."""

    rows_written: int
    batches_written: int
    batches_rejected: int


def batch_load(df: DataFrame, plan: LoadPlan, batch: str, target: str, load_id: str,
               keep: list[str] | None = None) -> BatchLoad:
    """Publish the rows of all batches without a violation.

    A bad row rejects its whole batch and no other one; rows without a batch id are one
    batch. Rows that landed are counted against the verdicts before they are published. The verdicts, one row per
    batch, are checkpointed, as rows and totals are both told from them; rows are
    conformed again for the write, which costs less than storing them twice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    require_plan(df, plan, [batch, *(keep or [])])
    conformed = conform.conform_table(df, plan, [batch, *(keep or [])])
    outcomes = quality.batch_outcomes(conformed, batch).checkpoint()
    accepted = F.col("bad_rows") == 0
    totals = outcomes.agg(
        F.coalesce(F.sum(F.when(accepted, F.col("row_count"))), F.lit(0)).alias("rows"),
        F.count_if(accepted).alias("batches"), F.count_if(~accepted).alias("rejected"),
    ).first()
    rejected = outcomes.where("bad_rows > 0").select(F.col(batch).alias("__bad"))
    good = conformed.join(rejected, F.col(batch).eqNullSafe(F.col("__bad")), "left_anti").drop("error_count", "errors")
    written = staged_load(conform.loadable(good, plan), target, load_id, totals["rows"])
    return BatchLoad(written, totals["batches"], totals["rejected"])


def read_published(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Rows of the latest published attempt of every load.

    The manifest decides by attempt, a partition column, so the join prunes folders. It grows with loads, not rows, and is left to the
    planner: no broadcast is forced.
    """
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/manifest")
    current = manifest.groupBy("load_id").agg(F.max_by("attempt", F.struct("attempt_no", "attempt")).alias("attempt"))
    full = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{target}/data").parquet(f"{target}/data")
    return rows.join(current, "attempt").drop("attempt")


@dataclass(frozen=True)
class JdbcTarget:
    """Where rows go over JDBC. ``connections`` bounds the load on the database."""

    url: str
    table: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    batch_rows: int = 8192
    connections: int = 32

    def options(self) -> dict[str, str]:
        values = {
            "url": self.url,
            "dbtable": self.table,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
            "isolationLevel": "READ_COMMITTED",
        }
        for key in ("driver", "user", "password"):
            if getattr(self, key):
                values[key] = getattr(self, key)
        return values


def jdbc_load(df: DataFrame, plan: LoadPlan, target: JdbcTarget, keep: list[str] | None = None) -> None:
    """Conform and append to an existing database table; times travel as exact text.

    A violation raises in its task instead of arriving as NULL. Appends of several
    connections are not one transaction, so ``target.table`` should be a staging table
    that is counted with :func:`target_count` and published by the database. Create it
    first with :func:`planning.create_table_sql`: the writer's own column types could
    not name the planned ones.
    """
    guarded(df, plan, keep).write.format("jdbc").mode("append").options(**target.options()).save()


def target_count(spark: SparkSession, target: JdbcTarget) -> int:
    """Rows of a database table, counted by the database."""
    query = f"(SELECT COUNT(*) AS row_count FROM {target.table}) AS counted"
    options = {**target.options(), "dbtable": query}
    return int(spark.read.format("jdbc").options(**options).load().first()["row_count"])


def target_columns(spark: SparkSession, target: JdbcTarget, schema: str, table: str) -> DataFrame:
    """Columns of a database table as catalog rows, to hold against a plan."""
    schema, table = schema.replace("'", "''"), table.replace("'", "''")
    query = (
        "(SELECT TABLE_NAME AS table_id, ORDINAL_POSITION - 1 AS ordinal, COLUMN_NAME AS name, DATA_TYPE AS type, "
        "CASE IS_NULLABLE WHEN 'YES' THEN 1 ELSE 0 END AS nullable_flag, NUMERIC_PRECISION AS precision, "
        "NUMERIC_SCALE AS scale FROM INFORMATION_SCHEMA.COLUMNS "
        f"WHERE TABLE_SCHEMA = '{schema}' AND TABLE_NAME = '{table}') AS target_columns"
    )
    found = spark.read.format("jdbc").options(**{**target.options(), "dbtable": query}).load()
    return found.select(
        "table_id", F.col("ordinal").cast("bigint").alias("ordinal"), "name", "type",
        (F.col("nullable_flag") == 1).alias("nullable"), F.col("precision").cast("int").alias("precision"),
        F.col("scale").cast("int").alias("scale"), F.col("ordinal").cast("bigint").alias("claimed_ordinal"),
    )


def file_target_count(spark: SparkSession, target: str) -> DataFrame:
    """Rows of a file target; a count reads no column data."""
    return spark.read.parquet(target).agg(F.count(F.lit(1)).alias("row_count"))
