"""Stored datasets: read, write once for every later reader, and summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_dataset(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet dataset; with ``columns`` only those are read from the files."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_dataset(df: DataFrame, path: str, batch_rows: int, partition_by: list[str] | None = None) -> None:
    """Write once, at most ``batch_rows`` rows per file."""
    if batch_rows < 1:
        raise ValueError("a batch holds at least one row")
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", batch_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def dataset_summary(df: DataFrame, batch: str, batches: DataFrame | None = None) -> DataFrame:
    """Rows and batches; ``batches`` names every batch of the dataset, also those without rows.

    Counted per batch first: the distinct count then works on one row per batch. Rows
    without a batch id are a batch.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    seen = df.select(batch, one.alias("__row"))
    if batches is not None:
        seen = seen.unionByName(batches.select(batch, none.alias("__row")))
    per_batch = seen.groupBy(batch).agg(F.sum("__row").alias("rows_in_batch"))
    return per_batch.agg(
        F.coalesce(F.sum("rows_in_batch"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("batch_count"),
        F.max("rows_in_batch").alias("largest_batch"),
    )
