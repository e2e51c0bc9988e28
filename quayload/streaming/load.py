"""Loads from a stream: every micro-batch is conformed, checked and appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayload.operators import conform
from quayload.policy import LoadPlan
from quayload.sources.sinks import require_plan


def stream_load(stream: DataFrame, plan: LoadPlan, target: str, checkpoint: str,
                keep: list[str] | None = None, available_now: bool = True, interval: str = "10 seconds"):
    """Good rows to ``target/rows``, diagnostics to ``target/diagnostics``.

    Both are partitioned by micro-batch and written with partition overwrite, so
    a micro-batch that is run again after a failure replaces what it had written.
    :mod:`quayload.streaming.batches` rejects whole batches instead.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch has fixed offsets, so each sink can read it for itself.
        conformed = conform.conform_table(batch, plan, keep).withColumn("micro_batch", F.lit(batch_id))
        good = conformed.where("error_count = 0").drop("error_count", "errors")
        _replace(conform.loadable(good, plan), f"{target}/rows")
        _replace(
            conformed.where("error_count > 0").select("micro_batch", *(keep or []), F.inline("errors")),
            f"{target}/diagnostics",
        )

    require_plan(stream, plan, keep)
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def load_stats(rows: DataFrame) -> DataFrame:
    """Rows per micro-batch of a stream target."""
    return rows.groupBy("micro_batch").agg(F.count(F.lit(1)).alias("row_count"))


def _replace(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("micro_batch").parquet(path)
    )
