"""Interval sampling of a stream of metrics, as tumbling windows in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def window_samples(samples: DataFrame, time: str, keys: list[str], value: str,
                   interval: str = "250 milliseconds", lateness: str = "10 seconds") -> DataFrame:
    """Count, sum and maximum of ``value`` per window and key.

    ``time`` must be a timestamp with zone: event time is a point on one line.
    The watermark bounds the state to the windows that can still change.
    """
    return (
        samples.withWatermark(time, lateness)
        .groupBy(F.window(time, interval).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.sum(value).alias("value_sum"),
            F.max(value).alias("value_max"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                *keys, "samples", "value_sum", "value_max")
    )


def sampled_to(samples: DataFrame, path: str, checkpoint: str):
    """Append closed windows to files; what a run leaves open stays in its state."""
    return (
        samples.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
