"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from quayload.session import shared_root

#: Words are maximal runs of characters outside these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Empty a staged table that nothing reads any more; its folder keeps an empty table.

    Written over by Spark itself, so any shared file system will do.
    """
    spark = staged.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in staged.inputFiles()}
    for folder in folders:
        spark.createDataFrame([], staged.schema).write.mode("overwrite").parquet(folder)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of jobs whose results are written."""
    import gc
    import time

    # Python tells the JVM of its dropped frames from a thread of its own, and what they held is
    # only found free in a later collection.
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def inputs(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that no further column of the input can clash.

    Names are matched as Spark does (case-insensitively by default); a name that
    occurs several times is an error of the caller.
    """
    return df.select(*(df[f"`{re.sub('`', '``', n)}`"] for n in names))
