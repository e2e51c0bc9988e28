"""Session helpers shared by operators, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quayload")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites recorded for every column expression make building a plan slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers import functions by module name, and a driver may have the package on its
    own path only. The archive is made on the driver and handed out by Spark.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quayload-package-"), "quayload.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is made
    only in local mode; on a cluster a missing setting is an error, since files
    on one machine are lost with that machine.
    """
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("quayload.localRoot", None)
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="quayload-")
    spark.conf.set("quayload.localRoot", root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for results that are read several times."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Reliable checkpoints need a folder; one that is already set is kept."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(shared_root(spark), "checkpoints"))


def partitions_for(df: DataFrame, rows_per_partition: int = 1 << 22) -> int:
    """Partitions for a sort of ``df``: by its counted rows, and no fewer than keep the cores busy.

    A range partitioning is not split at run time, so its number has to fit the data
    when the plan is made. Rows are counted, which reads no column that need not be
    read; a guess of the planner may be off by any factor.
    """
    spark = df.sparkSession
    fewest = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(fewest, -(-df.count() // rows_per_partition))
