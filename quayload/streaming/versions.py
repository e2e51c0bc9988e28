"""State of a stream as tables in the shared folder, one version for each micro-batch.

Version v is made from version v - 1 and the rows of micro-batch v, and written by overwrite:
a micro-batch that is run again after a failure makes the same version again, and a stream that
is started anew goes on from the last one. Any number of executors may be lost meanwhile.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


class Versions:
    """One table of the state; ``schema`` holds for every version of it."""

    def __init__(self, spark: SparkSession, target: str, name: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, f"{target}/{name}", schema

    def write(self, df: DataFrame, version: int) -> DataFrame:
        """``df`` as this version, read back."""
        columns = [F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields]
        df.select(*columns).write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return self.at(version)

    def at(self, version: int) -> DataFrame:
        """One version; there is nothing before the first."""
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={version}")

    def all(self, before: int | None = None) -> DataFrame:
        """All versions, or those before one, with column ``version``; a filter on it leaves out folders."""
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        try:
            df = self.spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return df if before is None else df.where(F.col("version") < before)

    def last(self) -> int:
        """The newest version, -1 if there is none."""
        newest = self.all().agg(F.max("version")).first()[0]
        return -1 if newest is None else newest


def require_own_target(table: Versions, version: int) -> None:
    """Refuse the first micro-batch of a stream whose target holds later versions of another one."""
    if version == 0 and table.last() > 0:
        raise ValueError(f"{table.path} holds versions of another stream: use its checkpoint, or another target")
