"""Loads from a stream by batches: a bad row rejects its whole batch.

A batch is named by a column and may run over several micro-batches. Rows are conformed and
landed once, with their violations. What is known of each open batch is keyed state: rows, bad
rows and violations so far, versioned by micro-batch (:mod:`quayload.streaming.versions`). A
batch ends when ``hold`` micro-batches have brought none of its rows, or when the load is
finished; then it is accepted or rejected as a whole, and only rows of accepted batches are
visible. Rows that come after their batch has ended are set aside.

Running statistics are written with the verdicts: rows and batches accepted so far after each
accepted batch, in the order of the verdicts and of the batch ids in one micro-batch. They go
on from the last version after a restart. Rows without a batch id are one batch, the first
of its micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quayload.operators import conform, quality
from quayload.policy import LoadPlan
from quayload.sources.sinks import require_plan
from quayload.streaming.versions import Versions, require_own_target

_COUNTS = ("row_count", "bad_rows", "violations")
_TOTALS = T.StructType([T.StructField(c, T.LongType()) for c in ("rows_written", "batches_written", "batches_rejected")])


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                bytes_per_batch: str | None = None) -> DataFrame:
    """A stream of Parquet files; a micro-batch takes no more than the given files or bytes."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


@dataclass(frozen=True)
class LoadStats:
    """What a load has written and refused."""

    rows_written: int
    batches_written: int
    batches_rejected: int


class BatchTarget:
    """The tables below the folder of one load, whose stream has ``schema``."""

    def __init__(self, spark: SparkSession, schema: T.StructType, plan: LoadPlan, batch: str, target: str, keep: list[str] | None = None):
        batch_type = schema[batch].dataType
        if not isinstance(batch_type, T.IntegralType):
            raise TypeError("batches are told apart and ordered by an integer")
        self.spark, self.plan, self.batch = spark, plan, batch
        self.keep = [c for c in keep or [] if c != batch]
        landed = conform.conform_table(spark.createDataFrame([], schema), plan, [batch, *self.keep]).schema
        key, counts = T.StructField(batch, batch_type), [T.StructField(c, T.LongType()) for c in _COUNTS]
        seen = [T.StructField(c, T.LongType()) for c in ("first_seen", "last_seen")]
        self.landed = Versions(spark, target, "landed", landed)
        self.outcomes = Versions(spark, target, "outcomes", T.StructType([key, *counts, *seen, T.StructField("ended", T.BooleanType())]))
        running = [T.StructField(c, T.LongType()) for c in ("row_count", "rows_written", "batches_written")]
        self.stats = Versions(spark, target, "stats", T.StructType([key, *running]))
        self.totals = Versions(spark, target, "totals", _TOTALS)

    # ---- one micro-batch ------------------------------------------------------------------------

    def step(self, micro: DataFrame, version: int, hold: int) -> None:
        """Land, judge and count one micro-batch; the source is read once."""
        require_own_target(self.landed, version)
        rows = self.landed.write(conform.conform_table(micro, self.plan, [self.batch, *self.keep]), version)
        over = self.outcomes.all(before=version).where("ended").select(F.col(self.batch).alias("__over"))
        here = quality.batch_outcomes(rows, self.batch).join(over, F.col(self.batch).eqNullSafe(F.col("__over")), "left_anti")
        now = F.lit(version).cast("bigint")
        so_far = self.outcomes.at(version - 1).where("not ended").drop("ended").unionByName(
            here.select(self.batch, *_COUNTS, now.alias("first_seen"), now.alias("last_seen")))
        merged = so_far.groupBy(self.batch).agg(
            *(F.sum(c).alias(c) for c in _COUNTS), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        judged = self.outcomes.write(merged.withColumn("ended", F.col("last_seen") <= version - hold), version)
        ended, before = judged.where("ended"), self._totals(version - 1)
        self.stats.write(self._running(ended, before), version)
        self.totals.write(self._added(ended, before), version)

    def _totals(self, version: int) -> LoadStats:
        row = self.totals.at(version).first()
        return LoadStats(0, 0, 0) if row is None else LoadStats(*row)

    def _running(self, ended: DataFrame, before: LoadStats) -> DataFrame:
        accepted = ended.where("bad_rows = 0").select(self.batch, "row_count", F.lit(1).cast("bigint").alias("batch_count"))
        return quality.running_totals(accepted, self.batch, ["row_count", "batch_count"]).select(
            self.batch, "row_count",
            (F.col("row_count_so_far") + before.rows_written).alias("rows_written"),
            (F.col("batch_count_so_far") + before.batches_written).alias("batches_written"),
        )

    def _added(self, ended: DataFrame, before: LoadStats) -> DataFrame:
        good = F.col("bad_rows") == 0
        return ended.agg(
            (F.coalesce(F.sum(F.when(good, F.col("row_count"))), F.lit(0)) + before.rows_written).alias("rows_written"),
            (F.count_if(good) + before.batches_written).alias("batches_written"),
            (F.count_if(~good) + before.batches_rejected).alias("batches_rejected"),
        )

    # ---- what a reader sees ---------------------------------------------------------------------

    def verdicts(self, finished: bool = True) -> DataFrame:
        """Batch, counts, ``accepted`` and ``ended_at``; ``finished`` ends what is still open, as nothing more will come."""
        last = self.outcomes.last()
        known = self.outcomes.all().where(F.col("ended") | F.lit(finished) & (F.col("version") == last))
        return known.select(self.batch, *_COUNTS, (F.col("bad_rows") == 0).alias("accepted"), F.col("version").alias("ended_at"))

    def _landed_with_verdict(self, finished: bool) -> DataFrame:
        verdicts = self.verdicts(finished).select(F.col(self.batch).alias("__judged"), "accepted", "ended_at")
        return self.landed.all().join(verdicts, F.col(self.batch).eqNullSafe(F.col("__judged"))).drop("__judged")

    def accepted_rows(self, finished: bool = True) -> DataFrame:
        """The visible rows, conformed."""
        rows = self._landed_with_verdict(finished).where("accepted and version <= ended_at")
        return rows.drop("accepted", "ended_at", "version", "error_count", "errors")

    def late_rows(self) -> DataFrame:
        """Rows that came after their batch had ended; good or bad, they are not loaded."""
        return self._landed_with_verdict(False).where("version > ended_at").drop("accepted", "ended_at")

    def diagnostics(self) -> DataFrame:
        """One row for each violation that landed."""
        return quality.diagnostics(self.landed.all(), [self.batch, *self.keep, "version"])

    def running_stats(self, finished: bool = True) -> DataFrame:
        """Batch, its rows, and rows and batches accepted so far."""
        written = self.stats.all().drop("version")
        last = self.outcomes.last()
        if not finished or last < 0:
            return written
        return written.unionByName(self._running(self.outcomes.at(last).where("not ended"), self._totals(last)))

    def load_stats(self, finished: bool = True) -> LoadStats:
        last = self.totals.last()
        totals = self._totals(last)
        if not finished or last < 0:
            return totals
        return LoadStats(*self._added(self.outcomes.at(last).where("not ended"), totals).first())


def stream_batches(stream: DataFrame, plan: LoadPlan, batch: str, target: str, checkpoint: str, keep: list[str] | None = None,
                   hold: int = 1, available_now: bool = True, interval: str = "10 seconds"):
    """Load a stream by batches; returns the running query.

    ``hold`` micro-batches without a row of it end a batch; 0 ends every batch with its
    micro-batch. How much a micro-batch takes is bounded by its source (:func:`file_stream`).
    """
    if hold < 0:
        raise ValueError("a batch cannot end before its rows")
    keep = keep or []
    require_plan(stream, plan, [batch, *keep])

    def load(micro: DataFrame, version: int) -> None:
        BatchTarget(micro.sparkSession, stream.schema, plan, batch, target, keep).step(micro, version, hold)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()

