"""First and last snapshot of every key of a stream of metrics, and their difference.

The state has one row for each key: the time of its latest sample, its first snapshot and its
last one. A micro-batch is folded to such rows by one aggregate and merged with the open keys of
the version before (:mod:`quayload.streaming.versions`). A key times out when the stream's
clock, the latest sample of the micro-batches before, has gone ``idle`` past its own latest
sample; it then leaves the state and its row stays in the version that closed it. A later sample
opens it again, from that row: however late a row comes, the deltas of the stream are those of
one table with the same rows, and only keys that may still change are merged each time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quayload.functions.exact import saturated_difference
from quayload.streaming.versions import Versions, require_own_target


@dataclass(frozen=True)
class SnapshotRule:
    """What a delta is made of.

    ``order`` are the columns that put the snapshots of a key in order, all of them times or
    numbers. The last snapshot is the latest one. The first is the latest one where ``initial``
    holds, and counts from 0 where there is none; without ``initial`` it is the earliest one.
    """

    keys: tuple[str, ...]
    counters: tuple[str, ...]
    order: tuple[str, ...]
    time: str
    initial: str | None = None
    attributes: tuple[str, ...] = field(default=())

    def fold(self, samples: DataFrame) -> DataFrame:
        """One row for each key of ``samples``."""
        order = F.struct(*self.order)
        kept = F.struct(*self.attributes, *self.counters)
        first = F.struct(*self.counters)
        if self.initial:
            chosen = F.when(F.col(self.initial), order)
            edge = (F.max_by(first, chosen).alias("first"), F.max(chosen).alias("first_order"))
        else:
            edge = (F.min_by(first, order).alias("first"), F.min(order).alias("first_order"))
        return samples.groupBy(*self.keys).agg(
            F.max(self.time).alias("latest"), F.max_by(kept, order).alias("last"), F.max(order).alias("last_order"), *edge
        )

    def merge(self, rows: DataFrame) -> DataFrame:
        """One row for each key from rows of :meth:`fold`."""
        pick, bound = (F.max_by, F.max) if self.initial else (F.min_by, F.min)
        return rows.groupBy(*self.keys).agg(
            F.max("latest").alias("latest"), F.max_by("last", "last_order").alias("last"), F.max("last_order").alias("last_order"),
            pick("first", "first_order").alias("first"), bound("first_order").alias("first_order"),
        )

    def deltas(self, rows: DataFrame) -> DataFrame:
        """Keys, attributes of the last snapshot, and last minus first counters."""
        return rows.select(
            *self.keys,
            *(F.col(f"last.{c}").alias(c) for c in self.attributes),
            *(saturated_difference(F.col(f"last.{c}"), F.coalesce(F.col(f"first.{c}"), F.lit(0))).alias(c) for c in self.counters),
        )


class SnapshotState:
    """The state below the folder of one stream."""

    def __init__(self, spark: SparkSession, schema: T.StructType, rule: SnapshotRule, target: str):
        folded = rule.fold(spark.createDataFrame([], schema)).schema
        self.rule, self.columns = rule, folded.names
        self.keys = Versions(spark, target, "keys", T.StructType([*folded.fields, T.StructField("open", T.BooleanType())]))
        self.folded = Versions(spark, target, "folded", folded)
        self.clock = Versions(spark, target, "clock", T.StructType([T.StructField("latest", schema[rule.time].dataType)]))

    def _same_key(self) -> Column:
        out = F.lit(True)
        for key in self.rule.keys:
            out = out & F.col(key).eqNullSafe(F.col(f"__{key}"))
        return out

    def step(self, micro: DataFrame, version: int, idle: str) -> None:
        """Merge one micro-batch; the source is read once."""
        require_own_target(self.keys, version)
        now = self._now(version - 1)
        fresh = self.folded.write(self.rule.fold(micro), version)
        before = self.keys.at(version - 1).where("open")
        wanted = fresh.select(*(F.col(k).alias(f"__{k}") for k in self.rule.keys))
        closed = self._newest(self.keys.all(before=version).where("not open").join(wanted, self._same_key(), "left_semi"))
        merged = self.rule.merge(fresh.unionByName(before.select(*self.columns)).unionByName(closed.select(*self.columns)))
        # Before the clock runs, every key may still change.
        stays = F.coalesce(F.col("latest") >= now - F.expr(f"INTERVAL {idle}"), now.isNull())
        state = self.keys.write(merged.withColumn("open", stays), version)
        self.clock.write(state.agg(F.greatest(F.max("latest"), now).alias("latest")), version)

    def _now(self, version: int) -> Column:
        """The clock of a version as a constant, NULL before the first."""
        kind = self.clock.schema["latest"].dataType
        row = self.clock.at(version).select(F.col("latest").cast("string")).first()
        return F.lit(None if row is None else row[0]).cast(kind)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Of the versions of a key the last; older ones are parts of it."""
        values = F.struct(*(c for c in self.columns if c not in self.rule.keys))
        return rows.groupBy(*self.rule.keys).agg(F.max_by(values, "version").alias("v")).select(*self.rule.keys, "v.*")

    def rows(self, open_only: bool = False) -> DataFrame:
        """The current row of every key, of closed and open ones."""
        last = self.keys.last()
        if open_only:
            return self.keys.at(last).where("open").select(*self.columns)
        return self._newest(self.keys.all().where(F.expr("not open") | (F.col("version") == last)))

    def deltas(self) -> DataFrame:
        return self.rule.deltas(self.rows())


def stream_deltas(samples: DataFrame, rule: SnapshotRule, target: str, checkpoint: str, idle: str = "1 HOUR",
                  available_now: bool = True, interval: str = "10 seconds"):
    """Keep the snapshots of a stream; returns the running query. Read with :class:`SnapshotState`."""

    def merge(micro: DataFrame, version: int) -> None:
        SnapshotState(micro.sparkSession, samples.schema, rule, target).step(micro, version, idle)

    writer = samples.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
