"""Streams that keep state: batches accepted or rejected as a whole, and metric deltas."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quayload.operators import quality, telemetry
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType
from quayload.streaming.batches import BatchTarget, LoadStats, file_stream, stream_batches
from quayload.streaming.deltas import SnapshotRule, SnapshotState, stream_deltas

PLAN = LoadPlan((
    PlannedColumn(0, "id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "value", True, SourceType("float64"), TargetType("float", precision=53)),
))
SCHEMA = "b long, id long, value double"
NAN = float("nan")


class Load:
    """A source that grows, and a load that goes on after each part."""

    def __init__(self, spark, folder, hold=1):
        self.spark, self.hold = spark, hold
        self.source, self.target, self.progress = (f"{folder}/{n}" for n in ("source", "target", "progress"))
        self.schema = spark.createDataFrame([], SCHEMA).schema
        self.tables = BatchTarget(spark, self.schema, PLAN, "b", self.target)

    def part(self, *rows):
        self.spark.createDataFrame([(b, i, v) for b, i, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        stream_batches(file_stream(self.spark, self.source, self.schema), PLAN, "b", self.target, self.progress, hold=self.hold).awaitTermination()

    def accepted(self, finished=True):
        return sorted(r["id"] for r in self.tables.accepted_rows(finished).collect())

    def stats(self, finished=True):
        return sorted(tuple(r)[1:] for r in self.tables.running_stats(finished).collect())


def test_bad_row_rejects_its_batch_over_three_micro_batches(spark, tmp_path):
    load = Load(spark, tmp_path)
    load.part((1, 10, 0.5), (2, 20, 0.5))
    assert load.accepted(False) == [] and load.stats(False) == []
    load.part((2, 21, 0.5), (3, 30, None))
    assert load.accepted(False) == [10] and load.stats(False) == [(1, 1, 1)]
    load.part((2, 22, NAN), (4, 40, 1.0), (4, 41, 1.0))
    assert load.accepted(False) == [10, 30] and load.stats(False) == [(1, 1, 1), (1, 2, 2)]
    # Nothing of batch 2 arrives, though its first rows were good and came before.
    load.part((5, 50, 1.0))
    assert load.accepted(False) == [10, 30, 40, 41] and load.stats(False) == [(1, 1, 1), (1, 2, 2), (2, 4, 3)]
    assert load.accepted() == [10, 30, 40, 41, 50] and load.stats()[-1] == (2, 4, 3)
    assert load.tables.load_stats(False) == LoadStats(4, 3, 1) and load.tables.load_stats() == LoadStats(5, 4, 1)
    assert [(r["b"], r["code"], r["version"]) for r in load.tables.diagnostics().collect()] == [(2, "NonFiniteFloat", 2)]
    verdicts = {r["b"]: (r["row_count"], r["bad_rows"], r["accepted"], r["ended_at"]) for r in load.tables.verdicts().collect()}
    assert verdicts == {1: (1, 0, True, 1), 2: (3, 1, False, 3), 3: (1, 0, True, 2), 4: (2, 0, True, 3), 5: (1, 0, True, 3)}


def test_late_rows_are_set_aside(spark, tmp_path):
    load = Load(spark, tmp_path)
    load.part((1, 10, 0.5), (None, 1, 0.5))
    load.part((2, 20, 0.5))
    load.part((1, 11, 0.5), (1, 12, NAN), (None, 2, 0.5), (3, 30, 0.5))
    assert load.accepted() == [1, 10, 20, 30]
    assert sorted((r["id"], r["version"]) for r in load.tables.late_rows().collect()) == [(2, 2), (11, 2), (12, 2)]
    assert load.tables.load_stats() == LoadStats(4, 4, 0)


def test_batches_end_with_their_micro_batch(spark, tmp_path):
    load = Load(spark, tmp_path, hold=0)
    load.part((1, 10, 0.5), (2, 20, NAN), (None, 1, 0.5))
    load.part((3, 30, 0.5))
    assert load.accepted(False) == [1, 10, 30] and load.stats(False) == [(1, 1, 1), (1, 2, 2), (1, 3, 3)]
    assert load.tables.load_stats(False) == LoadStats(3, 3, 1)


def test_a_version_can_be_made_again(spark, tmp_path):
    """A micro-batch that is run once more, as after a failure, changes nothing."""
    load = Load(spark, tmp_path)
    parts = [[(1, 10, 0.5), (2, 20, 0.5)], [(2, 21, NAN)], [(3, 30, 0.5)]]
    for version, rows in enumerate(parts):
        micro = spark.createDataFrame(rows, SCHEMA)
        load.tables.step(micro, version, 1)
        once = (load.accepted(), load.stats(), load.tables.load_stats())
        load.tables.step(micro, version, 1)
        assert (load.accepted(), load.stats(), load.tables.load_stats()) == once
    assert load.accepted() == [10, 30] and load.tables.load_stats() == LoadStats(2, 2, 1)
    with pytest.raises(ValueError, match="another stream"):
        load.tables.step(spark.createDataFrame(parts[0], SCHEMA), 0, 1)


def test_rate_limit_and_random_streams_equal_a_table(spark, tmp_path):
    """Files in any order, one a micro-batch: with batches held open the verdicts are those of the whole table."""
    r = random.Random(2)
    rows = [(r.choice([None, *range(40)]), i, NAN if r.random() < 0.01 else i / 2) for i in range(2000)]
    source = f"{tmp_path}/source"
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(5).write.parquet(source)
    stream = file_stream(spark, source, df.schema, files_per_batch=1)
    query = stream_batches(stream, PLAN, "b", f"{tmp_path}/target", f"{tmp_path}/progress", hold=100)
    query.awaitTermination()
    tables = BatchTarget(spark, df.schema, PLAN, "b", f"{tmp_path}/target")
    assert tables.landed.last() == 4
    bad = {b for b, _, v in rows if v != v}
    good = sorted(i for b, i, _ in rows if b not in bad)
    assert sorted(x["id"] for x in tables.accepted_rows().collect()) == good
    assert tables.load_stats() == LoadStats(len(good), 41 - len(bad), len(bad))
    running = [tuple(x) for x in tables.running_stats().orderBy("batches_written").collect()]
    assert [x[3] for x in running] == list(range(1, len(running) + 1)) and running[-1][2] == len(good)


def test_an_empty_stream_and_wrong_batches(spark, tmp_path):
    load = Load(spark, tmp_path)
    assert load.accepted() == [] and load.stats() == [] and load.tables.load_stats() == LoadStats(0, 0, 0)
    text = spark.createDataFrame([], "b string, id long, value double").schema
    with pytest.raises(TypeError):
        BatchTarget(spark, text, PLAN, "b", str(tmp_path))
    with pytest.raises(ValueError):
        stream_batches(None, PLAN, "b", "t", "p", hold=-1)


# ---- running totals -----------------------------------------------------------------------------


@pytest.mark.parametrize("block", [2, 64, 1 << 16])
def test_running_totals_of_sparse_ids(spark, block):
    r = random.Random(1)
    ids = [None, 0, -1, 1, 2**63 - 1, -(2**63), 10**9, -(10**9), *(r.randrange(-(2**40), 2**40) for _ in range(60))]
    if block == 2:
        ids = [None, *range(-9, 9), 100]
    rows = [(i, r.randrange(100)) for i in ids]
    got = {x["k"]: x["n_so_far"] for x in quality.running_totals(spark.createDataFrame(rows, "k long, n long"), "k", ["n"], block).collect()}
    total, want = 0, {}
    for k, n in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        total += n
        want[k] = total
    assert got == want


def test_running_totals_read_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("n")).mapInArrow(count, "k long, n int")
    assert quality.running_totals(df, "k", ["n"], 16).count() == 500
    assert seen.value == 500
    assert quality.running_totals(df.limit(0), "k", ["n"]).count() == 0
    nothing = spark.createDataFrame([(None, 5)], "k long, n long")
    assert [tuple(x) for x in quality.running_totals(nothing, "k", ["n"]).collect()] == [(None, 5, 5)]


def test_null_keys_meet_themselves(spark):
    from quayload.operators import reconcile

    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 3.0)], "k long, v double")
    assert [tuple(r) for r in reconcile.count_reconcile(rows, rows, "k").where("not matches").collect()] == []
    one = rows.where("v <> 2")
    assert reconcile.writer_parity(one, one, ["k"]).count() == 0
    changed = one.withColumn("v", F.when(F.col("k").isNull(), F.lit(9.0)).otherwise(F.col("v")))
    assert [tuple(r) for r in reconcile.writer_parity(one, changed, ["k"]).collect()] == [(None, "differs", "v")]
    first = spark.createDataFrame([(None, "a", 5, 1, 1)], "load_id long, wait_type string, waiting_tasks_count long, wait_time_ms long, signal_wait_time_ms long")
    last = spark.createDataFrame([(None, "a", 7, 4, 2)], first.schema)
    assert [tuple(r) for r in telemetry.wait_deltas(first, last, ["load_id"]).collect()] == [(None, "a", 2, 3, 1)]


def test_null_batch_with_a_bad_row_is_rejected(spark, tmp_path):
    from quayload.operators import conform
    from quayload.sources import sinks

    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (None, 3, NAN), (None, 4, 3.0), (2, 5, 1.0)], SCHEMA)
    conformed = conform.conform_table(df, PLAN, ["b"])
    assert sorted(r["id"] for r in quality.accepted_rows(conformed, "b").collect()) == [1, 2, 5]
    done = sinks.batch_load(df, PLAN, "b", f"{tmp_path}/t", "one")
    assert (done.rows_written, done.batches_written, done.batches_rejected) == (3, 2, 1)
    assert sorted(r["id"] for r in sinks.read_published(spark, f"{tmp_path}/t", df.schema).collect()) == [1, 2, 5]


def test_nothing_is_visible_after_a_failed_count(spark, tmp_path):
    from quayload.sources import sinks

    df = spark.range(5).select("id")
    sinks.staged_load(df, f"{tmp_path}/t", "a", rows_due=5)
    with pytest.raises(RuntimeError):
        sinks.staged_load(df, f"{tmp_path}/t", "b", rows_due=4)
    assert {r["load_id"] for r in sinks.read_published(spark, f"{tmp_path}/t", df.schema).collect()} == {"a"}


# ---- deltas -------------------------------------------------------------------------------------

SAMPLES = "k string, at timestamp_ntz, n long, initial boolean, c long, name string"


def samples(seed, count=300):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [
        (r.choice(["a", "b", "c", None, "d"]), start + dt.timedelta(minutes=r.randrange(10_000)), i, r.random() < 0.3,
         r.choice([r.randrange(1000), 2**62, -(2**62)]), f"name{i}")
        for i in range(count)
    ]


@pytest.mark.parametrize("initial", ["initial", None])
@pytest.mark.parametrize("idle", ["5 MINUTES", "1 DAY"])
def test_deltas_of_a_stream_are_those_of_the_table(spark, tmp_path, initial, idle):
    """Late rows included, whatever times out meanwhile."""
    rule = SnapshotRule(("k",), ("c",), ("at", "n"), "at", initial, ("name",))
    rows = samples(4)
    df = spark.createDataFrame(rows, SAMPLES)
    state = SnapshotState(spark, df.schema, rule, f"{tmp_path}/target")
    order = sorted(rows, key=lambda r: r[1])
    late, by_time = [r for r in order if r[2] % 7 == 0], [r for r in order if r[2] % 7]
    parts = [by_time[:80], by_time[80:160], by_time[160:], late, [], [(k, None, -1, True, 5, "no time") for k in ("a", "e")]]
    so_far, closed = [], 0
    for version, part in enumerate(parts):
        micro = spark.createDataFrame(part, SAMPLES)
        state.step(micro, version, idle)
        if version == 1:
            state.step(micro, version, idle)
        so_far += part
        table = spark.createDataFrame(so_far, SAMPLES)
        want = sorted(map(str, rule.deltas(rule.fold(table)).collect()))
        assert sorted(map(str, state.deltas().collect())) == want
        closed += state.keys.at(version).where("not open").count()
    assert closed > 0 if idle == "5 MINUTES" else True
    assert state.rows(open_only=True).count() <= 6


def test_stream_deltas_restart(spark, tmp_path):
    rule = SnapshotRule(("k",), ("c",), ("at", "n"), "at", "initial", ("name",))
    rows = samples(8, 90)
    schema = spark.createDataFrame([], SAMPLES).schema
    for part in (rows[:30], rows[30:60], rows[60:]):
        spark.createDataFrame(part, SAMPLES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
        stream_deltas(file_stream(spark, f"{tmp_path}/source", schema), rule, f"{tmp_path}/target", f"{tmp_path}/progress", "10 MINUTES").awaitTermination()
    state = SnapshotState(spark, schema, rule, f"{tmp_path}/target")
    assert state.keys.last() == 2
    want = telemetry.snapshot_deltas(
        spark.createDataFrame(rows, SAMPLES).withColumn("taken", F.struct("at", "n")), ["k"], ["c"], "taken", "initial", ["name"])
    assert sorted(map(str, state.deltas().collect())) == sorted(map(str, want.collect()))
