"""Batching, sinks and streams: what becomes visible, and when."""

import os

import pytest
from pyspark.sql import functions as F

from quayload.operators import conform, quality, reconcile, sizing
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType
from quayload.sources import batching, datasets, shapes, sinks
from quayload.streaming.load import load_stats, stream_load

PLAN = LoadPlan((
    PlannedColumn(0, "id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "value", True, SourceType("float64"), TargetType("float", precision=53)),
))


def rows(spark, count, bad=()):
    value = F.when(F.col("id").isin(list(bad)), F.lit("NaN").cast("double")).otherwise(F.col("id") / 2) if bad else F.col("id") / 2
    return spark.range(count).select("id", value.alias("value"))


def test_load_with_a_bad_row_leaves_the_target_untouched(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.table_load(rows(spark, 10), PLAN, target)
    with pytest.raises(Exception, match="NonFiniteFloat in column value"):
        sinks.table_load(rows(spark, 100, bad=[77]), PLAN, target)
    assert spark.read.parquet(target).count() == 10


def test_staged_load_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "s")
    good = rows(spark, 50)
    sinks.staged_load(good, target, "a")
    broken = good.withColumn("value", F.when(F.col("id") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        sinks.staged_load(broken, target, "b")
    seen = sinks.read_published(spark, target, good.schema)
    assert {r["load_id"] for r in seen.collect()} == {"a"} and seen.count() == 50
    sinks.staged_load(rows(spark, 7), target, "b")
    sinks.staged_load(rows(spark, 3), target, "a")
    counts = {r["load_id"]: r["count"] for r in sinks.read_published(spark, target, good.schema).groupBy("load_id").count().collect()}
    assert counts == {"a": 3, "b": 7}


@pytest.mark.parametrize("ids", [["a/b", "a%41b", "__HIVE_DEFAULT_PARTITION__", " ", "", "x=1"]])
def test_any_load_id_is_read_back(spark, tmp_path, ids):
    target = str(tmp_path / "s")
    for n, load_id in enumerate(ids, 1):
        assert sinks.staged_load(rows(spark, n), target, load_id) == n
    seen = sinks.read_published(spark, target, rows(spark, 1).schema)
    counts = {r["load_id"]: r["count"] for r in seen.groupBy("load_id").count().collect()}
    assert counts == {load_id: n for n, load_id in enumerate(ids, 1)}


def test_an_empty_load_replaces_an_earlier_one(spark, tmp_path):
    target = str(tmp_path / "s")
    sinks.staged_load(rows(spark, 5), target, "a")
    assert sinks.staged_load(rows(spark, 0), target, "a") == 0
    assert sinks.read_published(spark, target, rows(spark, 1).schema).count() == 0


def test_loads_refuse_what_is_not_planned(spark, tmp_path):
    """A double under an integer plan, text, an unplanned column, another order: nothing is written."""
    target = str(tmp_path / "t")
    sinks.table_load(rows(spark, 3), PLAN, target)
    good = rows(spark, 3)
    for df in (
        good.withColumn("id", F.col("id") + 0.9), good.withColumn("id", F.col("id").cast("string")),
        good.withColumn("z", F.lit(1)), good.select("value", "id"), good.select("id"),
    ):
        with pytest.raises(sinks.PlanMismatch):
            sinks.table_load(df, PLAN, target)
        with pytest.raises(sinks.PlanMismatch):
            sinks.batch_load(df.withColumn("b", F.lit(1)), PLAN, "b", str(tmp_path / "b"), "one")
    assert spark.read.parquet(target).count() == 3
    longer = LoadPlan((*PLAN.columns, PlannedColumn(2, "z", True, SourceType("int32"), TargetType("int"))))
    with pytest.raises(sinks.PlanMismatch):
        sinks.table_load(good.withColumn("z", F.lit(1)), longer, target)
    assert spark.read.parquet(target).columns == ["id", "value"]


def test_written_batches_and_summary(spark, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_dataset(rows(spark, 100).coalesce(1), path, 30)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    summary = datasets.dataset_summary(batching.batches_by_key(datasets.read_dataset(spark, path), "id", 30), "batch_id").first()
    assert tuple(summary) == (100, 4, 30)
    with pytest.raises(ValueError):
        batching.batches_by_key(rows(spark, 1), "id", 0)


def test_ranks_are_global_and_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("key")).repartition(7)
    got = batching.with_rank(df, ["key"]).collect()
    assert all(r["row_rank"] == r["key"] for r in got) and len(got) == 1000


def test_one_key_is_cut_over_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("same").alias("key"))
    sequence = batching.in_sequence(df, ["key"])
    sizes = [r["count"] for r in sequence.groupBy(F.shiftright("__sequence", batching.ROW_BITS)).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_batches_without_rows_are_counted(spark):
    """After batches of 0, 2 and 2 rows: (0, 1), (2, 2), (4, 3)."""
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 0), (9, 1)], "batch_id long, error_count int")
    sent = spark.createDataFrame([(0,), (1,), (2,)], "batch_id long")
    got = quality.running_load_stats(df, "batch_id", sent).orderBy("batch_id").collect()
    assert [(r["rows_written"], r["batches_written"]) for r in got] == [(0, 1), (2, 2), (4, 3)]
    outcomes = {r["batch_id"]: tuple(r)[1:] for r in quality.batch_outcomes(df, "batch_id", sent).collect()}
    assert outcomes == {0: (0, 0, 0), 1: (2, 0, 0), 2: (2, 0, 0), 9: (1, 1, 1)}


def test_running_totals_across_blocks(spark):
    df = spark.range(1000).select((F.col("id") - 300).alias("batch_id"), F.col("id").alias("n"))
    got = quality.running_totals(df, "batch_id", ["n"], block=64).orderBy("batch_id").collect()
    total = 0
    for row in got:
        total += row["n"]
        assert row["n_so_far"] == total
    assert len(got) == 1000


def test_row_and_batch_bytes(spark):
    """Two rows of three cells: 4, 1 and 8 bytes; 4, 5 and 1 bytes."""
    plan = LoadPlan((
        PlannedColumn(0, "a", False, SourceType("int32"), TargetType("int")),
        PlannedColumn(1, "b", True, SourceType("int32"), TargetType("int")),
        PlannedColumn(2, "c", True, SourceType("utf8"), TargetType("nvarchar", length=9)),
    ))
    df = spark.createDataFrame([(0, 1, None, "abc"), (0, 1, 5, None)], "batch int, a int, b int, c string")
    row = sizing.batch_bytes(df, plan, "batch").first()
    # 1 + 4 + 1 + (2 + 6) and 1 + 4 + 5 + 2
    assert (row["row_count"], row["payload_bytes"], row["max_row_bytes"]) == (2, 14 + 12, 14)


def test_counts_that_differ_are_an_error():
    reconcile.require_reconciled(3, 3, "t")
    with pytest.raises(RuntimeError):
        reconcile.require_reconciled(3, 2, "t")


def test_roundtrip_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    right = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    got = {r["v"]: (r["missing"], r["unexpected"]) for r in reconcile.roundtrip_diff(left, right).collect()}
    assert got == {1: (1, 0), 2: (0, 1)}


def test_stream_load_writes_every_row_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows(spark, 100, bad=[5, 50]).repartition(4).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream_load(stream.withColumn("key", F.col("id")), PLAN, target, checkpoint, ["key"]).awaitTermination()

    run(progress)
    loaded = spark.read.parquet(f"{target}/rows")
    assert loaded.count() == 98 and loaded.select("id").distinct().count() == 98
    assert load_stats(loaded).count() == 4
    assert {r["key"] for r in spark.read.parquet(f"{target}/diagnostics").collect()} == {5, 50}
    # More data goes on from the checkpoint.
    spark.range(1000, 1010).select("id", (F.col("id") / 2).alias("value")).coalesce(1).write.mode("append").parquet(source)
    run(progress)
    assert spark.read.parquet(f"{target}/rows").count() == 108
    # The same micro-batches run again replace what they wrote.
    run(str(tmp_path / "cp2"))
    again = spark.read.parquet(f"{target}/rows")
    assert again.count() == 108 and again.select("id").distinct().count() == 108


def test_jdbc_options_and_table_text():
    target = sinks.JdbcTarget("jdbc:example://host/db", "dbo.orders", user="u", password="p", batch_rows=500, connections=4)
    options = target.options()
    assert options["batchsize"] == "500" and options["numPartitions"] == "4" and options["dbtable"] == "dbo.orders"
    assert "driver" not in options


@pytest.mark.parametrize("shape", sorted(shapes.SHAPES))
def test_shapes_conform_to_their_own_plan(spark, shape):
    from quayload.operators.planning import plan_schema
    from quayload.policy import PlanOptions

    df = shapes.generate(spark, shape, 300)
    plan = plan_schema(df.schema, PlanOptions(uint64="decimal", date64="datetime2"))
    bad = conform.conform_table(df, plan).where(F.size("errors") > 0)
    assert bad.count() == 0


def test_shape_rows_beyond_64_bit_products(spark):
    row = 20_000_000_000_000
    got = spark.range(1).select(shapes.mixed_int(F.lit(row)).alias("m"), shapes.low_32_bits(F.lit(row), shapes.SECOND_FACTOR).alias("w")).first()
    assert got["m"] == (row * 1103515245 + 12345) % 2**64 % 1_000_000
    assert got["w"] == row * 2654435761 % 2**32


def test_batch_load_rejects_only_bad_batches(spark, tmp_path):
    target = str(tmp_path / "b")
    df = batching.batches_by_key(rows(spark, 100, bad=[5, 6, 50]), "id", 10)
    result = sinks.batch_load(df, PLAN, "batch_id", target, "one")
    assert (result.rows_written, result.batches_written, result.batches_rejected) == (80, 8, 2)
    seen = sinks.read_published(spark, target, df.select("batch_id", "id", "value").schema)
    assert seen.count() == 80 and seen.where("batch_id in (0, 5)").count() == 0


def test_sort_partitions_follow_the_rows(spark):
    from quayload import session

    assert session.partitions_for(spark.range(1000)) == 8
    assert session.partitions_for(spark.range(1000), rows_per_partition=10) == 100
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(50)]), "a int")
    assert session.partitions_for(unknown, rows_per_partition=1) == 50
