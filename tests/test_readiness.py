"""Counters, summaries and ranges of a load, and zone names judged once for each name."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayload.functions import zones
from quayload.functions.hold import Hold
from quayload.operators import conform, sizing
from quayload.policy import LoadPlan, PlannedColumn, SourceType, TargetType
from quayload.sources import datasets

PLAN = LoadPlan((
    PlannedColumn(0, "id", False, SourceType("int64"), TargetType("bigint")),
    PlannedColumn(1, "name", True, SourceType("utf8"), TargetType("nvarchar", length=9)),
))


def test_empty_batches_are_summed_up(spark):
    df = spark.createDataFrame([(1,), (1,), (3,), (None,)], "b int")
    sent = spark.createDataFrame([(0,), (1,), (3,), (7,)], "b int")
    assert tuple(datasets.dataset_summary(df, "b").first()) == (4, 3, 2)
    assert tuple(datasets.dataset_summary(df, "b", sent).first()) == (4, 5, 2)
    assert tuple(datasets.dataset_summary(df.limit(0), "b", sent).first()) == (0, 4, 0)


def test_load_counters_of_a_small_load(spark):
    """Rows of 1 + 8 + (2 + 2 per unit) bytes."""
    df = spark.createDataFrame([(0, 1, "ab"), (0, 2, None), (2, 3, "👍")], "b int, id long, name string")
    sent = spark.createDataFrame([(0,), (1,), (2,)], "b int")
    row = sizing.load_counters(df, PLAN, "b", ["id"], 24, sent).first().asDict()
    assert row == {"row_count": 3, "batches": 3, "row_ranges": 3, "encoded_bytes": 15 + 11 + 15, "max_range_bytes": 15,
                   "text_bytes": 8, "binary_bytes": 0, "null_cells": 1}
    nothing = sizing.load_counters(df.limit(0), PLAN, "b", ["id"], 24, sent).first().asDict()
    assert nothing["batches"] == 3 and sum(nothing.values()) == 3


def test_rejected_batches_have_no_ranges(spark):
    df = spark.createDataFrame([(0, 1, "ab"), (0, 2, "cd"), (None, 3, "x"), (5, 4, "much too long")], "b int, id long, name string")
    got = {r["b"]: (r["row_count"], r["accepted"], r["ranges"], r["max_range_bytes"])
           for r in sizing.readiness(conform.conform_table(df, PLAN, ["b", "id"]), PLAN, "b", ["id"], 20).collect()}
    assert got == {0: (2, True, 2, 15), None: (1, True, 1, 13), 5: (1, False, 0, 0)}


NAMES = ["UTC", "z", "+01", "+0530", "-03:30", "+14:00", "+14:01", "+12:60", "+1", "America/New_York", "Australia/Lord_Howe", "Mars/Olympus",
         "PST", "GMT+5", "america/new_york", "", None, "Etc/GMT+5", "Africa/Monrovia"]


def test_names_once_give_what_rows_give(spark):
    """On both sides of daylight saving time, by the second."""
    moments = [dt.datetime(1960, 1, 1), dt.datetime(2024, 3, 10, 6, 59, 59, 999999), dt.datetime(2024, 3, 10, 7), dt.datetime(2024, 11, 3, 5, 59, 59),
               dt.datetime(2024, 11, 3, 6), dt.datetime(2024, 4, 6, 14, 59, 59), dt.datetime(2024, 4, 6, 15), None]
    rows = [(z, m) for z in NAMES for m in moments]
    df = spark.createDataFrame(rows, "zone string, ntz timestamp_ntz").select("zone", F.col("ntz").cast("timestamp").alias("at"))
    hold = Hold()
    offset = zones.zone_offset(F.col("at"), F.col("zone"), hold)
    by_row = hold.add_to(df).select("zone", "at", offset.minutes.alias("offset_minutes"), offset.code.alias("code"))
    once = zones.with_offsets(df, "at", "zone")
    assert sorted(map(str, once.collect())) == sorted(map(str, by_row.collect()))
    found = {(r["zone"], r["at"]): r["offset_minutes"] for r in once.collect()}
    at = [r["at"] for r in df.where("zone = 'UTC'").collect()]
    assert [found["America/New_York", m] for m in at[1:5]] == [-300, -240, -240, -300]
    assert [found["Australia/Lord_Howe", m] for m in at[5:7]] == [660, 630]


def test_no_row_reads_a_timestamp_text(spark):
    """The plan judges names below the aggregate that makes them distinct."""
    df = spark.createDataFrame([("UTC", None)], "zone string, at timestamp")
    plan = zones.with_offsets(df, "at", "zone")._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.index("Join")
    assert "2000-01-01 00:00:00" not in plan[:joined] and "2000-01-01 00:00:00" in plan[joined:]


@pytest.mark.parametrize("name", ["zone", "offset"])
def test_columns_are_kept(spark, name):
    df = spark.createDataFrame([("UTC", 1)], f"{name} string, other int").withColumn("at", F.current_timestamp())
    assert zones.with_offsets(df, "at", name).columns == [name, "other", "at", "offset_minutes", "code"]
