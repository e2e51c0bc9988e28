"""Orders of fixed width, and plans that hash instead of sorting."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quayload.operators import telemetry
from quayload.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


def test_packed_order_sorts_like_its_parts(spark):
    r = random.Random(1)
    times = [dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), dt.datetime(2024, 3, 31, 2, 30),
             dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
    ties = [0, 1, -1, 2**63 - 1, -(2**63), 7]
    rows = [(t, n) for t in times for n in ties]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "t timestamp_ntz, n long").withColumn("o", telemetry.packed_order(F.col("t"), F.col("n")))
    assert [(x["t"], x["n"]) for x in df.orderBy("o").collect()] == sorted(rows)
    assert df.select("o").distinct().count() == len(rows)


def test_packed_order_does_not_follow_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 10, 27, 2, 30), 1)], "t timestamp_ntz, n long")
    found = set()
    try:
        for zone in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.add(df.select(telemetry.packed_order(F.col("t"), F.col("n"))).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(found) == 1


def test_numbers_are_picked_by_hash_aggregates(spark):
    for name in ("wait_deltas", "sample_coverage", "merge_counters"):
        plan = REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan, name


def test_first_repeat_gives_the_name(spark):
    rows = [(1, 5, "new", "LOG"), (1, 2, "old", "ROWS"), (2, 9, "only", "LOG")]
    df = spark.createDataFrame(rows, "file_id long, taken long, logical_name string, file_type string")
    for c in telemetry.FILE_COUNTERS:
        df = df.withColumn(c, F.lit(1).cast("bigint"))
    got = {r["file_id"]: (r["logical_name"], r["file_type"], r["read_bytes"]) for r in telemetry.merge_file_io(df, "taken").collect()}
    assert got == {1: ("old", "ROWS", 2), 2: ("only", "LOG", 1)}
