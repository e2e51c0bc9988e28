"""Packing against a plain loop, for small batches and for one batch over many tasks."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from quayload.operators import packing
from quayload.operators.packing import _apply, _combine, _cut, _describe, _enter_first, _enter


def brute(batches, sizes, limit):
    """Ranges row by row: (batch, number, first row, rows, bytes)."""
    out, current, row_in_batch = [], None, 0
    for batch, size in zip(batches, sizes):
        if current is None or current[0] != batch:
            current = [batch, 0, 0, 0, 0]
            out.append(current)
            row_in_batch = 0
        elif current[3] > 0 and current[4] + size > limit:
            current = [batch, current[1] + 1, row_in_batch, 0, 0]
            out.append(current)
        current[3] += 1
        current[4] += size
        row_in_batch += 1
    return [tuple(r) for r in out]


def by_segments(batches, sizes, limit, segment_rows, fan_in):
    """The distributed steps, run one after the other on pandas frames."""
    rows = pd.DataFrame({"batch": batches, "size": sizes})
    rows["segment"] = np.arange(len(rows)) // segment_rows
    level = pd.concat(list(_describe(limit)(iter([rows]))), ignore_index=True)
    levels = [level]
    while levels[-1]["segment"].max() >= fan_in:
        below = levels[-1].assign(parent=levels[-1]["segment"] // fan_in)
        levels.append(pd.concat([_combine(g) for _, g in below.groupby("parent")], ignore_index=True))
    entries = _enter_first(levels[-1])
    for level in reversed(levels[:-1]):
        members = level.assign(parent=level["segment"] // fan_in)
        parts = [_enter(g, entries[entries["segment"] == p]) for p, g in members.groupby("parent")]
        entries = pd.concat(parts, ignore_index=True)
    placed = rows.merge(entries, on="segment", how="left")
    pieces = pd.concat(list(_cut(limit)(iter([placed]))), ignore_index=True)
    ranges = pieces.groupby(["batch", "range_no"]).agg(
        start_row=("start_row", "min"), row_count=("row_count", "sum"), range_bytes=("range_bytes", "sum")).reset_index()
    return [tuple(int(x) for x in r) for r in ranges.itertuples(index=False)]


@settings(max_examples=100, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 40), min_size=1, max_size=6), limit=st.integers(1, 60),
    segment_rows=st.integers(1, 9), fan_in=st.integers(2, 4), seed=st.integers(0, 10_000), largest=st.integers(1, 70),
)
def test_segments_give_the_same_ranges(lengths, limit, segment_rows, fan_in, seed, largest):
    random = np.random.default_rng(seed)
    batches = np.repeat(np.arange(len(lengths)), lengths)
    sizes = random.integers(1, largest + 1, len(batches))
    assert by_segments(batches, sizes, limit, segment_rows, fan_in) == brute(batches.tolist(), sizes.tolist(), limit)


def test_steps_cover_every_entry_state():
    prefix = np.concatenate(([0], np.cumsum([3, 3, 3, 20, 3])))
    steps = pd.DataFrame(packing._steps(prefix, 10), columns=["fresh", "entry_max", "exit_bytes", "cuts"])
    exits, cuts = _apply(steps, np.arange(1, 25))
    for entry, left, count in zip(range(1, 25), exits, cuts):
        starts, open_bytes = packing.cut_starts(prefix, entry, 10)
        assert (open_bytes, len(starts)) == (left, count)


@pytest.mark.parametrize("limit, expected", [
    (10, [(0, 0, 2, 10), (1, 2, 2, 10)]),
    (4, [(i, i, 1, 5) for i in range(4)]),
])
def test_four_rows_of_five_bytes(spark, limit, expected):
    df = spark.createDataFrame([(0, i, 5) for i in range(4)], "batch int, row int, bytes long")
    got = packing.pack_ranges(df, "batch", ["row"], "bytes", limit).orderBy("range_no").collect()
    assert [(r["range_no"], r["start_row"], r["row_count"], r["range_bytes"]) for r in got] == expected


def test_zero_limit_is_an_error(spark):
    df = spark.createDataFrame([(0, 0, 5)], "batch int, row int, bytes long")
    with pytest.raises(ValueError):
        packing.pack_ranges(df, "batch", ["row"], "bytes", 0)


@pytest.mark.parametrize("kind, batches", [
    ("long", [None, 2**53 + 1, 2**53]), ("string", [None, "n", "v"]), ("binary", [None, b"\xff", b""]), ("date", [None]), ("double", [None, 0.1]),
])
def test_batches_of_any_type_and_null(spark, kind, batches):
    """Ten rows of 60 bytes in each batch, limit 100: one row a range."""
    df = spark.createDataFrame([(b, i, 60) for b in batches for i in range(10)], f"batch {kind}, row int, bytes long")
    got = packing.pack_ranges(df, "batch", ["row"], "bytes", 100).collect()
    assert df.schema["batch"].dataType == packing.pack_ranges(df, "batch", ["row"], "bytes", 100).schema["batch"].dataType
    want = sorted(repr((b, i, i, 1, 60)) for b in batches for i in range(10))
    assert sorted(repr(tuple(r)) for r in got) == want


def test_row_without_a_size_is_refused(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, None)], "batch int, row int, bytes long")
    with pytest.raises(Exception, match="without a size"):
        packing.pack_ranges(df, "batch", ["row"], "bytes", 10).collect()


def test_partitions_follow_counted_rows(spark, monkeypatch):
    """The planner takes an exploded row for one row."""
    monkeypatch.setattr(packing, "SEGMENT_ROWS", 100)
    df = spark.range(1).selectExpr("1 AS batch", "explode(sequence(1, 5000)) AS row", "7L AS bytes")
    got = packing.pack_ranges(df, "batch", ["row"], "bytes", 70)
    assert got.count() == 500 and got.agg({"range_bytes": "max"}).first()[0] == 70


@pytest.mark.parametrize("kind", ["int", "string"])
def test_one_batch_over_many_partitions(spark, monkeypatch, kind):
    """Most rows in one batch, more segments than one group takes."""
    monkeypatch.setattr(packing, "FAN_IN", 3)
    random = np.random.default_rng(3)
    batches = sorted(random.choice([0, 1, 1, 1, 1, 2], 5000).tolist())
    sizes = random.integers(1, 90, len(batches)).tolist()
    rows = [(b if kind == "int" else f"b{b}", i, s) for i, (b, s) in enumerate(zip(batches, sizes))]
    df = spark.createDataFrame(rows, f"batch {kind}, row int, bytes long").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = packing.pack_ranges(df, "batch", ["row"], "bytes", 400).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    expected = brute([r[0] for r in rows], sizes, 400)
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_no_rows(spark):
    df = spark.createDataFrame([], "batch int, row int, bytes long")
    assert packing.pack_ranges(df, "batch", ["row"], "bytes", 400).count() == 0


@pytest.mark.parametrize("kind, batches", [("long", [None, 2**53 + 1]), ("string", ["n", None]), ("binary", [None, b"\xff"])])
def test_promised_batches_give_the_same_ranges(spark, kind, batches):
    random = np.random.default_rng(5)
    rows = [(b, i, int(random.choice([0, 1, 30, 99, 100, 101, 250]))) for b in batches for i in range(200)]
    df = spark.createDataFrame(rows, f"batch {kind}, row int, bytes long").repartition(4)
    promised = packing.pack_ranges(df, "batch", ["row"], "bytes", 100, 200)
    free = packing.pack_ranges(df, "batch", ["row"], "bytes", 100)
    assert sorted(repr(tuple(r)) for r in promised.collect()) == sorted(repr(tuple(r)) for r in free.collect())
    assert promised.columns == free.columns and promised.dtypes == free.dtypes
    with pytest.raises(Exception, match="more than the 199 rows"):
        packing.pack_ranges(df, "batch", ["row"], "bytes", 100, 199).collect()
    with pytest.raises(Exception, match="without a size"):
        packing.pack_ranges(df.withColumn("bytes", packing.F.lit(None).cast("long")), "batch", ["row"], "bytes", 100, 200).collect()


def test_composed_steps_hold_for_every_entry():
    """Steps of many segments as one function, against cutting all rows at once."""
    random = np.random.default_rng(2)
    for _ in range(60):
        limit = int(random.integers(5, 60))
        parts = [random.integers(1, 25, random.integers(1, 12)) for _ in range(6)]
        tables = [packing._steps(packing._prefix(p), limit) for p in parts]
        whole = packing.reduce(packing._then, tables)
        prefix = packing._prefix(np.concatenate(parts))
        entries = np.arange(1, 80)
        exits, cuts = _apply(whole, entries)
        for entry, left, count in zip(entries.tolist(), exits.tolist(), cuts.tolist()):
            starts, open_bytes = packing.cut_starts(prefix, entry, limit)
            assert (open_bytes, len(starts)) == (left, count)
        assert (np.diff(whole["entry_max"]) > 0).all()


def test_large_segments_compose_in_bounded_memory():
    """Eight segments of 200,000 rows of few bytes each: a step for nearly every row, in arrays."""
    import tracemalloc

    random = np.random.default_rng(1)
    limit = 8 << 20
    tracemalloc.start()
    tables = [packing._steps(packing._prefix(random.integers(1, 80, 200_000)), limit) for _ in range(8)]
    whole = packing.reduce(packing._then, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20 and len(whole) > 0
