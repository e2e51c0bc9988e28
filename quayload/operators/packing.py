"""Greedy cut of batches, in row order, into ranges of at most ``limit`` bytes.

A range is closed when the next row would take it over the limit; a row larger
than the limit is a range of its own.

Rows are range-partitioned into segments, and every segment is described by how it
changes the state "bytes in the open range". Those descriptions are combined in
groups of ``FAN_IN`` up to one, entry states are handed back down, and each
segment then cuts its own rows. No task ever sees more than one segment of rows.

Where the caller knows how many rows a batch has at most, because batches were cut to
that number, each batch is folded inside the JVM instead, after one shuffle by batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quayload.session import partitions_for
from quayload.sources.batching import ROW_BITS, in_sequence

DEFAULT_LIMIT = 8 * 1024 * 1024
FAN_IN = 32
#: Rows of a segment, on average: what one task holds at once.
SEGMENT_ROWS = 1 << 20

SEGMENT_SCHEMA = (
    "segment long, first_batch {b}, last_batch {b}, through boolean, row_total long, "
    "fresh boolean, entry_max long, exit_bytes long, cuts long, exit_rows long"
)
ENTRY_SCHEMA = "segment long, open_batch {b}, open_bytes long, open_range long, open_rows long"
PIECE_SCHEMA = "batch {b}, range_no long, start_row long, row_count long, range_bytes long"


def pack_ranges(df: DataFrame, batch: str, order: list[str], row_bytes: str,
                limit: int = DEFAULT_LIMIT, batch_rows: int | None = None) -> DataFrame:
    """Ranges of every batch: number, first row in the batch, rows, bytes.

    Batches may be of any size, one batch over many tasks if need be. ``batch_rows`` is
    the caller's promise of how many rows a batch has at most; a batch that breaks it
    fails the job. A row without a size fails the job before rows are moved. Rows without
    a batch are a batch.
    """
    _check_limit(limit)
    kind = df.schema[batch].dataType.simpleString()
    size = F.coalesce(F.col(row_bytes).cast("bigint"), F.raise_error(F.lit("a row without a size cannot be packed")).cast("bigint"))
    if batch_rows is not None:
        return _fold_batches(df, batch, order, size, limit, batch_rows)
    rest = [c for c in order if c != batch]
    sizes = df.select(F.col(batch).alias("batch"), *rest, size.alias("size"))
    parts = partitions_for(df, SEGMENT_ROWS)
    rows = in_sequence(sizes, ["batch", *rest], partitions=parts).select(
        F.shiftright("__sequence", ROW_BITS).alias("segment"), batch_key(F.col("batch"), kind).alias("batch"), "size"
    )
    text = "string"
    levels = [rows.mapInPandas(_describe(limit), SEGMENT_SCHEMA.format(b=text)).checkpoint()]
    # Segment numbers are partition numbers, so this is at most the partition count.
    top = levels[0].agg(F.max("segment")).first()[0]
    if top is None:
        return sizes.select(F.col("batch").alias(batch)).limit(0).select(
            batch, *[F.lit(0).cast("bigint").alias(c) for c in ("range_no", "start_row", "row_count", "range_bytes")]
        )
    while top >= FAN_IN:
        below = levels[-1].withColumn("parent", F.call_function("div", F.col("segment"), F.lit(FAN_IN)))
        levels.append(below.groupBy("parent").applyInPandas(_combine, SEGMENT_SCHEMA.format(b=text)).checkpoint())
        top //= FAN_IN
    entry_schema = ENTRY_SCHEMA.format(b=text)
    entries = levels[-1].withColumn("parent", F.lit(0)).groupBy("parent").applyInPandas(_enter_first, entry_schema)
    for level in reversed(levels[:-1]):
        members = level.withColumn("parent", F.call_function("div", F.col("segment"), F.lit(FAN_IN)))
        entries = (
            members.groupBy("parent").cogroup(entries.groupBy("segment")).applyInPandas(_enter, entry_schema)
        )
    # One row per segment: bounded by the partition count, so it may be broadcast.
    placed = rows.join(F.broadcast(entries), "segment", "left").select(
        "segment", "batch", "size", "open_batch", "open_bytes", "open_range", "open_rows"
    )
    pieces = placed.mapInPandas(_cut(limit), PIECE_SCHEMA.format(b=text))
    whole = pieces.groupBy("batch", "range_no").agg(
        F.min("start_row").alias("start_row"),
        F.sum("row_count").alias("row_count"),
        F.sum("range_bytes").alias("range_bytes"),
    )
    return whole.select(batch_of_key(F.col("batch"), kind).alias(batch), "range_no", "start_row", "row_count", "range_bytes")


def _fold_batches(df: DataFrame, batch: str, order: list[str], size: Column, limit: int, batch_rows: int) -> DataFrame:
    """One fold over the sorted sizes of each batch, which has ``batch_rows`` rows at most."""
    rows = F.collect_list(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), size.alias("size")))
    refused = F.raise_error(F.lit(f"a batch has more than the {batch_rows} rows it may have"))
    held = F.when(F.count(F.lit(1)) <= batch_rows, F.array_sort(rows)).otherwise(refused)
    piece = "struct<start_row:bigint,row_count:bigint,range_bytes:bigint>"
    nothing = F.lit(0).cast("bigint")
    start = F.struct(F.array().cast(f"array<{piece}>").alias("closed"), *(nothing.alias(n) for n in ("start_row", "row_count", "range_bytes")))

    def open_range(state: Column) -> Column:
        return F.array(F.struct(state["start_row"].alias("start_row"), state["row_count"].alias("row_count"), state["range_bytes"].alias("range_bytes")))

    def add(state: Column, row: Column) -> Column:
        full = (state["row_count"] > 0) & (state["range_bytes"] + row["size"] > limit)
        return F.struct(
            F.when(full, F.concat(state["closed"], open_range(state))).otherwise(state["closed"]).alias("closed"),
            F.when(full, state["start_row"] + state["row_count"]).otherwise(state["start_row"]).alias("start_row"),
            F.when(full, F.lit(1).cast("bigint")).otherwise(state["row_count"] + 1).alias("row_count"),
            F.when(full, row["size"]).otherwise(state["range_bytes"] + row["size"]).alias("range_bytes"),
        )

    ranges = F.aggregate("__rows", start, add, lambda state: F.concat(state["closed"], open_range(state)))
    folded = df.groupBy(batch).agg(held.alias("__rows")).select(batch, ranges.alias("__ranges"))
    return folded.select(batch, F.posexplode("__ranges").alias("range_no", "__piece")).select(
        batch, F.col("range_no").cast("bigint").alias("range_no"), "__piece.start_row", "__piece.row_count", "__piece.range_bytes")


def batch_key(batch: Column, kind: str) -> Column:
    """A text for every batch, none of them NULL: pandas keeps it as it is, whatever the batch's type.

    Numbers would become floats beside a NULL and lose digits there.
    """
    value = F.base64(batch) if kind == "binary" else batch.cast("string")
    return F.coalesce(F.concat(F.lit("v"), value), F.lit("n"))


def batch_of_key(key: Column, kind: str) -> Column:
    value = F.when(key != "n", F.substring(key, 2, 2**31 - 1))
    return F.unbase64(value) if kind == "binary" else value.cast(kind)


def range_summary(ranges: DataFrame, batch: str) -> DataFrame:
    """Ranges, rows and bytes per batch, and the largest range."""
    return ranges.groupBy(batch).agg(
        F.count(F.lit(1)).alias("ranges"),
        F.sum("row_count").alias("row_count"),
        F.sum("range_bytes").alias("payload_bytes"),
        F.max("range_bytes").alias("max_range_bytes"),
    )


def _check_limit(limit: int) -> None:
    if limit < 1:
        raise ValueError("the byte limit of a range must be greater than zero")


def cut_starts(prefix: np.ndarray, open_bytes: int, limit: int) -> tuple[list[int], int]:
    """Rows that start a new range, and the bytes left open; ``prefix`` has n + 1 sums."""
    rows, at, starts = len(prefix) - 1, 0, []
    while at < rows:
        first = int(np.searchsorted(prefix, limit - open_bytes + prefix[at], side="right")) - 1
        if open_bytes == 0:
            first = max(first, at + 1)
        first = max(first, at)
        if first >= rows:
            break
        starts.append(first)
        at, open_bytes = first, 0
    return starts, int(open_bytes + prefix[rows] - prefix[at])


def _runs(batches: pd.Series) -> list[tuple[int, int]]:
    """Stretches of equal batch in an ordered column."""
    values = batches.to_numpy()
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    bounds = [0, *edges.tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:]))


def _prefix(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _whole_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches joined to whole segments; rows arrive in order."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for segment, part in frame.groupby("segment", sort=False):
            if held and held[0]["segment"].iat[0] != segment:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


STEP_COLUMNS = ["fresh", "entry_max", "exit_bytes", "cuts"]


def _table(tops: np.ndarray, exits: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
    """Steps in the order of their entries; neighbours with the same outcome become one."""
    order = np.argsort(tops, kind="stable")
    tops, exits, cuts = tops[order], exits[order], cuts[order]
    if len(tops):
        last = np.append((exits[1:] != exits[:-1]) | (cuts[1:] != cuts[:-1]), True)
        tops, exits, cuts = tops[last], exits[last], cuts[last]
    return pd.DataFrame({"fresh": False, "entry_max": tops, "exit_bytes": exits, "cuts": cuts})


def _description(segment: int, first, last, through: bool, row_total: int, exit_rows: int, fresh: tuple[int, int],
                 steps: pd.DataFrame | None) -> pd.DataFrame:
    """A segment's rows: what it does when nothing is open, then its steps if one batch runs through it."""
    head = pd.DataFrame({"fresh": [True], "entry_max": [0], "exit_bytes": [fresh[0]], "cuts": [fresh[1]]})
    out = head if steps is None or steps.empty else pd.concat([head, steps], ignore_index=True)
    out = out.assign(segment=segment, first_batch=first, last_batch=last, through=through, row_total=row_total, exit_rows=exit_rows)
    return out[["segment", "first_batch", "last_batch", "through", "row_total", *STEP_COLUMNS, "exit_rows"]]


def _describe(limit: int):
    """Per segment: the state it leaves behind, as a step function of the state it meets."""

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_segments(frames):
            runs = _runs(rows["batch"])
            low, high = runs[-1]
            prefix = _prefix(rows["size"].to_numpy()[low:high])
            starts, left = cut_starts(prefix, 0, limit)
            through = len(runs) == 1
            yield _description(
                rows["segment"].iat[0], rows["batch"].iat[0], rows["batch"].iat[-1], through, high - low, high - low,
                (left, len(starts)), _steps(prefix, limit) if through else None)

    return describe


def _steps(prefix: np.ndarray, limit: int) -> pd.DataFrame:
    """Steps (entry_max, exit_bytes, cuts): valid for entry bytes up to ``entry_max``.

    An entry of c bytes is first cut at the row where c plus the rows before and
    including it passes the limit. Each such row starts a chain of its own. A step without
    a cut carries its bytes on; its exit is the entry less ``exit_bytes``.
    """
    rows, total = len(prefix) - 1, int(prefix[-1])
    # Row p is the first cut for c in (limit - prefix[p+1], limit - prefix[p]].
    candidates = np.flatnonzero(prefix[:-1] < limit)
    following = np.searchsorted(prefix, prefix[:-1] + limit, side="right") - 1
    following = np.maximum(following, np.arange(rows) + 1)
    at, cuts = candidates.copy(), np.ones(len(candidates), dtype=np.int64)
    while True:
        onward = following[at] < rows
        if not onward.any():
            break
        at[onward] = following[at[onward]]
        cuts[onward] += 1
    exits = total - prefix[at]
    # An entry beyond the limit (one oversized row) is cut at once, like the largest.
    tops = np.where(candidates == 0, np.iinfo(np.int64).max, limit - prefix[candidates])
    if total < limit:
        # What fits without a cut carries its bytes on.
        tops, exits, cuts = np.append(tops, limit - total), np.append(exits, -total), np.append(cuts, 0)
    return _table(tops, exits, cuts)


def _apply(steps: pd.DataFrame, open_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exit bytes and cuts of many entry states at once."""
    at = np.searchsorted(steps["entry_max"].to_numpy(), open_bytes, side="left")
    exits, cuts = steps["exit_bytes"].to_numpy()[at], steps["cuts"].to_numpy()[at]
    return np.where(cuts == 0, open_bytes - exits, exits), cuts


def _split(member: pd.DataFrame) -> tuple[pd.Series, pd.DataFrame]:
    fresh = member[member["fresh"]].iloc[0]
    return fresh, member[~member["fresh"]].sort_values("entry_max")


def _members(table: pd.DataFrame) -> list[pd.DataFrame]:
    return [part for _, part in table.groupby("segment", sort=True)]


def _leave(state: tuple, member: pd.DataFrame) -> tuple:
    """State after a segment: (batch, bytes, range number, rows of the batch so far)."""
    fresh, steps = _split(member)
    batch, open_bytes, open_range, open_rows = state
    if fresh["through"] and batch is not None and fresh["first_batch"] == batch:
        exits, cuts = _apply(steps, np.array([open_bytes]))
        return batch, int(exits[0]), open_range + int(cuts[0]), open_rows + int(fresh["row_total"])
    return fresh["last_batch"], int(fresh["exit_bytes"]), int(fresh["cuts"]), int(fresh["exit_rows"])


def _combine(table: pd.DataFrame) -> pd.DataFrame:
    """The description of consecutive segments as one segment."""
    members = _members(table)
    batch = members[0]["first_batch"].iat[0]
    through = all(m["through"].iat[0] and m["first_batch"].iat[0] == batch for m in members)
    state = (None, 0, 0, 0)
    for member in members:
        state = _leave(state, member)
    total = int(sum(m["row_total"].iat[0] for m in members)) if through else 0
    steps = reduce(_then, (_split(m)[1] for m in members)) if through else None
    return _description(
        int(table["parent"].iat[0]), batch, members[-1]["last_batch"].iat[0], through, total, state[3], (state[1], state[2]), steps)


def _then(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """One step function after the other.

    Entries that the first one cuts leave it as values, which the second one moves on.
    Entries that it does not cut arrive as ``entry + total``, and are split where the
    second one has its steps.
    """
    tops, exits, cuts = (first[c].to_numpy() for c in STEP_COLUMNS[1:])
    cut = cuts > 0
    moved, more = _apply(second, exits[cut])
    made = [(tops[cut], moved, cuts[cut] + more)]
    for at in np.flatnonzero(~cut):
        total, below = -exits[at], tops[at - 1] if at else -1
        their_tops, their_exits, their_cuts = (second[c].to_numpy() for c in STEP_COLUMNS[1:])
        reach = their_tops - total
        until = int(np.searchsorted(reach, tops[at], side="left")) + 1
        reach = np.minimum(reach[:until], tops[at])
        met = reach > below
        value = np.where(their_cuts == 0, their_exits - total, their_exits)[:until]
        made.insert(0, (reach[met], value[met], their_cuts[:until][met]))
    return _table(*(np.concatenate(parts) for parts in zip(*made)))


def _entries(members: list[pd.DataFrame], state: tuple, batch_dtype) -> pd.DataFrame:
    out = []
    for member in members:
        out.append((int(member["segment"].iat[0]), *state))
        state = _leave(state, member)
    frame = pd.DataFrame(out, columns=["segment", "open_batch", "open_bytes", "open_range", "open_rows"])
    frame["open_batch"] = pd.array(frame["open_batch"].tolist(), dtype=batch_dtype)
    return frame


def _enter_first(table: pd.DataFrame) -> pd.DataFrame:
    """Entry states of the top level: nothing is open before the first segment."""
    return _entries(_members(table), (None, 0, 0, 0), _nullable(table["first_batch"]))


def _enter(table: pd.DataFrame, parent: pd.DataFrame) -> pd.DataFrame:
    """Entry states of the members of one parent segment."""
    row = parent.iloc[0]
    batch = None if pd.isna(row["open_batch"]) else row["open_batch"]
    state = (batch, int(row["open_bytes"]), int(row["open_range"]), int(row["open_rows"]))
    return _entries(_members(table), state, _nullable(table["first_batch"]))


def _nullable(column: pd.Series):
    return "Int64" if pd.api.types.is_integer_dtype(column.dtype) else object


def _cut(limit: int):
    """Pieces of ranges per segment; a range over two segments gives two pieces."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_segments(frames):
            head = rows.iloc[0]
            sizes, batches = rows["size"].to_numpy(), rows["batch"].to_numpy()
            out = []
            for low, high in _runs(rows["batch"]):
                carried, number, before = 0, 0, 0
                if low == 0 and not pd.isna(head["open_batch"]) and head["open_batch"] == batches[0]:
                    carried, number, before = (
                        int(head["open_bytes"]), int(head["open_range"]), int(head["open_rows"])
                    )
                prefix = _prefix(sizes[low:high])
                starts, _ = cut_starts(prefix, carried, limit)
                edges = [0, *starts, high - low]
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if b > a:
                        out.append((batches[low], number + i, before + a, b - a, int(prefix[b] - prefix[a])))
            yield pd.DataFrame(out, columns=["batch", "range_no", "start_row", "row_count", "range_bytes"])

    return cut
