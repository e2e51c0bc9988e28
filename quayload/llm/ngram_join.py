"""Operator 1: Jaccard self-join on word n-grams as a blocked sparse matrix product.

The matrix has a row per different n-gram set and a column per n-gram. Copies of a set
are one row from the start. Rows that cannot link are dropped by a bound: a row of n
n-grams needs a partner that shares one of its rarest n - ceil(t n) + 1, so a row with
that many n-grams of its own has none. A fixed share of all columns is enough to show
it for nearly all rows, and only 32 bits an n-gram are shuffled for that.

The rows left are cut to the columns they share with others and to prefixes of rarest
columns; rows that share prefix columns form clusters. The product runs cluster by
cluster: prefix blocks of columns give partial overlaps, pairs that their sizes or the
columns left rule out are discarded, and the rest of the columns completes the counts.
Clusters above ``TILE_ENTRIES`` are cut into row blocks, and every pair of blocks is a tile.

The query counts every link: the result is one row per document with its set size, the
smallest identifier reachable over links and its number of links, that is of other
documents whose set is at least ``THRESHOLD`` like its own; copies of the set count as
linked documents without being multiplied. :func:`linked_sets` gives the linked pairs of
different sets with both sizes and the overlap, :func:`members` the documents of each set.

:func:`keep_one` needs components only, which a spanning part of the links gives
(:func:`links`): rows of the largest component found so far are not multiplied among
themselves, since a pair of them connects nothing new, and a round against a few pivot
rows merges most of what is alike in a large cluster before its tiles.

Defined results: a text without words has an empty set and no links; fewer words than an
n-gram are one n-gram;
null identifiers are later than all others and come back as null; rows that repeat an
identifier are rows of their own; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.anchors import NULL_ID, UNIT_BYTES, keyed, pack_arrays, unpack_arrays
from quayload.llm.chunked import give_back
from quayload.llm.components import components
from quayload.llm.hashing import U64, Words, chunks, shingle_sets, text_bytes
from quayload.llm.registry import llm_query
from quayload.llm.workspace import WORD, release, shuffle_partitions, stage
from quayload.plans.registry import table

WORDS = 5
THRESHOLD = Fraction(3, 4)
#: Part of the column space that is asked about first.
SIEVE = Fraction(3, 8)
TILE_ENTRIES = 1 << 19
PIVOTS = 16
MANY = np.uint32(0xFFFFFFFF)


def prefix_sql(n: str) -> str:
    """SQL: how many of a set's rarest n-grams a partner must share one of."""
    t = THRESHOLD
    return f"({n} - ({t.numerator} * {n} + {t.denominator - 1}) div {t.denominator} + 1)"


# ---- sets, and what is asked about them ---------------------------------------------------------


def _finger(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a sorted set."""
    import xxhash

    digest = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class _Sieve:
    """Columns of many different sets below the sieve's bound."""

    def __init__(self) -> None:
        self.fingers: dict[int, int] = {}
        self.columns: list[np.ndarray] = []
        self.bytes = 0

    def add(self, finger: int, low: np.ndarray) -> None:
        if finger not in self.fingers:
            self.fingers[finger] = len(self.fingers)
            self.columns.append(low)

    def rows(self, buckets: int) -> Iterator[tuple]:
        """(kind, bucket, payload): questions, and counts of what this unit shows to be shared."""
        if not self.columns:
            return
        every = np.concatenate(self.columns)
        owner = np.repeat(np.arange(len(self.columns), dtype=np.uint32), [len(c) for c in self.columns])
        fingers = np.fromiter(self.fingers, np.int64, len(self.fingers))
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        new = np.ones(len(every), bool)
        new[1:] = every[1:] != every[:-1]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(every)))
        shared = np.bincount(owner[np.repeat(count > 1, count)], minlength=len(fingers))
        at = np.flatnonzero(shared)
        if len(at):
            # Any bucket can add these up.
            yield 1, int(fingers[at[0]]) % buckets, pack_arrays(fingers[at], shared[at].astype(np.int64))
        asked, holder = every[begin], np.where(count > 1, MANY, owner[begin])
        target = asked % U64(buckets)
        order = np.argsort(target, kind="stable")
        cuts = np.searchsorted(target[order], np.arange(buckets + 1, dtype=U64))
        for bucket in range(buckets):
            mine = order[cuts[bucket] : cuts[bucket + 1]]
            if len(mine):
                names, index = np.unique(holder[mine], return_inverse=True)
                known = np.append(fingers, 0)[np.where(names == MANY, len(fingers), names.astype(np.int64))]
                index = index.astype(np.uint16 if len(names) <= 1 << 16 else np.uint32)
                yield 2, bucket, pack_arrays(known, (names == MANY).astype(np.uint8), index,
                                             ((asked[mine] >> U64(20)) & U64(0xFFFFFFFF)).astype(np.uint32))


def sets(docs: DataFrame) -> DataFrame:
    """(id, text_hash, n, f1, f2, sent) of every document: its set's size, fingerprints and columns below the sieve's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, made in _made(batch):
                rows = [(len(own), *_finger(own), _low(own)) for own in made]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), *columns], ["id", "text_hash", "n", "f1", "f2", "sent"])
            give_back()

    return docs.mapInArrow(run, "id long, text_hash binary, n long, f1 long, f2 long, sent long")


def _frugal(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on one group, after which its worker keeps no memory: the next stage starts workers beside it."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        give_back()
        return out

    return run


def _made(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    raw, offsets = text_bytes(batch.column("text"))
    for first, last in chunks(offsets):
        yield batch.slice(first, last - first), list(shingle_sets(Words(raw, offsets, first, last, lower=True), WORDS))


BOUND = U64(int(SIEVE * (1 << 64)))


def _low(own: np.ndarray) -> int:
    return int(np.searchsorted(own, BOUND))


def questions(docs: DataFrame) -> DataFrame:
    """(kind, bucket, payload): what the sieve shuffles; a second look at the texts is cheaper than storing this."""
    buckets = 2 * shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve()
        for batch in batches:
            for part, made in _made(batch):
                for own in made:
                    if len(own):
                        sieve.add(_finger(own)[0], own[: _low(own)])
                sieve.bytes += part.column("text").nbytes
                if sieve.bytes >= UNIT_BYTES:
                    yield _sieve_batch(sieve, buckets)
                    sieve = _Sieve()
            give_back()
        yield _sieve_batch(sieve, buckets)
        del sieve
        give_back()

    return docs.select("text").mapInArrow(run, "kind int, bucket int, payload binary")


def _sieve_batch(sieve: _Sieve, buckets: int) -> pa.RecordBatch:
    columns = list(zip(*sieve.rows(buckets), strict=True)) or [[], [], []]
    kinds = [pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "bucket", "payload"])


def _shared_counts(table: pa.Table, slices: int) -> pa.Table:
    """For one bucket: per set the asked columns that another set has too, in a few rows of packed counts."""
    kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
    told = [unpack_arrays(p) for k, p in zip(kinds, payloads, strict=True) if k == 1]
    fingers, counts = [p[0] for p in told], [p[1] for p in told]
    parts = [unpack_arrays(p) for k, p in zip(kinds, payloads, strict=True) if k == 2]
    if parts:
        finger = np.concatenate([p[0][p[2]] for p in parts])
        many = np.concatenate([p[1][p[2]] for p in parts]) > 0
        column = np.concatenate([p[3] for p in parts])
        order = np.lexsort((finger, many, column))
        finger, many, column = finger[order], many[order], column[order]
        new = np.ones(len(column), bool)
        new[1:] = column[1:] != column[:-1]
        differs = np.zeros(len(column), bool)
        differs[1:] = ~new[1:] & ((finger[1:] != finger[:-1]) | many[1:])
        group = np.cumsum(new) - 1
        shared = (np.bincount(group, differs) > 0) | (np.bincount(group, many) > 0)
        names, found = np.unique(finger[shared[group] & (new | differs) & ~many], return_counts=True)
        fingers.append(names)
        counts.append(found.astype(np.int64))
    names, sums = _sums(fingers, counts)
    target = names.astype(U64) % U64(slices)
    order = np.argsort(target, kind="stable")
    cuts = np.searchsorted(target[order], np.arange(slices + 1, dtype=U64))
    rows = [(i, pack_arrays(names[order[a:b]], sums[order[a:b]])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    schema = pa.schema([("slice", pa.int32()), ("payload", pa.binary())])
    return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[], []], schema=schema)


def _sums(fingers: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not fingers:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    names, index = np.unique(np.concatenate(fingers), return_inverse=True)
    return names, np.bincount(index, np.concatenate(counts), len(names)).astype(np.int64)


def _summed(table: pa.Table) -> pa.Table:
    parts = [unpack_arrays(p) for p in table.column("payload").to_pylist()]
    names, sums = _sums([p[0] for p in parts], [p[1] for p in parts])
    return pa.table([pa.array(names), pa.array(sums)], schema=pa.schema([("f1", pa.int64()), ("shared", pa.int64())]))


def candidates(docs: DataFrame, made: DataFrame) -> DataFrame:
    """(id, text_hash, f1, copies) of one document per set that may have a link; ``made`` is a staged :func:`sets`."""
    slices = shuffle_partitions(docs.sparkSession)
    counted = questions(docs).groupBy("bucket").applyInArrow(_frugal(lambda t: _shared_counts(t, slices)), "slice int, payload binary")
    # A column may be counted in several units: that only keeps more rows.
    shared = counted.groupBy("slice").applyInArrow(_frugal(_summed), "f1 long, shared long")
    rows = (
        made.where("n > 0")
        .groupBy("f1", "f2")
        .agg(
            F.min(F.struct("id", "text_hash")).alias("head"),
            F.first("n").alias("n"),
            F.first("sent").alias("sent"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    return (
        rows.join(shared, "f1", "left")
        .where(f"sent - coalesce(shared, 0) < {prefix_sql('n')}")
        .select("head.id", "head.text_hash", "f1", "copies")
    )


# ---- the product --------------------------------------------------------------------------------


def incidence(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(row, n, column) of the chosen documents; ``row`` is the set's fingerprint."""
    # The chosen grow with the corpus, so they are never broadcast: one plan at every size.
    joined = docs.join(chosen.hint("merge"), ["id", "text_hash"]).select("text", "f1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            rows = batch.column("f1").to_pylist()
            for first, last in chunks(offsets):
                found = list(shingle_sets(Words(raw, offsets, first, last, lower=True), WORDS))
                sizes = [len(s) for s in found]
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[first:last], pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))],
                    ["row", "n", "columns"],
                )
            give_back()

    return joined.mapInArrow(run, "row long, n long, columns array<long>")


def shared_rows(full: DataFrame) -> DataFrame:
    """(row, n, columns, prefix): shared columns, rarest first, and how many of them are in the prefix."""
    entries = full.select("row", "n", F.explode("columns").alias("column"))
    counts = entries.groupBy("column").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = (
        entries.join(counts, "column")
        .groupBy("row", "n")
        # A set: documents that repeat identifier and text bring their row twice.
        .agg(F.array_sort(F.collect_set(F.struct("df", "column"))).alias("found"))
        .withColumn("prefix", F.expr(f"{prefix_sql('n')} - (n - size(found))"))
        .where("prefix > 0")
    )
    return own.select("row", "n", F.col("found.column").alias("columns"), F.least("prefix", F.size("found")).cast("long").alias("prefix"))


def clusters(rows: DataFrame) -> DataFrame:
    """(row, cluster): rows that share prefix columns, directly or over others; others have none."""
    prefix = rows.select("row", F.explode(F.slice("columns", F.lit(1), F.col("prefix").cast("int"))).alias("column"))
    hubs = prefix.groupBy("column").agg(F.min("row").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    edges = prefix.join(hubs, "column").where("row <> hub").select(F.col("row").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("row"), F.col("label").alias("cluster"))


class _Union:
    def __init__(self, labels: np.ndarray):
        self.above = list(range(len(labels)))
        self.size = [1] * len(labels)
        first: dict[int, int] = {}
        for i, label in enumerate(labels.tolist()):
            self.join(first.setdefault(label, i), i)

    def find(self, i: int) -> int:
        above = self.above
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if self.size[a] < self.size[b]:
            a, b = b, a
        self.above[b] = a
        self.size[a] += self.size[b]
        return True


def product_links(
    sizes: np.ndarray, prefixes: np.ndarray, columns: list[np.ndarray], labels: np.ndarray, pivots: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that join rows of different labels: enough of them to connect all that are connected.

    A row's columns come rarest first. With ``pivots`` only these rows are multiplied with
    all, else every row outside the largest component.
    """
    n = len(sizes)
    lengths = np.array([len(c) for c in columns])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    names, column = np.unique(np.concatenate(columns), return_inverse=True)
    row = np.repeat(np.arange(n), lengths)
    in_prefix = (np.arange(len(column)) - bounds[row]) < prefixes[row]
    # Postings of the prefix blocks only: a pair that may link shares a column there.
    order = np.argsort(column[in_prefix], kind="stable")
    posting = row[in_prefix][order]
    starts = np.searchsorted(column[in_prefix][order], np.arange(len(names) + 1))
    union = _Union(labels)
    marks = np.zeros(len(names), bool)
    t = THRESHOLD
    out: list[tuple[int, int]] = []
    for r in np.argsort(-lengths, kind="stable").tolist() if pivots is None else pivots.tolist():
        if pivots is None:
            if union.size[union.find(r)] == n:
                break
            if 2 * union.size[union.find(r)] > n:
                continue  # more than half of all rows: the others meet these rows on their own turn
        own = column[bounds[r] : bounds[r + 1]]
        overlap = np.bincount(np.concatenate([posting[starts[c] : starts[c + 1]] for c in own[: prefixes[r]]]), minlength=n)
        near = np.flatnonzero(overlap)
        near = near[near != r]
        # Size bounds: the smaller set must hold t of the larger one, and what is left must suffice.
        small, large = np.minimum(sizes[near], sizes[r]), np.maximum(sizes[near], sizes[r])
        need = -(-t.numerator * (sizes[near] + sizes[r]) // (t.numerator + t.denominator))
        # What both sets share outside both prefixes lies behind the prefix that ends first.
        most = overlap[near] + np.maximum(lengths[r] - prefixes[r], lengths[near] - prefixes[near])
        near = near[(t.denominator * small >= t.numerator * large) & (most >= need)]
        if pivots is None:
            mine = union.find(r)
            near = near[[union.find(x) != mine for x in near.tolist()]] if len(near) else near
        if not len(near):
            continue
        marks[own] = True
        where = np.concatenate([np.arange(bounds[x], bounds[x + 1]) for x in near.tolist()])
        hits = np.add.reduceat(marks[column[where]].astype(np.int64), np.concatenate([[0], np.cumsum(lengths[near])[:-1]]))
        marks[own] = False
        linked = near[t.denominator * hits >= t.numerator * (sizes[near] + sizes[r] - hits)]
        for x in linked.tolist():
            if union.join(r, x):
                out.append((r, x))
    return out


def _tile_links(rows: pa.Table) -> pa.Table:
    """Links of one task's clusters or tile."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = np.array(rows.column("row").to_pylist(), np.int64)
    parts = np.array(rows.column("part").to_pylist(), np.int64)
    kinds = np.array(rows.column("pivot").to_pylist(), np.int64)
    labels = np.array(rows.column("label").to_pylist(), np.int64)
    sizes, prefixes = (np.array(rows.column(c).to_pylist(), np.int64) for c in ("n", "prefix"))
    lists = rows.column("columns").combine_chunks()
    flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    out: list[tuple[int, int]] = []
    order = np.argsort(parts, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
        # A row may come as a pivot or as one of the others as well; it is one row.
        _, once = np.unique(names[own], return_index=True)
        is_pivot = np.isin(names[own][once], names[own][kinds[own] == 1])
        own = own[once]
        if len(own) < 2:
            continue
        pivots = np.flatnonzero(is_pivot) if is_pivot.any() else None
        found = product_links(sizes[own], prefixes[own], [flat[offsets[i] : offsets[i + 1]] for i in own.tolist()], labels[own], pivots)
        out += [(int(names[own[a]]), int(names[own[b]])) for a, b in found]
    return pa.table([list(c) for c in zip(*out, strict=True)] if out else [[], []], schema=schema)


def _multiply(rows: DataFrame) -> DataFrame:
    return rows.select("task", "part", "pivot", "label", "row", "n", "prefix", "columns").groupBy("task").applyInArrow(
        _frugal(lambda t: _tile_links(t.drop_columns(["task"]))), "a long, b long"
    )


def links(rows: DataFrame) -> DataFrame:
    """(a, b): links that connect all rows which are connected; ``rows`` is a staged :func:`shared_rows`."""
    spark = rows.sparkSession
    tasks = 4 * shuffle_partitions(spark)
    member = stage(clusters(rows), "clusters")
    placed = rows.join(member, "row").withColumn("weight", F.size("columns").cast("long"))
    weights = stage(placed.groupBy("cluster").agg(F.sum("weight").alias("total")), "cluster-weights")
    small = placed.join(weights.where(f"total <= {TILE_ENTRIES}"), "cluster")
    found = _multiply(
        small.withColumn("task", F.pmod(F.xxhash64("cluster"), F.lit(tasks)).cast("string"))
        .withColumn("part", F.col("cluster"))
        .withColumn("pivot", F.lit(0))
        .withColumn("label", F.col("row"))
    )
    if weights.where(f"total > {TILE_ENTRIES}").limit(1).count() == 0:
        return found
    large = stage(
        placed.join(weights.where(f"total > {TILE_ENTRIES}"), "cluster")
        .withColumn("blocks", F.ceil(F.col("total") / TILE_ENTRIES).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks"))),
        "large-clusters",
    )
    # A few rows of each large cluster meet all its rows.
    few = Window.partitionBy("cluster", "block").orderBy(F.xxhash64("row", F.lit(1)), "row")
    per_block = large.withColumn("rank", F.row_number().over(few)).where(f"rank <= {PIVOTS}")
    pivots = per_block.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64("row", F.lit(1)), "row"))).where(
        f"rank <= {PIVOTS}"
    )
    everywhere = pivots.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    task = F.concat_ws("/", "cluster", "block")
    first = stage(
        _multiply(
            large.withColumn("pivot", F.lit(0))
            .unionByName(everywhere.withColumn("pivot", F.lit(1)).drop("rank"))
            .withColumn("task", task)
            .withColumn("part", F.lit(0).cast("long"))
            .withColumn("label", F.col("row"))
        ),
        "pivot-links",
    )
    known = components(first)
    labelled = stage(
        large.join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row")), "labelled"
    )
    main = (
        labelled.groupBy("cluster", "label")
        .agg(F.sum("weight").alias("w"))
        .groupBy("cluster")
        .agg(F.max_by("label", F.struct("w", "label")).alias("main"))
    )
    marked = labelled.join(main, "cluster")
    rest = marked.where("label <> main")
    side = rest.groupBy("cluster").agg(F.ceil(F.sum("weight") / TILE_ENTRIES).cast("long").alias("sides"))
    # Rows outside the main component meet every row; rows inside it do not meet each other.
    ones = (
        marked.join(side, "cluster")
        .withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
        .withColumn("pivot", F.lit(0))
        .drop("sides")
    )
    others = (
        rest.join(side, "cluster")
        .withColumn("side", F.pmod(F.xxhash64("row", F.lit(2)), F.col("sides")))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("pivot", F.lit(1))
        .drop("sides")
    )
    second = _multiply(
        ones.unionByName(others).withColumn("task", F.concat_ws("/", "cluster", "block", "side")).withColumn("part", F.lit(0).cast("long"))
    )
    return found.union(first).union(second)


# ---- every link ---------------------------------------------------------------------------------


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    return np.repeat(begin - np.cumsum(length) + length, length) + np.arange(int(length.sum()))


def every_link(
    sizes: np.ndarray, prefixes: np.ndarray, columns: list[np.ndarray], sides: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, linked rows, overlaps): each linked pair of rows once, and with ``sides`` those between side 0 and side 1.

    A row's columns come rarest first.
    """
    n = len(sizes)
    lengths = np.array([len(c) for c in columns])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    names, column = np.unique(np.concatenate(columns), return_inverse=True)
    row = np.repeat(np.arange(n), lengths)

    def postings(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = entries[np.argsort(column[entries], kind="stable")]
        starts = np.searchsorted(column[order], np.arange(len(names) + 1))
        return row[order], starts[:-1], np.diff(starts)

    meets = np.ones(n, bool) if sides is None else sides == 1
    full = np.flatnonzero(meets[row])
    in_prefix = np.flatnonzero(meets[row] & ((np.arange(len(column)) - bounds[row]) < prefixes[row]))
    # Prefix blocks name the pairs that may link; then the rest of the columns completes the counts.
    prefix_rows, prefix_at, prefix_df = postings(in_prefix)
    full_rows, full_at, full_df = postings(full)
    marks = np.zeros(len(names), bool)
    t = THRESHOLD
    for r in range(n) if sides is None else np.flatnonzero(sides == 0).tolist():
        own = column[bounds[r] : bounds[r + 1]]
        head = own[: prefixes[r]]
        overlap = np.bincount(prefix_rows[_spread(prefix_at[head], prefix_df[head])], minlength=n)
        near = np.flatnonzero(overlap)
        if sides is None:
            near = near[near > r]
        small, large = np.minimum(sizes[near], sizes[r]), np.maximum(sizes[near], sizes[r])
        need = -(-t.numerator * (sizes[near] + sizes[r]) // (t.numerator + t.denominator))
        # What both sets share outside both prefixes lies behind the prefix that ends first.
        most = overlap[near] + np.maximum(lengths[r] - prefixes[r], lengths[near] - prefixes[near])
        near = near[(t.denominator * small >= t.numerator * large) & (most >= need)]
        if not len(near):
            continue
        if int(lengths[near].sum()) < int(full_df[own].sum()):
            marks[own] = True
            hits = np.add.reduceat(marks[column[_spread(bounds[near], lengths[near])]].astype(np.int64), np.cumsum(lengths[near]) - lengths[near])
            marks[own] = False
        else:
            hits = np.bincount(full_rows[_spread(full_at[own], full_df[own])], minlength=n)[near]
        linked = t.denominator * hits >= t.numerator * (sizes[near] + sizes[r] - hits)
        if linked.any():
            yield r, near[linked], hits[linked]


def _parts(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]]:
    """Per cluster or tile of a task: names, sizes and copies of its rows, and their links."""
    names, parts, sizes, prefixes, copies, sides = (
        rows.column(c).to_numpy() for c in ("row", "part", "n", "prefix", "copies", "side")
    )
    lists = rows.column("columns").combine_chunks()
    flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    order = np.argsort(parts, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
        if len(own) > 1:
            columns = [flat[offsets[i] : offsets[i + 1]] for i in own.tolist()]
            two = sides[own] if sides[own].any() else None
            yield names[own], sizes[own], copies[own], every_link(sizes[own], prefixes[own], columns, two)


def _tile_counts(rows: pa.Table) -> pa.Table:
    """(a, b, linked): how many documents of other sets each row is linked to, and links that connect what is connected."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.int64())])
    out: list[tuple[int, int | None, int | None]] = []
    for names, _, copies, found in _parts(rows):
        union, linked = _Union(np.arange(len(names))), np.zeros(len(names), np.int64)
        for r, near, _ in found:
            linked[r] += copies[near].sum()
            linked[near] += copies[r]
            out += [(int(names[r]), int(names[x]), None) for x in near.tolist() if union.join(r, x)]
        at = np.flatnonzero(linked)
        out += [(a, None, k) for a, k in zip(names[at].tolist(), linked[at].tolist(), strict=True)]
    return pa.table([list(c) for c in zip(*out, strict=True)] if out else [[], [], []], schema=schema)


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_a, set_b, n_a, n_b, n_both) of every linked pair of one task, row by row."""
    for names, sizes, _, found in _parts(pa.Table.from_batches(list(batches))):
        for r, near, hits in found:
            own = np.full(len(near), r)
            columns = [names[own], names[near], sizes[own], sizes[near], hits]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["set_a", "set_b", "n_a", "n_b", "n_both"])


def _tiles(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` with the task and part they are multiplied in: small clusters whole, of large ones every pair of blocks."""
    tasks = 4 * shuffle_partitions(rows.sparkSession)
    member = stage(clusters(rows), "clusters")
    placed = rows.join(copies, "row").join(member, "row")
    weights = stage(placed.groupBy("cluster").agg(F.sum(F.size("columns").cast("long")).alias("total")), "cluster-weights")
    small = (
        placed.join(weights.where(f"total <= {TILE_ENTRIES}"), "cluster")
        .withColumn("task", F.pmod(F.xxhash64("cluster"), F.lit(tasks)).cast("string"))
        .withColumn("part", F.col("cluster"))
        .withColumn("side", F.lit(0))
    )
    large = (
        placed.join(weights.where(f"total > {TILE_ENTRIES}"), "cluster")
        .withColumn("blocks", F.ceil(F.col("total") / TILE_ENTRIES).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("task", F.concat_ws("/", "cluster", F.least("block", "other"), F.greatest("block", "other")))
        .withColumn("part", F.lit(0).cast("long"))
        .withColumn("side", (F.col("block") > F.col("other")).cast("int"))
    )
    columns = ["task", "part", "side", "row", "n", "prefix", "copies", "columns"]
    # Of a tile of two blocks the smaller number is side 0; a block with itself has side 0 only.
    return small.select(*columns).union(large.select(*columns))


def _matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged :func:`sets`, :func:`shared_rows` and (row, copies) of those."""
    spark = docs.sparkSession
    made = stage(sets(docs), "sets")
    chosen = stage(candidates(docs, made), "candidates")
    release(spark)
    full = stage(incidence(docs, chosen), "incidence")
    release(spark)
    rows = stage(shared_rows(full), "rows")
    release(spark)
    return made, rows, chosen.select(F.col("f1").alias("row"), "copies")


def linked_sets(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(set_a, set_b, n_a, n_b, n_both) of every linked pair of different sets, once; documents come from :func:`members`."""
    _, rows, copies = _matrix(keyed(df, text, id_column))
    return _tiles(rows, copies).groupBy("task").applyInArrow(_tile_pairs, "set_a long, set_b long, n_a long, n_b long, n_both long")


def members(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, set_id, n_shingles) of every document with words; documents of one set are linked to each other as well."""
    made = sets(keyed(df, text, id_column)).where("n > 0")
    return made.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), F.col("f1").alias("set_id"), F.col("n").alias("n_shingles"))


def _labelled(made: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (id, n, f1, f2) of staged sets, and (f1, f2, component_id, copies) of their sets."""
    label = components(links).select(F.col("node").alias("f1"), "label")
    own = made.select("id", "n", "f1", "f2")
    heads = own.where("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    joined = heads.join(label, "f1", "left").withColumn("label", F.coalesce("label", "f1"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    return own, joined.join(least, "label").select("f1", "f2", "component_id", "copies")


def _real(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def classes(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document."""
    made, rows, copies = _matrix(keyed(df, text, id_column))
    found = stage(
        _tiles(rows, copies).groupBy("task").applyInArrow(_frugal(_tile_counts), "a long, b long, linked long"),
        "links",
    )
    own, component = _labelled(made, found.where("b is not null").select("a", "b"))
    linked = found.where("b is null").groupBy(F.col("a").alias("f1")).agg(F.sum("linked").alias("linked"))
    counted = component.join(linked, "f1", "left").select(
        "f1", "f2", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    known = own.where("n > 0").join(counted, ["f1", "f2"]).select("id", "n", "component_id", "n_links")
    return known.union(own.where("n = 0").select("id", "n", "id", F.lit(0).cast("long"))).select(
        _real("id").alias("doc_id"), F.col("n").alias("n_shingles"), _real("component_id").alias("component_id"), "n_links"
    )


def _components(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """doc_id and component_id of every document, by a spanning part of the links."""
    made, rows, _ = _matrix(keyed(df, text, id_column))
    own, component = _labelled(made, stage(links(rows), "links"))
    known = own.where("n > 0").join(component, ["f1", "f2"]).select("id", "component_id")
    return known.union(own.where("n = 0").select("id", "id")).select(_real("id").alias("doc_id"), _real("component_id").alias("component_id"))


def _kept_rows(docs: DataFrame) -> DataFrame:
    """(id, text_hash) of the row that stays of each component, by a spanning part of the links.

    The smallest identifier stays, of rows that share it or have none the smallest hash.
    """
    made, rows, _ = _matrix(docs)
    label = components(stage(links(rows), "links")).select(F.col("node").alias("f1"), "label")
    own = made.where("n > 0").select("id", "text_hash", "f1").join(label, "f1", "left")
    least = own.groupBy(F.coalesce("label", "f1").alias("label")).agg(F.min(F.struct("id", "text_hash")).alias("least"))
    return least.select("least.id", "least.text_hash")


def keep_one(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row of each component, all columns unchanged; rows without words are linked with nothing and all stay.

    The row with the smallest identifier stays. Rows that share an identifier, or have
    none, are told apart by their texts; of rows equal in both any one stays.
    """
    kept = _kept_rows(keyed(df, text, id_column)).select(F.col("id").alias("_kept"), F.col("text_hash").alias("_hash"))
    own = keyed(df, text, id_column, tuple(df.columns)).select("row", "id", "text_hash", F.col("text").rlike(WORD).alias("_words"))
    same = (F.col("id") == F.col("_kept")) & (F.col("text_hash") == F.col("_hash"))
    linked = own.where("_words").join(kept, same, "left_semi").dropDuplicates(["id", "text_hash"])
    stays = linked.unionByName(own.where("not _words"))
    return stays.select(*(F.col("row").getField(c).alias(c) for c in df.columns))


#: Shingles as texts, links by counted overlaps, components by following links.
ORACLE = """
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON b.g = a.g AND b.doc_id <> a.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
r(x, least) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.y, r.least FROM r JOIN l ON l.x = r.x),
c AS (SELECT x, min(least) AS component_id FROM r GROUP BY x),
m AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM d JOIN c ON c.x = d.doc_id LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""


@llm_query("op1_ngram_join", ORACLE)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
