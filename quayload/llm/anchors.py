"""Find and route the repeated windows of a corpus, whatever its size.

A window is a fixed number of consecutive symbols (bytes or words) of one text. Each has
an anchor: the position of the smallest hash among the short grams inside it, the leftmost
one on ties. Equal windows have equal anchors at equal offsets, and neighbouring windows
mostly share theirs, so a text is a series of runs of windows with one anchor each, and a
segment (the symbols of a run) stands for all its windows.

``repeated_anchors`` tells per document which anchors have a gram that occurs elsewhere:
only 32 bits a gram are shuffled, and a gram that one unit of texts holds many times is
sent once. ``resolve`` sends the segments of those anchors to the task of their gram and
lets an exact structure decide there which windows are repeats. Equal segments of one
batch are sent once. A gram that more documents hold than ``HOT`` would gather in one
task, so its windows travel alone, dealt by their own content.

Decisions do not depend on hashes: hashes only bring windows together, and every
comparison is of the symbols themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayload.llm.hashing import U64, Words, chunks, mix, stream, text_bytes, window_hashes
from quayload.llm.workspace import release, shuffle_partitions, stage

#: Symbols' text that one unit of questions covers.
UNIT_BYTES = 32 << 20
#: Occurrences of a gram from which its windows are dealt one by one.
HOT = 2000
LOW = U64(0xFFFFFFFF)
MANY = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Scheme:
    """Symbols, window and gram of one operator; a gram of bytes is a multiple of 8."""

    symbols: str
    window: int
    gram: int


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays in one byte string, each with its type and length."""
    return b"".join(a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + a.tobytes() for a in arrays)


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = np.dtype(data[at : at + 4].decode().strip()), int.from_bytes(data[at + 4 : at + 12], "little")
        out.append(np.frombuffer(data, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Runs:
    """Runs of windows of the texts ``first`` to ``last`` of a batch.

    Per run: ``owner`` (text, counted from ``first``), ``start`` (its first window) and
    ``anchor``, both as symbols from the text's start, ``count`` of windows and ``gram``
    hash of the anchor.
    """

    def __init__(self, scheme: Scheme, raw: np.ndarray, offsets: np.ndarray, first: int, last: int):
        self.scheme = scheme
        if scheme.symbols == "words":
            self.words = Words(raw, offsets, first, last)
            self.bounds = self.words.bounds
            hashes = self.words.hashes()
            grams = window_hashes(hashes, scheme.gram)
        else:
            self.data = raw[offsets[first] : offsets[last]]
            self.bounds = offsets[first : last + 1] - offsets[first]
            grams = _byte_grams(self.data, scheme.gram)
        n, window = int(self.bounds[-1]), scheme.window
        windows = n - window + 1
        if windows <= 0:
            grams, windows = np.zeros(0, U64), 0
        packed = (grams & ~LOW) | np.arange(len(grams), dtype=U64)
        anchors = (_sliding_min(packed, window - scheme.gram + 1)[:windows] & LOW).astype(np.int64) if windows else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(self.bounds))
        left, right = owner[:windows], owner[window - 1 : window - 1 + windows]
        inside = left == right
        new = np.ones(windows, bool)
        if windows:
            new[1:] = (anchors[1:] != anchors[:-1]) | (left[1:] != left[:-1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, windows))
        keep = inside[begin]
        begin, self.count = begin[keep], length[keep]
        self.owner = left[begin]
        base = self.bounds[self.owner]
        self.start, self.anchor = begin - base, anchors[begin] - base
        self.gram = grams[anchors[begin]]

    def segment(self, owner: int, start: int, count: int) -> bytes:
        """The symbols of ``count`` windows from ``start`` on; words keep the blanks between them."""
        a = int(self.bounds[owner]) + start
        b = a + count - 1 + self.scheme.window
        if self.scheme.symbols == "words":
            return self.words.data[self.words.starts[a] : self.words.ends[b - 1]].tobytes()
        return self.data[a:b].tobytes()


def _byte_grams(data: np.ndarray, width: int) -> np.ndarray:
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    padded = data.tobytes() + bytes(8)
    eight = np.empty(len(data), U64)
    for shift in range(min(8, len(data))):
        part = np.frombuffer(padded, "<u8", (len(padded) - shift) // 8, shift)
        target = eight[shift::8]
        target[:] = part[: len(target)]
    factors = stream(37, width // 8) | U64(1)
    out = np.zeros(n, U64)
    for i in range(width // 8):
        out += mix(eight[8 * i : 8 * i + n]) * factors[i]
    return mix(out)


# ---- which anchors are repeated -----------------------------------------------------------------


class _Unit:
    """Anchors of many texts, and the questions about them."""

    def __init__(self, number: int):
        self.number, self.bytes, self.symbols = number, 0, 0
        self.ids, self.hashes, self.starts, self.grams, self.places = [], [], [], [], []

    def add(self, runs: Runs, ids: np.ndarray, hashes: np.ndarray) -> None:
        self.ids.append(ids)
        self.hashes.append(hashes.ravel())
        self.starts.append(self.symbols + runs.bounds[:-1])
        self.grams.append(runs.gram)
        self.places.append((self.symbols + runs.bounds[runs.owner] + runs.anchor).astype(np.uint32))
        self.symbols += int(runs.bounds[-1])

    def rows(self, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        grams, places = np.concatenate(self.grams), np.concatenate(self.places)
        order = np.argsort(grams, kind="stable")
        grams, places = grams[order], places[order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(grams)))
        many = np.repeat(count > 1, count)
        heads = np.repeat(places[begin], count)
        table = pack_arrays(
            np.concatenate(self.ids), np.concatenate(self.hashes), np.concatenate(self.starts).astype(np.int64), heads[many], places[many]
        )
        # A group of its own: this row only passes through to its unit.
        yield buckets + self.number, self.number, table
        asked = grams[begin]
        target = asked % U64(buckets)
        order = np.argsort(target, kind="stable")
        rest = ((asked >> U64(20)) & LOW).astype(np.uint32)
        cuts = np.searchsorted(target[order], np.arange(buckets + 1, dtype=U64))
        for bucket in range(buckets):
            own = order[cuts[bucket] : cuts[bucket + 1]]
            if len(own):
                yield bucket, self.number, pack_arrays(rest[own], places[begin][own], count[own].astype(np.uint32))


def _answers(table: pa.Table, buckets: int) -> pa.Table:
    """For one bucket: which asked grams other units hold too, and which are hot."""
    schema = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
    units, payloads = table.column("unit").to_pylist(), table.column("payload").to_pylist()
    if table.num_rows == 0 or table.column("bucket")[0].as_py() >= buckets:
        return pa.table([units, [0] * len(units), payloads], schema=schema)
    parts = [unpack_arrays(p) for p in payloads]
    rest, place, count = (np.concatenate([p[i] for p in parts]) for i in range(3))
    source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    order = np.argsort(rest, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = rest[order][1:] != rest[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    asked = np.bincount(group)
    total = np.bincount(group, count)
    hot = total[group] > HOT
    known = (asked[group] > 1) | hot
    at = np.flatnonzero(known)
    cuts = np.searchsorted(source[at], np.arange(len(units) + 1))
    rows = [
        (unit, 1, pack_arrays(place[at[a:b]], hot[at[a:b]].astype(np.uint8)))
        for unit, a, b in zip(units, cuts[:-1], cuts[1:], strict=True)
        if b > a
    ]
    return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []], schema=schema)


def _by_document(table: pa.Table) -> pa.Table:
    """For one unit: the repeated anchors of each of its documents."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.binary()), ("anchors", pa.binary())])
    own, places, hot = None, [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)]
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
        if kind == 0:
            own = unpack_arrays(payload)
        else:
            a, b = unpack_arrays(payload)
            places.append(a)
            hot.append(b)
    ids, hashes, starts, heads, every = own
    hashes = hashes.reshape(-1, 2)
    place, is_hot = np.concatenate(places), np.concatenate(hot)
    hottest = np.sort(place[is_hot > 0])
    at = np.searchsorted(hottest, heads)
    head_hot = (at < len(hottest)) & (hottest[np.minimum(at, len(hottest) - 1)] == heads) if len(hottest) else np.zeros(len(heads), bool)
    single = ~np.isin(place, heads)
    place = np.concatenate([place[single], every]).astype(np.int64)
    is_hot = np.concatenate([is_hot[single], head_hot.astype(np.uint8)])
    order = np.argsort(place)
    place, is_hot = place[order], is_hot[order]
    # Empty texts share their start with the next one, which comes last.
    owner = np.searchsorted(starts, place, side="right") - 1
    rows = []
    cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        doc = int(owner[a])
        rows.append((int(ids[doc]), hashes[doc].tobytes(), pack_arrays((place[a:b] - starts[doc]).astype(np.uint32), is_hot[a:b])))
    return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []], schema=schema)


#: Stands for a null identifier inside kernels: it is later than any other.
NULL_ID = (1 << 63) - 1


def keyed(df: DataFrame, text: str, id_column: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """id, text and text_hash, which tell rows apart even where identifiers repeat; other columns in struct ``row``."""
    rows = df.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        *([F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row")] if carried else []),
    )
    # 128 bits: all rows without identifier share one, so the texts of one may be as many as the corpus has.
    return rows.withColumn("text_hash", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))


def hash_halves(column: pa.Array) -> np.ndarray:
    """The two 64-bit halves of each text hash, one row a text."""
    return text_bytes(column)[0].view(np.int64).reshape(-1, 2)


def _halves(hashes: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)


def repeated_anchors(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, text_hash, anchors) of the documents that hold grams which occur elsewhere."""
    buckets = 4 * shuffle_partitions(docs.sparkSession)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made, unit = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            hashes = hash_halves(batch.column("text_hash"))
            for first, last in chunks(offsets):
                if unit is None:
                    unit = _Unit(base + made)
                    made += 1
                unit.add(Runs(scheme, raw, offsets, first, last), ids[first:last], hashes[first:last])
                unit.bytes += int(offsets[last] - offsets[first])
                if unit.bytes >= UNIT_BYTES:
                    yield _row_batch(unit.rows(buckets))
                    unit = None
        if unit is not None:
            yield _row_batch(unit.rows(buckets))

    asked = docs.mapInArrow(ask, "bucket long, unit long, payload binary")
    answered = asked.groupBy("bucket").applyInArrow(
        lambda t: _answers(t, buckets), "unit long, kind int, payload binary"
    )
    found = answered.groupBy("unit").applyInArrow(_by_document, "id long, text_hash binary, anchors binary")
    return found.groupBy("id", "text_hash").agg(F.collect_list("anchors").alias("anchors"))


def _row_batch(rows: Iterator[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "unit", "payload"])


# ---- segments and their windows -----------------------------------------------------------------


class Ranked:
    """Equal contents once, with their earliest holders; all later ones are decided.

    Earlier is a smaller document or, with ``within``, also an earlier place in the same one.
    """

    def __init__(self, within: bool):
        self.within = within
        #: Holders (document, first window, text hash, windows) by (place of the gram, content).
        self.held: dict[tuple[int, bytes], list[tuple[int, int, bytes, int]]] = {}
        self.decided: list[tuple[int, int, bytes, int]] = []

    def add(self, key: tuple[int, bytes], doc: int, start: int, text_hash: bytes, count: int) -> None:
        mine = (doc, start, text_hash, count)
        held = self.held.get(key)
        if held is None:
            self.held[key] = [mine]
            return
        rank = 2 if self.within else 1
        if mine[:rank] > held[0][:rank]:
            self.decided.append(mine)
        elif mine[:rank] < held[0][:rank]:
            self.decided += held
            self.held[key] = [mine]
        else:
            held.append(mine)


#: Place of the gram of a window that travels alone: all of it is the gram.
ALONE = 0xFFFF


def _mail(ranked: Ranked, targets: dict[tuple[int, bytes], int], buckets: int) -> Iterator[tuple[int, bytes]]:
    """Segments by bucket, and what is decided already."""
    by_bucket: dict[int, list] = {}
    for (place, body), holders in ranked.held.items():
        by_bucket.setdefault(targets[place, body], []).extend((place, body, *h) for h in holders)
    for bucket, items in by_bucket.items():
        places, bodies, docs, starts, hashes, counts = zip(*items, strict=True)
        # A text may hold many of a bucket's segments; its key is sent once.
        numbers: dict[tuple[int, bytes], int] = {}
        own = [numbers.setdefault(key, len(numbers)) for key in zip(docs, hashes, strict=True)]
        packed = pack_arrays(
            np.array([d for d, _ in numbers], np.int64), _halves(h for _, h in numbers).ravel(), np.array(own, np.uint32),
            np.array(starts, np.uint32), np.array(counts, np.uint16), np.array(places, np.uint16),
            np.array([len(b) for b in bodies], np.uint32), np.frombuffer(b"".join(bodies), np.uint8),
        )
        # Segments repeat most of their neighbours' text, which the shuffle's own light codec does not use.
        yield bucket, len(packed).to_bytes(8, "little") + pa.Codec("zstd").compress(packed, asbytes=True)
    if ranked.decided:
        # Any bucket will do: these rows only pass through.
        yield buckets + ranked.decided[0][0] % buckets, _decided_arrays(ranked.decided)


def _decided_arrays(decided: list[tuple[int, int, bytes, int]]) -> bytes:
    docs, starts, hashes, counts = zip(*decided, strict=True)
    return pack_arrays(np.array(docs, np.int64), np.array(starts, np.uint32), _halves(hashes).ravel(), np.array(counts, np.uint32))


def segments(docs: DataFrame, anchors: DataFrame, scheme: Scheme, within: bool) -> DataFrame:
    """(bucket, payload): the segments of repeated anchors, dealt by gram."""
    import xxhash

    buckets = 4 * shuffle_partitions(docs.sparkSession)
    joined = docs.join(anchors, ["id", "text_hash"]).select("id", "text_hash", "text", "anchors")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            ids, hashes = (batch.column(c).to_pylist() for c in ("id", "text_hash"))
            flagged = batch.column("anchors")
            ranked, targets, held = Ranked(within), {}, 0
            for first, last in chunks(offsets):
                runs = Runs(scheme, raw, offsets, first, last)
                known = [[unpack_arrays(p) for p in flagged[i].as_py()] for i in range(first, last)]
                places = np.concatenate([p[0] + (np.int64(k) << 32) for k, own in enumerate(known) for p in own])
                hot = np.concatenate([p[1] for own in known for p in own])
                order = np.argsort(places)
                places, hot = places[order], hot[order]
                mine = runs.anchor + (runs.owner.astype(np.int64) << 32)
                at = np.minimum(np.searchsorted(places, mine), len(places) - 1)
                sent = np.flatnonzero(places[at] == mine)
                for i, is_hot in zip(sent.tolist(), hot[at[sent]].tolist(), strict=True):
                    owner, start, count = int(runs.owner[i]), int(runs.start[i]), int(runs.count[i])
                    doc, text_hash = ids[first + owner], hashes[first + owner]
                    if is_hot:
                        for k in range(start, start + count):
                            body = _plain(scheme, runs.segment(owner, k, 1))
                            ranked.add((ALONE, body), doc, k, text_hash, 1)
                            targets[ALONE, body] = xxhash.xxh64_intdigest(body) % buckets
                    else:
                        body = _plain(scheme, runs.segment(owner, start, count))
                        key = (int(runs.anchor[i]) - start, body)
                        ranked.add(key, doc, start, text_hash, count)
                        targets[key] = int(runs.gram[i]) % buckets
                        held += len(body)
                if held > UNIT_BYTES:
                    yield _mail_batch(_mail(ranked, targets, buckets))
                    ranked, targets, held = Ranked(within), {}, 0
            yield _mail_batch(_mail(ranked, targets, buckets))

    return joined.mapInArrow(send, "bucket int, payload binary")


def _plain(scheme: Scheme, body: bytes) -> bytes:
    return b" ".join(body.split()) if scheme.symbols == "words" else body


def _mail_batch(rows: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["bucket", "payload"])


@dataclass
class Contest:
    """Different segments that share a gram: their bodies and holders (document, first window, text hash, windows)."""

    bodies: list[bytes]
    holders: list[tuple[int, int, bytes, int]]


#: From a contest to (segment, offset of a window in it) pairs of the windows that an earlier holder has too.
Decide = Callable[[Contest], tuple[np.ndarray, np.ndarray]]


def _gram(scheme: Scheme, place: int, body: bytes) -> bytes:
    if place == ALONE:
        return b""
    if scheme.symbols == "words":
        return b" ".join(body.split(b" ", place + scheme.gram)[place : place + scheme.gram])
    return body[place : place + scheme.gram]


def resolve(mail: DataFrame, scheme: Scheme, within: bool, decide: Decide, buckets: int) -> DataFrame:
    """(id, text_hash, starts, counts): runs of windows to remove, by document; several rows a document."""

    def run(table: pa.Table) -> pa.Table:
        payloads = table.column("payload").to_pylist()
        ranked = Ranked(within)
        if table.num_rows and table.column("bucket")[0].as_py() >= buckets:
            found = [unpack_arrays(p) for p in payloads]
            return _removed(*(np.concatenate([f[i] for f in found]) for i in range(4)))
        for payload in payloads:
            packed = pa.Codec("zstd").decompress(payload[8:], int.from_bytes(payload[:8], "little"), asbytes=True)
            docs, hashes, own, starts, counts, places, lengths, data = unpack_arrays(packed)
            keys = [(doc, half.tobytes()) for doc, half in zip(docs.tolist(), hashes.reshape(-1, 2), strict=True)]
            body, at = data.tobytes(), 0
            for number, start, count, place, length in zip(*(x.tolist() for x in (own, starts, counts, places, lengths)), strict=True):
                doc, text_hash = keys[number]
                ranked.add((place, body[at : at + length]), doc, start, text_hash, count)
                at += length
        # Different segments compete where they hold the same gram.
        grams: dict[bytes, int] = {}
        for place, body in ranked.held:
            gram = _gram(scheme, place, body)
            grams[gram] = grams.get(gram, 0) + 1
        contest = Contest([], [])
        for (place, body), holders in ranked.held.items():
            if grams[_gram(scheme, place, body)] > 1:
                contest.bodies += [body] * len(holders)
                contest.holders += holders
        decided = _columns(ranked.decided)
        if contest.bodies:
            segment, offset = decide(contest)
            docs, starts, hashes, _ = (c[segment] for c in _columns(contest.holders))
            found = (docs, starts + offset, hashes, np.ones(len(segment), np.int64))
            decided = [np.concatenate([a, b]) for a, b in zip(decided, found, strict=True)]
        return _removed(*decided)

    return mail.groupBy("bucket").applyInArrow(run, "id long, text_hash binary, starts binary, counts binary")


def _columns(holders: list[tuple[int, int, bytes, int]]) -> list[np.ndarray]:
    """Documents, first windows, text hashes (two halves a row) and windows of holders."""
    docs, starts, hashes, counts = zip(*holders, strict=True) if holders else ((), (), (), ())
    return [np.array(docs, np.int64), np.array(starts, np.int64), _halves(hashes), np.array(counts, np.int64)]


def _removed(docs: np.ndarray, starts: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> pa.Table:
    """Decided windows by document."""
    hashes = hashes.reshape(-1, 2)
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.binary()), ("starts", pa.binary()), ("counts", pa.binary())])
    order = np.lexsort((starts, hashes[:, 1], hashes[:, 0], docs))
    docs, starts, hashes, counts = docs[order], starts[order], hashes[order], counts[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1]).any(1)
    cuts = np.append(np.flatnonzero(new), len(docs))
    starts, counts = starts.astype(np.uint32), counts.astype(np.uint32)
    rows = [(int(docs[a]), hashes[a].tobytes(), starts[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []], schema=schema)


def repeated_windows(docs: DataFrame, scheme: Scheme, within: bool, decide: Decide) -> DataFrame:
    """Per document of ``keyed`` docs: (id, text_hash, starts, counts), lists of packed runs of windows to remove."""
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    # Each step is written, so that the shuffles before it can go.
    later = stage(copies(docs), "copies")
    anchors = repeated_anchors(docs, scheme).join(later.select("id", "text_hash"), ["id", "text_hash"], "left_anti")
    anchors = stage(anchors, "anchors")
    release(spark)
    found = stage(resolve(segments(docs, anchors, scheme, within), scheme, within, decide, buckets), "repeats")
    release(spark)
    return found.union(later).groupBy("id", "text_hash").agg(F.collect_list("starts").alias("starts"), F.collect_list("counts").alias("counts"))


def copies(docs: DataFrame) -> DataFrame:
    """Documents whose whole text a smaller identifier has too, with all their windows to remove.

    Their segments need not travel: what they hold, the smallest of them holds earlier.
    """
    own = docs.select("id", "text_hash", F.sha2("text", 256).alias("sha"))
    first = own.groupBy("sha").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    every = lambda value: F.lit(np.array([value], np.uint32).tobytes())
    return own.join(first, "sha").where("id > least").select("id", "text_hash", every(0).alias("starts"), every(0xFFFFFFFF).alias("counts"))


def covered(n: int, window: int, starts: list[bytes], counts: list[bytes]) -> np.ndarray:
    """Which of ``n`` symbols the given runs of windows cover."""
    begin = np.concatenate([np.frombuffer(s, np.uint32) for s in starts]).astype(np.int64)
    count = np.concatenate([np.frombuffer(c, np.uint32) for c in counts]).astype(np.int64)
    # A copy's windows are given without their number.
    count = np.minimum(count, n - window + 1 - begin)
    begin, count = begin[count > 0], count[count > 0]
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + count - 1 + window, -1)
    return np.cumsum(steps[:n]) > 0
