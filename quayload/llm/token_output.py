"""Operator 8: token ids in training order, as fixed-stride binary shards.

Packed sequences are numbered 0 to n - 1. A keyed Feistel permutation over the smallest
even number of bits that holds n, walked along its cycle until it lands below n, gives
every sequence its slot in training order: no sort by random keys, no table of
positions, and any slot can be turned back into its sequence. Slots are cut into ranges
of ``shard_sequences``; one task writes one shard, so a task's memory does not depend on
the corpus. A sequence takes ``capacity`` ids of fixed width in its shard, padded at the
end: slot k lies at a known byte of a known file, and a reader goes on from any slot.

Files are named once they are whole, in the result; a retried task writes under a new
name. Defined results: null and empty texts are an end token; documents that repeat are
sequences of their own; an empty table writes no shard; ids that do not fit the width are
an error; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm import packing
from quayload.llm.chunked import from_planes
from quayload.llm.hashing import U64, mix
from quayload.llm.registry import llm_query
from quayload.llm.workspace import discard, release, stage
from quayload.plans.registry import table
from quayload.session import shared_path

ROUNDS = 6
SHARD_SEQUENCES = 4096
PAD_ID = 0
#: Shards are written in so many runs, in turns, so that shuffles hold only a part of the ids at a time.
RUNS = 2


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of 0 .. n - 1."""

    n: int
    key: int

    @property
    def half(self) -> int:
        return max(1, -(-max(1, (self.n - 1).bit_length()) // 2))

    def _round(self, value: np.ndarray, number: int) -> np.ndarray:
        return mix(value + U64((self.key + 0x9E3779B97F4A7C15 * (number + 1)) % (1 << 64))) & U64((1 << self.half) - 1)

    def _once(self, value: np.ndarray, back: bool) -> np.ndarray:
        half, mask = U64(self.half), U64((1 << self.half) - 1)
        left, right = value >> half, value & mask
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(left, number), left
            else:
                left, right = right, left ^ self._round(right, number)
        return left << half | right

    def _walk(self, value: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(value, U64), back)
        while (outside := np.flatnonzero(out >= U64(self.n))).size:
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


def place(packed: DataFrame, order: Feistel) -> DataFrame:
    """``packed`` pieces with the ``slot`` of their sequence."""
    names = packed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = order.slots(batch.column("sequence_id").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slots)], [*names, "slot"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema.fields)
    return packed.mapInArrow(run, schema + ", slot long")


def write_shards(
    placed: DataFrame, folder: str, capacity: int = packing.CAPACITY, shard_sequences: int = SHARD_SEQUENCES, width: int = 2
) -> DataFrame:
    """Write pieces (doc_id, slot, sequence_id, offset, ids) as shards; one row per sequence.

    ``ids`` are lists or compressed by :func:`chunked.planes`. The rows have
    slot, sequence_id, path, byte_offset, n_tokens, ids_crc32 (of the unpadded ids as
    unsigned 32-bit integers) and doc_ids in the order of their pieces.
    """
    schema = pa.schema([
        ("slot", pa.int64()), ("sequence_id", pa.int64()), ("shard", pa.int64()), ("path", pa.string()), ("byte_offset", pa.int64()),
        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ])

    def write(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("slot", "ascending"), ("offset", "ascending")])
        slots, sequences, docs = (rows.column(c).to_pylist() for c in ("slot", "sequence_id", "doc_id"))
        lists = rows.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        if pa.types.is_list(lists.type):
            flat, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        else:
            parts = [from_planes(p.as_py()) for p in lists]
            flat, bounds = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        if len(flat) and int(flat.max()) >= 1 << 8 * width:
            raise ValueError(f"an id does not fit {width} bytes")
        shard = rows.column("shard")[0].as_py()
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
        out, start, last = [], 0, shard * shard_sequences - 1
        with system.open_output_stream(f"{path}/{name}") as stream:
            for end in [*(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]:
                ids = flat[bounds[start] : bounds[end]]
                if slots[start] != last + 1 or len(ids) > capacity:
                    raise ValueError("a shard's sequences are not whole")
                last = slots[start]
                block = np.full(capacity, PAD_ID, f"<u{width}")
                block[: len(ids)] = ids
                stream.write(block.tobytes())
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                at = (last - shard * shard_sequences) * capacity * width
                out.append((last, sequences[start], shard, f"{folder}/{name}", at, len(ids), crc, docs[start:end]))
                start = end
        return pa.table([list(c) for c in zip(*out, strict=True)], schema=schema)

    sharded = placed.select("doc_id", "slot", "sequence_id", "offset", "ids", F.expr(f"slot div {shard_sequences}").alias("shard"))
    return sharded.groupBy("shard").applyInArrow(
        write,
        "slot long, sequence_id long, shard long, path string, byte_offset long, n_tokens long, ids_crc32 long, doc_ids array<long>",
    )


def read_slots(
    paths: dict[int, str], first: int, count: int, capacity: int = packing.CAPACITY, shard_sequences: int = SHARD_SEQUENCES, width: int = 2
) -> Iterator[np.ndarray]:
    """Padded sequences from slot ``first`` on, read in order; ``paths`` has the files by shard."""
    stride, slot = capacity * width, first
    while slot < first + count:
        shard, inside = divmod(slot, shard_sequences)
        take = min(shard_sequences - inside, first + count - slot)
        system, path = fs.FileSystem.from_uri(paths[shard])
        with system.open_input_file(path) as file:
            file.seek(inside * stride)
            for _ in range(take):
                yield np.frombuffer(file.read(stride), f"<u{width}")
        slot += take


def materialise(docs: DataFrame, tokenizer: str, folder: str, key: int, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """Tokenise, pack, order and write whole documents; the rows of :func:`write_shards`."""
    pieces = stage(packing.tokenize(docs, tokenizer, compressed=True), "id-pieces")
    last = packing.pack(pieces.drop("ids")).agg(F.max("sequence_id")).first()[0]
    order = Feistel(1 if last is None else last + 1, key)
    placed = place(packing.pack(pieces), order).select("doc_id", "slot", "sequence_id", "offset", "ids")
    placed = stage(placed, "placed")
    # The ids are on disk no more than three times; beside the shards once, and the part that is on its way.
    discard(pieces)
    shards = []
    for run in range(min(RUNS, -(-order.n // shard_sequences))):
        release(docs.sparkSession)
        part = placed.where(F.expr(f"(slot div {shard_sequences}) % {RUNS} = {run}"))
        shards.append(stage(write_shards(part, folder, shard_sequences=shard_sequences), "shard-index"))
    discard(placed)
    return reduce(DataFrame.unionAll, shards)


@llm_query("op8_token_output")
def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return materialise(table(spark, sf_dir, "documents"), tokenizer, shared_path(spark, "shards"), 20240229).drop("path")
