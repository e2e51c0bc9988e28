"""Cut texts into chunks that a tokenizer treats alone, and keep each chunk's ids.

Chunks are whitespace-delimited pieces. A batch's new chunks are encoded once; every
text is then the concatenation of its chunks' ids. The store of known chunks is bounded
in bytes and belongs to one Python worker.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from quayload.llm.hashing import chunks as byte_ranges
from quayload.llm.hashing import text_bytes

#: What a worker keeps of known chunks, and the longest chunk it keeps; longer ones are encoded each time.
KEPT_BYTES = 150 << 20
LONGEST_KEPT = 256
#: Text that is coded at once.
SLICE_BYTES = 4 << 20
_PRESS = zstandard.ZstdCompressor(level=3)
#: Of a kept chunk besides its characters and ids.
_ENTRY = 210


class ChunkStore:
    """ids of chunks as little-endian unsigned 32-bit bytes; the store of known ones is bounded in bytes."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], limit: int = KEPT_BYTES):
        self.encode_many, self.limit = encode_many, limit
        self.known: dict[str, bytes] = {}
        self.size = 0

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of ``chunks``, which are distinct."""
        if self.size > self.limit:
            self.known, self.size = {}, 0
        known = self.known
        out = list(map(known.get, chunks))
        new = [i for i, ids in enumerate(out) if ids is None]
        made = self.encode_many([chunks[i] for i in new])
        for i, ids in zip(new, made, strict=True):
            out[i] = ids
            c = chunks[i]
            if len(c) <= LONGEST_KEPT:
                known[c] = ids
                self.size += _ENTRY + len(c) + len(ids)
        return out

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its chunks."""
        distinct = list(set().union(*texts))
        ids = dict(zip(distinct, self.ids_of(distinct), strict=True))
        return [b"".join(map(ids.__getitem__, t)) for t in texts]

    def encode_split(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, cut at white space as :meth:`str.split` does.

        Chunks are coded by Arrow and looked up once a call, ids are gathered by their codes.
        """
        lists = pc.utf8_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        packed = pa.array(self.ids_of(distinct), pa.large_binary())
        found = packed.take(coded.indices)
        _, offsets, data = found.buffers()
        # Where the ids of each chunk begin; of each text, where its first chunk's do.
        begins = np.frombuffer(offsets, np.int64, len(found) + 1) if len(found) else np.zeros(1, np.int64)
        bounds = begins[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))].tolist()
        return [data.slice(a, b - a).to_pybytes() if b > a else b"" for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def give_back() -> None:
    """Return freed memory to the system; a worker that waits for its next task would keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about 4 MiB of text each; a longer text is a part of its own."""
    if batch.num_rows:
        _, offsets = text_bytes(batch.column(column))
        for first, last in byte_ranges(offsets, SLICE_BYTES):
            yield batch.slice(first, last - first)


def planes(ids: bytes) -> bytes:
    """Packed ids, their bytes by significance, compressed: what shuffles and staged tables carry of them."""
    return _PRESS.compress(np.ascontiguousarray(np.frombuffer(ids, np.uint8).reshape(-1, 4).T))


def from_planes(blob: bytes) -> np.ndarray:
    parts = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(parts.T).view("<u4").ravel()


def id_lists(encoded: list[bytes]) -> pa.Array:
    """Arrow lists of 32-bit ids from packed ids."""
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
    values = np.frombuffer(b"".join(encoded), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
