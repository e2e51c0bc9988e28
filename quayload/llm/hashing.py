"""Vector kernels over batches of whole texts: words, word hashes, window hashes.

Texts of one Arrow batch are laid end to end in one byte array, each followed by a
blank, so that no word or window can run from one text into the next. All kernels
are plain numpy over that array and run inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Bytes of text that one kernel call works on; longer batches are cut between texts. A call's
# arrays take some fifty times as much.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection on 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE_CODES = stream(11, 256)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U64)
    if n > 1:
        out[1:] = U64(base)
        np.multiply.accumulate(out, out=out)
    return out


_POWERS: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept up to a fixed length and made anew above it."""
    if n > 2 * CHUNK_BYTES:
        return _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    if not _POWERS:
        _POWERS.extend((_powers(_BASE, 2 * CHUNK_BYTES), _powers(_BASE_INVERSE, 2 * CHUNK_BYTES)))
    return _POWERS[0][:n], _POWERS[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


class Words:
    """Words of the texts ``first`` to ``last`` of a batch.

    ``starts``/``ends`` are byte positions in ``data``; ``owner`` is the text of each
    word, counted from ``first``; ``bounds[i]`` is the first word of text i.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, first: int, last: int, lower: bool = False):
        own = offsets[first : last + 1] - offsets[first]
        count = last - first
        data = np.full(int(own[-1]) + count, 32, np.uint8)
        body = raw[offsets[first] : offsets[last]]
        keep = np.ones(len(data), bool)
        keep[own[1:] + np.arange(count)] = False
        data[keep] = LOWER[body] if lower else body
        self.data = data
        space = _IS_SPACE[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = not space[0] if len(data) else False
        edge[1:-1] = space[1:] != space[:-1]
        edge[-1] = False
        at = np.flatnonzero(edge)
        self.starts, self.ends = at[0::2], at[1::2]
        self.text_starts = own[:-1] + np.arange(count)
        self.bounds = np.searchsorted(self.starts, np.append(self.text_starts, len(data)))
        self.owner = np.repeat(np.arange(count), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of every word."""
        n = len(self.data)
        power, inverse = power_tables(n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE_CODES[self.data] * power[:n], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(U64))


def window_hashes(words: np.ndarray, width: int, seed: int = 23) -> np.ndarray:
    """A hash of every ``width`` consecutive entries, texts not minded."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    factors = stream(seed, width) | U64(1)
    out = words[:n] * factors[0]
    for i in range(1, width):
        out += words[i : i + n] * factors[i]
    return mix(out)


def shingle_sets(words: Words, width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words has one shingle, its whole sequence; one without words none.
    """
    hashes = words.hashes()
    every = window_hashes(hashes, width)
    for first, last in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if last - first >= width:
            yield np.unique(every[first : last - width + 1])
        elif last > first:
            yield window_hashes(hashes[first:last], int(last - first), 29 + int(last - first))
        else:
            yield np.zeros(0, U64)
