"""Operator 7: byte-level BPE encoding and decoding.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over the
vocabulary finds, in one pass over a piece, the longest token that starts at each
byte. The encoder walks from left to right with longest matches and backtracks where
two neighbours would not stand next to each other in a BPE result. A sequence is the
BPE result exactly when every adjacent pair is its own encoding; that verdict on pairs
is made once by plain merging of the two tokens' bytes and memoised. Positions found
dead are marked, so each is left at most once and the work is linear in the piece.

Defined results: null and empty text give no ids and decode to empty bytes; rows are
encoded one by one, so ties and repeated rows do not matter; texts of any length are
encoded whole; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.chunked import ChunkStore, id_lists, text_slices
from quayload.llm.registry import llm_query
from quayload.plans.registry import table

PAIR_LIMIT = 1_000_000
NO_RANK = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes by rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def merge_plainly(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """BPE by definition: merge the pair of lowest rank, the leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    joined = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
    while joined:
        best = min(joined)
        if best == NO_RANK:
            break
        at = joined.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        # Only the neighbours of the new part have another pair.
        del joined[at]
        if at:
            joined[at - 1] = ranks.get(parts[at - 1] + parts[at], NO_RANK)
        if at < len(joined):
            joined[at] = ranks.get(parts[at] + parts[at + 1], NO_RANK)
    return parts


class ByteBpe:
    """Encoder and decoder for one vocabulary of byte ranks and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.risky = regex.compile(r"\s ")
        self.tokens = [b""] * (max(ranks.values()) + 1)
        automaton = ahocorasick.Automaton()
        #: Tokens that merging can make; a token that it cannot make only ever stands for a whole piece.
        self.made: set[bytes] = set()
        for token, rank in ranks.items():
            self.tokens[rank] = token
            if merge_plainly(token, ranks) == [token]:
                self.made.add(token)
                automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        self.automaton = automaton
        self.lengths = [len(t) for t in self.tokens]
        self.shorter: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}
        self.store = ChunkStore(self._encode_chunks)

    def _prefix(self, token: int) -> int:
        """The longest shorter token that ``token`` begins with, or -1."""
        if token not in self.shorter:
            whole = self.tokens[token]
            fits = (self.ranks[whole[:n]] for n in range(len(whole) - 1, 0, -1) if whole[:n] in self.made)
            self.shorter[token] = next(fits, -1)
        return self.shorter[token]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens, merged plainly, give the two tokens again."""
        if len(self.pairs) >= PAIR_LIMIT:
            self.pairs.clear()
        both = [self.tokens[left], self.tokens[right]]
        verdict = self.pairs[left << 32 | right] = merge_plainly(both[0] + both[1], self.ranks) == both
        return verdict

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, lengths, pairs = len(piece), self.lengths, self.pairs
        longest = [-1] * n
        # Matches come in order of their ends, so the last one of a start is its longest.
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token
        dead: set[int] = set()
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if at + lengths[token] not in dead:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | token)
                    if self._compatible(last, token) if fits is None else fits:
                        break
                token = self._prefix(token)
            if token >= 0:
                out.append(token)
                at += lengths[token]
                last, token = token, longest[at] if at < n else -1
            else:
                # Nothing may follow ``last`` here: go back and try a shorter token in its place.
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
        return out

    def _encode_chunks(self, chunks: list[str]) -> Iterator[bytes]:
        known, made = self.store.known, {}
        for chunk in chunks:
            own = []
            for piece in self.split.findall(chunk):
                packed = made.get(piece)
                if packed is None:
                    packed = known.get(piece)
                    # A known chunk is a piece if the pattern takes it whole.
                    if packed is None or self.split.findall(piece) != [piece]:
                        ids = self.encode_piece(piece.encode())
                        packed = struct.pack(f"<{len(ids)}I", *ids)
                    made[piece] = packed
                own.append(packed)
            yield own[0] if len(own) == 1 else b"".join(own)

    def _chunks(self, text: str) -> list[str]:
        """Parts that the pattern never matches across, each starting with the blank before it.

        A blank after other white space belongs to a run that the pattern cuts by what
        follows, so such a text is cut by the pattern itself.
        """
        if self.risky.search(text):
            return self.split.findall(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + part for part in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as packed unsigned 32-bit integers."""
        return self.store.encode([self._chunks(t) for t in texts])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder for each vocabulary and Python worker."""
    return ByteBpe(read_ranks(path), pattern)


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", id_column: str = "doc_id", decoded: bool = False
) -> DataFrame:
    """``id_column`` and ``ids`` of every whole text; with ``decoded`` also the bytes those ids stand for."""
    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            for part in text_slices(batch, "text"):
                encoded = bpe.encode(part.column("text").to_pylist())
                columns = [part.column("id"), id_lists(encoded)]
                names = ["id", "ids"]
                if decoded:
                    columns.append(pa.array([bpe.decode(e) for e in encoded], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))
    return out.withColumnRenamed("id", id_column)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``decoded``, the bytes of every id list."""
    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            texts = [b"".join(map(bpe.tokens.__getitem__, x)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], ["id", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_column)


@llm_query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        decoded=True,
    )
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
