"""Operator 2: packing token sequences by shortest-pack-first over the length histogram.

Documents become pieces of at most ``capacity`` tokens, cut at multiples of it. Only the
histogram of piece lengths, at most ``capacity`` rows, reaches the driver. Lengths are
placed there from the longest down, always into the shortest open pack that has room,
which moves counts between packing patterns; no document is looked at. Patterns then go
back to the pieces by rank: the k-th piece of a length fills the k-th slot that the
patterns have for this length. Ranks are counted in buckets of each length, so that a
length which a third of all pieces share is ranked by many tasks.

Defined results: a null text counts as empty and is the end token alone; repeated
rows are packed as documents of their own; an empty table gives no pieces; texts of any
length are tokenised whole; further columns are not read by :func:`tokenize`, and
:func:`pack` carries all columns of its input under their own names.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.chunked import ChunkStore, give_back, id_lists, planes, text_slices
from quayload.llm.registry import llm_query
from quayload.llm.workspace import shuffle_partitions, stage
from quayload.plans.registry import table

CAPACITY = 2048
END_ID = 1
#: ASCII and Latin-1; the small ones are what lower case makes of the others, and none composes with another.
LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
SMALL_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")

# ---- tokens -------------------------------------------------------------------------------------


class WordTokenizer:
    """The installed tokenizer over whitespace-delimited chunks, none of whose matches hold white space."""

    #: Characters that str.split cuts at but the tokenizer keeps.
    KEPT = re.compile("[\x1c-\x1f]")
    #: One of them: its id stands for nothing else.
    MARK = "\x1e"
    #: A point or comma after one of these is a match of its own; :func:`_plain` judges other letters.
    BEFORE_END = "([0-9A-Za-z])([.,])"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self._ids([self.MARK])[0].tolist()
        self.ends = {e: self._ids([e])[0].tobytes() for e in ".,"}
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: In such texts a capital matters: its small letter might compose with the mark, or spell a special token.
        self.cased = "|".join([r"[A-Z]\p{M}", *(f"(?i:{a})" for a in added)])
        self.direct = self._direct()
        self.store = ChunkStore(self._encode_chunks)

    def _direct(self):
        """The tokenizer for words of small letters, which it neither rewrites nor cuts, or None.

        It goes from white space straight to the merges, and keeps no words: the store has those.
        """
        from tokenizers import Tokenizer, models

        spec = json.loads(self.tokenizer.to_str())
        cuts, model = spec["pre_tokenizer"] or {}, dict(spec["model"])
        kinds = [c["type"] for c in cuts.get("pretokenizers", [])]
        letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        whole = self.tokenizer.pre_tokenizer.pre_tokenize_str(letters) if self.lowers and kinds == ["Split", "ByteLevel"] else []
        if model.pop("type", "") != "BPE" or len(whole) != 1 or self.tokenizer.normalizer.normalize_str(letters) != letters:
            return None
        spec |= {"normalizer": None, "post_processor": None, "added_tokens": []}
        spec["pre_tokenizer"] = cuts | {"pretokenizers": [{"type": "WhitespaceSplit"}, cuts["pretokenizers"][1]]}
        direct = Tokenizer.from_str(json.dumps(spec))
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.pop("merges")]
        direct.model = models.BPE(**{k: v for k, v in model.items() if v is not None}, merges=merges, cache_capacity=0)
        return direct

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> Iterator[bytes]:
        """A point or comma after a letter or digit is a match of its own, so the word before it is looked up."""
        known = self.store.known
        ends = [c[-1] if len(c) > 1 and c[-1] in self.ends and _plain(c[:-1]) else "" for c in chunks]
        words = [c[:-1] if e else c for c, e in zip(chunks, ends, strict=True)]
        made: dict[str, bytes] = {}
        if self.direct:
            words = [w if w.isascii() or not LETTERS.fullmatch(w) else w.lower() for w in words]
            small = [w for w in dict.fromkeys(words) if w not in known and SMALL_LETTERS.fullmatch(w)]
            made = dict(zip(small, self._encode_words(small, self.direct), strict=True))
        new = [w for w in dict.fromkeys(words) if w not in known and w not in made]
        made |= zip(new, self._encode_words(new), strict=True)
        for word, end in zip(words, ends, strict=True):
            own = made.get(word)
            yield (known[word] if own is None else own) + (self.ends[end] if end else b"")

    def _encode_words(self, chunks: list[str], tokenizer=None) -> Iterator[bytes]:
        """Many chunks go through the tokenizer as one text, told apart by a character none of them has."""
        for first in range(0, len(chunks), 256):
            (ids,) = self._ids([f" {self.MARK} ".join(chunks[first : first + 256])], tokenizer)
            packed, begin = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(ids == self.mark)).tolist():
                yield packed[begin:end]
                begin = end + 4
            yield packed[begin:]

    def _alike(self, texts: pa.Array) -> pa.Array:
        """Texts with the same ids, in which words that differ only in capitals or a mark at the end are one chunk."""
        if self.lowers:
            texts = pc.if_else(pc.match_substring_regex(texts, self.cased), texts, pc.ascii_lower(texts))
        return pc.replace_substring_regex(texts, self.BEFORE_END, r"\1 \2")

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text; the array has no nulls."""
        texts = self._alike(texts)
        whole = np.flatnonzero(pc.match_substring_regex(texts, self.KEPT.pattern).to_numpy(zero_copy_only=False))
        if not len(whole):
            return self.store.encode_split(texts)
        plain = np.setdiff1d(np.arange(len(texts)), whole)
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(plain.tolist(), self.store.encode_split(texts.take(pa.array(plain))), strict=True):
            out[i] = ids
        for i, ids in zip(whole.tolist(), self._ids(texts.take(pa.array(whole)).to_pylist()), strict=True):
            out[i] = ids.tobytes()
        return out


def _plain(word: str) -> bool:
    """Whether a mark after ``word`` is a match of its own.

    It ends in a letter or digit that lower case leaves one (some capitals become a letter and
    a mark), and normal form leaves the word as it is (some letters are split into a letter and
    a mark).
    """
    last = word[-1]
    return last.isalnum() and (last < "\x80" or last.lower() == last) and (word.isascii() or unicodedata.is_normalized("NFC", word))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenize(
    df: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID,
    with_ids: bool = True, compressed: bool = False,
) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids.

    ``compressed`` ids are binary, as :func:`chunked.planes` makes them.
    """
    rows = df.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    end = int(end_id).to_bytes(4, "little")
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                encoded = [e + end for e in tokenizer.encode(part.column("text"))]
                cuts = [(i, b) for i, e in enumerate(encoded) for b in range(0, len(e), width)]
                pieces = [encoded[i][b : b + width] for i, b in cuts]
                columns = [
                    part.column("doc_id").take(pa.array([i for i, _ in cuts], pa.int64())),
                    pa.array([b // 4 for _, b in cuts], pa.int64()),
                    pa.array([len(p) // 4 for p in pieces], pa.int64()),
                    pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                    pa.array([len(encoded[i]) // 4 for i, _ in cuts], pa.int64()),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(map(planes, pieces), pa.binary()) if compressed else id_lists(pieces))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
                del encoded, pieces, columns
            give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + f", ids {'binary' if compressed else 'array<int>'}" * with_ids
    return rows.mapInArrow(run, schema)


# ---- patterns -----------------------------------------------------------------------------------


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns with their counts: (count, lengths in pack order).

    Lengths go longest first into the shortest pack that has room; packs with equal room
    are one pattern until their counts part. A length that no open pack has room for
    opens packs of its own.
    """
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(room: int, count: int, pattern: tuple[int, ...]) -> None:
        if room:
            open_packs.setdefault(room, []).append((count, pattern))
        else:
            done.append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                # Not even the shortest pack has room.
                put(capacity - length, left, (length,))
                break
            count, pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(count, left)
            if used < count:
                put(room, count - used, pattern)
            put(room - length, used, pattern + (length,))
            left -= used
    return done + [pack for packs in open_packs.values() for pack in packs]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of every place in every pattern."""
    out, next_rank, sequence = [], {}, 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = next_rank.get(length, 0)
            next_rank[length] = first + count
            out.append((length, first, first + count, sequence, offset))
            offset += length
        sequence += count
    return out


def pack(pieces: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "start"), capacity: int = CAPACITY) -> DataFrame:
    """All rows of ``pieces`` with ``sequence_id`` and ``offset``; it is read twice, so stage it if it is costly.

    ``order`` ranks pieces of one length and should tell rows apart, so that a rerun gives
    the same ranks.
    """
    spark = pieces.sparkSession
    buckets = shuffle_partitions(spark)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = keyed.groupBy(F.col(length).alias("_l"), F.col("_bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    histogram = {row["_l"]: row["n"] for row in counts.groupBy("_l").agg(F.sum("_c").alias("n")).collect()}
    if any(not 0 < size <= capacity for size in histogram):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    # At most a few places for each length and pattern: the size follows the capacity, not the data.
    places = spark.createDataFrame(
        slots(shortest_pack_first(histogram, capacity)) or [(0, 0, 0, 0, 0)],
        "_sl long, _first long, _end long, _sequence long, _offset long",
    )
    before = Window.partitionBy("_l").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_l", "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(length, "_bucket").orderBy(*order)
    ranked = keyed.withColumn("_in", F.row_number().over(inside) - 1).join(
        starts, (F.col(length) == F.col("_l")) & (F.col("_bucket") == F.col("_b"))
    )
    rank = F.col("_base") + F.col("_in")
    return ranked.join(
        F.broadcast(places), (F.col(length) == F.col("_sl")) & (rank >= F.col("_first")) & (rank < F.col("_end"))
    ).select(
        *(F.col(f"`{c}`") for c in pieces.columns),
        (F.col("_sequence") + rank - F.col("_first")).cast("long").alias("sequence_id"),
        F.col("_offset").cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """Tokenise and pack whole documents; the narrow pieces are staged, the texts read once."""
    return pack(stage(tokenize(docs, path, with_ids=False), "pieces"))


@llm_query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
