"""Operator 13: phrase collocations by relational mining (SETM).

The occurrence relation R1 has every word of every piece, sorted by piece and position, and is
written once. It is kept by chunk: the documents of one language in about 8 MiB of text, words
as codes of the chunk's dictionary and pieces as runs of codes, both compressed; no piece
crosses a chunk. Then, length by length:

- merge-join: an occurrence of k words meets the one that begins a word later in its piece;
  sorted runs make that one step over neighbouring entries;
- group-count: each chunk deals the hashes of its distinct phrases and their counts to buckets, a
  bucket's hashes as sorted differences in some three bytes each, and each bucket adds them up;
- semi-join: one bit for each phrase tells the chunk whether its hash reaches the minimum, and only
  occurrences of such phrases are extended or counted by their text.

Hashes only leave out phrases that cannot be frequent, since a collision can but add; the counts
that are returned are added up by the phrases themselves. A phrase that every document has is
one row for each chunk. Replies to a chunk are bounded by the chunk. Scores are exact: decimals
of 38 digits hold the products up to counts of 10^16.

Defined results: a null text has no words, a null language is ``und`` (and shares it with rows
that say so); repeated rows count each; ties are ordered by count and by the phrase's bytes; an
empty table has no rows; identifiers and other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.chunked import give_back
from quayload.llm.hashing import BYTE_CODES, LOWER, U64, mix, stream, text_bytes
from quayload.llm.hashing import chunks as byte_ranges
from quayload.llm.registry import llm_query
from quayload.llm.workspace import discard, release, shuffle_partitions, stage
from quayload.plans.registry import table

MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
TOP = 2000
#: A phrase goes where a longer one around it has at least this share of its count, in percent.
INSIDE_PERCENT = 50
CHUNK_TEXT = 8 << 20
LOW = U64(0xFFFFFFFF)

# What ends a piece, and what parts words.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[list(BLANKS)] = _BLANK
_KIND[list(PIECE_ENDS)] = _END

RELATION = "lang string, chunk long, n_words long, words array<string>, counts array<int>, codes binary, pieces binary"

# ---- the occurrence relation ----------------------------------------------------------------------


def occurrences(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, code of each occurrence, index of the first occurrence of each piece) in order."""
    raw, offsets = text_bytes(texts)
    own_ends = offsets[1:] + np.arange(len(texts))
    data = np.full(len(raw) + len(texts), PIECE_ENDS[-1], np.uint8)
    body = np.ones(len(data), bool)
    body[own_ends] = False
    data[body] = LOWER[raw]
    kind = _KIND[data]
    inside = kind == _WORD
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    piece = np.searchsorted(np.flatnonzero(kind == _END), starts)
    first = np.flatnonzero(np.diff(piece, prepend=-1)).astype(np.int32)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    # Cut at ASCII characters only, so still text.
    return coded.dictionary.view(pa.large_string()).cast(pa.string()), coded.indices.to_numpy(), first


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, their bytes by significance, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)


def _listed(values) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def relation(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """R1: one row for each chunk, its occurrences sorted by piece and position."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            if not batch.num_rows:
                continue
            _, offsets = text_bytes(batch.column("text"))
            for begin, end in byte_ranges(offsets, CHUNK_TEXT):
                part = batch.slice(begin, end - begin)
                langs = part.column("lang").dictionary_encode()
                codes = langs.indices.to_numpy()
                order = np.argsort(codes, kind="stable")
                runs = np.flatnonzero(np.diff(codes[order], prepend=-1, append=-1))
                for a, b in zip(runs[:-1], runs[1:], strict=True):
                    words, found, pieces = occurrences(part.column("text").take(pa.array(order[a:b])))
                    if len(found):
                        # Frequent words have small codes, which leaves little to store of the others' bytes.
                        counts = np.bincount(found, minlength=len(words))
                        by_count = np.argsort(-counts, kind="stable")
                        rank = np.empty(len(by_count), np.int32)
                        rank[by_count] = np.arange(len(by_count))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([langs.dictionary[int(codes[order[a]])].as_py()]),
                                pa.array([chunk]),
                                pa.array([len(found)]),
                                _listed(words.take(pa.array(by_count))),
                                _listed(counts[by_count].astype(np.int32)),
                                pa.array([packed(rank[found])], pa.binary()),
                                pa.array([packed(np.diff(pieces, append=len(found)))], pa.binary()),
                            ],
                            ["lang", "chunk", "n_words", "words", "counts", "codes", "pieces"],
                        )
                        chunk += 1

    return rows.mapInArrow(run, RELATION)


# ---- lengths --------------------------------------------------------------------------------------


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word's bytes; no word is empty."""
    raw, offsets = text_bytes(words)
    lengths = np.diff(offsets)
    if not len(lengths):
        return np.zeros(0, U64)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], lengths)
    factors = stream(37, int(lengths.max())) | U64(1)
    return mix(np.add.reduceat(BYTE_CODES[raw] * factors[place], offsets[:-1]) + lengths.astype(U64))


class Mining:
    """The relations R2, R3, ... of one chunk.

    ``at`` has the first word of each occurrence in order, ``group`` its phrase; ``phrases``
    are the codes of each distinct phrase, one array for each place.
    """

    def __init__(self, lang: str, words: pa.Array, codes: np.ndarray, lengths: np.ndarray):
        self.words, self.codes = words, codes
        # Words that follow in the same piece, itself included.
        self.left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
        self.size = 1
        self.at = np.arange(len(codes))
        self.group, self.phrases = codes.astype(np.int64), [np.arange(len(words))]
        self.seed = U64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        self.word_hashes = _word_hashes(words)

    def extend(self) -> np.ndarray:
        """Join each occurrence with the one a word later; the counts of the phrases."""
        follows = np.zeros(max(len(self.at) - 1, 0), bool)
        if len(follows):
            follows = (np.diff(self.at) == 1) & (self.left[self.at[:-1]] > self.size)
        head = np.flatnonzero(follows)
        width = np.int64(len(self.words))
        pairs = self.group[head] * width + self.codes[self.at[head] + self.size]
        distinct, group, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        before, last = distinct // width, distinct % width
        self.phrases = [places[before] for places in self.phrases] + [last]
        self.at, self.group, self.size = self.at[head], group.astype(np.int64), self.size + 1
        return counts

    def hashes(self) -> np.ndarray:
        factors = stream(41, self.size) | U64(1)
        total = np.full(len(self.phrases[0]), self.seed, U64)
        for places, factor in zip(self.phrases, factors, strict=True):
            total += self.word_hashes[places] * factor
        return mix(total)

    def keep(self, stays: np.ndarray) -> None:
        """Leave out occurrences of phrases that do not stay."""
        number = np.cumsum(stays) - 1
        kept = stays[self.group]
        self.at, self.group = self.at[kept], number[self.group[kept]]
        self.phrases = [places[stays] for places in self.phrases]

    def texts(self) -> pa.Array:
        return pc.binary_join_element_wise(*(self.words.take(pa.array(places)) for places in self.phrases), " ")


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of hashes by bucket and the 32 bits that tell them apart there, those bits, and the bounds of the buckets."""
    target, rest = (hashes & LOW) % U64(buckets), (hashes >> U64(32)).astype(np.uint32)
    order = np.lexsort((rest, target))
    return order, rest[order], np.searchsorted(target[order], np.arange(buckets + 1, dtype=U64))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Mining, list[pa.Array | None]]]:
    """Language, number, relation and replies of each chunk."""
    for batch in batches:
        replies = [c for c in batch.schema.names if c.startswith("reply")]
        for row in range(batch.num_rows):
            values = {c: batch.column(c)[row] for c in ("lang", "chunk", "words", "codes", "pieces", *replies)}
            codes, lengths = unpacked(values["codes"].as_py()), unpacked(values["pieces"].as_py())
            mining = Mining(values["lang"].as_py(), values["words"].values, codes, lengths)
            yield values["lang"].as_py(), values["chunk"].as_py(), mining, [values[c].values for c in replies]


def _climb(mining: Mining, replies: list[pa.Array | None], buckets: int) -> Iterator[np.ndarray]:
    """Counts of the frequent phrases of each length that has a reply, the relation left at that length."""
    for reply in replies:
        counts = mining.extend()
        stays = np.zeros(len(counts), bool)
        if reply is not None:
            order, _, cuts = _dealt(mining.hashes(), buckets)
            for answer in reply.to_pylist():
                own = order[cuts[answer["bucket"]] : cuts[answer["bucket"] + 1]]
                stays[own] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=len(own)).astype(bool)
        mining.keep(stays)
        yield counts[stays]


def hashed_counts(r1: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, rest, counts) of the phrases one word longer than the replies of ``r1`` go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk, mining, replies in _chunks(batches):
            for _ in _climb(mining, replies, buckets):
                pass
            counts = mining.extend()
            order, rest, cuts = _dealt(mining.hashes(), buckets)
            counts = counts[order]
            rows = [
                (k, chunk, packed(np.diff(rest[a:b], prepend=np.uint32(0))), packed(counts[a:b]))
                for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                if b > a
            ]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "chunk", "rest", "counts"])
            del mining, counts, order, rest
            give_back()

    return r1.drop("counts", "n_words").mapInArrow(run, "bucket int, chunk long, rest binary, counts binary")


def frequent_hashes(asked: DataFrame, min_count: int) -> DataFrame:
    """(chunk, bucket, bits): which of a chunk's hashes in a bucket have ``min_count`` occurrences over all chunks."""

    def run(table: pa.Table) -> pa.Table:
        rest = [np.cumsum(unpacked(r).view(np.uint32), dtype=np.uint32) for r in table.column("rest").to_pylist()]
        bounds = np.cumsum([0, *map(len, rest)])
        _, group = np.unique(np.concatenate(rest), return_inverse=True)
        counts = np.concatenate([unpacked(c) for c in table.column("counts").to_pylist()])
        # Sums of integers far below 2^53 are exact.
        frequent = (np.bincount(group, counts) >= min_count)[group]
        rows = [
            (chunk, bucket, np.packbits(frequent[a:b]).tobytes())
            for chunk, bucket, a, b in zip(
                table.column("chunk").to_pylist(), table.column("bucket").to_pylist(), bounds[:-1], bounds[1:], strict=True
            )
            if frequent[a:b].any()
        ]
        del rest, group, counts, frequent
        give_back()
        schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())])
        return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []], schema=schema)

    return asked.groupBy("bucket").applyInArrow(run, "chunk long, bucket int, bits binary")


def exact_counts(r1: DataFrame, buckets: int) -> DataFrame:
    """(lang, size, phrase, count) by chunk of the phrases that the replies leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, mining, replies in _chunks(batches):
            for counts in _climb(mining, replies, buckets):
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array(np.full(n, mining.size)), mining.texts(), pa.array(counts)],
                    ["lang", "size", "phrase", "count"],
                )

    return r1.drop("counts", "n_words").mapInArrow(run, "lang string, size long, phrase string, count long")


def frequent_phrases(r1: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, size, phrase, f) of all phrases of 1 to ``max_words`` words with at least ``min_count`` occurrences."""
    spark = r1.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    words = r1.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("phrase"))
    singles = words.agg(F.sum("counts").alias("f")).where(F.col("f") >= min_count)
    # Each step is written, so that the shuffles before it can go.
    singles = stage(singles.select("lang", F.lit(1).cast("long").alias("size"), "phrase", "f"), "words")
    answered, replies = r1, []
    for size in range(2, max_words + 1):
        frequent = frequent_hashes(hashed_counts(answered, buckets), min_count)
        # A bit for each of a chunk's own phrases.
        reply = stage(frequent.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"reply{size}")), f"frequent-{size}")
        del frequent
        release(spark)
        replies.append(reply)
        answered = answered.join(reply, "chunk", "left")
    longer = exact_counts(answered, buckets).groupBy("lang", "size", "phrase").agg(F.sum("count").alias("f"))
    found = stage(singles.unionByName(longer.where(F.col("f") >= min_count)), "phrases")
    for done in (singles, *replies):
        discard(done)
    return found


# ---- scores ---------------------------------------------------------------------------------------


def _part(first, length):
    return F.array_join(F.slice("_w", first, length), " ")


def scored(phrases: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Candidates with a, l, r and score of their weakest cut."""
    size = F.col("size").cast("int")
    cuts = (
        phrases.where(F.col("size") >= max(min_words, 2))
        .withColumn("_w", F.split("phrase", " "))
        .select("lang", "size", "phrase", F.col("f").alias("a"), "_w", F.explode(F.sequence(F.lit(1), size - 1)).alias("_k"))
        .select("lang", "size", "phrase", "a", "_k", _part(F.lit(1), F.col("_k")).alias("_first"), _part(F.col("_k") + 1, size - F.col("_k")).alias("_rest"))
    )
    left = phrases.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    wide = {c: F.col(c).cast("decimal(38,0)") for c in "alr"}
    exact = F.call_function("div", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)"), wide["l"] * wide["r"])
    joined = cuts.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"])
    weakest = joined.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct(exact.alias("score"), F.col("_k"), F.col("l"), F.col("r"))).alias("_cut"))
    return weakest.select("lang", "size", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def stands_alone(candidates: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """Candidates without a longer one around them that has ``inside_percent`` of their count."""
    size = F.col("size").cast("int")
    inner = (
        candidates.where("size > 2")
        .withColumn("_w", F.split("phrase", " "))
        .select("lang", "a", "_w", size.alias("_n"), F.explode(F.sequence(F.lit(2), size - 1)).alias("_m"))
        .select("lang", "a", "_w", "_m", F.explode(F.sequence(F.lit(1), F.col("_n") - F.col("_m") + 1)).alias("_at"))
        .select("lang", "a", _part(F.col("_at"), F.col("_m")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("_longer"))
    )
    alone = F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("a"))
    return candidates.join(inner, ["lang", "phrase"], "left").where(alone).drop("_longer")


def mine(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS, max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """All collocations (lang, size, phrase, a, l, r, score), and the number of words (lang, n)."""
    r1 = stage(relation(docs, text, lang), "occurrences")
    totals = stage(r1.groupBy("lang").agg(F.sum("n_words").alias("n")), "word-totals")
    phrases = frequent_phrases(r1, max_words, min_count)
    discard(r1)
    return stands_alone(scored(phrases, min_words), inside_percent), totals


def strongest(found: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language; a task sends on no more than that many of each."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, doc, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
q AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
r1 AS (SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM q),
tot AS (SELECT lang, count(*) AS n FROM r1 GROUP BY lang),
c1 AS (SELECT lang, w AS phrase, count(*) AS f FROM r1 GROUP BY ALL),
r2 AS (SELECT x.lang, x.piece, x.pos, x.w AS w1, y.w AS w2 FROM r1 x JOIN r1 y ON y.piece = x.piece AND y.pos = x.pos + 1),
c2 AS (SELECT lang, w1, w2, count(*) AS f FROM r2 GROUP BY ALL HAVING count(*) >= 10),
r3 AS (SELECT x.lang, x.w1, x.w2, y.w AS w3 FROM r2 x SEMI JOIN c2 USING (lang, w1, w2) JOIN r1 y ON y.piece = x.piece AND y.pos = x.pos + 2),
c3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM r3 GROUP BY ALL HAVING count(*) >= 10),
cut AS (
  SELECT c2.lang, w1 || ' ' || w2 AS phrase, c2.f AS a, 1 AS k, a.f AS l, b.f AS r, 2 AS size
  FROM c2 JOIN c1 a ON a.lang = c2.lang AND a.phrase = w1 JOIN c1 b ON b.lang = c2.lang AND b.phrase = w2
  UNION ALL SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || w3, c3.f, 1, a.f, b.f, 3
  FROM c3 JOIN c1 a ON a.lang = c3.lang AND a.phrase = c3.w1 JOIN c2 b ON b.lang = c3.lang AND b.w1 = c3.w2 AND b.w2 = c3.w3
  UNION ALL SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || w3, c3.f, 2, a.f, b.f, 3
  FROM c3 JOIN c2 a ON a.lang = c3.lang AND a.w1 = c3.w1 AND a.w2 = c3.w2 JOIN c1 b ON b.lang = c3.lang AND b.phrase = c3.w3),
s AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1),
longer AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM c3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM c3)
           GROUP BY ALL),
kept AS (SELECT s.* FROM s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase AND s.size = 2
         WHERE g.f IS NULL OR 100 * g.f < 50 * s.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN tot ON tot.lang = k.lang QUALIFY rank <= 2000
"""


@llm_query("op13_phrase_mining", ORACLE)
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strongest(*mine(table(spark, sf_dir, "documents")))
