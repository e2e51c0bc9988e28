"""Operator 9: removal of repeated 20-word windows through FM-indexes of shards.

Shards are made of the corpus's repeated material: segments of windows that share a
gram (see ``anchors``), so that every window meets all its equals in one shard and no
shard is searched for texts that have nothing to do with it. Each shard's segments are
indexed by a compressed FM-index over word numbers (wavelet matrix of the
Burrows-Wheeler transform). The segments then stream past the index by backward search;
a window whose matching statistic reaches the window length has a suffix interval,
which is the same for all its equals, and the earliest of them stays.

A word is removed when it lies in a window whose words start earlier, in a smaller
document or earlier in the same one, judged on the input. Defined results: null and
blank texts have no words; texts shorter than a window are kept whole; rows that repeat
an identifier are told apart by their text, and neither of two equal ones is earlier; a
null identifier is later than any other and comes back as null; other columns are not
read by the query and are carried unchanged by :func:`drop_repeats`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.anchors import NULL_ID, Contest, Scheme, covered, keyed, repeated_windows
from quayload.llm.chunked import text_slices
from quayload.llm.fm_index import FmIndex
from quayload.llm.registry import llm_query
from quayload.plans.registry import table

WINDOW = 20
SCHEME = Scheme("words", WINDOW, 4)
#: A word and the blanks after it.
WORD = re.compile(rb"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*")


def decide(contest: Contest, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard that an earlier holder has too, as (segment, offset)."""
    words = [body.split() for body in contest.bodies]
    lengths = np.array([len(w) for w in words])
    numbers = {w: i for i, w in enumerate(set().union(*words), 1)}
    # Each segment ends with 0, which no pattern holds: matches stay inside segments.
    text = np.fromiter((x for w in words for x in (*map(numbers.__getitem__, w), 0)), np.int64, int(lengths.sum()) + len(words))
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    index = FmIndex(text)
    counts = lengths - window + 1
    segment = np.repeat(np.arange(len(words)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    place = begin[segment] + offset
    low, high = np.zeros(len(place), np.int64), np.full(len(place), len(text), np.int64)
    for step in reversed(range(window)):
        low, high = index.extend(text[place + step], low, high)
    return _later(contest, segment, offset, low, high)


def _later(contest: Contest, segment: np.ndarray, offset: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows with one suffix interval all but the earliest."""
    holders = np.array([h[:2] for h in contest.holders], np.int64)[segment]
    doc, start = holders[:, 0], holders[:, 1] + offset
    shared = np.flatnonzero(high - low > 1)
    order = shared[np.lexsort((start[shared], doc[shared], low[shared]))]
    new = np.ones(len(order), bool)
    new[1:] = low[order][1:] != low[order][:-1]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    later = (doc[order] > doc[head]) | ((doc[order] == doc[head]) & (start[order] > start[head]))
    return segment[order[later]], offset[order[later]]


def _judge(docs: DataFrame) -> DataFrame:
    """``keyed`` docs with n_words, n_removed, kept_words (joined by one blank) and kept_text (blanks as they were)."""
    removed = repeated_windows(docs.select("id", "text", "text_hash"), SCHEME, True, decide)
    joined = docs.join(removed, ["id", "text_hash"], "left")
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = [_keep(*x) for x in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "counts")), strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *columns], [*rest, "n_words", "n_removed", "kept_words", "kept_text"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in rest)
    return joined.select(*rest, "text", "starts", "counts").mapInArrow(run, schema + ", n_words long, n_removed long, kept_words string, kept_text string")


def _keep(text: str, starts: list[bytes] | None, counts: list[bytes] | None) -> tuple[int, int, str, str]:
    data = text.encode()
    if not starts:
        words = data.split()
        return len(words), 0, b" ".join(words).decode(), text
    found = list(WORD.finditer(data))
    if not found:
        return 0, 0, "", text
    gone = covered(len(found), WINDOW, starts, counts).tolist()
    kept = [m for m, g in zip(found, gone, strict=True) if not g]
    # A word goes with the blanks that follow it.
    left = data[: found[0].start()] + b"".join(m[0] for m in kept)
    return len(found), len(found) - len(kept), b" ".join(m[1] for m in kept).decode(), left.decode()


def judged(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed, kept_words and kept_text of every document."""
    out = _judge(keyed(df, text, id_column))
    return out.withColumn("doc_id", F.when(F.col("id") != NULL_ID, F.col("id"))).drop("id", "text_hash")


def drop_repeats(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """All rows and columns of ``df``, with repeated windows cut out of the text; null texts become empty."""
    others = tuple(c for c in df.columns if c != text)
    out = _judge(keyed(df, text, id_column, others))
    return out.select(*((F.col("kept_text") if c == text else F.col("row").getField(c)).alias(c) for c in df.columns))


#: Windows of 20 words as texts, doubled up from pairs of words.
ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM d),
w2 AS (SELECT *, w || ' ' || lead(w, 1) OVER o AS g2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w4 AS (SELECT *, g2 || ' ' || lead(g2, 2) OVER o AS g4 FROM w2 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w8 AS (SELECT *, g4 || ' ' || lead(g4, 4) OVER o AS g8 FROM w4 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w20 AS (SELECT doc_id, p, w, g8 || ' ' || lead(g8, 8) OVER o || ' ' || lead(g4, 16) OVER o AS g FROM w8 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
a AS (SELECT doc_id, p, w, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS again FROM w20),
c AS (SELECT doc_id, p, w, max(again::INTEGER) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM a),
k AS (SELECT doc_id, count(*) AS n, sum(gone)::BIGINT AS gone, string_agg(w, ' ' ORDER BY p) FILTER (gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@llm_query("op9_substring_dedup", ORACLE)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256")
    )
