"""Operator 6: removal of repeated byte strings through suffixes in deep-shallow order.

The suffixes that matter are those at the starts of windows whose gram occurs in several
texts (see ``anchors``). In the task of a gram they are ordered by deep-shallow sorting:
a multikey quicksort that takes eight bytes as one character goes down to a shallow
depth, refining only what is still tied; groups that share all of that prefix are put
in order by blind tries, which look at branching bytes on the way down and compare whole
remainders once per suffix. Suffixes end up next to their equals, and a window's common
prefix with its neighbour tells whether it occurs again.

A byte is removed when a 50-byte string covers it that also starts in a document with a
smaller identifier, judged on the input; repeats inside one document stay. Defined
results: null text is empty; texts of fewer bytes than a window are kept whole; rows that
repeat an identifier do not remove each other's bytes; a null identifier is larger than
any other and comes back as null; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.anchors import NULL_ID, Contest, Scheme, covered, keyed, repeated_windows
from quayload.llm.chunked import text_slices
from quayload.llm.registry import llm_query
from quayload.plans.registry import table

WINDOW = 50
SCHEME = Scheme("bytes", WINDOW, 24)
#: Depth of the shallow sort in characters of eight bytes.
SHALLOW = 3


class BlindTrie:
    """Orders strings of one length, given as integers; equal strings share a leaf."""

    def __init__(self, length: int):
        self.length = length
        self.root: list | None = None

    def _byte(self, value: int, depth: int) -> int:
        return value >> 8 * (self.length - 1 - depth) & 255

    def insert(self, value: int, number: int) -> None:
        """A node is [depth, children by byte]; a leaf is [length, value, numbers]."""
        length = self.length
        if self.root is None:
            self.root = [length, value, [number]]
            return
        node = self.root
        while node[0] < length:
            # Blindly: bytes between branchings are not looked at, and a missing branch may be any.
            children = node[1]
            node = children.get(self._byte(value, node[0])) or next(iter(children.values()))
        differ = node[1] ^ value
        if not differ:
            node[2].append(number)
            return
        depth = length - 1 - (differ.bit_length() - 1) // 8
        above, at = None, self.root
        while at[0] < depth:
            above, at = at, at[1][self._byte(value, at[0])]
        leaf = [length, value, [number]]
        if at[0] == depth:
            at[1][self._byte(value, depth)] = leaf
            return
        split = [depth, {self._byte(node[1], depth): at, self._byte(value, depth): leaf}]
        if above is None:
            self.root = split
        else:
            above[1][self._byte(value, above[0])] = split

    def leaves(self) -> Iterator[list[int]]:
        """The numbers of equal strings, strings in ascending order."""
        waiting = [self.root] if self.root else []
        while waiting:
            node = waiting.pop()
            if node[0] == self.length:
                yield node[2]
            else:
                waiting.extend(node[1][b] for b in sorted(node[1], reverse=True))


def deep_shallow(data: np.ndarray, places: np.ndarray, depth: int = WINDOW, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ``depth``-byte suffixes at ``places``, and in that order whether each equals its predecessor."""
    n = len(places)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    order, group = np.arange(n), np.zeros(n, np.int64)
    tied = np.arange(n)
    for level in range(shallow):
        if not len(tied):
            break
        at = places[order[tied]] + 8 * level
        character = np.zeros(len(tied), np.uint64)
        for byte in range(8):
            character = character << np.uint64(8) | padded[at + byte]
        inner = np.lexsort((character, group[tied]))
        order[tied] = order[tied[inner]]
        key, old = character[inner], group[tied]
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
        # Groups are named by the position of their first member, which later levels keep.
        group[tied] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size = np.bincount(group[tied], minlength=n)
        tied = tied[size[group[tied]] > 1]
    same = np.zeros(n, bool)
    if not len(tied):
        return order, same
    start = np.flatnonzero(np.concatenate([[True], group[tied][1:] != group[tied][:-1]]))
    size = np.diff(np.append(start, len(tied)))
    rest, width = 8 * shallow, depth - 8 * shallow
    # Two suffixes need one comparison, made for all such groups at once.
    first = tied[start[size == 2]]
    if len(first):
        a, b = (data[places[order[first + k]][:, None] + np.arange(rest, depth)] for k in (0, 1))
        differ = a != b
        equal = ~differ.any(1)
        at = np.where(equal, 0, differ.argmax(1))
        swap = a[np.arange(len(a)), at] > b[np.arange(len(a)), at]
        left, right = first[swap], first[swap] + 1
        order[left], order[right] = order[right].copy(), order[left].copy()
        same[first + 1] = equal
    raw = data.tobytes()
    for begin, count in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        at = int(tied[begin])
        members = order[at : at + count].tolist()
        trie = BlindTrie(width)
        for member in members:
            place = int(places[member])
            trie.insert(int.from_bytes(raw[place + rest : place + depth], "big"), member)
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            same[at + 1 : at + len(leaf)] = True
            at += len(leaf)
    return order, same


def decide(contest: Contest, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows that also start in a smaller document, as (segment, offset)."""
    lengths = np.array([len(b) for b in contest.bodies])
    data = np.frombuffer(b"".join(contest.bodies), np.uint8)
    begin = np.cumsum(lengths) - lengths
    counts = lengths - window + 1
    segment = np.repeat(np.arange(len(lengths)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    order, same = deep_shallow(data, begin[segment] + offset)
    doc = np.array([h[0] for h in contest.holders], np.int64)[segment][order]
    head = np.flatnonzero(~same)
    least = np.minimum.reduceat(doc, head) if len(head) else doc
    later = doc > least[np.cumsum(~same) - 1]
    return segment[order[later]], offset[order[later]]


def judged(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every document."""
    docs = keyed(df, text, id_column)
    removed = repeated_windows(docs, SCHEME, False, decide)
    joined = docs.join(removed, ["id", "text_hash"], "left").select("id", "text", "starts", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for text, starts, counts in zip(*(part.column(c).to_pylist() for c in ("text", "starts", "counts")), strict=True):
                    data = text.encode()
                    gone = covered(len(data), WINDOW, starts, counts) if starts else np.zeros(len(data), bool)
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if starts else data
                    rows.append((len(data), len(data) - len(kept), spans, kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept_bytes"])

    out = joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")
    return out.withColumn("doc_id", F.when(F.col("id") != NULL_ID, F.col("id"))).drop("id")


#: Windows of 50 bytes as hexadecimal texts, doubled up from pairs of bytes.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT doc_id, unnest(regexp_extract_all(h, '..')) AS b, generate_subscripts(regexp_extract_all(h, '..'), 1) AS p FROM d),
b2 AS (SELECT *, b || lead(b, 1) OVER o AS g2 FROM b WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
b4 AS (SELECT *, g2 || lead(g2, 2) OVER o AS g4 FROM b2 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
b8 AS (SELECT doc_id, p, b, g2, g4 || lead(g4, 4) OVER o AS g8 FROM b4 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
b16 AS (SELECT doc_id, p, b, g2, g8 || lead(g8, 8) OVER o AS g16 FROM b8 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
b50 AS (SELECT doc_id, p, b, g16 || lead(g16, 16) OVER o || lead(g16, 32) OVER o || lead(g2, 48) OVER o AS g FROM b16 WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
f AS (SELECT g, min(doc_id) AS least FROM b50 WHERE g IS NOT NULL GROUP BY g HAVING min(doc_id) < max(doc_id)),
a AS (SELECT b50.doc_id, p, b, coalesce(f.least < b50.doc_id, false) AS again FROM b50 LEFT JOIN f USING (g)),
c AS (SELECT doc_id, p, b, max(again::INTEGER) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM a),
e AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), 0) = 0 AS starts FROM c),
k AS (SELECT doc_id, sum(gone)::BIGINT AS gone, count(*) FILTER (starts) AS spans, string_agg(b, '' ORDER BY p) FILTER (gone = 0) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@llm_query("op6_suffix_dedup", ORACLE)
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
