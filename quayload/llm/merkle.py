"""Operator 12: Merkle dataset manifest by lag and lead windows.

A row's fields make a leaf digest. Leaves are numbered per group in order, and per level
every ``fanout`` consecutive nodes (the last run may be shorter) become the digest of their
concatenation, until one node, the group's subroot, remains; subroots, ordered by group,
make the root in the same way.

Leaf positions are cut into blocks of ``fanout ** LEVELS``, so a group with most of the rows
is many window partitions and every level of a block works in one sort: a node of level j
stands on the row of its first leaf, its siblings are lag and lead columns at fixed offsets
of ``fanout ** j`` rows, masked by the node's slot and its run's length, and the first-child
row hashes the parent. A leaf's own path is filled forward from those rows. Block roots, a
1024th of the rows, are the nodes of the next pass. Positions come from one range sort of the
narrow digests; nothing but counts reaches the driver.

Defined results: each null field is ``-`` and a null text differs from an empty one; null
groups are a group of their own, before all others; null ids come first in their group; rows
with equal ids are ordered by digest, so repeated rows have leaves of their own at
neighbouring places; an empty table has no rows; a group of one row has its leaf as subroot;
a leaf that is the root has an empty proof; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.registry import llm_query
from quayload.llm.workspace import discard, stage
from quayload.plans.registry import table
from quayload.session import partitions_for

FANOUT = 2
#: Levels of one window pass: a block has FANOUT ** LEVELS leaves.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Spark's generated ids hold the partition above this many bits of row number.
ROW_BITS = 33
STEP = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*(field(v) for v in values))


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings of ``path`` give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def group_key(group: Column) -> Column:
    """A text that sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[Column], label: str) -> tuple[DataFrame, int]:
    """``rows`` with ``_pos`` in and ``_n`` of their ``_key``, and the largest ``_n``.

    Equal rows are told apart by where they were read, so no sort partition depends on one key.
    """
    ordered = [F.col("_key").asc(), *order, F.col("_tie").asc()]
    ranged = (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(partitions_for(rows), *ordered)
        .sortWithinPartitions(*ordered)
        .drop("_tie")
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    # Written, since the numbers refer to these very partitions.
    placed = stage(ranged, label).withColumn("_part", F.shiftright("_seq", ROW_BITS))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each sort partition.
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_seq").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    globally = placed.join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_offset") + within).drop("_part", "_offset", "_seq")
    groups = stage(globally.groupBy("_key").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")), f"{label}-groups")
    largest = groups.agg(F.max("_n")).first()[0] or 0
    return globally.join(groups, "_key").withColumn("_pos", F.col("_at") - F.col("_first")).drop("_at", "_first"), largest


def climbed(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``nodes`` (_key, _pos, _n, _hash) with ``_block``, the siblings inside it and ``_up``, the block's root."""
    block = fanout**levels
    window = Window.partitionBy("_key", "_block").orderBy("_pos")
    rows = nodes.withColumn("_block", F.expr(f"_pos div {block}")).withColumn("_h0", F.col("_hash"))
    for level in range(levels):
        step, node = fanout**level, F.col(f"_h{level}")
        index, count = F.expr(f"_pos div {step}"), F.expr(f"(_n + {step - 1}) div {step}")
        slot = index % fanout
        run_length = F.least(F.lit(fanout), count - index + slot)
        stands = (F.col("_pos") % step == 0) & (count > 1)
        lags = [F.when(slot >= o, F.lag(node, o * step).over(window)) for o in range(fanout - 1, 0, -1)]
        leads = [F.when(slot + o < run_length, F.lead(node, o * step).over(window)) for o in range(1, fanout)]
        rows = rows.select(
            "*",
            F.when(stands, F.concat_ws("", *lags)).alias(f"_l{level}"),
            F.when(stands, F.concat_ws("", *leads)).alias(f"_r{level}"),
        )
        parent = F.when(count > 1, digest(node, F.col(f"_r{level}"))).otherwise(node)
        rows = rows.select("*", F.when(F.col("_pos") % (step * fanout) == 0, parent).alias(f"_h{level + 1}"))
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    filled = [
        F.last(F.when(F.col(f"_l{level}").isNotNull(), F.struct(F.col(f"_l{level}").alias("left"), F.col(f"_r{level}").alias("right"))),
               ignorenulls=True).over(so_far)
        for level in range(levels)
    ]
    root = F.last(f"_h{levels}", ignorenulls=True).over(so_far)
    return rows.select(*nodes.columns, "_block", F.array_compact(F.array(*filled)).alias("_inside"), root.alias("_up"))


def proved(nodes: DataFrame, largest: int, crown: Callable[[DataFrame], DataFrame], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``nodes`` with ``_path``, ``_subroot`` and ``_root``; ``crown`` gives these for the last node of each key.

    The rows of a group stay in blocks up to the last join, whose keys are (_key, _block).
    """
    if largest <= 1:
        return crown(nodes)
    # No more levels than the largest group has.
    taken = next(n for n in range(1, levels + 1) if n == levels or fanout**n >= largest)
    block = fanout**taken
    rows = climbed(nodes, fanout, taken)
    parents = rows.where(F.col("_pos") % block == 0).select(
        "_key", F.col("_block").alias("_pos"), F.expr(f"(_n + {block - 1}) div {block}").alias("_n"), F.col("_up").alias("_hash")
    )
    above = proved(stage(parents, "merkle-nodes"), -(-largest // block), crown, fanout, levels).select(
        "_key", F.col("_pos").alias("_block"), F.col("_path").alias("_above"), "_subroot", "_root"
    )
    return rows.join(above, ["_key", "_block"]).select(
        *nodes.columns, F.concat("_inside", "_above").alias("_path"), "_subroot", "_root"
    )


def _crown_of_one(nodes: DataFrame) -> DataFrame:
    return nodes.select("*", F.array().cast(f"array<{STEP}>").alias("_path"), F.col("_hash").alias("_subroot"), F.col("_hash").alias("_root"))


def _crown_of_groups(fanout: int, levels: int) -> Callable[[DataFrame], DataFrame]:
    """Subroots as the leaves of one more tree."""

    def crown(subroots: DataFrame) -> DataFrame:
        leaves = subroots.select(F.lit("").alias("_key"), F.col("_key").alias("_group"), "_hash")
        nodes, largest = numbered(leaves, [F.col("_group").asc()], "merkle-subroots")
        over = proved(nodes, largest, _crown_of_one, fanout, levels).select(F.col("_group").alias("_key"), "_path", "_root")
        return subroots.withColumn("_subroot", F.col("_hash")).join(over, "_key")

    return crown


def manifest(leaves: DataFrame, group: str, order: str, leaf_column: str = "leaf", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Every row of ``leaves`` with ``path`` (left and right siblings, level by level), ``subroot`` and ``root``.

    ``leaves`` has one digest per row and should be narrow: it is sorted. Its columns must not
    begin with an underscore.
    """
    keyed = leaves.withColumn("_key", group_key(F.col(group))).withColumn("_hash", F.col(leaf_column))
    nodes, largest = numbered(keyed, [F.col(order).asc_nulls_first(), F.col("_hash").asc()], "merkle-leaves")
    return proved(nodes, largest, _crown_of_groups(fanout, levels), fanout, levels).select(
        *leaves.columns, F.col("_path").alias("path"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root")
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf of every document, and ``tampered``, the leaf of the rows a check is to catch."""
    columns = {c: F.col(c) for c in FIELDS}
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return docs.select(
        "doc_id",
        "lang",
        leaf(*columns.values()).alias("leaf"),
        F.when(hit, leaf(*(columns | {"n_chars": more}).values())).alias("tampered"),
    )


# Levels by recursion over whole runs, then every leaf up its own path; crc32 bit by bit.
ORACLE = """
WITH RECURSIVE
f(doc_id, lang, head, n_chars, tail) AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-'), n_chars, coalesce(strlen(text) || ':' || text, '-') FROM documents),
v AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
             sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS changed,
             list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                 lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc FROM f),
d AS (SELECT doc_id, leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN changed ELSE leaf END AS start,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM v),
up(g, lv, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM d
  UNION ALL SELECT g, lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY g, lv, i // 2, n),
sub AS (SELECT g, h FROM up WHERE n = 1),
top(lv, i, n, h) AS (
  SELECT 0, g, (SELECT count(*) FROM sub), h FROM sub
  UNION ALL SELECT lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lv, i // 2, n),
walk(doc_id, g, lv, i, n, h, proof) AS (
  SELECT doc_id, g, 0, i, n, start, '' FROM d
  UNION ALL SELECT w.doc_id, w.g, w.lv + 1, w.i // 2, (w.n + 1) // 2,
    CASE WHEN w.i % 2 = 1 THEN sha256(s.h || w.h) ELSE sha256(w.h || coalesce(s.h, '')) END, w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN up s ON s.g = w.g AND s.lv = w.lv AND s.i = xor(w.i, 1) WHERE w.n > 1),
on_top(doc_id, g, lv, i, n, h, proof) AS (
  SELECT doc_id, g, 0, g, (SELECT count(*) FROM sub), h, proof FROM walk WHERE n = 1
  UNION ALL SELECT w.doc_id, w.g, w.lv + 1, w.i // 2, (w.n + 1) // 2,
    CASE WHEN w.i % 2 = 1 THEN sha256(s.h || w.h) ELSE sha256(w.h || coalesce(s.h, '')) END, w.proof || coalesce(s.h, '')
  FROM on_top w LEFT JOIN top s ON s.lv = w.lv AND s.i = xor(w.i, 1) WHERE w.n > 1)
SELECT d.doc_id, d.leaf, sub.h AS subroot, top.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = top.h AS verified
FROM d JOIN sub USING (g) JOIN on_top o ON o.doc_id = d.doc_id AND o.n = 1 JOIN top ON top.n = 1
"""


@llm_query("op12_merkle_manifest", ORACLE)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The digests are written, so that the sort's sample and its rows do not hash the texts twice.
    leaves = stage(document_leaves(table(spark, sf_dir, "documents")), "leaf-digests")
    proofs = manifest(leaves, "lang", "doc_id")
    discard(leaves)
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
