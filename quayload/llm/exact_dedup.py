"""Operator 4: exact dedup by content sort, DataFrame functions only.

The normalised text (the six ASCII blanks deleted) is range-partitioned by sampled
splitters and sorted externally, so that equal texts lie next to each other; equality
is decided by the comparison of whole neighbouring texts. Splitters are drawn from a
bounded key, the first characters and a 64-bit hash of the text, which keeps what
the driver samples small and spreads texts with one common beginning. A salt from
the identifier splits every group of copies over up to ``salts`` range partitions;
what meets after that is one narrow row per (text, salt).

Of equal texts the row with the most code points in the original text stays, then
the smallest identifier. Defined results: a null text counts as empty, and all empty
texts are one group; identifiers that repeat with equal text are separate rows of one
group; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.registry import llm_query
from quayload.llm.workspace import shuffle_partitions, stage
from quayload.plans.registry import table

BLANKS = r"[\x20\x09-\x0D]+"
HEAD_CHARS = 32
SALTS = 64


def classes(df: DataFrame, text: str = "text", id_column: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    original = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(id_column).alias("doc_id"),
        F.length(original).alias("_n"),
        F.regexp_replace(original, BLANKS, "").alias("_norm"),
    ).select(
        "*",
        F.substring("_norm", 1, HEAD_CHARS).alias("_head"),
        F.xxhash64("_norm").alias("_hash"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("_salt"),
    )
    # The content sort. A range partitioning on the leading keys already clusters the
    # window's partitions, so the window adds no second exchange of the texts.
    ranged = rows.repartitionByRange(shuffle_partitions(df.sparkSession), "_head", "_hash", "_salt")
    same = Window.partitionBy("_head", "_hash", "_salt", "_norm")
    first = same.orderBy(F.col("_n").desc(), F.col("doc_id").asc_nulls_last())
    # Read twice below, so it is written: the texts are sorted once.
    sorted_rows = stage(
        ranged.select(
            "doc_id",
            "_salt",
            "_n",
            F.row_number().over(first).alias("_rank"),
            F.count(F.lit(1)).over(same).alias("_size"),
            F.sha2("_norm", 256).alias("text_sha256"),
        ),
        "content-sort",
    )
    heads = sorted_rows.where("_rank = 1").select("text_sha256", "_salt", "_n", "doc_id", "_size")
    # One row per (text, salt) at most; map-side combine leaves less.
    merged = heads.groupBy("text_sha256").agg(
        F.min_by("doc_id", F.struct(-F.col("_n"), F.col("doc_id").isNull(), F.col("doc_id"))).alias("keep_id"),
        F.sum("_size").cast("long").alias("group_size"),
    )
    # Back to the rows by text and salt, so that no key has more than its share of a group.
    salted = heads.select("text_sha256", "_salt").join(merged, "text_sha256")
    return sorted_rows.select("doc_id", "text_sha256", "_salt", "_rank").join(salted, ["text_sha256", "_salt"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_rank") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged; one of rows that repeat both identifier and text."""
    kept = classes(df, text, id_column).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(id_column).alias("_own"), F.sha2(normal, 256).alias("_text"))
    stays = rows.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_sha")), "left_semi")
    once = stays.dropDuplicates(["_own", "_text"])
    return once.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))


ORACLE = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


@llm_query("op4_exact_dedup", ORACLE)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
