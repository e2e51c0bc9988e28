"""Operator 10: quality rules as one Spark projection, without user functions.

A table of thresholds over length, symbol, stop-word and line ratios is compiled into
boolean columns. All measures are built-in expressions over the whole text.

Defined results: a null or blank text has zero words, fails the base rule and is not
kept; rows are judged one by one, so repeated rows get equal verdicts; an empty table
gives an empty result; other columns of the input are not read, or are carried
through unchanged by :func:`apply_rules`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.llm.registry import llm_query
from quayload.llm.workspace import WORD
from quayload.plans.registry import table

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to is in that it be for on with as was by at this from are or an a "
    "der die das und ist den nicht von mit ein eine zu auf für im dem sich des auch sie "
    "le la les et de un une est du en dans que qui pour sur pas il elle avec au "
    "el los las y por con no se una del al lo su es para"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject where ``measure`` is outside ``[low, high]``; None is no bound."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are over the words, word characters or lines of a text.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 20.0),
    Rule("symbol_ratio", "n_symbols / word_chars", None, 0.05),
    Rule("stop_word_ratio", "n_stop_words / n_words", 0.02, None),
    Rule("duplicate_line_ratio", "n_dup_lines / n_lines", None, 0.4),
)

_BLANKS = r"[\x20\x09-\x0D]"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _lines(text: Column) -> Column:
    """Lines that hold a word, as they stand."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def _repeated_positions(words: Column) -> Column:
    """Sorted first-word positions of 3-word windows that occur at least twice.

    Windows are sorted by content with their positions, so that equal ones are
    neighbours: n log n, whatever the text repeats.
    """
    n = F.size(words)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")
        ),
    )


def measures(df: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and the whole-text measures the rules are made of."""
    base = df.select(F.col(id_column), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    split = base.select(
        id_column,
        _words(F.col("_t")).alias("_w"),
        _lines(F.col("_t")).alias("_l"),
        F.length(F.regexp_replace("_t", _BLANKS + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    windows = split.select("*", F.array_sort(_repeated_positions(F.col("_w"))).alias("_s"))
    found = windows.select(
        "*",
        F.array_sort(
            F.filter(
                F.transform(
                    "_s",
                    lambda x, j: F.when(
                        (x["w"] == F.get(F.col("_s"), j + 1)["w"]) | ((j > 0) & (x["w"] == F.get(F.col("_s"), j - 1)["w"])),
                        x["i"],
                    ),
                ),
                lambda p: p.isNotNull(),
            )
        ).alias("_p"),
    )
    # A window at p covers p to p + 2; the next one adds what lies beyond.
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("_p"), j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.select(
        id_column,
        F.size("_w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(F.rtrim(w, F.lit(".,;:"))).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        # Not deterministic to the optimizer: a filter that reads it stays above this projection. Pushed
        # below, it would hold the expressions of all measures once for every time they are read.
        F.spark_partition_id().alias("_above"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rejected(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean from the whole threshold table; undefined ratios reject nothing."""
    out = F.lit(False)
    for rule in rules:
        over, under = rule.measure.split(" / ")
        ratio = F.when(F.col(under) > 0, F.col(over) / F.col(under))
        for broken in ([ratio < rule.low] if rule.low is not None else []) + ([ratio > rule.high] if rule.high is not None else []):
            out = out | F.coalesce(broken, F.lit(False))
    return out


def judge(df: DataFrame, text: str = "text", id_column: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: measures, ``base_failed`` and ``kept``."""
    return (
        measures(df, text, id_column)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~rejected(rules))
    )


def _public(judged: DataFrame) -> DataFrame:
    return judged.drop("n_lines", "n_stop_words", "_above")


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, all columns unchanged; no shuffle, no join."""
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(text).alias("_text"))
    verdicts = judge(packed, "_text", "_row", rules).where("kept and _above >= 0")
    return verdicts.select(*(F.col("_row").getField(c).alias(c) for c in df.columns))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
h AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS c FROM h WHERE c IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines,
             len(list_filter(ws, lambda x: list_contains([STOP_WORDS], lower(rtrim(x, '.,;:')))))::BIGINT AS n_stop_words
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 20 AND n_symbols / word_chars <= 0.05
         AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.4 AS kept
FROM b
""".replace("STOP_WORDS", ", ".join(f"'{w}'" for w in STOP_WORDS))


@llm_query("op10_quality_rules", ORACLE)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _public(judge(table(spark, sf_dir, "documents")))
