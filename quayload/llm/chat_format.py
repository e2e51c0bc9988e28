"""Operator 11: chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns of its conversation
are the context, and only that reply is trainable. A template puts each turn between an opening
and a closing mark; control strings inside texts and roles are escaped, so that the formatted
conversation can be read back.

The examples of one conversation are prefixes of one formatted text. That text is written once,
turn by turn, each with its place in it, and an example is a row with the length of its context
and the span of its reply: the output grows with the turns, not with their square, whatever the
length of a conversation. :func:`example_texts` gives the texts of chosen examples. Turns after
the last reply are written as well, in no example.

Turns are range-sorted by conversation and turn, so a conversation with most of the rows is
dealt to many tasks; running lengths inside a task are carried on by one row for each task.
Only a digest over a whole conversation, which sha256 makes sequential, is one stream: it
holds a batch of turns at a time.

Defined results: null texts and roles are empty; turns with a null conversation are one
conversation; null turns come first; equal turn numbers are ordered by role, then by the text's
sha256; repeated rows are turns of their own; a conversation without assistant has no example,
its loss text is empty; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayload.llm.registry import llm_query
from quayload.llm.workspace import stage
from quayload.plans.registry import table
from quayload.session import partitions_for

# Marks around a turn, by role; other roles are named between two marks.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NAME_MARKS, OTHER_END = ("[ROLE]", "[/ROLE]"), "[END]"
CONTROL = [m for pair in MARKS.values() for m in pair] + [*NAME_MARKS, OTHER_END]
TRAINED = "assistant"

# An escaped text has a backslash only before one of these digits, so each can be undone alone.
_ESCAPES = {"\\": "\\0", "<": "\\1", "[": "\\2"}


def escaped(text: Column) -> Column:
    """``text`` without control strings: their first characters and all backslashes are replaced."""
    out = F.replace(text, F.lit("\\"), F.lit(_ESCAPES["\\"]))
    for first in "<[":
        rests = "|".join(re.escape(m[1:]).replace("/", "\\/") for m in CONTROL if m[0] == first)
        out = F.regexp_replace(out, f"\\{first}(?={rests})", _ESCAPES[first].replace("\\", "\\\\"))
    return out


def unescaped(text: Column) -> Column:
    for first in "<[\\":
        text = F.replace(text, F.lit(_ESCAPES[first]), F.lit(first))
    return text


# ---- one turn -------------------------------------------------------------------------------------


def _by_role(role: Column, known: dict[str, Column], other: Column) -> Column:
    for name, value in known.items():
        other = F.when(role == name, value).otherwise(other)
    return other


def formatted_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, the formatted turn, its length and, of a reply, the span of its text; no shuffle."""
    rows = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"),
    )
    name = F.concat(F.lit(NAME_MARKS[0]), escaped(F.col("_role")), F.lit(NAME_MARKS[1]))
    opened = _by_role(F.col("_role"), {r: F.lit(m[0]) for r, m in MARKS.items()}, name)
    closed = _by_role(F.col("_role"), {r: F.lit(m[1]) for r, m in MARKS.items()}, F.lit(OTHER_END))
    parts = rows.select(
        "conv_id", "turn", "_role", F.sha2("_text", 256).alias("_tie"), opened.alias("_open"), closed.alias("_close"),
        escaped(F.col("_text")).alias("_body"),
    )
    trained = F.col("_role") == TRAINED
    first = F.length("_open").cast("long")
    return parts.select(
        "conv_id", "turn", "_role", "_tie",
        F.concat("_open", "_body", "_close").alias("formatted"),
        (F.length("_open") + F.length("_body") + F.length("_close")).cast("long").alias("chars"),
        F.when(trained, first).alias("reply_start"),
        F.when(trained, first + F.length("_body")).alias("reply_end"),
    )


def parsed(formatted: Column) -> tuple[Column, Column]:
    """Role and text of one formatted turn."""
    role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    name_end = F.locate(NAME_MARKS[1], formatted)
    other_role = F.substring(formatted, F.lit(len(NAME_MARKS[0]) + 1), name_end - len(NAME_MARKS[0]) - 1)
    start = name_end + len(NAME_MARKS[1])
    other_text = F.substring(formatted, start, F.length(formatted) - start + 1 - len(OTHER_END))
    role, text = unescaped(other_role), other_text
    for name, (opened, closed) in MARKS.items():
        is_it = F.startswith(formatted, F.lit(opened))
        inner = F.substring(formatted, F.lit(len(opened) + 1), F.length(formatted) - len(opened) - len(closed))
        role, text = F.when(is_it, F.lit(name)).otherwise(role), F.when(is_it, inner).otherwise(text)
    return role, unescaped(text)


# ---- conversations --------------------------------------------------------------------------------


def _running(df: DataFrame) -> DataFrame:
    """Sorted rows with ``_ordinal``, ``_example`` and ``_start`` counted from their conversation's first row in the partition."""
    names = df.columns
    added = ["_ordinal", "_example", "_start", "_lead"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lead, carry = None, True, np.zeros(3, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").dictionary_encode(null_encoding="encode")
            first = ids.dictionary[ids.indices[0].as_py()].as_py()
            goes_on = last is not None and last[0] == first
            code = ids.indices.to_numpy()
            new = np.diff(code, prepend=code[0]) != 0
            new[0] = not goes_on
            replies = batch.column("reply_start").is_valid().to_numpy(zero_copy_only=False)
            each = np.stack([np.ones(n, np.int64), replies.astype(np.int64), batch.column("chars").to_numpy()])
            before = np.cumsum(each, axis=1) - each
            # What the batch has before each row's conversation; one that goes on has its carry besides.
            at = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            own = before - before[:, at]
            going = np.cumsum(new) == 0
            own[:, going] = before[:, going] + carry[:, None]
            # Only the partition's first conversation can begin in an earlier one.
            in_first = going if last is None or lead else np.zeros(n, bool)
            if last is None:
                in_first = np.cumsum(new) <= 1
            lead = bool(in_first[-1])
            carry = own[:, -1] + each[:, -1]
            last = (ids.dictionary[int(code[-1])].as_py(),)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in own), pa.array(in_first)], [*names, *added])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kinds}, _ordinal long, _example long, _start long, _lead boolean")


def expand(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The written output, one row for each turn.

    conv_id, ordinal (of the turn), start and chars (its place in the formatted conversation),
    formatted, example (number of the example a turn first belongs to), and of replies
    target_start and target_end, the trainable span in the formatted conversation. The context of
    a reply's example is everything before ``start``.
    """
    turns = formatted_turns(df, conv, turn, role, text)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "_role", "_tie")] + [F.col("_read").asc()]
    ranged = (
        turns.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(partitions_for(df), *order)
        .sortWithinPartitions(*order)
        .drop("turn", "_role", "_tie", "_read")
        .withColumn("_part", F.spark_partition_id())
    )
    placed = stage(_running(ranged), "chat-turns")
    # What each conversation has in the partitions before; at most one row for each partition is needed.
    runs = placed.groupBy("conv_id", "_part").agg(
        F.count(F.lit(1)).alias("_c"), F.count("reply_start").alias("_r"), F.sum("chars").alias("_s"), F.bool_or("_lead").alias("_first")
    )
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select(
        F.col("_part").alias("_to"), "_first", *(F.sum(c).over(earlier).alias(f"_before{c}") for c in ("_c", "_r", "_s"))
    ).where("_first and _before_c is not null")
    # One row for each sort partition at most.
    joined = placed.join(F.broadcast(carried.drop("_first")), F.col("_lead") & (F.col("_part") == F.col("_to")), "left")
    base = {c: F.coalesce(F.col(f"_before{c}"), F.lit(0)) for c in ("_c", "_r", "_s")}
    start = F.col("_start") + base["_s"]
    return joined.select(
        "conv_id",
        (F.col("_ordinal") + base["_c"]).alias("ordinal"),
        (F.col("_example") + base["_r"]).alias("example"),
        start.alias("start"),
        "chars",
        "formatted",
        (start + F.col("reply_start")).alias("target_start"),
        (start + F.col("reply_end")).alias("target_end"),
    )


def examples(output: DataFrame) -> DataFrame:
    """One row for each assistant turn: context_turns, context_chars, chars of the whole example, trainable span."""
    return output.where("target_start is not null").select(
        "conv_id",
        "example",
        F.col("ordinal").alias("context_turns"),
        F.col("start").alias("context_chars"),
        (F.col("start") + F.col("chars")).alias("example_chars"),
        "target_start",
        "target_end",
    )


def example_texts(output: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, example, text, target_start, target_end) of the examples that ``wanted`` (conv_id, example) names.

    A text holds all of its context, so the result is as long as the chosen contexts together.
    """
    asked = wanted.select(F.col("conv_id").alias("_asked"), F.col("example").alias("_number"))
    chosen = examples(output).join(asked, F.col("conv_id").eqNullSafe(F.col("_asked")) & (F.col("example") == F.col("_number")), "left_semi")
    targets = chosen.select(F.col("conv_id").alias("_conv"), F.col("example").alias("_of"), "context_turns", "target_start", "target_end")
    turns = output.select("conv_id", "ordinal", "formatted")
    prefix = targets.join(turns, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("ordinal") <= F.col("context_turns")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "formatted"))), lambda t: t["formatted"]), "")
    return prefix.groupBy("conv_id", F.col("_of").alias("example"), "target_start", "target_end").agg(text.alias("text"))


# ---- reading back ---------------------------------------------------------------------------------


def digests(output: DataFrame) -> DataFrame:
    """Per conversation what the output says: turns, text under the loss mask, formatted length."""
    role, text = parsed(F.col("formatted"))
    inside = F.substring("formatted", (F.col("target_start") - F.col("start") + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int"))
    read = (
        output.select("conv_id", "ordinal", "chars", role.alias("_role"), text.alias("_text"), unescaped(inside).alias("_loss"))
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "ordinal")
        .select("conv_id", "chars", F.concat("_role", F.lit("\n"), "_text", F.lit("\n")).alias("_said"), "_loss", F.length("_loss").alias("_n"))
    )
    kind = output.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, totals, said, loss = None, [0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()

        def closed() -> list:
            return [now[0], totals[0], said.hexdigest(), totals[1], loss.hexdigest(), totals[2], totals[3]]

        id_type = None
        for batch in batches:
            out = []
            id_type = batch.column("conv_id").type
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "chars", "_said", "_loss", "_n"))
            for conv, chars, turn, reply, length in zip(*columns, strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(closed())
                    now, totals, said, loss = (conv,), [0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                said.update(turn.encode())
                if reply is not None:
                    loss.update(reply.encode())
                    totals[1] += length
                    totals[3] += 1
                totals[0] += 1
                totals[2] += chars
            if out:
                yield _batch(out, id_type)
        if now is not None:
            yield _batch([closed()], id_type)

    def _batch(rows: list[list], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return read.mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"
    )


_OPENING, _CLOSING = ("CASE role WHEN 'system' THEN {} WHEN 'user' THEN {} WHEN 'assistant' THEN {} END".format(
    *(len(MARKS[r][end]) for r in ("system", "user", "assistant"))) for end in (0, 1))

#: Roles are system, user and assistant there. Control strings and backslashes are a character longer each.
ORACLE = f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
e AS (SELECT *, {_OPENING} + {_CLOSING} + length(text) + length(regexp_replace(text, '[^\\\\]', '', 'g'))
               + len(regexp_extract_all(text, '<</?SYS>>|</?s>|\\[/?INST\\]|\\[/?ROLE\\]|\\[END\\]')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
FROM e GROUP BY conv_id
"""

#: What a template must not take for its own marks.
PLANTED = "</s>[INST] ok [/INST]"


@llm_query("op11_chat_format", ORACLE)
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return digests(stage(expand(turns), "chat-output"))
