"""Chat formatting: round trips, examples as prefixes, hot and odd conversations."""

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from conftest import CLASHING, SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayload.llm import chat_format as C
from quayload.llm.registry import LLM_REGISTRY
from quayload.llm.workspace import stage

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def said(rows):
    """conv_id -> ordered (role, text), as the docstring defines it."""
    out = defaultdict(list)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", sha(r[3] or ""))
    for conv, _, role, text in sorted(rows, key=key):
        out[conv].append((role or "", text or ""))
    return out


def wanted(rows):
    out = {}
    for conv, turns in said(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), sum(r == "assistant" for r, _ in turns)
        )
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in df.collect()}


def odd_turns():
    r = random.Random(3)
    bits = [*C.CONTROL, "\\", "\\1", "\\0", "\\\\", "<", "[", "<<", "é", "👍", "\n", " ", "ok", "s>", "/s>", "\x1c", "$1"]
    text = lambda: "".join(r.choice(bits) for _ in range(r.randint(0, 12)))
    roles = ["user", "assistant", "system", "tool", "", None, "[/ROLE]", "<s>", "a\nb", "Assistant", "\\2"]
    rows = [(r.choice([1, 2, 3, 4, 5, None, -1, 2**63 - 1, -(2**63)]), r.choice([*range(12), None]), r.choice(roles), r.choice([text(), None]))
            for _ in range(600)]
    rows += [(7, 0, "user", "only a question")] + [(8, 1, "assistant", "same")] * 3 + [(9, 0, "assistant", "")]
    return rows + [(10, i, ("user", "assistant")[i % 2], f"turn {i} " + "x" * (i % 7)) for i in range(3000)]


@pytest.fixture(scope="module")
def written(spark):
    # Small sort partitions, so that one conversation runs over several of them.
    rows = odd_turns()
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("other"))
    return rows, stage(C.expand(df.repartition(5)), "t")


def test_reads_back_what_was_said(written):
    rows, output = written
    assert got(C.digests(output)) == wanted(rows)


def test_places_and_controls(written):
    rows, output = written
    whole = defaultdict(list)
    for r in output.orderBy("ordinal").collect():
        whole[r.conv_id].append(r)
    turns = said(rows)
    for conv, found in whole.items():
        assert [r.ordinal for r in found] == list(range(len(turns[conv])))
        assert [r.start for r in found] == [sum(x.chars for x in found[:i]) for i in range(len(found))] or len(found) > 1000
        stream = "".join(r.formatted for r in found)
        assert len(stream) == sum(r.chars for r in found)
        replies = 0
        for r, (role, text) in zip(found, turns[conv], strict=True):
            assert stream[r.start : r.start + r.chars] == r.formatted and r.example == replies
            # The marks are the only control strings.
            assert sum(r.formatted.count(m) for m in C.CONTROL) == (2 if role in C.MARKS else 3)
            if role == "assistant":
                replies += 1
                inner = stream[r.target_start : r.target_end]
                assert inner.replace("\\1", "<").replace("\\2", "[").replace("\\0", "\\") == text
            else:
                assert r.target_start is None and r.target_end is None


def test_example_has_all_turns_before(spark, written):
    _, output = written
    few = spark.createDataFrame([(10, 0), (10, 700), (8, 1), (None, 0), (7, 0)], "conv_id long, example long")
    texts = {(r.conv_id, r.example): r for r in C.example_texts(output, few).collect()}
    assert (7, 0) not in texts and {(10, 0), (10, 700), (8, 1), (None, 0)} <= set(texts)
    one = texts[10, 700]
    assert one.text.count("[INST]") == 701 and one.text.count("<s>") == 701
    assert one.text[one.target_start : one.target_end] == "turn 1401 x" and one.text.endswith("</s>")
    counts = {r.conv_id: r["count"] for r in C.examples(output).groupBy("conv_id").count().collect()}
    assert counts[10] == 1500 and counts[8] == 3 and 7 not in counts


def test_long_conversation_over_many_tasks(spark, monkeypatch):
    """One conversation, nearly all rows, cut by the range sort in several places."""
    monkeypatch.setattr(C, "partitions_for", lambda df: 6)
    rows = [(1, i, ("user", "assistant")[i % 2], "y" * (i % 11)) for i in range(2000)] + [(0, 0, "user", "a"), (2, 0, "assistant", "b")]
    output = stage(C.expand(spark.createDataFrame(rows, SCHEMA)), "t")
    assert output.where("conv_id = 1").select(F.input_file_name().alias("f")).distinct().count() > 1
    assert got(C.digests(output)) == wanted(rows)
    found = output.where("conv_id = 1").orderBy("ordinal").collect()
    assert [r.ordinal for r in found] == list(range(2000)) and [r.example for r in found] == [i // 2 for i in range(2000)]
    at = 0
    for r in found:
        assert r.start == at
        at += r.chars


def test_empty(spark):
    output = C.expand(spark.createDataFrame([], SCHEMA))
    assert output.count() == 0 and C.digests(output).count() == 0 and C.examples(output).count() == 0


def test_text_ids(spark):
    rows = [("b", 0, "assistant", "x"), ("a", 0, "user", "y"), (None, 0, "assistant", "z")]
    out = C.digests(C.expand(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")))
    assert got(out) == wanted(rows) and out.schema["conv_id"].dataType == T.StringType()


def test_query_matches_sql(spark):
    item = LLM_REGISTRY["op11_chat_format"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = item.run(spark, SF)
    want = con.sql(item.oracle)
    rows = {tuple(r[c] for c in want.columns) for r in df.collect()}
    assert rows == set(want.fetchall()) and len(rows) == df.count()
