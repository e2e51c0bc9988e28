"""Phrase mining against plain counting, with odd texts, several lengths and chunks of any size."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from conftest import CLASHING, SF
from pyspark.sql import functions as F

from quayload.llm import collocations as P
from quayload.llm.registry import LLM_REGISTRY

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        if words := re.findall("[^\x20\x09]+", piece):
            yield words


def brute(rows, longest=3, least=10, inside=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i : i + k]] = max(covered[p[i : i + k]], a)
        found = []
        for p, a in candidates.items():
            if p in covered and 100 * covered[p] >= inside * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def odd_texts():
    r = random.Random(9)
    words = ["the", "of", "A", "a", "new", "york", "city", "é", "日本", "👍", "x-y", "\x1c", "\xa0", "$", "Nul\0l"] + [f"w{i}" for i in range(40)]
    ends = [".", ", ", "\n", "\r\n", " ; ", "!?", "\x0b", "\x0c", "\t", "  "]
    weights = [20] * 8 + [1] * (len(words) - 8)
    text = lambda n: "".join(r.choices(words, weights)[0] + (r.choice(ends) if r.random() < 0.2 else " ") for _ in range(n))
    rows = [(r.choice(["en", "de", None, "und", ""]), r.choice([text(r.randint(0, 60)), text(3), None, "", " \t\n"])) for _ in range(400)]
    rows += [("en", "new york city " * 30)] * 5 + [("fr", "same same same same")] * 9 + [("long", text(30000))] + [("xx", "one word")] * 12
    return rows + [("en", "New\tYork,new york;NEW YORK")] * 12


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for c in [*CLASHING, "hash", "chunk", "phrase", "f"]:
        df = df.withColumn(c, F.lit("x"))
    return rows, df.withColumn("doc_id", F.lit(None).cast("long"))


def test_odd_texts(odd_docs):
    rows, df = odd_docs
    assert rows_of(P.strongest(*P.mine(df))) == brute(rows)


@pytest.mark.parametrize(("longest", "least", "inside", "top"), [(2, 3, 50, 5), (4, 10, 80, 2000), (5, 20, 30, 10)])
def test_lengths(odd_docs, longest, least, inside, top):
    rows, df = odd_docs
    found = P.strongest(*P.mine(df, max_words=longest, min_count=least, inside_percent=inside), top)
    assert rows_of(found) == brute(rows, longest, least, inside, top)


def test_hashes_decide_nothing(odd_docs, monkeypatch):
    """With two hash values for all phrases the filter lets everything through, and the result stays."""
    import quayload.llm.collocations as module

    class Colliding(module.Mining):
        def hashes(self):
            return super().hashes() & module.U64(1)

    rows, df = odd_docs
    monkeypatch.setattr(module, "Mining", Colliding)
    assert rows_of(P.strongest(*P.mine(df))) == brute(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert P.strongest(*P.mine(docs)).count() == 0
    nothing = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert P.strongest(*P.mine(nothing)).count() == 0


def test_products_pass_64_bits(spark):
    big = [("x", 1, "p", 9_000_000_000_000), ("x", 1, "q", 8_000_000_000_000), ("x", 2, "p q", 7_000_000_000_000)]
    row = P.scored(spark.createDataFrame(big, "lang string, size long, phrase string, f long")).first()
    assert row.score == 1_000_000 * 7_000_000_000_000**2 // (9_000_000_000_000 * 8_000_000_000_000)


def test_query_matches_brute_force(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert rows_of(LLM_REGISTRY["op13_phrase_mining"].run(spark, SF)) == brute(rows)


def test_questions_are_small(odd_docs):
    """A phrase costs some bytes in the shuffle, not a row; a row of three 64-bit numbers each before."""
    from quayload.llm.collocations import Mining, hashed_counts, relation, unpacked

    _, df = odd_docs
    r1 = relation(df).cache()
    asked = hashed_counts(r1, 4).collect()
    want = sum(len(Mining(r.lang, pa.array(r.words), unpacked(r.codes), unpacked(r.pieces)).extend()) for r in r1.collect())
    assert sum(len(unpacked(r.rest)) for r in asked) == want
    assert sum(len(r.rest) + len(r.counts) for r in asked) < 6 * want + 60 * len(asked)
