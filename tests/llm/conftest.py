import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Python workers find the package by this path.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHING = ("id", "text_hash", "row", "n", "bucket", "unit", "payload", "_row", "_text", "_w", "label", "columns", "starts", "kept_text", "_id", "_n")


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, shared passages, a long text, odd characters."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(300)] + ["é", "日本", "👍", "A", "a", "\x1c", " x"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(60)
    near = base.split(" ")
    near[50] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "ONE"), (7, "two words"), (8, "a b c d e"), (9, "a b c d e"),
        (10, base), (11, base), (12, base.replace(" ", "\n")), (13, " ".join(near)), (14, base.upper()),
        (15, prose(30) + " " + passage + "\n" + prose(25)), (16, prose(40) + "\n\n" + passage), (17, passage + " " + passage),
        (18, "x" * 200), (19, "x" * 120), (20, ("lo " * 400).strip()), (21, prose(15000)), (22, "é" * 60), (23, prose(49)),
        (24, prose(3) + " | " + prose(200)), (25, "same line here\n" * 30), (None, base), (None, None), (10, base), (10, prose(30)),
        (26, "Des! .. \x1c\x1d x y"), (27, "  lead and  double   blanks \n \n tail  "),
    ]
    rows += [(100 + i, " ".join(near[:40] + [f"v{i}"] + near[41:])) for i in range(8)]
    r.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    names = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    names += [T.StructField(c, T.StringType()) for c in CLASHING]
    rows = [(doc, text, *(f"{c}{i}" for c in CLASHING)) for i, (doc, text) in enumerate(odd_rows())]
    return spark.createDataFrame(rows, T.StructType(names)).repartition(3)


@pytest.fixture(scope="session")
def odd_pairs():
    return odd_rows()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def real_pairs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
