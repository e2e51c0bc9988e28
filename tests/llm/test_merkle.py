"""The Merkle manifest against a plain tree, over several passes and with odd rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from conftest import CLASHING, SF
from pyspark.sql import functions as F

from quayload.llm import merkle as M
from quayload.llm.registry import LLM_REGISTRY
from quayload.llm.workspace import stage


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """(root, path of every node as (left, right) pairs)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            run = at // fanout * fanout
            path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fanout])))
        places = [at // fanout for at in places]
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def tree(rows, fanout=2):
    """Sorted (group, id, leaf, subroot, root, path) of (group, id, leaf) rows."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    made = [climb([r[2] for r in groups[g]], fanout) for g in names]
    root, over = climb([m[0] for m in made], fanout)
    return sorted(
        (str(r), m[0], root, tuple(path + above))
        for g, m, above in zip(names, made, over, strict=True)
        for r, path in zip(groups[g], m[1], strict=True)
    )


def built(df, fanout=2, levels=10):
    out = M.manifest(df, "lang", "doc_id", "leaf", fanout, levels)
    return sorted((str((r.lang, r.doc_id, r.leaf)), r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in out.collect())


def odd_leaves():
    rows = [("en", i, h(str(i))) for i in range(530)] + [(None, 5, h("n"))] + [("de", i % 7, h(str(i % 9))) for i in range(40)]
    rows += [("fr", None, h(f"f{i}")) for i in range(20)] + [("", 1, h("blank")), ("é", -3, h("e")), ("zz", 2**63 - 1, h("z"))]
    return rows + [("same", 1, h("same"))] * 33 + [("two", 1, h("a")), ("two", 2, h("b"))]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 10), (2, 3), (2, 1), (3, 2), (5, 1)])
def test_tree(spark, fanout, levels):
    rows = odd_leaves()
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").repartition(4)
    assert built(df, fanout, levels) == tree(rows, fanout)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9])
def test_small(spark, n):
    rows = [("en", i, h(str(i))) for i in range(n)]
    assert built(spark.createDataFrame(rows, "lang string, doc_id long, leaf string"), 2, 2) == (tree(rows) if n else [])


def test_many_groups(spark):
    rows = [(f"g{i % 700}", i, h(str(i))) for i in range(1500)]
    assert built(spark.createDataFrame(rows, "lang string, doc_id long, leaf string"), 2, 4) == tree(rows)


def test_fold_tells_a_change(spark):
    rows = [("en", i, h(str(i))) for i in range(37)]
    out = M.manifest(spark.createDataFrame(rows, "lang string, doc_id long, leaf string"), "lang", "doc_id")
    wrong = F.when(F.col("doc_id") % 5 == 0, F.lit(h("other"))).otherwise(F.col("leaf"))
    verdicts = {r.doc_id: r.ok for r in out.select("doc_id", (M.fold(wrong, F.col("path")) == F.col("root")).alias("ok")).collect()}
    assert verdicts == {i: i % 5 != 0 for i in range(37)}


def brute(rows):
    """What the query returns for (doc_id, text, lang, source, n_chars) rows."""
    leaves = [(lang, doc, leaf(doc, source, lang, n, text)) for doc, text, lang, source, n in rows]
    changed = {}
    for doc, text, lang, source, n in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        changed[leaf(doc, source, lang, n, text)] = leaf(doc, source, lang, n + 1, text) if hit else leaf(doc, source, lang, n, text)
    out = []
    for key, sub, root, path in tree(leaves):
        _, doc, own = eval(key)  # noqa: S307
        node = changed[own]
        for left, right in path:
            node = h(left, node, right)
        out.append((doc, own, sub, root, h(*(left + right for left, right in path)), node, node == root))
    return sorted(out, key=str)


def test_query(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (7, "é" * 9, None, "web", None), (3, "x" * 300000, "en", None, 2**63 - 1),
           (None, "t", "en", "s", 5), (2**63 - 1, "last", "en", "s", 1), (-5, "neg", "zz", "s", 4)]
    mixed = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
    for c in CLASHING:
        mixed = mixed.withColumn(c, F.lit("x"))
    mixed.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in mixed.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = LLM_REGISTRY["op12_merkle_manifest"].run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    assert any(not r.verified for r in found) and any(r.verified for r in found)


def test_discarded_table_is_empty(spark):
    from quayload.llm.workspace import discard

    df = stage(spark.range(100).repartition(3), "t")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    discard(df)
    assert spark.read.schema("id long").parquet(path).count() == 0
