"""Deduplication operators against brute force, over real and odd rows."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import exact_classes, near_classes, repeated_bytes, repeated_words, words
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from quayload.llm import anchors, exact_dedup, hashing, ngram_join, substring_dedup, suffix_dedup
from quayload.llm.components import components
from quayload.llm.fm_index import FmIndex, suffix_array
from quayload.llm.suffix_dedup import deep_shallow


def rows_of(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


NEAR = ("doc_id", "n_shingles", "component_id")
WORD = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTE = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def word_digest(df):
    from pyspark.sql import functions as F

    return substring_dedup.judged(df).withColumn("kept_sha256", F.sha2("kept_words", 256))


def byte_digest(df):
    from pyspark.sql import functions as F

    return suffix_dedup.judged(df).withColumn("kept_sha256", F.sha2("kept_bytes", 256))


def test_near_real(spark, real_pairs):
    assert rows_of(ngram_join.op1_ngram_join(spark, SF), *NEAR) == Counter(near_classes(real_pairs))


def test_near_odd(odd, odd_pairs):
    assert rows_of(ngram_join.classes(odd), *NEAR) == Counter(near_classes(odd_pairs))


def test_near_large_clusters(spark, odd, odd_pairs, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_ENTRIES", 300)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    assert rows_of(ngram_join.classes(odd), *NEAR) == Counter(near_classes(odd_pairs))


def test_near_empty(empty):
    assert ngram_join.classes(empty).count() == 0


def test_near_keeps_one_with_all_columns(odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 13 not in ids and 107 not in ids and 23 in ids and 1 in ids


@pytest.mark.parametrize("ids", [(None, None, None), (7, 7, 8), (7, 8, 7), (None, 3, None), (5, 5, 5), (9, None, 9)])
def test_near_keeps_one_of_null_and_repeated_ids(spark, ids):
    """Three near copies, one of them twice, beside texts without words and another document of the same id."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join([*words[:n], "changed", *words[n + 1 :]]) for n in (10, 50, 90)]
    rows = [(i, t) for i, t in zip(ids, texts, strict=True)] + [(ids[0], texts[0]), (ids[0], "some other text of six words"), (ids[0], ""), (ids[0], None)]
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    near = [r for r in kept if r[1] in texts]
    assert len(near) == 1 and near[0][0] == min((i for i in ids if i is not None), default=None)
    assert sorted(str(r[1]) for r in kept if r[1] not in texts) == ["", "None", "some other text of six words"]


@given(st.lists(st.tuples(st.lists(st.integers(0, 30), max_size=12), st.integers(0, 3)), min_size=2, max_size=12))
@settings(max_examples=200, deadline=None)
def test_product_finds_every_link(made):
    """Columns are in one order for all rows; own columns of a row are counted in its size only."""
    sets = [sorted(set(c)) for c, _ in made]
    sizes = np.array([len(s) + own for s, (_, own) in zip(sets, made, strict=True)])
    prefix = np.array([n - -(-3 * n // 4) + 1 - own for n, (_, own) in zip(sizes.tolist(), made, strict=True)])
    rows = [i for i in range(len(made)) if prefix[i] > 0 and sets[i]]
    if len(rows) < 2:
        return
    found = ngram_join.product_links(
        sizes[rows], np.minimum(prefix[rows], [len(sets[i]) for i in rows]), [np.array(sets[i]) for i in rows], np.arange(len(rows))
    )
    up = list(range(len(made)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for a, b in found:
        up[find(rows[a])] = find(rows[b])
    got = [find(i) for i in range(len(made))]
    up = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            k = len(set(sets[i]) & set(sets[j]))
            if k and 100 * k >= 75 * (sizes[i] + sizes[j] - k):
                up[find(i)] = find(j)
    want = [find(i) for i in range(len(made))]
    same = lambda x: [[x[i] == x[j] for j in range(len(x))] for i in range(len(x))]
    assert same(got) == same(want)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    labels = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(labels[i] == 0 for i in range(41)) and all(labels[i] == 100 for i in range(100, 130))
    assert labels[200] == labels[201] == 200


def test_words_real(spark, real_pairs):
    assert rows_of(substring_dedup.op9_substring_dedup(spark, SF), *WORD) == Counter(repeated_words(real_pairs))


@pytest.mark.parametrize("hot", [2000, 1])
def test_words_odd(odd, odd_pairs, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    assert rows_of(word_digest(odd), *WORD) == Counter(repeated_words(odd_pairs))


def test_words_many_units(odd, odd_pairs, monkeypatch):
    """Tiny units and chunks ask across units what is otherwise settled inside one."""
    monkeypatch.setattr(anchors, "UNIT_BYTES", 1)
    assert rows_of(word_digest(odd), *WORD) == Counter(repeated_words(odd_pairs))


def test_words_empty_and_columns(empty, odd):
    assert substring_dedup.judged(empty).count() == 0
    cut = substring_dedup.drop_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    texts = {r.doc_id: r.text for r in cut.where("doc_id in (1, 27)").collect()}
    assert texts[1] == "" and texts[27] == "  lead and  double   blanks \n \n tail  "


def test_bytes_real(spark, real_pairs):
    some = sorted(real_pairs)[:80]
    df = spark.createDataFrame(some, "doc_id long, text string")
    assert rows_of(byte_digest(df), *BYTE) == Counter(repeated_bytes(some))


@pytest.mark.parametrize("hot", [2000, 1])
def test_bytes_odd(odd, odd_pairs, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    assert rows_of(byte_digest(odd), *BYTE) == Counter(repeated_bytes(odd_pairs))


def test_bytes_empty(empty):
    assert suffix_dedup.judged(empty).count() == 0


@given(st.lists(st.integers(0, 2), min_size=60, max_size=400), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_deep_shallow_sorts(symbols, shallow):
    data = np.array(symbols, np.uint8)
    places = np.arange(len(data) - 49)
    order, same = deep_shallow(data, places, 50, shallow)
    strings = [data[p : p + 50].tobytes() for p in places]
    got = [strings[i] for i in order]
    assert got == sorted(strings)
    assert same.tolist() == [i > 0 and got[i] == got[i - 1] for i in range(len(got))]


@given(st.lists(st.integers(1, 5), min_size=1, max_size=200), st.lists(st.integers(1, 5), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_backward_search_counts(symbols, pattern):
    text = np.array([*symbols, 0])
    order = suffix_array(text)
    assert [text[i:].tolist() for i in order] == sorted(text[i:].tolist() for i in range(len(text)))
    index, low, high = FmIndex(text), np.array([0]), np.array([len(text)])
    for symbol in reversed(pattern):
        if symbol >= len(index.first) - 1:
            return
        low, high = index.extend(np.array([symbol]), low, high)
    count = sum(text[i : i + len(pattern)].tolist() == pattern for i in range(len(text)))
    assert int(high[0] - low[0]) == count


def test_exact_odd(odd, odd_pairs):
    got = rows_of(exact_dedup.classes(odd), "doc_id", "keep_id", "group_size", "text_sha256")
    assert got == Counter(exact_classes(odd_pairs))
    kept = exact_dedup.classes(odd).where("kept")
    assert kept.count() == kept.select("text_sha256").distinct().count()


def test_exact_empty_and_columns(empty, odd, odd_pairs):
    assert exact_dedup.classes(empty).count() == 0
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({x[3] for x in exact_classes(odd_pairs)})


def test_exact_content_sort_moves_texts_once(spark, odd):
    """The window over the range-partitioned texts adds no second exchange."""
    rows = odd.selectExpr("text as t").repartitionByRange(4, "t").selectExpr("count(1) over (partition by t) as c")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def collided_texts():
    """Two different texts whose xxhash64 has equal low 32 bits."""
    made = [" ".join(f"w{i}x{j}" for j in range(30)) for i in (948, 74123)]
    import xxhash

    assert len({xxhash.xxh64_intdigest(t, seed=42) & 0xFFFFFFFF for t in made}) == 1
    return made


def test_texts_without_id_and_equal_short_hashes(spark):
    """A copy's removals, and a set's columns, stay with their own text."""
    one, two = collided_texts()
    near = [t.rsplit(" ", 1)[0] for t in (one, two)]
    rows = [(1, one), (None, one), (None, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(word_digest(df), *WORD) == Counter(repeated_words(rows))
    assert rows_of(byte_digest(df), *BYTE) == Counter(repeated_bytes(rows))
    # Parts of texts are repeated, not whole ones.
    rows = [(1, near[0] + " a b c"), (None, one), (None, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(word_digest(df), *WORD) == Counter(repeated_words(rows))
    assert rows_of(byte_digest(df), *BYTE) == Counter(repeated_bytes(rows))
    rows = [(None, one), (None, two), (1, near[0]), (2, near[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert rows_of(ngram_join.classes(df), *NEAR) == Counter(near_classes(rows))


@pytest.mark.parametrize("scheme", [substring_dedup.SCHEME, suffix_dedup.SCHEME])
def test_unit_tables_do_not_gather(scheme):
    """Tables of units from many tasks are dealt to groups of their own, whatever the number of buckets."""
    data = " ".join(f"word{i}" for i in range(60)).encode()
    raw, offsets = np.frombuffer(data, np.uint8), np.array([0, len(data)])
    for buckets in (32, 96, 800):
        groups = Counter()
        for task in range(40):
            for made in range(4):
                unit = anchors._Unit((task << 32) + made)
                unit.add(anchors.Runs(scheme, raw, offsets, 0, 1), np.array([1]), np.zeros((1, 2), np.int64))
                groups.update(group for group, _, _ in unit.rows(buckets) if group >= buckets)
        assert len(groups) == 160 and max(groups.values()) == 1


def near_links(rows):
    """Per row its links to other rows, and the sizes and overlaps of linked different sets."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, text in rows:
        w = words((text or "").translate(lower))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    like = lambda a, b: bool(a) and 4 * len(a & b) >= 3 * len(a | b)
    counts = Counter((doc, sum(like(s, x) for j, x in enumerate(sets) if j != i)) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))
    once = sorted(set(sets), key=sorted)
    return counts, Counter(
        (*sorted((len(a), len(b))), len(a & b)) for i, a in enumerate(once) for b in once[:i] if like(a, b)
    )


@pytest.mark.parametrize("entries", [1 << 19, 300])
def test_near_counts_every_link(odd, odd_pairs, monkeypatch, entries):
    """Also inside a group that a few of its links would connect, and between tiles."""
    monkeypatch.setattr(ngram_join, "TILE_ENTRIES", entries)
    counts, pairs = near_links(odd_pairs)
    assert rows_of(ngram_join.classes(odd), "doc_id", "n_links") == counts
    found = ngram_join.linked_sets(odd).collect()
    assert Counter((*sorted((r.n_a, r.n_b)), r.n_both) for r in found) == pairs
    sizes = {r.set_id: r.n_shingles for r in ngram_join.members(odd).collect()}
    assert all(sizes[r.set_a] == r.n_a and sizes[r.set_b] == r.n_b for r in found)


def test_near_keeps_one_of_large_clusters(odd, odd_pairs, monkeypatch):
    """The spanning part of the links over pivots and tiles gives the components of all links."""
    monkeypatch.setattr(ngram_join, "TILE_ENTRIES", 300)
    monkeypatch.setattr(ngram_join, "PIVOTS", 1)
    got = rows_of(ngram_join._components(odd, "text", "doc_id"), "doc_id", "component_id")
    assert got == Counter((doc, least) for doc, _, least in near_classes(odd_pairs))


def test_sets_need_little_memory():
    """A worker's arrays follow the chunk, not the batch; 226 MB were held at once before."""
    import tracemalloc

    text = " ".join(f"w{i * 7919 % 9973}" for i in range(400))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5000)), pa.array([b"0" * 16] * 5000), pa.array([f"{i} {text}" for i in range(5000)])], ["id", "text_hash", "text"]
    )
    hashing._POWERS.clear()
    tracemalloc.start()
    try:
        assert sum(1 for _, made in ngram_join._made(batch) for own in made if len(own) == 397) == 5000
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()
        hashing._POWERS.clear()
