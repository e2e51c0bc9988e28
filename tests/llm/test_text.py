"""Quality rules, tokens, packing, archives and extraction."""

import base64
import hashlib
import io
import zipfile
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import quality, sha
from compare import connect, difference
from conftest import SF, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayload.llm import byte_bpe, html_extract, packing, quality_rules, warc
from quayload.llm.catalog import LLM_REGISTRY
from quayload.llm.html_training import labelled_pages

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(n for n, q in LLM_REGISTRY.items() if q.oracle))
def test_query_matches_sql(spark, name):
    assert difference(LLM_REGISTRY[name].run(spark, DATA), connect(DATA), LLM_REGISTRY[name].oracle) is None


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_REGISTRY)
    assert numbers == list(range(1, 14))


# ---- quality ------------------------------------------------------------------------------------

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_of_odd_rows(odd, odd_pairs):
    got = Counter((r.doc_id, *(r[n] for n in NAMES)) for r in quality_rules.judge(odd).collect())
    assert got == Counter((doc, *quality(text)) for doc, text in odd_pairs)


def test_rules_keep_columns_and_use_no_python(spark, odd, empty):
    kept = quality_rules.apply_rules(odd)
    assert kept.columns == odd.columns and quality_rules.apply_rules(empty).count() == 0
    plan = quality_rules.apply_rules(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    verdicts = Counter(r.doc_id for r in quality_rules.judge(odd).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == verdicts


def test_good_labels_are_kept():
    """Documents labelled as good and long enough are kept but for a few in a thousand."""
    con = connect("/root/testdata/sf0.1")
    sql = f"SELECT count(*) FILTER (kept), count(*) FROM ({quality_rules.ORACLE}) JOIN labels USING (doc_id) WHERE quality = 1 AND NOT base_failed"
    kept, all_good = con.sql(sql).fetchall()[0]
    assert kept >= 0.995 * all_good
    bad = con.sql(f"SELECT avg(kept::INT) FROM ({quality_rules.ORACLE}) JOIN labels USING (doc_id) WHERE quality = 0").fetchall()[0][0]
    assert bad < 0.1


# ---- byte BPE -----------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coders():
    import tiktoken

    ranks = byte_bpe.read_ranks(RANKS)
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN), exact


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_bpe_of_odd_and_real_texts(coders, real_pairs):
    own, exact = coders
    texts = [t or "" for _, t in odd_rows() + real_pairs]
    for text, got in zip(texts, own.encode(texts), strict=True):
        assert ids(got) == exact.encode_ordinary(text)
        assert own.decode(got) == text.encode()


@given(st.lists(st.sampled_from(["a", "th", "ing", " ", "  ", "\n", "\t", "'s", "12", "é", "日本", "👍", "!", "\x1c", " ", "zzzz"]), max_size=40))
@settings(max_examples=300, deadline=None)
def test_bpe_of_mixed_texts(coders, parts):
    own, exact = coders
    text = "".join(parts)
    assert ids(own.encode([text])[0]) == exact.encode_ordinary(text)


@given(st.binary(min_size=1, max_size=40))
@settings(max_examples=300, deadline=None)
def test_backtracking_is_plain_merging(coders, piece):
    own, _ = coders
    whole = own.ranks.get(piece)
    want = [whole] if whole is not None else [own.ranks[t] for t in byte_bpe.merge_plainly(piece, own.ranks)]
    assert own.encode_piece(piece) == want


def test_bpe_operator_round_trip(spark, odd, odd_pairs, empty, coders):
    coded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back.collect()) == Counter((d, (t or "").encode()) for d, t in odd_pairs)
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    query = byte_bpe.op7_byte_bpe(spark, SF).where("doc_id = 3").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id = 3").first().text
    want = coders[1].encode_ordinary(text)
    assert (query.n_tokens, query.ids_sha256, query.decoded_sha256) == (len(want), sha(",".join(map(str, want))), sha(text))


# ---- packing ------------------------------------------------------------------------------------

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter()
    for doc, text in texts:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(own), 2048):
            part = own[start : start + 2048]
            want[doc, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(own)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * len(sequences))


def test_packing_of_real_texts(spark):
    rows = packing.op2_packing(spark, DATA).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert check_packing(rows, texts) > 0.98


def test_packing_of_odd_rows(odd, odd_pairs, empty):
    check_packing(packing.pack_documents(odd, WORDS).collect(), odd_pairs)
    assert packing.pack_documents(empty, WORDS).count() == 0
    coded = packing.tokenize(odd, WORDS).where("size(ids) <> length").count()
    assert coded == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
@settings(max_examples=200, deadline=None)
def test_patterns_place_every_length(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    placed = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True)
        for length in lengths:
            placed[length] += count
    assert placed == Counter(histogram)


# ---- archives -----------------------------------------------------------------------------------


def test_archives_of_odd_pages(spark, tmp_path):
    big = "<p>" + "word " * 200_000
    pages = [(3, "http://a", "x"), (1, "http://b\r\nEvil: 1", "x"), (2, None, "x"), (4, "u", None), (5, "u", ""), (6, "u", "é\r\n\r\n日"), (7, "u", big), (9, "u", big), (None, "n", "x"), (None, "n", "alone")]
    df = spark.createDataFrame([(*p, "extra", "extra") for p in pages], "page_id long, url string, html string, payload string, path string")
    archives = warc.write_archives(df, str(tmp_path / "w")).cache()
    got = {(r.page_id, r.payload_digest): (r.payload_bytes, r.record_type, r.refers_to) for r in warc.resolve(warc.read_archives(archives)).collect()}
    first = {}
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", page_id)
    for page_id, _, html in pages:
        payload = (html or "").encode()
        head = first[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = ("response", None) if head == page_id else ("revisit", head)
        assert got[page_id, digest] == (len(payload), *kind)
    assert len(got) == len(pages)
    records = warc.read_archives(archives).where("record_type = 'response'").collect()
    assert {bytes(r.payload) for r in records} == {(h or "").encode() for _, _, h in pages}
    assert warc.read_archives(warc.write_archives(df.limit(0), str(tmp_path / "e"))).count() == 0


def test_least_bytes(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(df, str(tmp_path), 3)).collect()
    assert {(r.page_id, r.record_type) for r in rows} == {(1, "response"), (2, "response"), (3, "response"), (4, "revisit")}


def test_zip64_directories(tmp_path):
    """Members with ZIP64 fields, and an archive with more entries than the plain end record can count."""
    writer = warc.ArchiveWriter(str(tmp_path), 0, force_zip64=True)
    for i in range(5):
        writer.add(i, "u", b"p" * i, warc.payload_digest(b"p" * i), None)
    path, records, _ = writer.close()
    assert records == 5 and [(r[0], r[5]) for r in warc.read_archive(path)] == [(i, b"p" * i) for i in range(5)]
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w", zipfile.ZIP_STORED) as out:
        for i in range(66_000):
            out.writestr(zipfile.ZipInfo(f"m{i}"), b"%d" % i)
        out.comment = b"a comment"
    ranges = warc.ZipRanges(many, len(many.getvalue()))
    assert len(ranges.members) == 66_000 and ranges.read("m65999") == b"65999"
    with pytest.raises(ValueError):
        warc.ZipRanges(io.BytesIO(b"no archive"), 10)


def test_warc_query(spark):
    rows = warc.op3_warc(spark, SF).collect()
    pages = duckdb.sql(f"SELECT page_id, coalesce(html, '') FROM '{SF}/pages.parquet'").fetchall()
    assert {(r.page_id, r.payload_bytes) for r in rows} == {(i, len(h.encode())) for i, h in pages} and len(rows) == len(pages)


# ---- extraction ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return html_extract.train(labelled_pages())


def test_held_out_pages(model):
    right = wrong = 0
    for page in labelled_pages(100, seed=1234):
        tree = html_extract.parse(page)
        labels = html_extract._labels(tree)
        for text, label, p in zip(tree.text, labels, html_extract.marginals(tree, model), strict=True):
            if text is not None:
                right += (p >= 0.5) == bool(label)
                wrong += (p >= 0.5) != bool(label)
    assert right > 0.97 * (right + wrong)


def test_marginals_are_exact(model):
    """Against the sum over all labellings of a small page."""
    import itertools
    import math

    tree = html_extract.parse("<div class=ad><p>buy now</p></div><article><h1>t</h1><p>One two three.</p></article>")
    n = len(tree.parent)
    limit = html_extract.NODE_LIMIT
    node = [max(-limit, min(limit, sum(model.node.get(f, 0.0) for f in html_extract.features(tree, i)))) for i in range(n)]
    total, article = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        score = model.root[labels[0]] + sum(node[i] * labels[i] for i in range(n))
        for i in range(1, n):
            table = model.edge.get(html_extract._edge(tree, i), model.edge.get("other"))
            score += table[labels[tree.parent[i]]][labels[i]]
        total += math.exp(score)
        for i in range(n):
            article[i] += labels[i] * math.exp(score)
    for got, want in zip(html_extract.marginals(tree, model), article, strict=True):
        assert got == pytest.approx(want / total, abs=1e-9)


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<nav><ul><li><a href=/x>Home</a></li><li><a href=/y>News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
<article><h1>A &amp; B&nbsp;title</h1><p>First   paragraph<br>goes &#233; on.<p>Second <b>paragraph</b>, <a href=/z>linked</a> text that is long enough.</p>
<div class="advert"><p>Buy this!</p></div></article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I do not agree.</p></div></section>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/r>Other story</a></li></ul></aside>
<form><label>Mail</label><input name=m><button>Send</button></form><footer>&copy; 2024 Us</footer></body></html>"""


def test_page_with_all_kinds_of_parts(model):
    assert html_extract.main_text(PAGE, model) == (
        "A & B title\n\nFirst paragraph goes é on.\n\nSecond paragraph, linked text that is long enough."
    )


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<div" * 50, "<a b='", '<p x="1>text', "&#xFFFFFFFF; &bogus;", "\0<p>\0</p>", "<div>" * 5000])
def test_broken_pages(model, page):
    assert isinstance(html_extract.main_text(page, model), str)


def test_extract_odd_rows(spark, model):
    rows = [(1, "u", None, "a", "b"), (2, None, PAGE, "a", "b"), (2, None, PAGE, "a", "b"), (None, "u", "", "a", "b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _html string")
    got = Counter((r.page_id, r.url, r.text) for r in html_extract.extract(df, model).collect())
    text = html_extract.main_text(PAGE, model)
    assert got == Counter([(1, "u", ""), (2, None, text), (2, None, text), (None, "u", "")])
    assert html_extract.extract(df.limit(0), model).count() == 0


def test_bpe_encodes_a_piece_once(coders, monkeypatch):
    """A word before several marks is one walk; each chunk took its own before."""
    own, exact = coders
    seen = []
    walk = own.encode_piece
    monkeypatch.setattr(own, "encode_piece", lambda piece: seen.append(piece) or walk(piece))
    texts = [f"x zqvartlonk{mark} y" for mark in (".", ",", ";", "!", "")]
    assert [ids(p) for p in own.encode(texts)] == [exact.encode_ordinary(t) for t in texts]
    assert seen.count(b" zqvartlonk") == 1
