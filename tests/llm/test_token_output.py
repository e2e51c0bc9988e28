"""Training order: a permutation, whole shards, and reads from any slot."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayload.llm import packing, token_output
from quayload.llm.token_output import Feistel

WORDS = public_tokenizers.path("word_bpe_49k.json")


@given(st.integers(1, 3000), st.integers(0, 2**64 - 1))
@settings(max_examples=100, deadline=None)
def test_feistel_is_a_permutation(n, key):
    order = Feistel(n, key)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.sequences(slots).tolist() == list(range(n))


def test_keys_give_other_orders():
    a, b = (Feistel(1000, k).slots(np.arange(1000)) for k in (1, 2))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def test_shards_round_trip(odd, odd_pairs, empty, tmp_path, spark):
    from tokenizers import Tokenizer

    pieces = packing.tokenize(odd, WORDS, capacity=64).cache()
    total = packing.pack(pieces.drop("ids"), capacity=64).agg({"sequence_id": "max"}).first()[0] + 1
    order = Feistel(total, 9)
    rows = token_output.write_shards(token_output.place(packing.pack(pieces, capacity=64), order), str(tmp_path), 64, 100).cache()
    index = sorted(rows.collect())
    assert [r.slot for r in index] == list(range(total))
    assert order.slots(np.array([r.sequence_id for r in index])).tolist() == list(range(total))
    paths = {r.shard: r.path for r in index}
    whole = list(token_output.read_slots(paths, 0, total, 64, 100))
    for r, ids in zip(index, whole, strict=True):
        assert r.byte_offset == r.slot % 100 * 128 and not ids[r.n_tokens :].any()
    tail = list(token_output.read_slots(paths, total - 150, 150, 64, 100))
    assert np.array_equal(np.array(tail), np.array(whole[-150:]))
    tokenizer = Tokenizer.from_file(WORDS)
    want = sorted(i for _, t in odd_pairs for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    got = sorted(i for r, ids in zip(index, whole, strict=True) for i in ids[: r.n_tokens].tolist())
    assert got == want
    docs = {d for d, _ in odd_pairs}
    assert {d for r in index for d in r.doc_ids} == docs
    assert token_output.materialise(empty, WORDS, str(tmp_path / "e"), 1).count() == 0


def test_width_is_checked(odd, tmp_path):
    pieces = packing.pack(packing.tokenize(odd, WORDS).cache())
    with pytest.raises(Exception, match="does not fit"):
        token_output.write_shards(token_output.place(pieces, Feistel(10**6, 1)), str(tmp_path), width=1).collect()


def test_compressed_ids_give_the_same_shards(odd, tmp_path):
    """Ids travel compressed; four bytes each before."""
    plain = packing.tokenize(odd, WORDS, capacity=64).cache()
    small = packing.tokenize(odd, WORDS, capacity=64, compressed=True).cache()
    total = packing.pack(plain.drop("ids"), capacity=64).agg({"sequence_id": "max"}).first()[0] + 1
    index = []
    for name, pieces in (("plain", plain), ("small", small)):
        placed = token_output.place(packing.pack(pieces, capacity=64), Feistel(total, 9))
        index.append(sorted(token_output.write_shards(placed, str(tmp_path / name), 64, 100).drop("path", "doc_ids").collect()))
    assert index[0] == index[1]
    whole = packing.tokenize(odd, WORDS, compressed=True).where("length > 500").collect()
    assert whole and all(len(r.ids) < 2 * r.length for r in whole)


def test_shards_are_written_in_runs(odd, odd_pairs, tmp_path, monkeypatch):
    """No shuffle carries all ids; one did before, beside all placed pieces and all shards."""
    write, taken = token_output.write_shards, []
    monkeypatch.setattr(token_output, "write_shards", lambda placed, *a, **k: taken.append(placed.count()) or write(placed, *a, **k))
    runs = token_output.materialise(odd, WORDS, str(tmp_path / "runs"), 9, shard_sequences=3).cache()
    assert len(taken) == token_output.RUNS and max(taken) < 0.8 * sum(taken)
    once = token_output.materialise(odd, WORDS, str(tmp_path / "once"), 9, shard_sequences=10**6)
    assert len(taken) == token_output.RUNS + 1 and taken[-1] == sum(taken[:-1])
    columns = ("slot", "sequence_id", "n_tokens", "ids_crc32")
    assert sorted(runs.select(*columns).collect()) == sorted(once.select(*columns).collect())
    paths = {r.shard: r.path for r in runs.select("shard", "path").distinct().collect()}
    whole = list(token_output.read_slots(paths, 0, runs.count(), shard_sequences=3))
    for r in runs.collect():
        assert zlib.crc32(whole[r.slot][: r.n_tokens].astype("<u4").tobytes()) == r.ids_crc32
