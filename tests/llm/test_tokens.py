"""Token ids of operators 2 and 8 against the tokenizer itself, for every assigned character."""

import random
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quayload.llm import chunked
from quayload.llm.packing import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    exact = Tokenizer.from_file(PATH)
    return WordTokenizer(PATH), lambda texts: [np.array(e.ids, "<u4").tobytes() for e in exact.encode_batch_fast(texts, add_special_tokens=False)]


def differing(both, texts):
    own, exact = both
    return [t for t, a, b in zip(texts, own.encode(pa.array(texts, pa.string())), exact(texts), strict=True) if a != b]


@pytest.mark.parametrize("form", ["{}.", "{},", "a{}.", "{}a,", "{}"])
def test_every_assigned_character(both, form):
    characters = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cs", "Cn")]
    assert differing(both, [form.format(c) for c in characters]) == []


def test_random_texts(both):
    r = random.Random(1)
    bits = ["क़", "क़", "שׁ", ",", ".", "a", "é", "é", "İ", "ß", "ﬁ", " ", "\x1c", "\x85", " ", "\n", "'s", "日本", "👍", "A", "9", "_", "-", "!", "w" * 300]
    assert differing(both, ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(30_000)]) == []


def test_capitals(both):
    """Capitals are made small first, except where that would compose with a mark or spell a special token."""
    r = random.Random(2)
    bits = [*"ABHIJKSTWXYZ", "\u030c", "\u0331", "\u0308", "\u030a", "\u0307", "\u0338", "É", "ÿ", "Ÿ", "ß", "ẞ", "×", "÷", "µ", "ª", "K", "Å", "’", "'S", "'Re", "3.5,", "...", ",", ".", " ", "\n", "\x1d"]
    bits += ["<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "<|endoftext|>", "<|", "|>", "<", "end"]
    assert differing(both, ["".join(r.choice(bits) for _ in range(r.randint(0, 9))) for _ in range(60_000)]) == []
    assert differing(both, [a + m for a in map(chr, range(0x41, 0x5B)) for m in map(chr, range(0x300, 0x370))]) == []


def test_words_are_kept_once():
    """A capital or a mark at the end made a chunk of its own, which was encoded again."""
    own, sent = WordTokenizer(PATH), []
    encode = own._encode_words
    own._encode_words = lambda chunks, *a: sent.extend(chunks) or encode(chunks, *a)
    own.encode(pa.array(["Harbour harbour, HARBOUR. harbour,", "Écluse écluse. éCLUSE,"]))
    assert sorted(sent) == [",", ".", "harbour", "écluse"] and len(own.store.known) < 8


def test_store_is_bounded_in_bytes():
    store = chunked.ChunkStore(lambda chunks: [c.encode() * 4 for c in chunks], limit=10_000)
    for n in range(50):
        texts = [f"w{n} x{n} " + "y" * 5000, "", f"  w{n} "]
        assert store.encode_split(pa.array(texts)) == [b"".join(c.encode() * 4 for c in t.split()) for t in texts]
        assert store.size <= 10_000 + 2000 and all(len(c) <= chunked.LONGEST_KEPT for c in store.known)
    assert store.encode_split(pa.array([], pa.string())) == [] and store.encode_split(pa.array(["", " "])) == [b"", b""]
