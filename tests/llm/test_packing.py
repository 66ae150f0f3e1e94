import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clicklake.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ["", "İstanbul 'S it's. <|endoftext|> a<|startoftext|>, x", "H̱ ẖ K, ΣΑΣ. don't! a.b c1. ...", "é ́x. 日本語。 ǅ. ½, ۱۲", "a" * 5000 + "."])
def test_words_encode_as_the_whole_text(tokenizer, text):
    encode = packing.WordEncoder(PATH)
    assert list(encode.many([text, text])) == [plain(tokenizer, text)] * 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_texts_encode_alike(texts):
    tokenizer, encode = Tokenizer.from_file(PATH), packing.encoder(PATH)
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert list(encode.many(texts)) == [plain(tokenizer, t) for t in texts]


def test_a_full_memory_and_a_huge_text(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 10_000)
    monkeypatch.setattr(packing, "HUGE", 200)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcé.,", k=rng.randint(1, 9))) for _ in range(n)) for n in (5, 400, 30, 2000)]
    encode = packing.WordEncoder(PATH)
    assert list(encode.many(texts)) == [plain(tokenizer, t) for t in texts]
    assert encode.older and len(encode.known) + len(encode.older) < len({w for t in texts for w in t.split()})
    assert list(encode.many(texts)) == [plain(tokenizer, t) for t in texts]


def test_each_different_word_is_looked_up_once(tokenizer):
    class Counted(dict):
        looked_up = 0

        def get(self, key):
            self.looked_up += 1
            return super().get(key)

    encode, texts = packing.WordEncoder(PATH), ["The house, the HOUSE: the old house."] * 500
    encode.known = Counted()
    assert list(encode.many(texts)) == [plain(tokenizer, texts[0])] * 500
    assert encode.known.looked_up <= 7


def test_texts_side_by_side_do_not_touch(tokenizer):
    texts = ["H", "\u0331 A.", ".", "", "A.", "!", "<|ENDOFTEXT|>", "x", None, "don'T 'Tis", "A\x1cB,\x85C. D", "Σ", "A", "\u030a", "it's,\n(A1b2)..."]
    expected = [plain(tokenizer, t or "") for t in texts]
    assert list(packing.WordEncoder(PATH).many(texts)) == expected
    assert list(packing.WordEncoder(PATH).many(pa.array(texts)[3:])) == expected[3:]
    texts.append("<|endoftext|> A<|STARTOFTEXT|> B<|startoftext|>")  # no capital may become small beside a control token
    assert list(packing.WordEncoder(PATH).many(pa.array(texts))) == [*expected, plain(tokenizer, texts[-1])]


def test_the_bound_on_open_bins_closes_bins_and_costs_little():
    rng = random.Random(2)
    lengths = [min(4096, int(30 * 1.002 ** (3 * rng.randint(1, 900)))) for _ in range(20_000)]
    made = {}
    for most in (4, 64, 1 << 20):
        bins = packing.Bins(4096, most)
        assert max(bins.open for n in lengths if bins.place(n)) <= most
        made[most] = bins.made
    assert made[4] > made[64] and made[64] <= 1.01 * made[1 << 20]


def test_best_fit_takes_the_fullest_bin_and_closes_the_fullest_first():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (8, 5, 9, 5, 2)] == [(0, 0), (1, 0), (2, 0), (1, 5), (3, 0)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 8))
def test_bins_equal_a_plain_search(lengths, most):
    bins, open_, made = packing.Bins(50, most), {}, 0
    for n in lengths:
        fits = [f for f in open_.values() if f >= n]
        found, offset = bins.place(n)
        if fits:
            assert offset == 50 - min(fits) and open_[found] == min(fits)
        else:
            assert (found, offset) == (made, 0)
            made += 1
            if len(open_) >= most:
                low = min(open_.values())
                closed = next(b for b in open_ if open_[b] == low and b not in sum(bins.free.values(), []))
                del open_[closed]
            open_[found] = 50
        open_[found] -= n
        if not open_[found]:
            del open_[found]


def check_layout(rows, size):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size


def test_documents(odd, tokenizer):
    found = packing.pack_documents(odd, keep_ids=True, size=1000, lot=50_000).collect()
    check_layout(found, 1000)
    whole = {}
    for r in sorted(found, key=lambda r: (repr(r["doc_id"]), r["piece"])):
        assert r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"]) and r["start"] == 1000 * r["piece"]
        if r["doc_id"] not in (5,):
            whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + bytes(r["ids"])
    end = np.array([1], "<u4").tobytes()
    for r in odd.where("doc_id <> 5 or doc_id is null").collect():
        assert whole[r["doc_id"]] == plain(tokenizer, r["text"] or "") + end
    assert sum(r["doc_id"] == 5 for r in found) == 2


def test_reruns_agree_and_few_sequences(documents):
    rng = random.Random(5)
    docs = documents(*[(i, "word " * rng.randint(1, 900)) for i in range(400)])
    first, second = (sorted(map(tuple, packing.pack_documents(docs, size=512).collect())) for _ in range(2))
    assert first == second
    total = sum(r[3] for r in first)
    assert len({r[5] for r in first}) <= 1.02 * total / 512 + 1


def test_no_rows(documents):
    assert packing.pack_documents(documents()).count() == 0
