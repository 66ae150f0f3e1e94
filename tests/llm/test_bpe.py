import json
import random
from hashlib import sha256

import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clicklake.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(PATH)

TEXTS = [
    "", " ", "  \n\n x  ", "I'm it's we'll 'd 's'S don''t", "aaaaaaaaaaa aaa aaaa a", "ababababab bababa", "12 345 ½²١٢ x1y2", "naïve Straße 日本語 한국 🎉🎉 é ́x",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext", "՘x ࢏1 \U0003fc2cabc a՘", "\x00\x01\x1c\x1d \x85  ​﻿", " \t \t a",
    "mississippi" * 50, " " * 500 + "x", "!!!???..." * 100,
]


def ids_of(texts):
    return [
        [i for n in numbers for i in ([~n] if n < 0 else map(int, ENCODER.decimal[n].split(",")))] for numbers in ENCODER.many(texts)
    ]


def test_texts_encode_and_decode_as_the_library_does():
    expected = [LIBRARY.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert ids_of(TEXTS) == expected
    for ids in expected:
        assert bpe.decode(ids, ENCODER.vocabulary.bytes_of) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab c'<|>endoftx \n1é", max_size=80)), max_size=5))
def test_any_texts_encode_alike(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert ids_of(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode_alike(ids):
    assert bpe.decode(ids, ENCODER.vocabulary.bytes_of) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_character_is_cut_as_the_library_cuts_it():
    for start in range(0, 0x110000, 0x4000):
        text = "".join(f"a{c}1{c}!{c} {c}{c} " for c in map(chr, range(start, min(start + 0x4000, 0x110000))) if not "\ud800" <= c <= "\udfff")
        found = [p for part in ENCODER.vocabulary.pieces(text) for p in part]
        assert found == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]


def test_a_long_text_is_cut_where_pieces_start(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices(["word ", "  ", "x", "\n", "don't ", "42 ", "é", " . "], k=4000))
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    for size in (1, 7, 100):
        monkeypatch.setattr(bpe, "CHUNK", size)
        assert ids_of([text]) == [expected]


def test_what_is_forgotten_is_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 1000)
    for _ in range(3):
        assert ids_of(TEXTS) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH) as file:
        held = json.load(file)
    held["model"]["merges"] = held["model"]["merges"][::-1]
    (tmp_path / "reversed.json").write_text(json.dumps(held))
    with pytest.raises(ValueError, match="later merges"):
        bpe.Vocabulary(str(tmp_path / "reversed.json"))
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def expected_row(doc_id, text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    back = LIBRARY.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(back.encode()).hexdigest()


def test_odd_rows(odd, rows):
    clashing = odd.withColumnRenamed("words", "ids").withColumnRenamed("hits", "n_tokens")
    assert rows(bpe.round_trip(clashing, PATH)) == sorted((expected_row(r["doc_id"], r["text"]) for r in odd.collect()), key=repr)


def test_kept_ids_decode_to_the_texts(documents, rows):
    docs = documents(*enumerate(TEXTS), (None, None))
    found = bpe.round_trip(docs, PATH, keep=True)
    assert {r["doc_id"]: r["decoded"] for r in found.collect()} == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    again = bpe.decoded(found.select("doc_id", "ids"), PATH)
    assert {r["doc_id"]: r["text"] for r in again.collect()} == {r["doc_id"]: r["decoded"] for r in found.collect()}


def test_no_rows(documents):
    assert bpe.round_trip(documents(), PATH).count() == 0


def test_the_query_equals_the_library_on_the_whole_table(spark, rows):
    from clicklake.llm.queries import op13_byte_bpe

    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert rows(op13_byte_bpe(spark, folder)) == sorted((expected_row(d["doc_id"], d["text"]) for d in docs), key=repr)
