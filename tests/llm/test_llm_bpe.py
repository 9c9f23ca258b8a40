import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from calipers.llm import bpe
from corpus_cases import TEXTS, documents, empty


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\x0b\x1c\x85 ab'stREve.!?129é日", max_size=80)), max_size=5))
def test_ids_equal_the_library(library, own, texts):
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = list(own.encode(texts))
    assert got == want
    assert [own.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_repeats_and_long_words(library, own):
    texts = ["a" * 3000, " " * 4000, "!" * 900, "abab" * 700, "<|endoftext|>", "x<|endoftext|><|endoftext|> y ", "'s'll  \n\n  x"]
    assert list(own.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_an_unremembered_word_is_encoded_alike(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 3)
    own = bpe.Bpe(bpe.vocabulary())
    for text in ["one two three four five six", "six five four three two one", "encyclopaedia encyclopaedic encyclical"]:
        assert list(own.encode([text])) == [library.encode(text, add_special_tokens=False).ids]


def test_rows(spark, library):
    got = bpe.round_trip(documents(spark)).collect()
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe.round_trip(empty(spark)).count() == 0
    decoded = bpe.decode(bpe.encode(documents(spark))).collect()
    assert sorted(r["text"] for r in decoded) == sorted(t or "" for _, t in TEXTS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x0b\x1c\x85\u3000 ab'stREve.!?129é日", max_size=80))
def test_pieces_are_whole_words(own, text):
    pieces = own.pieces(text)
    assert "".join(pieces) == text
    assert [w for p in pieces for w in own.words.findall(p)] == own.words.findall(text)


def test_a_piece_met_before_is_not_cut_again():
    own, cut = bpe.Bpe(bpe.vocabulary()), []

    class Words:
        def findall(self, text, find=own.words.findall):
            cut.append(text)
            return find(text)

    own.words = Words()
    one, two, more = own.encode(["so much the better, ", "the better the much", "so much  the\n better"])
    assert sorted(cut) == sorted(set(cut)) and len(cut) == 8, cut
    assert own.decode(more) == "so much  the\n better" and list(own.encode(["so much the better, "])) == [one] and len(cut) == 8
