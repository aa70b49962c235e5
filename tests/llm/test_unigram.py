"""Counts against the tokenizers library's Unigram model on the same vocabulary."""

import random

import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from burstwatch.llm import unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = unigram.vocabulary(PATH)


def library(vocabulary):
    found = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    found.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return found


LIBRARY = library(VOCABULARY)
COUNTER = unigram.Counter(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab  \n<s>/é漢🎉▁0x thñ", max_size=60)))
def test_any_text(text):
    assert COUNTER.text(text)[1] == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_ties():
    """Equal scores: which path wins shows in the number of pieces."""
    rng = random.Random(3)
    bytes_ = [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    for _ in range(60):
        pieces = {"▁": -2.0} | {"".join(rng.choice("ab▁") for _ in range(rng.randint(1, 4))): -float(rng.randint(1, 3)) for _ in range(9)}
        vocabulary = [("<unk>", 0.0), *bytes_, *pieces.items()]
        own, other = unigram.Counter(vocabulary), library(vocabulary)
        for _ in range(20):
            text = "".join(rng.choice("ab c") for _ in range(12))
            assert own.text(text)[1] == len(other.encode(text, add_special_tokens=False).ids), (pieces, text)


def test_operator(docs):
    texts = [None, "", "one", "one", " two  spaces", "x" * 5000, "\n"]
    found = {r.doc_id: r for r in unigram.count_tokens(docs(list(enumerate(texts))), PATH).collect()}
    for i, text in enumerate(texts):
        assert found[i].n_tokens == len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
    assert found[0].best_score == 0
    assert unigram.count_tokens(docs([]), PATH).collect() == []


def test_what_is_remembered_is_bounded(monkeypatch):
    """Long segments are not remembered, and short ones only up to a number of characters."""
    monkeypatch.setattr(unigram, "REMEMBERED", 1_000)
    own = unigram.Counter(VOCABULARY)
    texts = ["".join(random.Random(i).choice("abcde") for _ in range(n)) for i in range(40) for n in (5, 64, 65, 3000)]
    for text in texts:
        assert own.text(text)[1] == len(LIBRARY.encode(text, add_special_tokens=False).ids)
        assert own.held <= 1_000 and own.held == sum(len(s) + unigram.ENTRY for s in own.seen)
        assert all(len(s) <= unigram.LONGEST for s in own.seen)
