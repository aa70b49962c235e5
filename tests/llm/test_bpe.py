"""Encoding against the tokenizers library, whole, in leaves and joined in a tree."""

import random

import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from burstwatch.llm import bpe
from burstwatch.llm.queries import token_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["a", "b", "th", "ing", " ", "  ", "\n", "'s", "!", "--", "<|endoftext|>", "é", "漢", "1", "12", "\u00a0", "\x1c", "'re"]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def in_leaves(text, leaf):
    own, done, parts = bpe.codec(PATH), [], []
    for part in bpe.leaves(text, own, leaf):
        ids = own.whole(part.pieces[0].decode()).tolist() if part.ordinary else [i for p in part.pieces for i in own.unsplit(p)]
        if not part.continues:
            done += bpe.tree(own, parts)
            parts = []
        parts.append(ids)
    return done + bpe.tree(own, parts)


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(PIECES), max_size=60).map("".join)), st.integers(2, 20))
def test_any_text(text, leaf):
    own, expected = bpe.codec(PATH), library(text)
    assert own.whole(text).tolist() == expected
    assert in_leaves(text, leaf) == expected
    assert own.text(expected) == LIBRARY.decode(expected, skip_special_tokens=False) == text


def test_one_pre_token_in_many_leaves():
    rng = random.Random(1)
    for leaf in (3, 16, 100):
        text = "".join(rng.choice(["a", "b", "th", "ing", "er", "é"]) for _ in range(600))
        assert in_leaves(text, leaf) == library(text)


def test_operator(docs):
    rng = random.Random(2)
    unsplit = "".join(rng.choice("abcdeé") for _ in range(900))
    texts = [None, "", "short one", unsplit, unsplit, "many words here " * 90, "x<|endoftext|>y" * 40, "a1!b2?" * 80]
    rows = docs(list(enumerate(texts)), extra="key")
    encoded = bpe.encode(rows, PATH, leaf=64)
    assert encoded.columns == [*rows.columns, "ids"]
    found = {r.doc_id: r for r in bpe.decode(encoded, PATH).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].ids == library(text or "")
        assert found[i].decoded == (text or "")


def test_empty_table_and_unknown_ids(docs, spark):
    assert bpe.encode(docs([]), PATH).collect() == []
    rows = spark.createDataFrame([([64, 99999999, 64],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(rows, PATH).collect()] == ["aa", ""]


def test_query_digests(table):
    import hashlib

    from burstwatch.llm.queries import token_digests

    rows = table("documents").where(F.length("text") < 3000)
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in token_digests(rows).collect():
        ids = library(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_digests_take_one_python_worker_a_task(docs, capsys):
    token_digests(docs([(1, "a text"), (2, None)])).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1, plan
    assert "FlatMapGroupsInArrow" not in plan
