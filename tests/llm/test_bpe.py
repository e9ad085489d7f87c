import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrane.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(file.read()), Tokenizer.from_file(PATH)


def same(both, text):
    own, theirs = both
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(
        text, add_special_tokens=False).ids
    assert own.decode(ids) == theirs.decode(
        np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcehinorst  \n\t'!é漢😀01AZ|<>_"), max_size=60))
def test_small_texts(both, text):
    same(both, text)


def test_hard_texts(both):
    rng = random.Random(3)
    for text in ["a" * 3000, "ab" * 2000, " " * 2000, "aaab" * 800, "é" * 500, "it's 'tis",
                 "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "\x85x\xa0  y"]:
        same(both, text)
    for _ in range(300):
        same(both, "".join(rng.choice("thereinganedoultion") for _ in range(rng.randrange(60))))


def test_round_trip_of_odd_rows(spark, odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs, PATH, out="t"), PATH, ids="t", out="back").collect()
    assert len(rows) == odd_docs.count()
    assert all(r["back"] == (r["text"] or "") for r in rows)
    assert all(r["ids"] == "ids" for r in rows)
    assert bpe.encode(no_docs, PATH, out="t").count() == 0


def test_query_against_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    tokenizer = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r for r in queries.op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    for doc in docs:
        ids = tokenizer.encode(doc["text"], add_special_tokens=False).ids
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(doc["text"].encode()).hexdigest()


def test_frequent_pieces_are_encoded_once(both, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 40)
    pieces, met = bpe.Pieces(both[0].vocabulary), []
    encode = both[0].vocabulary.encode_piece
    monkeypatch.setattr(both[0].vocabulary, "encode_piece", lambda p: met.append(p) or encode(p))
    for i in range(300):
        assert pieces[" the"] == encode(" the") and pieces[f"x{i}"] == encode(f"x{i}")
        assert len(pieces) + len(pieces.older) <= 40
    assert met.count(" the") == 1


def test_frequent_pairs_are_compared_once(both, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 60)
    with open(PATH, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    met, compatible = [], vocabulary.compatible
    monkeypatch.setattr(vocabulary, "compatible",
                        lambda a, b: met.append((a, b)) or compatible(a, b))
    rng = random.Random(8)
    pair = None
    for _ in range(300):
        frequent = vocabulary.walk("xqzj")
        pair = pair or tuple(frequent[:2])
        vocabulary.walk("".join(rng.choice("abcdehinorst") for _ in range(6)))
        assert len(vocabulary.stands) + len(vocabulary.stands.older) <= 60
    assert met.count(pair) == 1 and len(set(met)) > 120


def test_going_back_matches_no_more_than_it_needs(both, monkeypatch):
    vocabulary, made = both[0].vocabulary, []

    class Counted:
        def iter_long(self, *where, find=vocabulary.automaton.iter_long):
            return (made.append(x) or x for x in find(*where))

    text = "antherehesandeouldtionshing" * 4
    taken = vocabulary.walk(text)
    monkeypatch.setattr(vocabulary, "automaton", Counted())
    assert vocabulary.walk(text) == taken == both[1].encode(text, add_special_tokens=False).ids
    assert len(made) < 3 * len(taken)
