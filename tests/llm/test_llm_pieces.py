"""Piece encoding and decoding against the library whose ids they must equal."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.pieces import PieceCodec, decode_pieces, encode_pieces, read_model
from tidemark.llm.queries import documents, op12_sentencepiece, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
THUE_MORSE = "".join("ab"[i.bit_count() & 1] for i in range(1024))
ODD = [
    None,
    "",
    " ",
    " \n\t ",
    *(" " * n for n in range(2, 40)),
    *("x" + " " * n + "y" for n in range(1, 40)),
    "▁a ▁▁ b▁",
    "<s>a</s><unk><0x41>",
    "日本語 ﬁ ① 　x​\u0000a é é İ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa ----------======= ((((((()))))))",
    "12345 6.7 it's WE'LL \U0001f600\U0001f468‍\U0001f469",
    THUE_MORSE,
    THUE_MORSE.translate(str.maketrans("ab", "ba")),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(read_model(MODEL))


def both_ways(codec, library, texts):
    ids, at = codec.encode_column(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    want = [library.encode(x or "") for x in texts]
    assert got == want
    decoded = codec.decode_column(ids, at).to_pylist()
    assert decoded == [library.decode(x) for x in want] == [codec.decode(x) for x in want]


def test_odd_texts(codec, library):
    both_ways(codec, library, ODD)
    for text in ODD:
        both_ways(codec, library, [text])


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("  abcdeinrst'0129.,!<|>(\n▁ñéßİ日"), st.characters(codec="utf-8")), max_size=60), max_size=5))
@settings(max_examples=300, deadline=None)
def test_any_text(codec, library, texts):
    both_ways(codec, library, texts)


def test_every_piece_and_pairs_of_pieces(codec, library):
    texts = list(codec.ids)
    both_ways(codec, library, texts)
    both_ways(codec, library, [a + b for a, b in zip(texts[::3], texts[7::2], strict=False)])


@given(st.lists(st.integers(0, 31_999), max_size=12))
@settings(max_examples=300, deadline=None)
def test_any_ids_decode_as_in_the_library(codec, library, ids):
    assert codec.decode(ids) == library.decode(ids)


def test_memory_that_is_emptied_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr("tidemark.llm.memo.MOST_PIECES", 0)
    for text in ("some words that come again", "again some other words"):
        both_ways(codec, library, [text])


def test_query_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf_dir).collect()}
    rows = op12_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(None, "a b", 1, "x"), (1, None, 2, "y"), (1, "", 3, None), (1, "a b", 4, "z"), (1, "a b", 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    coded = encode_pieces(docs, MODEL, decoded=True)
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in coded.collect()) == [(0, 2, "a b"), (1, 0, ""), (1, 0, ""), (1, 2, "a b"), (1, 2, "a b")]
    again = decode_pieces(coded, MODEL)
    assert sorted(r.decoded for r in again.collect()) == ["", "", "a b", "a b", "a b"]
    assert encode_pieces(docs.limit(0), MODEL).count() == 0
    odd = spark.createDataFrame([(1, None, "old"), (2, [2, 13, 0], "old")], "doc_id long, ids array<int>, decoded string")
    assert {r.doc_id: r.decoded is None for r in decode_pieces(odd, MODEL).collect()} == {1: True, 2: False}


def test_a_very_long_text(spark, library):
    text = "Und die Wörter, immer wieder: " * 60_000
    row = encode_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), MODEL, decoded=True).first()
    assert row.ids == library.encode(text) and row.decoded == text
