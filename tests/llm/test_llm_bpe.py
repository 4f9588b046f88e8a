"""Encoding and decoding against the library whose ids they must equal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.bpe import Codec, SuffixAutomaton, decode_documents, decode_ids, encode_documents
from tidemark.llm.queries import documents, tokenizer_path

# Two words that polynomials modulo 2**64 do not tell apart.
THUE_MORSE = "".join("ab"[i.bit_count() & 1] for i in range(1024))
ODD = [
    None,
    "",
    " \n\t ",
    "<|endoftext|>a <|startoftext|>",
    "<|endoftext",
    "ΑΣ Σ' it's WE'LL x²³½ 日本語 a\x1cb !\x1c! a\x85b c　d ​z é é 12345",
    "a\u0000b İstanbul İ ﬁ Ǆ",
    "aaaaaaaaaaaaaaaa eeeeeeeeeee !!!!!!!!!!!!!!!!!! ----------=======",
    ",'s ''s it's, 's.a1b2 'ree é's á ,́",
    "a|b < c",
    THUE_MORSE,
    THUE_MORSE.translate(str.maketrans("ab", "ba")),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def codec():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return Codec(file.read())


def ids_of(codec, texts):
    ids, at = codec.encode_column(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_odd_texts(library, codec):
    want = [library.encode(x or "", add_special_tokens=False).ids for x in ODD]
    assert ids_of(codec, ODD) == want
    plain = [x for x in ODD if not x or "<|" not in x]
    assert ids_of(codec, plain) == [library.encode(x or "", add_special_tokens=False).ids for x in plain]
    assert [codec.encode(x or "") for x in ODD] == want
    assert [decode_ids(codec.names, x) for x in want] == [library.decode(x, skip_special_tokens=False) for x in want]


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcdeinrst'0129.,!<|> \nñéßΣİ日́"), st.characters(codec="utf-8")), max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_any_text(library, codec, texts):
    assert ids_of(codec, texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_every_token_of_the_vocabulary_is_its_own_encoding(codec):
    final = [i for i in range(512, 49406) if codec.names[i].endswith("</w>")][::97]
    letters = {x: i for i, x in enumerate([codec.names[t] for t in codec.inner])}
    words = [bytes(letters[c] for c in codec.names[i][:-4]) for i in final]
    assert codec.encode_words(words) == [(i,) for i in final]


def test_a_memory_that_is_emptied_changes_nothing(codec, monkeypatch):
    texts = ["some words that come again", "again some other words", "that come"]
    want = ids_of(codec, texts)
    monkeypatch.setattr("tidemark.llm.memo.MOST_PIECES", 0)
    assert [ids_of(codec, [t])[0] for t in texts] == want


def test_automaton_knows_all_substrings_and_no_others():
    sequences = [(1, 2, 1, 2, 3), (2, 1, 2, 2), (3,)]
    automaton = SuffixAutomaton(sequences, 4)
    known = {s[a:b] for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}

    def accepts(seq):
        state = 0
        for x in seq:
            state = automaton.go.get(state * 4 + x)
            if state is None:
                return False
        return True

    import itertools

    for n in range(1, 5):
        for seq in itertools.product((1, 2, 3), repeat=n):
            assert accepts(seq) == (seq in known)


def test_operators_give_the_librarys_ids_and_text(spark, sf_dir, library):
    docs = documents(spark, sf_dir)
    rows = decode_documents(encode_documents(docs, tokenizer_path()), tokenizer_path()).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for row in rows:
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids and row.n_tokens == len(ids)
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_nulls_repeats_empty_tables_and_clashing_names(spark):
    rows = [(None, "a b", 1, "x"), (1, None, 2, "y"), (1, "", 3, None), (1, "a b", 4, "z"), (1, "a b", 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    got = encode_documents(docs, tokenizer_path())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 2), (1, 0), (1, 0), (1, 2), (1, 2)]
    assert encode_documents(docs.limit(0), tokenizer_path()).count() == 0
    both = encode_documents(docs, tokenizer_path(), decoded=True)
    again = decode_documents(both, tokenizer_path())
    assert sorted(r.decoded for r in both.collect()) == sorted(r.decoded for r in again.collect()) == ["", "", "a</w> b</w>", "a</w> b</w>", "a</w> b</w>"]
    odd = spark.createDataFrame([(1, None, "old")], "doc_id long, ids binary, decoded string")
    assert decode_documents(odd, tokenizer_path()).first().decoded is None


def test_a_very_long_text(spark, library):
    text = "Und die Wörter, immer wieder: " * 60_000
    row = encode_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), tokenizer_path()).first()
    assert row.n_tokens == 60_000 * len(library.encode("Und die Wörter, immer wieder: ", add_special_tokens=False).ids)
