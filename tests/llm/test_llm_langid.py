"""Language models: exact code lengths, held-out accuracy, odd input."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.langid import ORDER, identify, train, train_languages
from tidemark.llm.queries import documents, op3_language_id
from tidemark.llm.textbatch import utf8

TEXTS = {"x": [b"abracadabra abracadabra", b"a cab"], "y": [b"banana bandana", b"cabbage"], "z": [b""]}


def plain_bits(training, text):
    """Code length of a text by prediction by partial matching, step by step.

    Contexts count that were met in any language's training texts twice or more
    in one language, as their suffixes were.
    """

    def counts(texts, context):
        found = {}
        for t in texts:
            for i in range(len(t) - len(context)):
                if t[i : i + len(context)] == context:
                    b = t[i + len(context)]
                    found[b] = found.get(b, 0) + 1
        return found

    seen = {b for texts in TEXTS.values() for t in texts for b in t}

    def is_node(context):
        if not context:
            return True
        return is_node(context[1:]) and any(sum(counts(texts, context).values()) >= 2 for texts in TEXTS.values())

    total = 0.0
    for i, byte in enumerate(text):
        context = text[max(0, i - ORDER) : i]
        while not is_node(context):
            context = context[1:]
        excluded = set()
        while True:
            found = {b: n for b, n in counts(training, context).items() if b not in excluded}
            kinds, n = len(found), sum(found.values())
            if byte in found:
                total -= math.log2(found[byte] / (n + kinds))
                break
            if kinds:
                total -= math.log2(kinds / (n + kinds))
                excluded |= set(found)
            if not context:
                total += math.log2(256 - len(excluded))
                break
            context = context[1:]
    del seen
    return total


def test_code_lengths_are_those_of_the_method():
    model = train(TEXTS)
    column = pa.array(["abracadabra", "banana cab", "a", "", "cabbage!", "zebra é"])
    bits = model.code_lengths(*utf8(column))
    for i, text in enumerate(column.to_pylist()):
        for k, name in enumerate(model.languages):
            assert abs(bits[i, k] - plain_bits(TEXTS[name], text.encode())) < 1e-3


def test_probabilities_of_all_bytes_sum_to_one():
    model = train(TEXTS)
    n = np.ones(model.cost.shape[1])
    n[-1] = 256 - (len(n) - 1)
    # the last class stands for several bytes; each has an equal share
    assert np.allclose((np.exp2(-model.cost.astype(float)) * n[None, :, None]).sum(axis=1), 1, atol=1e-4)


def test_strands_give_what_one_pass_gives():
    model = train(TEXTS)
    long = "abracadabra banana cabbage " * 400
    whole = model.code_lengths(*utf8(pa.array([long])))[0]
    state, total = 0, np.zeros(3)
    for b in long.encode():
        c = model.classes[b]
        total += model.cost[state, c]
        state = model.step[state, c]
    assert np.allclose(whole, total, rtol=1e-6)


def test_held_out_accuracy(spark, sf_dir):
    lang = documents(spark, sf_dir).select("doc_id", "lang")
    rows = op3_language_id(spark, sf_dir).join(lang, "doc_id").collect()
    assert len(rows) == lang.count()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "der und die das", "de"), (2, "the and of that", "en"), (3, None, "de"), (4, "text without", None), (None, "une les", "fr"), (5, "der die und das ist", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_languages(docs)
    assert model.languages == ["de", "en"]
    odd = [(1, None, 0), (None, "", 1), (2, "123 !? 4", 2), (2, "die und das", 3), (2, "die und das", 3), (3, "the and of " * 90_000, 4), (4, "日本語", 5)]
    asked = spark.createDataFrame(odd, "doc_id long, text string, score int").withColumn("lang_pred", F.lit("old"))
    found = identify(asked, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    got = [(r.lang_pred, r.score) for r in found.collect()]
    assert [x for x, _ in got[:6]] == ["und", "und", "und", "de", "de", "en"]
    assert got[0][1] == 0 and got[3] == got[4] and all(0 <= s <= 1 for _, s in got)
    assert identify(asked.limit(0), model).count() == 0
    nothing = train_languages(docs.limit(0))
    assert {r.lang_pred for r in identify(asked, nothing).collect()} == {"und"}


def test_signs_of_numbers_are_no_letters(spark):
    model = train_languages(spark.createDataFrame([(1, "der und die das", "de"), (2, "the and of that", "en")], "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "½ ²"), (2, "① Ⅷ _ 4"), (3, "½ und")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred == "und" for r in identify(asked, model).collect()} == {1: True, 2: True, 3: False}


def test_sample_is_bounded_and_fixed(spark, sf_dir):
    from tidemark.llm.sampling import sample_per_label

    keys = documents(spark, sf_dir).select("doc_id", "lang")
    one = sample_per_label(keys, "lang", 10).collect()
    counts = {}
    for r in one:
        counts[r.lang] = counts.get(r.lang, 0) + 1
    assert set(counts.values()) == {10}
    assert sorted(one) == sorted(sample_per_label(keys.repartition(7), "lang", 10).collect())


def test_the_stage_keeps_texts_of_a_corpus_without_languages(spark):
    rows = [(1, "hello", None), (2, "½ ²", None), (3, None, None), (4, "", None), (5, "привет 1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[4]]
    assert kept.columns == docs.columns
