"""Repeated passages against a search of all windows."""

from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import substrings
from tidemark.llm.substrings import Reference, match_shards, match_windows, remove_repeated_passages


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window):
    """(words, removed flags) of each (id, text) row."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w, gone = words(text), [False] * len(words(text))
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out.append((w, gone))
    return out


@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=25), st.integers(0, 9)), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_automaton_knows_the_first_document_of_every_window(items):
    reference = Reference(items)
    for sequence, _ in items:
        want = []
        for i in range(len(sequence) - 3):
            key = sequence[i : i + 4]
            want.append(min(o for s, o in items if any(s[j : j + 4] == key for j in range(len(s) - 3))))
        assert reference.origins(sequence, 4) == want
    stranger = [b"a", b"b", b"z", b"a", b"b", b"c", b"a"]
    got = reference.origins(stranger, 3)
    for i, origin in enumerate(got):
        key = stranger[i : i + 3]
        holders = [o for s, o in items if any(s[j : j + 3] == key for j in range(len(s) - 2))]
        assert origin == (min(holders) if holders else None)


def sample_rows(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "the"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocabulary) for _ in range(rng.randint(0, 20))]
            if rng.random() < 0.6:
                p = list(rng.choice(passages))
                if rng.random() < 0.3:
                    p[rng.randrange(len(p))] = "edit"
                w += p
        if rng.random() < 0.1:
            w += ["same"] * 40
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(n, rows[3][1]), (n + 1, rows[5][1]), (2, rows[9][1]), (7, rows[7][1]), (None, rows[4][1]), (n + 2, None), (n + 3, "")]
    rng.shuffle(rows)
    return rows


def check(spark, rows, window):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_words string").repartition(5)
    got = remove_repeated_passages(docs, window=window)
    assert got.columns == ["doc_id", "text", "n_words", "n_words_removed"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    have = sorted(((r.doc_id, r.n_words, r.n_words_removed, " ".join(words(r.text))) for r in got.collect()), key=key)
    want = sorted(((d, len(w), sum(g), " ".join(x for x, y in zip(w, g, strict=True) if not y)) for (d, _), (w, g) in zip(rows, plain(rows, window), strict=True)), key=key)
    assert have == want
    untouched = {r.text for r in got.where("n_words_removed = 0").collect()}
    assert untouched <= {t for _, t in rows}


def test_removal_equals_a_search_of_all_windows(spark):
    check(spark, sample_rows(1), 8)
    check(spark, sample_rows(2), 12)


def test_shards_too_large_for_one_automaton(spark, monkeypatch):
    original = substrings.repeated_spans
    monkeypatch.setattr(substrings, "repeated_spans", lambda *a: original(*a, shard_passages=1))
    check(spark, sample_rows(3), 10)


def test_both_ways_to_match_agree(spark):
    rng = random.Random(5)
    rows = [(i % 3, i, 100 - i, " ".join(rng.choice("abcd") for _ in range(14)), 9) for i in range(30)]
    shards = spark.createDataFrame(rows, "anchor long, passage long, doc_id long, words string, members long")

    def windows(df):
        return {(r.anchor, r.passage, x["at"] + k): x["origin"] for r in df.collect() for x in r.runs for k in range(x["n"])}

    one = windows(match_shards(shards, 5))
    two = windows(match_windows(shards, 5))
    assert set(one) == set(two)
    # windows are first compared within their anchor; equal windows of other anchors only lower the second
    first = {}
    for a, p, d, text, _ in rows:
        w = text.split()
        for i in range(10):
            first[a, tuple(w[i : i + 5])] = min(first.get((a, tuple(w[i : i + 5])), d), d)
    texts = {(a, p): t.split() for a, p, _, t, _ in rows}
    assert all(o == first[a, tuple(texts[a, p][i : i + 5])] for (a, p, i), o in one.items())
    assert all(two[k] <= o for k, o in one.items())


def test_long_texts_and_an_empty_table(spark):
    base = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, base), (2, "start " + base + " end"), (3, "word " * 5000), (4, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_words_removed, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest()) for r in remove_repeated_passages(docs).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {
        1: (30_000, 0, digest(base)),
        2: (30_002, 30_000, digest("start end")),
        3: (5000, 0, digest(" ".join(["word"] * 5000))),
        4: (5000, 5000, digest("")),
    }
    assert remove_repeated_passages(docs.limit(0)).count() == 0


def test_weak_hashes_and_clashing_names_cut_nothing(spark):
    # words that polynomials modulo 2**64 do not tell apart
    one = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{rest} {one} {rest}"), (2, f"{one} x"), (3, f"{rest.upper()} {two} {rest}")]
    docs = spark.createDataFrame([(d, x, 1, 2, 3, 4) for d, x in rows], "doc_id long, text string, _th int, _doc int, _Hash int, _spans int")
    got = remove_repeated_passages(docs)
    assert got.columns == [*docs.columns, "n_words", "n_words_removed"]
    assert {r.doc_id: r.n_words_removed for r in got.collect()} == {1: 0, 2: 0, 3: 60}
    mixed = [(1, " ".join([one] * 25 + [two] * 25)), (2, " ".join([two] * 25 + [one] * 25)), (3, " ".join([one] * 25 + [two] * 25))]
    found = remove_repeated_passages(spark.createDataFrame(mixed, "doc_id long, text string"))
    assert {r.doc_id: r.n_words_removed for r in found.collect()} == {1: 0, 2: 0, 3: 50}
