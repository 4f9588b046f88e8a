"""Near words against comparing all pairs."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import spelling
from tidemark.llm.queries import documents
from tidemark.llm.spelling import WordIndex, near_words, one_error, spelling_variants, suffix_array


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def count(rows, every=199):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def expected(words: dict[str, int]):
    spots = {}
    for w in words:
        for i in range(len(w)):
            spots.setdefault((len(w), i, w[:i] + w[i + 1 :]), set()).add(w)
    by_text = {}
    near = {w: set() for w in words}
    for (_, _, text), ws in spots.items():
        by_text.setdefault(text, set()).update(ws)
        for w in ws:
            near[w] |= ws - {w}
    for text, ws in by_text.items():
        if text in words:
            near[text] |= ws
            for w in ws:
                near[w].add(text)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


@given(st.binary(max_size=60))
@settings(max_examples=200, deadline=None)
def test_suffix_array(raw):
    text = bytes(b % 3 + 1 for b in raw) + b"\0"
    assert suffix_array(np.frombuffer(text, np.uint8)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@given(st.sets(st.text("abé", min_size=2, max_size=9), min_size=1, max_size=40), st.data())
@settings(max_examples=200, deadline=None)
def test_searches_find_each_pair_once(words, data):
    words = sorted(words)
    limit = data.draw(st.sampled_from([0, 1, 32]))
    before, spelling.SMALL_INTERVAL = spelling.SMALL_INTERVAL, limit
    try:
        index = WordIndex([w.encode("latin-1") for w in words])
        halves = [data.draw(st.integers(0, len(w))) for w in words]
        who, which = one_error(index, [w.encode("latin-1") for w in words], halves)
    finally:
        spelling.SMALL_INTERVAL = before
    got = sorted(zip(who.tolist(), which.tolist(), strict=True))
    want = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b) and a[: halves[i]] == b[: halves[i]]]
    assert got == want


@pytest.mark.parametrize("letters", [60, 100_000])
def test_pieces_and_tiles_lose_nothing(spark, letters):
    rng = np.random.default_rng(3)
    words = {"prefix" + "".join(rng.choice(list("abç"), rng.integers(0, 5))) for _ in range(120)}
    words |= {"".join(rng.choice(list("ab"), rng.integers(6, 10))) for _ in range(120)}
    counts = {w: int(rng.integers(5, 400)) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in near_words(table, letters).collect()}
    want = {}
    for w in words:
        near = [v for v in words if one_apart(w, v)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            want[w] = (len(near), best, counts[best])
    assert got == want


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    got = rows_of(spelling_variants(documents(spark, sf_dir)))
    assert got == expected(count(rows)) and any(r[1] for r in got)


def test_chains_ties_and_odd_rows(spark):
    text = " ".join(["walking"] * 200 + ["walkings"] * 40 + ["wAlkinxs"] * 8 + ["talking"] * 200 + ["naïveté"] * 5 + ["NAÏVETÉ"] * 5 + ["short"] * 9 + ["balking"] * 5)
    long = "q" * 30_000
    rows = [(1, text, "a", 5), (2, None, "b", 5), (3, "", None, 5), (None, " ".join([long] * 5 + [long + "q"] * 30), "c", None), (4, "12 34 ŸŸŸ", "d", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    want = expected(count([(r[0], r[1]) for r in rows], 10**12))
    assert rows_of(spelling_variants(table, error_every=10**12)) == want
    found = {r[0]: r for r in want}
    assert found["balking"][1] == "talking" and found["walkinxs"][2] == "walking" and found[long][1] == long + "q"
    twice = table.unionByName(table)
    assert rows_of(spelling_variants(twice)) == expected(count([(r[0], r[1]) for r in rows * 2]))
    assert spelling_variants(table.limit(0)).count() == 0
    assert spelling_variants(table.where("doc_id = 4")).count() == 0
