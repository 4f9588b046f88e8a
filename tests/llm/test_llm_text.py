"""Words, hashes and windows as arrays."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.textbatch import Names, equal_ranges, range_hashes, slices, sliding_min, union_of_spans, windows_by_minimum, word_hashes, word_names, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b日\x1c", max_size=30)), max_size=6)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_what_the_pattern_finds(texts):
    w = words(pa.array(texts, pa.string()))
    raw = w.data.tobytes()
    for i, text in enumerate(texts):
        got = [raw[w.starts[k] : w.ends[k]].decode() for k in range(w.first[i], w.first[i + 1])]
        assert got == re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_equal_words_have_equal_hashes_wherever_they_stand():
    w = words(pa.array(["one two", None, "two one two three"]))
    h = word_hashes(w).tolist()
    assert h[0] == h[3] and h[1] == h[2] == h[4]
    assert len(set(h)) == 3
    assert len(range_hashes(np.frombuffer(b"abab", np.uint8), np.array([0, 2]), np.array([2, 4]))) == 2


def test_a_sliced_column_is_read_where_it_begins():
    column = pa.array(["skip this", "a b", "c"])[1:]
    w = words(column)
    assert w.data.tobytes() == b"a bc" and w.first.tolist() == [0, 2, 3]


@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 12))
def test_sliding_min(values, width):
    got = sliding_min(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_windows_stay_inside_their_text_and_cover_it():
    values = np.arange(23, dtype=np.uint64) % np.uint64(7)
    first = np.array([0, 3, 3, 13, 23])
    text, begin, end, name, _ = windows_by_minimum(values, first, 4, 2)
    covered = {t: set() for t in range(4)}
    for t, a, b in zip(text, begin, end, strict=True):
        assert first[t] <= a and b <= first[t + 1] and b - a >= 4
        covered[t] |= set(range(a, b - 3))
    assert covered == {0: set(), 1: set(), 2: set(range(3, 10)), 3: set(range(13, 20))}


def test_equal_windows_have_equal_names():
    values = np.array([5, 1, 4, 1, 9, 8, 7, 5, 1, 4, 1, 9], np.uint64)
    text, begin, end, name, _ = windows_by_minimum(values, np.array([0, 6, 12]), 5, 2)
    names = [{n for t, a, b, n in zip(text, begin, end, name, strict=True) if t == k and a <= at < b - 4} for k, at in ((0, 0), (1, 7))]
    assert names[0] == names[1] and len(names[0]) == 1


def test_slices_keep_all_rows_and_take_a_long_text_alone():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, "y" * 100, None, "", "z" * 5]})
    parts = list(slices([batch], size=20))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in parts) < 5


def test_union_of_spans():
    assert union_of_spans([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)]


def test_equal_ranges_are_equal():
    word = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    w = words(pa.array([" ".join(["x", other, word, "y", other, "x", word, other[:-1]])]))
    group, shown = equal_ranges(w.data, w.starts, w.ends)
    texts = [w.data[a:b].tobytes() for a, b in zip(w.starts, w.ends, strict=True)]
    assert [texts[shown[g]] for g in group] == texts and len(shown) == 5


def test_names_tell_apart_what_one_polynomial_does_not():
    word = "".join("ab"[i.bit_count() & 1] for i in range(2048))
    texts = [word, word.translate(str.maketrans("ab", "ba")), word]
    w = words(pa.array(texts))
    assert len(set(word_hashes(w).tolist())) == 1
    one, two, again = word_names(w).tolist()
    assert one == again != two
    signs = np.array([i.bit_count() & 1 for i in range(4096)], np.uint64) + np.uint64(7)
    both = Names(np.concatenate((signs, np.uint64(15) - signs)))
    a, b = both.ranges(np.array([0, 4096]), np.array([4096, 8192])).tolist()
    assert a != b
    grams = both.grams(50)
    assert grams[10] == Names(signs[10:60]).ranges(np.array([0]), np.array([50]))[0] or len(grams) == 8192 - 49
