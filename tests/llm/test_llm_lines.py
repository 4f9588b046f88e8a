"""Repeated runs of lines against a search of all windows."""

from __future__ import annotations

import random

import corpus_pipeline
from tidemark.llm.lines import remove_repeated_lines


def plain(rows, run):
    """What is left of each (id, text) row, and how many lines went."""
    places = {}
    full = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        full.append((lines, at))
        if doc is not None:
            for k in range(len(at) - run + 1):
                key = tuple(lines[i] for i in at[k : k + run])
                places[key] = min(places.get(key, (doc, k)), (doc, k))
    out = []
    for (doc, text), (lines, at) in zip(rows, full, strict=True):
        gone = set()
        for k in range(len(at) - run + 1):
            if doc is not None and places[tuple(lines[i] for i in at[k : k + run])] != (doc, k):
                gone |= set(at[k : k + run])
        out.append((None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(at), len(gone)))
    return out


def check(spark, rows, run):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_lines string").repartition(4)
    got = remove_repeated_lines(docs, run_lines=run)
    assert got.columns == ["doc_id", "text", "n_lines", "n_lines_removed"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    have = sorted(((r.doc_id, r.text, r.n_lines, r.n_lines_removed) for r in got.collect()), key=key)
    want = sorted(((d, *p) for (d, _), p in zip(rows, plain(rows, run), strict=True)), key=key)
    assert have == want


def test_removal_equals_a_search_of_all_windows(spark):
    rng = random.Random(4)
    pool = [f"line {i}" for i in range(25)] + ["", "  ", "line 1 ", "é"]
    blocks = [[rng.choice(pool) for _ in range(rng.randint(2, 8))] for _ in range(5)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += [rng.choice(pool) for _ in range(rng.randint(0, 3))] + (rng.choice(blocks) if rng.random() < 0.6 else [])
        if rng.random() < 0.1:
            lines += ["again"] * 7
        rows.append((i, "\n".join(lines) + rng.choice(["", "\n", "\n\n"])))
    rows += [(3, rows[3][1]), (60, rows[5][1]), (None, rows[6][1]), (61, None), (62, "")]
    for run in (1, 2, 3):
        check(spark, rows, run)


def test_a_common_line_alone_stays_and_an_empty_table(spark):
    rows = [(i, f"start {i}\ncommon\nend {i}") for i in range(200)]
    check(spark, rows, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert remove_repeated_lines(docs).where("n_lines_removed > 0").count() == 0
    assert remove_repeated_lines(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "\n".join(f"line number {i}" for i in range(40_000))
    check(spark, [(1, text), (2, "first\n" + text)], 3)


def plain_runs(rows, run, least):
    """As plain(), where fewer lines are a run by their words, or as a whole text without a run."""
    places, full = {}, []
    for doc, text in rows:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        runs = []
        for k in range(len(at)):
            for n in range(1, min(run, len(at) - k) + 1):
                key = tuple(lines[i] for i in at[k : k + n])
                kind = 1 if n == run or sum(len(x.split()) for x in key) >= least else 2 if n == len(at) else 0
                if kind:
                    runs.append((k, n, (kind, key)))
        full.append((lines, at, runs))
        if doc is not None:
            for k, _, key in runs:
                places[key] = min(places.get(key, (doc, k)), (doc, k))
    out = []
    for (doc, text), (lines, at, runs) in zip(rows, full, strict=True):
        gone = {i for k, n, key in runs if doc is not None and places[key] != (doc, k) for i in at[k : k + n]}
        out.append((None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(at), len(gone)))
    return out


def test_runs_by_content(spark):
    rng = random.Random(9)
    pool = [" ".join(rng.choice(("a", "bc", "def")) for _ in range(rng.randint(1, 7))) for _ in range(40)] + ["", " ", "x"]
    sizes = (0, 1, 1, 2, 2, 3, 9)
    rows = [
        (i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"line {i} {k}" for k in range(rng.choice(sizes))) + rng.choice(["", "\n"]))
        for i in range(120)
    ]
    rows += [(3, rows[3][1]), (3, rows[7][1]), (200, rows[5][1]), (None, rows[6][1]), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2])
    for run, least in ((3, 5), (2, 4), (3, 1)):
        have = sorted((tuple(r) for r in remove_repeated_lines(docs, run_lines=run, least_words=least).collect()), key=key)
        assert have == sorted(((d, *p) for (d, _), p in zip(rows, plain_runs(rows, run, least), strict=True)), key=key)
    assert remove_repeated_lines(docs.limit(0), least_words=5).count() == 0


def test_the_stage_cuts_single_lines_and_short_texts(spark):
    common = [(i, f"start {i}\nthis boilerplate stands between unique lines\nend {i}") for i in range(30)]
    short = [(40, "two\nlines"), (41, "two\nlines"), (42, "one line"), (43, "one line")]
    docs = spark.createDataFrame(common + short, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in corpus_pipeline.deduplicate_lines(spark, docs, "").collect()}
    assert kept == {i: common[0][1] if i == 0 else f"start {i}\nend {i}" for i in range(30)} | {40: "two\nlines", 42: "one line"}


def test_weak_hashes_and_clashing_names_cut_nothing(spark):
    # words that polynomials modulo 2**64 do not tell apart
    one = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{one}\nsame\nother"), (2, f"{two}\nsame\nother"), (3, f"{one}\nsame\nother")]
    docs = spark.createDataFrame([(d, x, 1, 2, 3, 4) for d, x in rows], "doc_id long, text string, _th int, _doc int, _Hash int, _spots int")
    got = remove_repeated_lines(docs, run_lines=3)
    assert got.columns == [*docs.columns, "n_lines", "n_lines_removed"]
    assert {r.doc_id: r.n_lines_removed for r in got.collect()} == {1: 0, 2: 0, 3: 3}
    cut = remove_repeated_lines(docs.select("doc_id", "text"), run_lines=3, least_words=5)
    assert {r.doc_id: r.n_lines_removed for r in cut.collect()} == {1: 0, 2: 0, 3: 3}


def test_texts_are_merged_with_their_cuts_at_any_size(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc\n" + str(i)) for i in range(4)], "doc_id long, text string")
    cut = remove_repeated_lines(docs)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(r.n_lines_removed for r in cut.collect()) == [0, 3, 3, 3]
