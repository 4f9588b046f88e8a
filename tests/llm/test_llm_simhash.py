"""Fingerprints and groups against plain counting."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.queries import documents, op10_simhash
from tidemark.llm.simhash import BitPlanes, near_pairs, one_per_group, simhash_groups


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps):
    """Smallest id reachable for (id, fingerprint) rows; ids may repeat."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(fps))]


def test_bit_planes_count_like_popcount():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 64, 3, np.uint64, endpoint=False)
    fps = np.array([base[i % 3] ^ sum((np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, i % 5)), np.uint64(0)) for i in range(200)], np.uint64)
    for radius in (0, 1, 2, 3, 6):
        want = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
        assert (BitPlanes(fps).within(fps, radius) == want).all()


def test_query_over_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).select("doc_id", "text").collect()}
    rows = op10_simhash(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    fps = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    assert all(plain_fingerprint(texts[d]) == f and len(r.fingerprint) == 16 for (d, f), r in zip(fps, rows, strict=True))
    assert [r.component_id for r in rows] == plain_groups(fps)


def near_rows(n, seed):
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    fps = {centre, 0, (1 << 64) - 1, 1 << 63}
    while len(fps) < n:
        x = centre if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    return sorted(fps)


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    fps = near_rows(300, 3)
    nodes = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps)], "node long, fp long")
    want = plain_groups(list(enumerate(fps)))
    for size in (1024, 32):
        monkeypatch.setattr(simhash, "BLOCK_ROWS", size)
        found = {r.node: r.component for r in components(near_pairs(nodes)).collect()}
        assert [found.get(i, i) for i in range(len(fps))] == want


def test_nulls_empty_texts_ties_repeats_and_clashing_names(spark):
    long_text = "word other thing " * 40_000
    rows = [
        (None, "alpha beta gamma delta", 1),
        (5, "Alpha BETA gamma delta", 2),
        (7, "alpha beta gamma delta", 3),
        (7, "alpha beta gamma delta", 3),
        (8, None, 4),
        (9, " \n", 5),
        (3, "quite another text of a few words", 6),
        (None, "alone without an id at all", 7),
        (10, long_text, 8),
        (11, long_text, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id, r.fp) for r in simhash_groups(docs).collect()), key=lambda r: (r[0] or -1, r[1] or -1))
    fps = [(d, plain_fingerprint(t)) for d, t, _ in rows]
    want = sorted(((d, c, f - (1 << 64) if f >> 63 else f) for (d, f), c in zip(fps, plain_groups(fps), strict=True)), key=lambda r: (r[0] or -1, r[1] or -1))
    assert got == want
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 3, 5, 8, 10]
    assert simhash_groups(docs.limit(0)).count() == 0 == one_per_group(docs.limit(0)).count()


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1300)]
    edges = spark.createDataFrame([*path, *hub, (5, 5), (None, 3), (4, None), (7, 1000)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(1000, 1300)}
    assert components(edges.limit(0)).count() == 0


def jaccard(a, b):
    sets = []
    for text in (a, b):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def test_the_stage_leaves_no_near_copies(spark):
    rng = random.Random(6)
    rows = []
    for i in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((6, 60, 150, 300)))]
        rows.append((i, " ".join(base)))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(8)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(1000)}"
            rows.append((100 + len(rows), " \n ".join(copy).upper()))
    hub = [f"hub{i}" for i in range(400)]
    rows += [(1000 + i, " ".join(hub[:i] + ["x"] + hub[i:])) for i in range(0, 400, 8)]
    rows += [(5, rows[0][1]), (5, "a text of its own under a repeated id"), (None, rows[0][1]), (2000, None), (2001, " "), (2002, "a b"), (2003, "A  b")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int")
    kept = corpus_pipeline.deduplicate_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    stay = [(r.doc_id, r.text) for r in kept.collect()]
    assert not [(a, b) for a in stay for b in stay if None not in (a[0], b[0]) and a[0] < b[0] and jaccard(a[1], b[1]) >= 0.8]
    gone = [x for x in rows if x not in stay]
    assert all(any(a[0] is not None and a[0] < b[0] and jaccard(a[1], b[1]) >= 0.8 for a in rows) for b in gone)
    assert len(gone) > 60 and (None, rows[0][1]) in stay and {(5, "a text of its own under a repeated id"), (2000, None), (2002, "a b")} <= set(stay)
    assert corpus_pipeline.deduplicate_near_copies(spark, docs.limit(0), "").count() == 0


def test_the_stage_links_fingerprints_first(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(800)]
    texts = [" ".join(base)] + [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in (0, 400, 799)]
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs, of_group = [], simhash._of_group

    def seen(nodes):
        fps = {r.id: r.fp & (1 << 64) - 1 for r in nodes.collect()}
        found = of_group(nodes).localCheckpoint()
        pairs.extend((r.x_id, r.id) for r in found.collect())
        least = plain_groups(list(fps.items()))
        assert sorted(pairs) == sorted((c, i) for (i, _), c in zip(fps.items(), least, strict=True) if c != i)
        return found

    monkeypatch.setattr(simhash, "_of_group", seen)
    kept = corpus_pipeline.deduplicate_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(4, 24)]
    assert pairs
