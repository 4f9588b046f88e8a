"""Packing: every token once, no padding, whole groups."""

from __future__ import annotations

import weakref
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.bpe import codec_of
from tidemark.llm.langid import identify, train
from tidemark.llm.lines import remove_repeated_lines
from tidemark.llm.packing import STEP_TOKENS, halve, pack, pack_documents, step_groups
from tidemark.llm.queries import documents, op6_packing, tokenizer_path
from tidemark.llm.simhash import without_near_copies
from tidemark.llm.substrings import remove_repeated_passages


def check_cover(pieces, sequences):
    seen = defaultdict(list)
    for sequence in sequences:
        for doc, start, n in sequence:
            assert n > 0
            seen[doc].append((start, n))
    for doc, start, n in pieces:
        at = start
        for a, m in sorted(seen.pop(doc)):
            assert a == at
            at += m
        assert at == start + n
    assert not seen


@given(st.lists(st.integers(1, 6000), max_size=60))
@settings(max_examples=200, deadline=None)
def test_pack_and_halve(lengths):
    pieces = [(i, 0, n) for i, n in enumerate(lengths)]
    full, left = pack(list(pieces))
    assert all(sum(n for _, _, n in s) in (256, 512, 1024, 2048) for s in full)
    rest = halve(left)
    sizes = [sum(n for _, _, n in s) for s in rest]
    assert all(n & (n - 1) == 0 and n <= 2048 for n in sizes)
    check_cover(pieces, full + rest)
    groups = step_groups(full + rest)
    load = defaultdict(int)
    for g, s in zip(groups, full + rest, strict=True):
        load[g] += sum(n for _, _, n in s)
    assert all(x <= STEP_TOKENS for x in load.values())


def test_few_cuts_with_many_documents():
    lengths = [(i * 7919) % 1800 + 30 for i in range(3000)]
    full, left = pack([(i, 0, n) for i, n in enumerate(lengths)])
    pieces = sum(map(len, full)) + len(left)
    assert pieces < 1.3 * len(lengths)


def test_step_groups_are_balanced():
    full, _ = pack([(i, 0, (i * 7919) % 1800 + 30) for i in range(3000)])
    cost = defaultdict(int)
    for g, s in zip(step_groups(full), full, strict=True):
        cost[g] += sum(n * n for _, _, n in s)
    whole = sorted(cost.values())[1:]
    assert max(whole) < 3 * (sum(whole) / len(whole))


def test_pieces_hold_the_librarys_ids(spark, sf_dir):
    library = Tokenizer.from_file(tokenizer_path())
    docs = documents(spark, sf_dir)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = pack_documents(docs, tokenizer_path()).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = library.encode(texts[doc], add_special_tokens=False).ids + [1]
        parts.sort(key=lambda r: r.start)
        joined = b"".join(bytes(r.ids) for r in parts)
        assert joined == b"".join(i.to_bytes(4, "little") for i in ids)
        assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert all(r.doc_tokens == len(ids) for r in parts)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at == parts[0].sequence_length and at & (at - 1) == 0 and at <= 2048
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in op6_packing(spark, sf_dir).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}


def test_null_empty_repeated_and_long_texts(spark):
    rows = [(None, "a", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, "word " * 9000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(1)
    got = pack_documents(docs, tokenizer_path()).collect()
    assert sum(r.length for r in got) == 2 + 1 + 1 + 1 + 9001
    assert {r.doc_tokens for r in got} == {1, 2, 9001}
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_other_stages_free_a_workers_tokenizer(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three"), (2, "one two three four")], "doc_id long, text string")
    tasks, kind = [], type(docs)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, run, *a, **b: tasks.append(run) or plain(self, run, *a, **b))
    identify(docs, train({"en": [b"one two"], "fr": [b"un deux"]}))
    remove_repeated_lines(docs)
    without_near_copies(docs)
    remove_repeated_passages(docs)
    assert len(tasks) >= 8
    with open(tokenizer_path(), encoding="utf-8") as file:
        model = file.read()
    for run in tasks:  # as a worker that packed before would
        codec = weakref.ref(codec_of(model))
        assert codec_of(model) is codec()
        assert list(run(iter([]))) == []
        assert codec() is None
