from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.overlay import overlay
from tidemark.sources.chunks import infer_value_type, parse_index, split_lines
from tidemark.streaming import ingest as ingest_module
from tidemark.streaming.ingest import (
    ingest_batch,
    known_files,
    last_file_seq,
    prepare,
    read_ingest_manifest,
    read_ingested,
    read_receipts,
    runs_before,
    stream_ingest,
)


class Queue:
    def __init__(self, spark, home):
        self.spark, self.home = spark, home
        self.out = str(home / "out")
        (home / "queue").mkdir()

    def put(self, series_id, file_id, *lines):
        folder = self.home / "queue" / f"series_id={series_id}"
        folder.mkdir(exist_ok=True)
        (folder / f"{file_id}.csv").write_text("".join(f"{line}\n" for line in lines))

    def drain(self, **kw):
        stream_ingest(
            self.spark, str(self.home / "queue"), self.out, str(self.home / "state"), once=True, **kw
        ).awaitTermination()

    def stored(self):
        rows = read_ingested(self.spark, self.out).collect()
        return sorted((r.series_id, r.file_id.removesuffix(".csv"), r["index"], r.value, r.value_text) for r in rows)

    def states(self):
        return {r.file_id.removesuffix(".csv"): r.state for r in read_receipts(self.spark, self.out).collect()}


@pytest.fixture
def queue(spark, tmp_path):
    return Queue(spark, tmp_path)


def test_good_files_are_stored_and_bad_ones_put_aside(spark, queue):
    queue.put("7", "good", "1,1.5", "", "2,")
    queue.put("7", "back", "2,1", "1,1")
    queue.put("t", "text", "1,fo,o", "2,1")
    queue.put("t", "repeat", "1,1", "1,2")
    queue.put("t", "unread", "x,1", "2,2")
    queue.drain()
    assert queue.states() == {
        "good": "Ready", "text": "Ready", "back": "Failed", "repeat": "Failed", "unread": "Failed"}
    assert queue.stored() == [
        ("7", "good", 1, 1.5, None), ("7", "good", 2, None, None),
        ("t", "text", 1, None, "fo,o"), ("t", "text", 2, None, "1")]
    kinds = {r.file_id.removesuffix(".csv"): (r.kind, r.n_samples) for r in read_ingest_manifest(spark, queue.out).collect()}
    assert kinds == {"good": ("numeric", 2), "text": ("text", 2)}
    assert spark.read.parquet(f"{queue.out}/failed").count() == 6


def test_later_file_wins_and_a_repeated_one_does_nothing(queue):
    queue.put("a", "one", "1,1", "2,2", "3,3")
    queue.drain()
    queue.put("a", "two", "2,20", "3,", "4,40")
    queue.drain()
    queue.put("a b", "one", "9,9")
    queue.put("a", "three", "4,400")
    before = len(queue.stored())
    queue.drain()
    got = overlay(read_ingested(queue.spark, queue.out), kind="numeric")
    values = {(r.series_id, r["index"]): r.value for r in got.collect()}
    assert values == {
        ("a", 1): 1.0, ("a", 2): 20.0, ("a", 3): 3.0, ("a", 4): 400.0, ("a b", 9): 9.0}
    assert len(queue.stored()) == before + 2


def test_redelivered_file_is_ignored(spark, queue):
    queue.put("a", "one", "1,1")
    queue.drain()
    # The same upload once more, in a batch of its own.
    again = spark.createDataFrame(
        [("a", "one.csv", 0, "1", "777"), ("a", "one.csv", 0, "5", "5")],
        "series_id string, file_id string, block_start bigint, index_token string, value_token string",
    ).withColumn("modified", F.timestamp_millis(F.lit(1_700_000_000_000)))
    ingest_batch(again, 1, queue.out)
    assert queue.stored() == [("a", "one", 1, 1.0, None)]
    assert known_files(spark, queue.out, 0).count() == 0
    assert known_files(spark, queue.out, 1).count() == 1


def test_files_of_one_stem_are_judged_apart(queue):
    queue.put("a", "one", "1,1", "2,2")
    (queue.home / "queue" / "series_id=a" / "one.txt").write_text("1,10\n0,5\n")
    (queue.home / "queue" / "series_id=a" / "one two+%.txt").write_text("7,7\n")
    queue.drain()
    assert queue.states() == {"one": "Ready", "one.txt": "Failed", "one two+%.txt": "Ready"}
    assert [r[1] for r in queue.stored()] == ["one", "one", "one two+%.txt"]


def test_numbers_begin_above_those_given_elsewhere(spark, queue):
    queue.put("a", "one", "1,1")
    high = 9_000_000_000_000_000_000
    queue.drain(above=high)
    assert read_ingested(spark, queue.out).first().file_seq > high


def test_small_batches_give_the_same_as_one_batch_job(spark, queue):
    rng = random.Random(1)
    lines = []
    for n in range(12):
        index = sorted(rng.sample(range(100), 20))
        rows = [f"{i},{rng.choice(['', 'x', '1.5', '2'])}" for i in index]
        queue.put("a", f"f{n:02}", *rows)
        lines += [(f"f{n:02}", row) for row in rows]
    queue.drain(max_files=5)
    tokens = split_lines(spark.createDataFrame(lines, "file_id string, line string"))
    batch = infer_value_type(parse_index(tokens), ["file_id"])
    want = sorted(
        (("a", r.file_id, r["index"], r.value, r.value_text) for r in batch.collect()), key=str
    )
    assert sorted(queue.stored(), key=str) == want
    seqs = read_ingested(spark, queue.out).groupBy("file_id").agg(F.countDistinct("file_seq").alias("n"))
    assert {r.n for r in seqs.collect()} == {1}
    assert read_ingested(spark, queue.out).select("file_seq").distinct().count() == 12
    in_batches = read_ingest_manifest(spark, queue.out).orderBy("file_seq").collect()
    assert sorted(r.file_id for r in in_batches) == [f"f{n:02}.csv" for n in range(12)]


def test_a_batch_run_twice_leaves_the_same(spark, queue):
    queue.put("a", "one", "1,1", "2,2")
    queue.drain()
    before = queue.stored()
    raw = spark.createDataFrame(
        [("a", "two", 0, "1", "5"), ("a", "two", 0, "3", "6")],
        "series_id string, file_id string, block_start bigint, index_token string, value_token string",
    ).coalesce(1).withColumn("modified", F.timestamp_millis(F.lit(1_700_000_000_000)))
    for _ in range(2):
        ingest_batch(raw, 1, queue.out)
        assert len(queue.stored()) == len(before) + 2
        assert len(queue.states()) == 2


def test_runs_cover_all_earlier_batches_with_few_folders():
    for n in (0, 1, 15, 16, 17, 255, 256, 257, 5_000):
        runs = runs_before(n)
        spans = [range(start, start + 16**level) for level, start in runs]
        assert [b for span in spans for b in span] == list(range(n))
        assert len(runs) <= 15 * 4
    assert len(runs_before(65_536)) == 1


def test_names_are_found_in_merged_runs_by_few_folders(spark, queue, monkeypatch):
    monkeypatch.setattr(ingest_module, "FAN", 2)
    columns = "series_id string, file_id string, block_start bigint, index_token string, value_token string"

    def batch(number, *files):
        rows = [("a", f, 0, "1", str(number)) for f in files]
        raw = spark.createDataFrame(rows, columns).withColumn("modified", F.timestamp_millis(F.lit(1_700_000_000_000)))
        ingest_batch(raw, number, queue.out)

    prepare(spark, queue.out)
    for n in range(4):
        batch(n, f"f{n}", f"g{n}")
    for _ in range(2):  # a batch that is run again merges again
        batch(3, "f3", "g3")
    assert runs_before(4) == [(2, 0)]
    names = [("a", "f0"), ("a", "new")]
    known = known_files(spark, queue.out, 4, names)
    assert ("a", "f0") in {tuple(r) for r in known.collect()}
    parts = {ingest_module._name_hash(*n)[:2] for n in names}
    read = known.select(F.input_file_name().alias("path")).distinct().collect()
    assert {r.path.split("part=")[1][:2] for r in read} <= parts
    assert known_files(spark, queue.out, 4).count() == 8
    batch(4, "f0", "g2", "h")
    assert {r[1]: r[3] for r in queue.stored()}["f0"] == 0.0 and len(queue.stored()) == 9
    seqs = [r.file_seq for r in read_ingested(spark, queue.out).filter("file_id = 'h'").collect()]
    assert seqs[0] == last_file_seq(spark, queue.out, 5) > last_file_seq(spark, queue.out, 4)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan
