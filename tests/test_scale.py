"""What keeps work in proportion: pruned folders, stored layouts, partial results."""

from __future__ import annotations

import glob
import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate as agg
from tidemark.operators import ingest, overlay, read
from tidemark.operators.metadata import search
from tidemark.operators.reshape import block_columns, from_blocks, to_blocks, to_long, to_wide, to_wide_blocks
from tidemark.operators.rollup import aggregate_rollup, exact_mean, rollup
from tidemark.operators.search_index import candidates, needed_grams, search_indexed, write_search_index
from tidemark.plans import inputs
from tidemark.plans.queries import pivot_blocks
from tidemark.schema import SAMPLES_RAW
from tidemark.sinks.rewrite import delete_series_files, merge_contested, replace_rows
from tidemark.sinks.samples import write_samples
from tidemark.sources.manifest import read_listed
from tidemark.sources.samples import read_samples

DAY = 86_400_000_000_000


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {f.split("/")[-1] for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# -- listed files ------------------------------------------------------------


def test_ten_thousand_listed_files(spark, tmp_path):
    base = tmp_path / "chunks"
    listed = []
    for n in range(10_000):
        folder = base / f"series_id=s{n % 20}" / f"day={n % 50}"
        if n < 1_000:
            folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{n}.csv").write_text(f"{n},{n}.5\n")
        if n % 3:
            listed.append((f"series_id=s{n % 20}/day={n % 50}/{n}.csv", f"s{n % 20}", n, f"f{n}"))
    manifest = spark.createDataFrame(listed, "path string, series_id string, file_seq long, file_id string")
    got = read_listed(spark, manifest, str(base))
    assert got.agg(F.count("*"), F.sum("value")).first() == (len(listed), sum(n + 0.5 for _, _, n, _ in listed))
    some = read_listed(spark, manifest.filter("series_id = 's7'"), str(base))
    assert "dynamicpruning" in plan_of(some) and some.select("series_id").distinct().count() == 1
    gone = manifest.limit(1).withColumn("path", F.lit("series_id=s1/day=1/none.csv"))
    with pytest.raises(ValueError):
        read_listed(spark, manifest.unionByName(gone), str(base))


# -- keys of stored chunks ---------------------------------------------------


def test_stored_keys_are_not_shuffled(spark, tmp_path, sf_dir):
    listing = inputs.chunk_listing(inputs.table(spark, sf_dir, "events"))
    path = str(tmp_path / "keys")
    keyed = ingest.with_chunk_key(listing)
    ingest.remember_ingested(spark, path, keyed.filter("day % 2 = 0"), buckets=4)
    ingest.remember_ingested(spark, path, keyed.filter("day % 6 = 1"), buckets=4)
    new = ingest.not_ingested(spark, path, listing, buckets=4)
    assert {r.day % 6 for r in new.collect()} == {3, 5}
    right = plan_of(new).split("SortMergeJoin")[1].split("Scan parquet")[-1]
    assert "Bucketed: true" in plan_of(new) and "Exchange" not in right
    assert new.count() == ingest.incremental_ingest(listing, keyed.filter("day % 2 = 0 or day % 6 = 1")).count()


# -- rewriting ---------------------------------------------------------------


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "samples")
    for seq in range(3):
        rows = [(f"s{s}", seq, f"{seq}-s{s}", d * DAY + i, float(seq * 100 + i), None) for s in range(3) for d in range(3) for i in range(seq, 5) if (s, d) != (2, 2) or seq == 0]
        schema = "series_id string, file_seq bigint, file_id string, index bigint, value double, value_text string"
        write_samples(spark.createDataFrame(rows, schema), path)
    return path


def values(df):
    return sorted((r.series_id, r["index"], r.value) for r in df.collect())


def test_delete_leaves_other_files_alone(spark, stored):
    lone = spark.createDataFrame([("lone", 7, "7-lone", 1, 1.0, None, 0)], SAMPLES_RAW)
    write_samples(lone, stored)
    before, rows = files(stored), values(overlay.overlay(read_samples(spark, stored), kind="numeric"))
    went = delete_series_files(spark, stored, spark.createDataFrame([("lone",)], "series_id string"))
    assert went.count() == 1 and len(before - files(stored)) == 1 and files(stored) < before
    assert values(overlay.overlay(read_samples(spark, stored), kind="numeric")) == [r for r in rows if r[0] != "lone"]
    unknown = spark.createDataFrame([("none",)], "series_id string")
    now = files(stored)
    assert delete_series_files(spark, stored, unknown).count() == 0 and files(stored) == now


def test_rewriting_that_broke_off_changes_no_read(spark, stored, monkeypatch):
    want = values(overlay.overlay(read_samples(spark, stored), kind="numeric"))
    monkeypatch.setattr("tidemark.sinks.rewrite.delete_file", lambda *a: None)
    replace_rows(spark, stored, spark.createDataFrame([("none",)], "series_id string"), ["series_id"])
    manifest = ingest.manifest_of(read_samples(spark, stored))
    merge_contested(spark, stored, manifest)
    assert values(overlay.overlay(read_samples(spark, stored), kind="numeric")) == want


def test_merged_days_are_read_without_a_shuffle(spark, stored):
    manifest = ingest.manifest_of(read_samples(spark, stored))
    want = values(overlay.overlay(read_samples(spark, stored), kind="numeric"))
    listing = merge_contested(spark, stored, manifest)
    contested = overlay.contested_days(listing)
    assert contested.count() == 0 and listing.count() == 9
    samples = read_samples(spark, stored)
    assert samples.groupBy("series_id", "index").count().filter("count > 1").isEmpty()
    assert values(read.get(samples, kind="numeric", ordered=False, contested=contested)) == want
    assert values(samples.select("series_id", "index", "value")) == want
    again = merge_contested(spark, stored, listing)
    assert again.count() == 9


# -- partial results ---------------------------------------------------------


@pytest.mark.parametrize("function", ["mean", "std", "min", "max"])
@pytest.mark.parametrize("start,end,period", [(None, None, "3h"), ("1970-01-01T01:30", "1970-01-03T05:00", "6h"), ("1970-01-02T02:00", "1970-01-02T03:00", "1h"), ("1970-01-02", "1970-01-03", "24h")])
def test_rollups_equal_direct_aggregates(spark, function, start, end, period):
    rows = [(f"s{s}", i * 1_700_000_000_000, 1e6 + math.sin(i * (s + 1))) for s in range(2) for i in range(200)]
    samples = spark.createDataFrame(rows, "series_id string, index bigint, value double")
    parts = rollup(samples, "1h")
    got = {(r.series_id, r["index"]): r.value for r in aggregate_rollup(parts, samples, start, end, period, function, base_period="1h").collect()}
    direct = agg.resample(samples, period, function, start, end)
    want = {(r.series_id, r["index"]): r.value for r in direct.collect()}
    assert got.keys() == want.keys() and got
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or math.isclose(got[k], v, rel_tol=1e-7))


def test_whole_days_are_not_scanned(spark, stored, tmp_path):
    samples, path = read_samples(spark, stored), str(tmp_path / "rollup")
    rollup(samples, "1h").write.partitionBy("day").parquet(path)
    parts = spark.read.parquet(path)
    got = aggregate_rollup(parts, samples, 0, 3 * DAY, "24h", "max", base_period="1h")
    assert stored not in plan_of(got)
    cut = aggregate_rollup(parts, samples, 0, 2 * DAY + 3, "24h", "max", base_period="1h")
    scans = [line for line in plan_of(cut).splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert any("day" in line and "PartitionFilters" in line and "(day" in line for line in scans)
    assert {(r["index"] // DAY): r.value for r in cut.filter("series_id = 's0'").collect()} == {0: 204.0, 1: 204.0, 2: 202.0}
    with pytest.raises(ValueError):
        aggregate_rollup(parts, samples, 0, DAY, "90m", "max", base_period="1h")
    with pytest.raises(ValueError):
        rollup(samples, "7h")


def test_exact_means_do_not_depend_on_order(spark):
    rows = [("s", i, 0.1 * (i % 97) + 1e6 * (i % 3)) for i in range(5_000)]
    samples = spark.createDataFrame(rows, "series_id string, index bigint, value double")
    found = {exact_mean(samples.repartition(n), 0, DAY, "24h", scale=3).first().value for n in (1, 2, 7, 13)}
    assert len(found) == 1
    assert found == {sum(round(v * 1000) for _, _, v in rows) / 1000 / len(rows)}


# -- search ------------------------------------------------------------------


def test_grams():
    assert needed_grams("abcd*xy*efg") == ["abc", "bcd", "efg"]
    assert needed_grams("*a*b*") == [] and needed_grams("") == []


def test_indexed_search_equals_search(spark, tmp_path, sf_dir):
    entries, links, path = inputs.metadata(spark, sf_dir), inputs.links(spark, sf_dir), str(tmp_path / "index")
    write_search_index(entries, path)
    for args in [("nation",), ("nation", "NATION_1"), ("customer.building", "Customer#", "nation"), ("customer.machinery", "Customer#", "nation", "NATION*2"),
                 ("customer.machinery", "Customer#00", "nation", "TION_1"), ("nation", "N", "region", "1"), ("nation", "N", "none", "abcd"), ("none", "N", "nation", "NATION")]:
        got, want = search_indexed(spark, path, links, *args), search(links, entries, *args)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    found = candidates(spark, path, "customer.machinery", "nation", "N*ION*1*")
    assert "PartitionFilters: [isnotnull(part" in plan_of(found) or "PartitionFilters: [(part" in plan_of(found)
    assert "part=" in str(found.inputFiles())
    keyed = search_indexed(spark, path, links, "customer.building", "Customer#0000001")
    assert keyed is not None


# -- wide tables -------------------------------------------------------------


def test_blocks_of_columns(spark):
    rows = [(f"s{i % 25}", i // 2, float(i)) for i in range(400)] + [("other", 1, 9.0)]
    samples = spark.createDataFrame(rows, "series_id string, index bigint, value double")
    names = [f"s{i}" for i in range(25)] + ["missing"]
    wide = to_wide_blocks(samples, names, block=7)
    assert wide.columns == ["index", *names]
    assert sorted(map(str, wide.collect())) == sorted(map(str, to_wide(samples, names).select(*wide.columns).collect()))
    assert to_long(wide, names).count() == 400
    plan = plan_of(wide.select("*"))
    assert plan.count("hashpartitioning(index") <= 5 and "CartesianProduct" not in plan


@pytest.mark.parametrize("broadcast", [True, False])
def test_blocks_and_back(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("tidemark.operators.joins.MAX_BROADCAST_BYTES", -1)
    rows = [(f"s{i % 25}", i // 2, float(i)) for i in range(400)]
    rows += [("s1", 0, 7.0), ("s1", 0, -7.0), ("s2", 500, None), (None, 3, 1.0), (None, 3, 2.0), ("s3", None, 4.0), ("other", 1, 9.0)]
    samples = spark.createDataFrame(rows, "series_id string, index bigint, value double")
    columns = block_columns(samples.filter("series_id <=> null or series_id <> 'other'"), 7)
    placed = {(r.block, r.place): r.series_id for r in columns.collect()}
    assert sorted(placed.values(), key=str) == sorted([None, *(f"s{i}" for i in range(25))], key=str) and all(0 <= p < 7 for _, p in placed)
    want = {}
    for sid, index, value in rows:
        if sid != "other" and value is not None:
            want[sid, index] = max(value, want.get((sid, index), value))
    blocks = to_blocks(samples, columns, block=7)
    got = blocks.collect()
    assert len({(r["index"], r.block) for r in got}) == len(got) and {len(r["values"]) for r in got} == {7}
    assert {(placed[r.block, p], r["index"]): v for r in got for p, v in enumerate(r["values"]) if v is not None} == want
    assert [r["values"] for r in got if r["index"] == 500] == [[None] * 7]
    back = from_blocks(blocks, columns)
    assert back.columns == ["series_id", "index", "value"]
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(str((*k, v)) for k, v in want.items())


def test_a_plan_of_blocks_does_not_grow_with_the_columns(spark, tmp_path):
    plans = set()
    for users in (10, 450):
        sf = str(tmp_path / str(users))
        events = spark.range(users * 4).selectExpr(f"id % {users} as user_id", "timestamp'2024-01-02' + make_dt_interval(0, id) as ts", "double(id) as value")
        events.write.parquet(f"{sf}/events.parquet")
        pivoted = pivot_blocks(spark, sf)
        want = agg.aggregate(inputs.samples(spark, sf), "2024-01-01", "2024-01-31", "1h", "max")
        assert values(pivoted) == values(want) and pivoted.count() > users
        plans.add(re.sub(r"\d+", "", pivoted._jdf.queryExecution().optimizedPlan().toString()))
    assert len(plans) == 1
