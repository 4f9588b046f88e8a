"""Operators against small frames and pandas."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate as agg
from tidemark.operators import ingest, joins, read, reshape, validate
from tidemark.operators import metadata as md
from tidemark.operators.overlay import combine_first, contested_days, overlay
from tidemark.schema import LINKS, METADATA, SAMPLES, SAMPLES_RAW, SERIES
from tidemark.session import settle, stored_bytes

DAY = 86_400_000_000_000


def raw(spark, rows):
    """Rows ``(series, file_seq, index, value[, text])``."""
    full = [
        (r[0], r[1], f"f{r[1]}", r[2], r[3], r[4] if len(r) > 4 else None, r[2] // DAY)
        for r in rows
    ]
    return spark.createDataFrame(full, SAMPLES_RAW)


def samples(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], SAMPLES)


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# -- overlay ---------------------------------------------------------------


def random_uploads(seed, n_files=4):
    rng = random.Random(seed)
    rows, expected = [], {}
    for sid in ("a", "b"):
        newest_first = None
        for seq in reversed(range(n_files)):
            picked = sorted(rng.sample(range(-5, 15), rng.randint(0, 12)))
            values = [rng.choice([None, float(rng.randint(0, 99))]) for _ in picked]
            rows += [(sid, seq, i * (DAY // 3), v) for i, v in zip(picked, values)]
            upload = pd.Series(values, index=picked, dtype="float64")
            newest_first = upload if newest_first is None else newest_first.combine_first(upload)
        expected[sid] = newest_first
    want = [
        (sid, i * (DAY // 3), None if np.isnan(v) else v)
        for sid, s in expected.items()
        for i, v in s.items()
    ]
    return rows, sorted(want, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_overlay_equals_combining_newest_first(spark, seed):
    rows, want = random_uploads(seed)
    stored = raw(spark, rows)
    assert result(overlay(stored, kind="numeric"), "series_id", "index", "value") == want
    assert result(overlay(stored), "series_id", "index", "value") == want
    contested = contested_days(ingest.manifest_of(stored))
    fast = overlay(stored, kind="numeric", contested=contested)
    assert result(fast, "series_id", "index", "value") == want


def test_overlay_of_text_and_mixed(spark):
    stored = raw(
        spark,
        [
            ("a", 0, 1, 1.0), ("a", 1, 1, None, "x"),
            ("a", 0, 2, None, "x"), ("a", 1, 2, 2.0),
            ("a", 0, 3, None, "x"), ("a", 1, 3, None),
            ("a", 1, 4, None),
        ],
    )
    assert result(overlay(stored), "index", "value", "value_text") == [
        (1, None, "x"), (2, 2.0, None), (3, None, "x"), (4, None, None)]
    text = overlay(stored.filter("index <> 2"), kind="text")
    assert result(text, "index", "value_text") == [(1, "x"), (3, "x"), (4, None)]


def test_combine_first_equals_overlay(spark):
    rows, _ = random_uploads(9, n_files=2)
    stored = raw(spark, rows)
    parts = [stored.filter(F.col("file_seq") == n).select("series_id", "index", "value") for n in (0, 1)]
    assert result(combine_first(parts[1], parts[0]), "series_id", "index", "value") == result(
        overlay(stored, kind="numeric"), "series_id", "index", "value")


# -- reads -----------------------------------------------------------------


def test_combine_first_keeps_number_or_text_of_one_frame(spark):
    newer = samples(spark, [("a", 1, None), ("a", 2, 5.0)]).withColumn(
        "value_text", F.when(F.col("index") == 1, "new")
    )
    older = spark.createDataFrame(
        [("a", 1, 7.0, None), ("a", 2, None, "old"), ("a", 3, None, "kept"), ("a", 4, 1.0, None)], SAMPLES
    )
    got = result(combine_first(newer, older), "index", "value", "value_text")
    assert got == [(1, None, "new"), (2, 5.0, None), (3, None, "kept"), (4, 1.0, None)]
    numbers = combine_first(newer.drop("value_text"), older.drop("value_text"))
    assert numbers.columns == ["series_id", "index", "value"]
    assert result(numbers, "index", "value") == [(1, 7.0), (2, 5.0), (3, None), (4, 1.0)]


def test_half_open_range(spark):
    s = samples(spark, [("a", i, float(i)) for i in range(-2, 5)])

    def indices(start, end):
        return [r["index"] for r in read.get(s, "a", start, end).collect()]

    assert indices(0, 3) == [0, 1, 2]
    assert indices(2, 3) == [2]
    assert indices(None, 0) == [-2, -1]
    assert indices(None, None) == [-2, -1, 0, 1, 2, 3, 4]
    assert indices(3, None) == [3, 4]


def test_get_options(spark):
    s = samples(spark, [("b", 5, 1.0), ("a", 7, 2.0), ("a", 3, 3.0), ("c", 1, 4.0)])
    assert [(r.series_id, r["index"]) for r in read.get(s).collect()] == [
        ("a", 3), ("a", 7), ("b", 5), ("c", 1)]
    assert read.get(s, ["a", "c"]).count() == 3
    assert read.get(s, []).count() == 0
    many = [f"x{n}" for n in range(read.MAX_ID_LIST + 1)] + ["b"]
    assert read.get(s, many).count() == 1
    ids = spark.createDataFrame([("a",), ("a",)], "series_id string")
    assert read.get(s, ids).count() == 2
    assert str(read.get(s, "a", 3, 4, convert_date=True).first().time).startswith("1970-01-01")
    with pytest.raises(ValueError):
        read.get(s, "a", 100, 200, raise_empty=True)
    with pytest.raises(ValueError):
        read.get(s, "a", 2, 1)


# -- aggregation -----------------------------------------------------------


@pytest.mark.parametrize("function", ["mean", "min", "max", "std"])
@pytest.mark.parametrize("stored", [False, True])
def test_aggregate_equals_pandas(spark, function, stored):
    rng = random.Random(3)
    rows = [("a", i * 7_000_000 - 10**9, rng.choice([None, rng.random()])) for i in range(400)]
    data = (
        raw(spark, [(s, 0, i, -5.0) for s, i, _ in rows] + [(s, 1, i, v) for s, i, v in rows])
        if stored
        else samples(spark, rows)
    )
    frame = pd.DataFrame(rows, columns=["s", "index", "value"])
    if stored:
        frame["value"] = frame["value"].fillna(-5.0)
    frame["value"] = frame["value"].astype("float64")
    frame = frame[(frame["index"] >= -500_000_000) & (frame["index"] < 1_200_000_000)].dropna()
    want = frame.groupby(frame["index"] // 10**8 * 10**8)["value"].agg(function)
    got = agg.aggregate(data, -500_000_000, 1_200_000_000, "100ms", function).toPandas()
    got = got.set_index("index")["value"].sort_index()
    pd.testing.assert_series_equal(got, want, check_names=False)


def test_contested_days_give_the_same_aggregates(spark):
    rows = [("a", seq, i, float(i * (seq + 1))) for seq in (0, 1) for i in range(0, 1000, seq + 1)]
    stored = raw(spark, rows)
    want = result(agg.aggregate(stored, 0, 1000, "tick", "mean"), "index", "value")
    contested = contested_days(stored)
    for fast in (
        agg.aggregate(stored, 0, 1000, "tick", "mean", contested=contested),
        agg.resample(stored, "tick", "mean", contested=contested),
        agg.resample(stored, "tick", "mean"),
    ):
        assert result(fast, "index", "value") == want


def test_one_bin_of_a_hot_series_is_spread_over_tasks(spark):
    """Before the partial aggregate no task holds much more than the others."""
    rows = spark.range(40_000).selectExpr(
        "'hot' AS series_id", "id % 2 AS file_seq", "concat('f', id % 2) AS file_id", "id AS index",
        "id * 1.0D AS value", "CAST(NULL AS STRING) AS value_text", "0 AS day",
    ).repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        present = agg._present(rows, 0, 40_000, 3_600_000_000_000, None)
        sizes = present.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(sizes) == 40_000 and max(sizes) < 2 * sum(sizes) / 8


def test_resampling_day_by_day(spark):
    hour = DAY // 24
    rng = random.Random(7)
    rows = [("a", d * DAY + h * hour + m, rng.random())
            for d in (-1, 0, 2) for h in rng.sample(range(24), 6) for m in (0, 5, 9)]
    got = agg.resample(samples(spark, rows), "1h", "std", fill_within="24h").toPandas()
    got = got.set_index("index")["value"].sort_index()
    series = pd.Series({pd.Timestamp(i): v for _, i, v in rows}).sort_index()
    want = pd.concat([day.resample("1h").std() for _, day in series.groupby(series.index.floor("D"))])
    want.index = want.index.astype("int64")
    pd.testing.assert_series_equal(got, want, check_names=False)
    with pytest.raises(ValueError):
        agg.resample(samples(spark, rows), "7h", "std", fill_within="24h")


def test_single_sample_has_no_deviation(spark):
    s = samples(spark, [("a", 1, 5.0)])
    assert result(agg.aggregate(s, 0, 10, "tick", "Stdev"), "index", "value") == [(0, None)]


@pytest.mark.parametrize("block", [2, 3, 4, 5, 4096])
def test_dense_bins(spark, monkeypatch, block):
    monkeypatch.setattr(agg, "BINS_PER_BLOCK", block)
    s = samples(spark, [("a", 250, 1.0), ("a", 1150, 2.0), ("b", 150, 3.0), ("b", 1300, 9.0)])
    ids = spark.createDataFrame([("a",), ("empty",)], "series_id string")
    dense = agg.aggregate(s, 150, 1201, "tick", "max", include_empty=True, series=ids)
    got = {(r.series_id, r["index"]): r.value for r in dense.collect()}
    edges = range(100, 1300, 100)
    want = {(sid, e): None for sid in ("a", "empty") for e in edges}
    want.update({("a", 200): 1.0, ("a", 1100): 2.0})
    assert dense.count() == len(want) and got == want
    sparse = agg.aggregate(s, 150, 1201, "tick", "max", series=ids)
    assert result(dense.filter("value IS NOT NULL"), "series_id", "index", "value") == result(
        sparse, "series_id", "index", "value")
    missing = agg.gaps(s, 150, 1201, "tick", series=ids)
    assert result(missing, "series_id", "index") == sorted(
        [k for k, v in want.items() if v is None], key=str)


def test_dense_bins_before_1970_and_of_all_series(spark):
    s = samples(spark, [("a", -250, 1.0), ("b", 50, 2.0)])
    dense = agg.aggregate(s, -300, 100, "tick", "mean", include_empty=True)
    assert dense.count() == 8


def test_any_number_of_dense_bins(spark):
    """Some ten million seconds of a series: all bins are there, once."""
    s = samples(spark, [("a", 5 * 10**9, 1.0), ("a", 10_000_000 * 10**9, 2.0)])
    ids = spark.createDataFrame([("a",)], "series_id string")
    end = 10_454_400 * 10**9
    dense = agg.aggregate(s, 0, end, "1s", "max", include_empty=True, series=ids)
    counted = dense.agg(F.count("*"), F.count("value"), F.min("index"), F.max("index"), F.sum(F.col("index") / 10**9)).first()
    assert tuple(counted)[:4] == (10_454_400, 2, 0, end - 10**9)
    assert counted[4] == sum(range(10_454_400))
    assert agg.gaps(s, 0, end, "1s", series=ids).count() == 10_454_398
    filled = agg.resample(s, "1s", "max", fill_within="4000h")
    assert filled.count() == 10_000_000 - 5 + 1


def test_aggregate_arguments(spark):
    s = samples(spark, [("a", 1, 5.0)])
    good = {"start": 0, "end": 10, "period": "1s", "function": "mean"}
    for name in good:
        with pytest.raises(ValueError):
            agg.aggregate(s, **{**good, name: None})
    for wrong in ({"function": "sum"}, {"period": "1y"}, {"end": 0}):
        with pytest.raises(ValueError):
            agg.aggregate(s, **{**good, **wrong})
    for name in ("mean", "Avg", "AVG", "min", "Min", "max", "Max", "std", "Stdev", "stdev"):
        assert agg.aggregate(s, **{**good, "function": name}).count() == 1
    text = spark.createDataFrame([("a", 1, None, "x")], SAMPLES)
    with pytest.raises(ValueError):
        agg.aggregate(text.drop("value"), **good)
    for refused in (agg.aggregate(text, **good), agg.resample(text, "1s", "mean"), agg.gaps(text, 0, 10, "1s")):
        with pytest.raises(Exception, match="text cannot be aggregated"):
            refused.collect()
    outside = agg.aggregate(text, 5 * 10**9, 6 * 10**9, "1s", "mean")
    assert outside.count() == 0


def test_extents(spark):
    s = samples(spark, [("a", -4, 5.0), ("a", 9, None)])
    ids = spark.createDataFrame([("a",), ("e",)], "series_id string")
    assert result(agg.series_extent(ids, s), *agg.series_extent(ids, s).columns) == [
        ("a", -4, 9, 2), ("e", 0, -1, 0)]


# -- reshaping -------------------------------------------------------------


def test_wide_and_long_are_inverse(spark):
    s = samples(spark, [("x", 0, 1.0), ("y", 0, 2.0), ("x", 1, 3.0), ("z", 5, 4.0), ("no", 1, 1.0)])
    wide = reshape.to_wide(s, ["x", "y", "z"])
    assert result(wide, "index", "x", "y", "z") == [
        (0, 1.0, 2.0, None), (1, 3.0, None, None), (5, None, None, 4.0)]
    assert result(reshape.to_long(wide, ["x", "y", "z"]), "series_id", "index", "value") == result(
        s.filter("series_id <> 'no'"), "series_id", "index", "value")


def test_recode_boolean(spark):
    texts = ["true", "True", "false", "False", "TRUE", None]
    rows = [("a", n, None, t) for n, t in enumerate(texts)] + [("a", 9, 7.0, None)]
    got = result(reshape.recode_boolean(spark.createDataFrame(rows, SAMPLES)), "index", "value", "value_text")
    assert got == [(0, 1.0, None), (1, 1.0, None), (2, 0.0, None), (3, 0.0, None),
                   (4, None, "TRUE"), (5, None, None), (9, 7.0, None)]


# -- validation ------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [1, 2, 3, 7, 1 << 20])
def test_verdicts_equal_looking_at_whole_files(spark, block_rows):
    rng = random.Random(block_rows)
    rows, want = [], {}
    for n in range(30):
        size = rng.randint(1, 12)
        index = sorted(rng.choices(range(40), k=size))
        if rng.random() < 0.4:
            rng.shuffle(index)
        index = [None if rng.random() < 0.02 else i for i in index]
        places = sorted(rng.sample(range(-20, 60), size))
        rows += [(f"f{n}", p, i) for p, i in zip(places, index)]
        pairs = [(a, b) for a, b in zip(index, index[1:]) if a is not None and b is not None]
        good = None not in index and all(a < b for a, b in pairs)
        want[f"f{n}"] = ("Ready" if good else "Failed", all(a <= b for a, b in pairs))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, pos bigint, index bigint")
    verdicts = validate.file_verdicts(df, ["file"], ["pos"], block_rows)
    assert {r.file: r.state for r in verdicts.collect()} == {f: s for f, (s, _) in want.items()}
    complete = {r.file for r in verdicts.filter("n_unreadable = 0").collect()}
    ordered = validate.check_sorted(df, ["file"], ["pos"], block_rows).collect()
    assert {r.file: r.is_sorted for r in ordered if r.file in complete} == {
        f: s for f, (_, s) in want.items() if f in complete}
    ready, failed = validate.validate_files(df, ["file"], ["pos"], block_rows)
    assert ready.count() + failed.count() == len(rows)
    assert {r.file for r in ready.collect()} == {f for f, (s, _) in want.items() if s == "Ready"}


def test_check_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "file string, index bigint")
    assert result(validate.check_unique(df, ["file"]), "file", "index", "n") == [("a", 1, 2)]


# -- joins -----------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(500).select(
        F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        "id",
        F.create_map(F.lit("a"), "id").alias("m"),
    )
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    plain = big.join(lookup, ["k"], how)
    salted = joins.lookup_join(big, lookup, ["k"], how, small=False)
    assert salted.columns == plain.columns
    assert result(salted, *salted.columns) == result(plain, *plain.columns)
    assert result(joins.lookup_join(big, lookup, ["k"], how), *plain.columns) == result(
        plain, *plain.columns)


def test_size_check(spark, monkeypatch):
    df = spark.range(1000).select(F.uuid().alias("text"))
    kept = settle(df)
    assert kept.count() == 1000 and 36_000 < stored_bytes(kept) < 100_000
    assert joins.fits_broadcast(kept)
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 30_000)
    assert not joins.fits_broadcast(kept)
    with pytest.raises(ValueError):
        joins.lookup_join(df, df, ["text"], "full")


def test_large_lookups_give_the_same_results(spark, monkeypatch):
    rows, want = random_uploads(5)
    stored = raw(spark, rows)
    contested = contested_days(ingest.manifest_of(stored))
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", -1)
    fast = overlay(stored, kind="numeric", contested=contested)
    assert result(fast, "series_id", "index", "value") == want


# -- ingest ----------------------------------------------------------------


def test_receipts_of_good_and_bad_files(spark):
    df = spark.createDataFrame(
        [("s", "ok", 0, 5), ("s", "ok", 1, 8), ("s", "bad", 0, 2), ("s", "bad", 1, 1)],
        "series_id string, file_id string, pos bigint, index bigint",
    )
    verdicts = validate.file_verdicts(df, ["series_id", "file_id"], ["pos"])
    ready, _ = validate.split_by_verdict(df, verdicts, ["series_id", "file_id"])
    got = ingest.receipts(ready, verdicts)
    assert result(got, "file_id", "first_index", "last_index", "state") == [
        ("bad", None, None, "Failed"), ("ok", 5, 8, "Ready")]


def test_append_and_delete(spark):
    stored = raw(spark, [("a", 0, 1, 1.0), ("b", 0, 1, 2.0)])
    assert ingest.next_file_seq(stored) == 1
    assert ingest.next_file_seq(stored.limit(0)) == 0
    new = samples(spark, [("a", 1, 9.0), ("a", -1, 3.0)])
    both = ingest.append(stored, ingest.as_upload(new, 1, "f1"))
    assert result(overlay(both, kind="numeric"), "series_id", "index", "value") == [
        ("a", -1, 3.0), ("a", 1, 9.0), ("b", 1, 2.0)]
    gone = spark.createDataFrame([("a",), ("unknown",)], "series_id string")
    assert result(ingest.delete_series(both, gone), "series_id") == [("b",)]


def test_create_empty(spark):
    none = spark.createDataFrame([], SERIES)
    one = ingest.create_empty(none, ["a"])
    both = ingest.create_empty(one, ["b"])
    assert result(both, "series_id", "aliases") == [("a", []), ("b", [])]
    extent = agg.series_extent(both, samples(spark, [("b", 3, 1.0)]))
    assert result(extent, "series_id", "first_index", "last_index") == [("a", 0, -1), ("b", 3, 3)]


def test_chunk_key_and_changed_content(spark):
    # A path, its content mark and the names they are stored under.
    path = "03fc12505d3d41fea77df405b2563e49/2022/12/30/day/csv/19356.csv"
    md5 = "fJ85MDJqsTW6zDJbd+Fa4A=="
    now = spark.createDataFrame([(path, md5), ("p/2", "m2"), ("p/3", "m3")], "path string, content_md5 string")
    keyed = ingest.with_chunk_key(now).filter(F.col("path") == path).first()
    assert keyed.chunk_key == "parquet03fc12505d3d41fea77df405b2563e4920221230daycsv19356csv"
    assert keyed.md5_key == "Zko4NU1ESnFzVFc2ekRKYmQrRmE0QT09"
    stored = spark.createDataFrame([(path, md5), ("p/2", "old")], "path string, content_md5 string")
    new = ingest.incremental_ingest(now, ingest.with_chunk_key(stored))
    assert result(new, "path") == [("p/2",), ("p/3",)]


def test_chunks_in_overlay_order(spark):
    rows = [("s", 19357, 1, 0), ("s", 19356, 1, 0), ("s", 19356, 0, 0), ("s", 19358, 2, 1)]
    df = spark.createDataFrame(rows, "series_id string, day int, file_seq bigint, chunk_seq int")
    assert [(r.day, r.file_seq) for r in ingest.chunks_by_day(df).collect()] == [
        (19356, 0), (19356, 1), (19357, 1), (19358, 2)]


# -- metadata --------------------------------------------------------------


@pytest.fixture(scope="module")
def entries(spark):
    rows = [
        ("m1", "plant.hall", "pump7", {"a": "1", "maker": "Nordic Flow"}),
        ("m2", "plant.hall", "pump7b", {"b": "x"}),
        ("m3", "plant.hall.x", "pump7", {"a": "1"}),
        ("m4", "plant.hall", "other", {"a": None}),
    ]
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], METADATA)


@pytest.fixture(scope="module")
def linked(spark):
    return spark.createDataFrame([("s1", "m1"), ("s1", "m2"), ("s2", "m1"), ("s3", "m3"), ("s4", "m4")], LINKS)


@pytest.mark.parametrize(
    "args, pairs",
    [
        (("plant.hall",), [("s1", "m1"), ("s1", "m2"), ("s2", "m1"), ("s4", "m4")]),
        (("plant",), []),
        (("plant.hall", "pu"), [("s1", "m1"), ("s1", "m2"), ("s2", "m1")]),
        (("plant.hall", "pump7b"), [("s1", "m2")]),
        (("plant.hall", "pu", "a"), [("s1", "m1"), ("s2", "m1")]),
        (("plant.hall", "", "a"), [("s1", "m1"), ("s2", "m1"), ("s4", "m4")]),
    ],
)
def test_search(linked, entries, args, pairs):
    assert result(md.search(linked, entries, *args), "series_id", "metadata_id") == pairs


@pytest.mark.parametrize(
    "value, ids",
    [(1, ["s1", "s2"]), ("1", ["s1", "s2"]), ("2", []), ("*1", ["s1", "s2"])],
)
def test_search_by_value_gives_ids(linked, entries, value, ids):
    found = md.search(linked, entries, "plant.hall", "pu", "a", value)
    assert found.columns == ["series_id"]
    assert sorted(r.series_id for r in found.collect()) == ids


@pytest.mark.parametrize(
    "pattern, fits",
    [("Flow", True), ("Nor*", True), ("*Flow", True), ("Nor*Flow", True), ("*ic F*", True),
     ("flow", False), ("Flow*", False), ("*Nordic", False), ("Nordic F*Flow", False), ("*", True),
     ("N*r*ic*w", True), ("*N*F*", True), ("*F*N*", False), ("N*x*w", False), ("N_rdic Flow", False),
     ("%ic*", False), ("N*\\\\*", False)],
)
def test_partial_values(entries, pattern, fits):
    text = F.try_element_at("value", F.lit("maker"))
    hits = entries.filter(F.col("metadata_id") == "m1").filter(md.value_matches(text, pattern))
    assert (hits.count() == 1) == fits


def test_arguments_after_none_are_ignored(linked, entries):
    with pytest.warns(UserWarning):
        assert md.search(linked, entries, "plant.hall", None, "maker").count() == 4
    with pytest.warns(UserWarning):
        assert md.hierarchical("a", "b", None, "d") == ["a", "b"]
    assert md.hierarchical("a", "b", None, None) == ["a", "b"]


def test_set_get_browse_delete(spark, entries, linked):
    update = spark.createDataFrame(
        [("plant.hall", "pump7", {"n": "2"}), ("new", "k", {})],
        "namespace string, key string, value map<string,string>",
    )
    with pytest.raises(ValueError):
        md.create_metadata(entries, update)
    after = md.create_metadata(entries, update, overwrite=True, user="me")
    assert after.count() == 5
    changed = md.metadata_get(after, namespace="plant.hall", key="pump7").first()
    assert (changed.metadata_id, changed.value, changed.created_by, changed.last_modified_by) == (
        "m1", {"n": "2"}, None, "me")
    assert md.metadata_get(after, "m3").first().key == "pump7"
    with pytest.raises(ValueError):
        md.metadata_get(after, namespace="plant.hall")
    assert [r.namespace for r in md.metadata_browse(after).collect()] == ["new", "plant.hall", "plant.hall.x"]
    assert [r.key for r in md.metadata_browse(after, "plant.hall").collect()] == ["other", "pump7", "pump7b"]
    assert md.metadata_search(entries, "plant.hall", "pump7").count() == 2
    gone = spark.createDataFrame([("m1",)], "metadata_id string")
    kept, kept_links = md.metadata_delete(entries, linked, gone)
    assert (kept.count(), kept_links.count()) == (3, 3)


def test_links(spark, linked):
    again = spark.createDataFrame([("s1", "m1"), ("s9", "m1")], LINKS)
    assert md.link_metadata(linked, again).count() == 6
    assert md.unlink_metadata(linked, again).count() == 4
    for wrong in ((None, None, "k"), (None, "ns", None)):
        with pytest.raises(ValueError):
            md.names_an_entry(*wrong)
    assert md.names_an_entry("id", None, None) and not md.names_an_entry(None, "ns", "k")


def test_names_with_the_same_signs_have_their_own_ids(spark, entries):
    update = spark.createDataFrame(
        [("a/b", "c", {"n": "1"}), ("a", "b/c", {"n": "2"}), ("1:a", "b", {}), ("1", ":ab", {})],
        "namespace string, key string, value map<string,string>",
    )
    after = md.metadata_set(entries, update)
    assert after.select("metadata_id").distinct().count() == after.count() == 8


def test_info_and_attached_series(spark, linked, entries):
    extents = spark.createDataFrame(
        [("s1", 1, 5), ("s2", 0, -1), ("bare", 0, -1)],
        "series_id string, first_index bigint, last_index bigint",
    )
    info = md.series_info(extents, linked, entries)
    assert result(info, "series_id", "first_index", "metadata_id") == [
        ("bare", 0, None), ("s1", 1, "m1"), ("s1", 1, "m2"), ("s2", 0, "m1")]
    extra = entries.limit(1).withColumns({"metadata_id": F.lit("m9")})
    attached = md.metadata_with_series(entries.unionByName(extra), linked, extents)
    got = result(attached, "metadata_id", "series_id", "last_index")
    assert ("m9", None, None) in got and ("m1", "s1", 5) in got and ("m3", "s3", None) in got
    assert len(got) == 6
