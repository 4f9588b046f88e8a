"""A whole life of a store: create, append, read, search, delete."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tidemark import SeriesStore

DAY = 86_400_000_000_000


@pytest.fixture
def store(spark, tmp_path):
    return SeriesStore(spark, str(tmp_path / "store"), user="tester")


def points(df, value="value"):
    return [(r["index"], r[value]) for r in df.collect()]


def hours(start, n, first=0.0):
    index = pd.date_range(start, periods=n, freq="h")
    return pd.Series(np.arange(n, dtype="float64") + first, index=index)


def test_create_and_read(store):
    data = hours("2022-12-30", 96)
    receipt = store.create(data)
    assert receipt["TimeOfFirstSample"] == 1672358400000000000
    assert receipt["TimeOfLastSample"] == 1672700400000000000
    sid = receipt["TimeSeriesId"]
    everything = points(store.get(sid, convert_date=False))
    assert everything == list(zip(data.index.astype("int64"), data))
    part = store.get(sid, "2022-12-31", "2023-01-01")
    assert part.count() == 24
    assert str(part.first().time) == "2022-12-31 00:00:00"


def test_append_overwrites_and_fills(store):
    sid = store.create(pd.Series([1.0, 2.0, 3.0], index=[0, 1, 2]))["TimeSeriesId"]
    receipt = store.append(pd.Series([20.0, np.nan, 40.0], index=[1, 2, 3]), sid)
    assert (receipt["TimeOfFirstSample"], receipt["TimeOfLastSample"]) == (0, 3)
    got = points(store.get(sid, convert_date=False))
    assert got == [(0, 1.0), (1, 20.0), (2, 3.0), (3, 40.0)]


def test_frames_are_taken_too(store, spark):
    frame = spark.range(5_000).selectExpr(
        "id AS pos", "timestamp_seconds(1704067200 + id) AS index", "id * 2.0D AS value"
    )
    receipt = store.create(frame.repartition(3))
    assert receipt["TimeOfLastSample"] - receipt["TimeOfFirstSample"] == 4_999 * 10**9
    assert store.get(receipt["TimeSeriesId"]).count() == 5_000
    with pytest.raises(ValueError):
        store.create(frame.withColumn("pos", -frame.pos))
    with pytest.raises(ValueError):
        store.create(frame.drop("pos"))


def test_empty_series(store):
    receipt = store.create()
    sid = receipt["TimeSeriesId"]
    assert (receipt["TimeOfFirstSample"], receipt["TimeOfLastSample"]) == (0, -1)
    assert store.get(sid).count() == 0
    with pytest.raises(ValueError):
        store.get(sid, raise_empty=True)
    row = store.info(sid).first()
    assert (row.first_index, row.last_index, row.metadata_id) == (0, -1, None)


def test_text_and_boolean_series(store):
    sid = store.create(pd.Series(["fo,o", "bar"], index=[1, 2]))["TimeSeriesId"]
    assert points(store.get(sid), "value_text") == [(1, "fo,o"), (2, "bar")]
    with pytest.raises(ValueError):
        store.get_samples_aggregate(
            sid, 0, 10, aggregation_period="tick", aggregation_function="mean"
        )
    flags = store.create(pd.Series([True, False], index=[1, 2]))["TimeSeriesId"]
    assert points(store.get(flags), "value_text") == [(1, "True"), (2, "False")]


@pytest.mark.parametrize(
    "index", [[2, 1, 3], [1, 1, 2]], ids=["unsorted", "repeated"]
)
def test_bad_index_is_refused(store, index):
    with pytest.raises(ValueError):
        store.create(pd.Series([1.0, 2.0, 3.0], index=index))
    with pytest.raises(ValueError):
        store.create(pd.Series([1.0], index=["a"]))


def test_aggregate(store):
    sid = store.create(hours("2024-01-01", 48))["TimeSeriesId"]
    store.append(hours("2024-01-02", 24, first=100.0), sid)

    def run(**kw):
        df = store.get_samples_aggregate(
            sid, "2024-01-01", "2024-01-04", aggregation_period="24h", **kw
        )
        return points(df.orderBy("index"))

    first = 19723 * DAY
    assert run(aggregation_function="mean") == [(first, 11.5), (first + DAY, 111.5)]
    dense = run(aggregation_function="Max", include_empty_aggregations=True)
    assert dense == [(first, 23.0), (first + DAY, 123.0), (first + 2 * DAY, None)]
    for missing in ("aggregation_function", "aggregation_period"):
        arguments = {"aggregation_function": "mean", "aggregation_period": "1h", missing: None}
        with pytest.raises(ValueError):
            store.get_samples_aggregate(sid, "2024-01-01", "2024-01-02", **arguments)
    with pytest.raises(ValueError):
        run(aggregation_function="median")


def test_several_series_and_deletion(store):
    a = store.create(pd.Series([1.0], index=[1]))["TimeSeriesId"]
    b = store.create(pd.Series([2.0], index=[1]))["TimeSeriesId"]
    assert store.get([a, b]).count() == 2
    assert store.get(None).count() == 2
    entry = store.metadata_set("plant.hall", "pump7", maker="Nordic Flow")
    store.set_metadata(a, entry)
    store.delete(a)
    store.delete("unknown")
    assert [r.series_id for r in store.get(None).collect()] == [b]
    for call in (store.get, store.info, lambda sid: store.set_metadata(sid, entry)):
        with pytest.raises(ValueError):
            call(a)
    with pytest.raises(ValueError):
        store.set_metadata(b, "no such entry")
    with pytest.raises(ValueError):
        store.append(pd.Series([1.0], index=[9]), a)
    assert store.search("plant.hall").count() == 0
    assert store.metadata_get(entry).first().series_id is None


def test_metadata(store):
    sid = store.create(pd.Series([1.0, 2.0], index=[5, 9]))["TimeSeriesId"]
    entry = store.metadata_set("plant.hall", "pump7", maker="Nordic Flow", size="DN50")
    assert store.metadata_set("plant.hall", "pump7", maker="Nordic Flow", size="DN80") == entry
    got = store.metadata_get(namespace="plant.hall", key="pump7").first()
    assert got.value == {"maker": "Nordic Flow", "size": "DN80"}
    assert got.created_by == "tester"

    info = store.set_metadata(sid, entry).first()
    assert (info.first_index, info.last_index, info.key) == (5, 9, "pump7")
    with pytest.raises(ValueError):
        store.set_metadata(sid, namespace="plant.hall", key="pump7", maker="x")
    store.set_metadata(sid, namespace="plant.hall", key="fan1", n=1)
    store.set_metadata(sid, namespace="plant.hall", key="pump7", overwrite=True, a=1, b="else")

    assert [r.namespace for r in store.metadata_browse().collect()] == ["plant.hall"]
    assert [r.key for r in store.metadata_browse("plant.hall").collect()] == ["fan1", "pump7"]
    assert store.metadata_search("plant.hall", "pu").count() == 1
    assert store.search("plant.hall").count() == 2
    assert store.search("plant.hall", "pump7", "a").count() == 1
    assert [r.series_id for r in store.search("plant.hall", "pump7", "a", 1).collect()] == [sid]
    assert store.search("plant.hall", "pump7", "a", 2).count() == 0
    by_id = store.metadata_get(entry).first()
    assert (by_id.series_id, by_id.first_index, by_id.last_index) == (sid, 5, 9)

    store.remove_metadata(sid, entry)
    assert store.search("plant.hall", "pump7").count() == 0
    assert store.metadata_get(entry).count() == 1
    store.metadata_delete(entry)
    assert store.metadata_get(entry).count() == 0
    with pytest.raises(ValueError):
        store.metadata_get(namespace="plant.hall")


def test_queued_uploads(store):
    sid = store.create(pd.Series([1.0, 2.0], index=[1, 2]))["TimeSeriesId"]
    queued = store.append(
        pd.Series([20.0, 30.0], index=[2, 3]), sid, wait_on_verification=False
    )
    assert queued["State"] == "Queued"
    assert store.get(sid).count() == 2
    receipts = store.process_queue()
    assert [r.state for r in receipts.collect()] == ["Ready"]
    assert points(store.get(sid)) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    store.process_queue()
    assert store.get(sid).count() == 3
    assert store.info(sid).first().last_index == 3


def test_queued_text_and_order(store):
    sid = store.create(pd.Series(["1", "2"], index=[1, 2]), wait_on_verification=False)["TimeSeriesId"]
    store.append(pd.Series(["3"], index=[2]), sid)
    assert points(store.get(sid), "value_text") == [(2, "3")]
    store.process_queue()
    # the queued upload came first, so the direct one wins
    assert points(store.get(sid), "value_text") == [(1, "1"), (2, "3")]
    assert store.process_queue().count() == 1


def test_an_upload_that_breaks_off_is_never_read(store, monkeypatch):
    sid = store.create(pd.Series([1.0, 2.0], index=[1, 2]))["TimeSeriesId"]

    def fail(upload):
        raise RuntimeError("lost the cluster")

    with monkeypatch.context() as patch:
        patch.setattr("tidemark.operators.ingest.manifest_of", fail)
        with pytest.raises(RuntimeError):
            store.append(pd.Series(["x", "y"], index=[2, 3]), sid)
    assert points(store.get(sid)) == [(1, 1.0), (2, 2.0)]
    assert store.samples.count() == 2
    store.append(pd.Series([20.0, 3.0], index=[2, 3]), sid)
    assert points(store.get(sid)) == [(1, 1.0), (2, 20.0), (3, 3.0)]
    assert store.info(sid).first().last_index == 3


def test_many_series_at_once(store, spark):
    frame = spark.range(3_000).selectExpr(
        "concat('tag', id % 30) AS name", "id AS pos", "id * 10 AS index", "id * 1.0D AS value"
    )
    ids = {r.name: r.series_id for r in store.create_many(frame).collect()}
    assert len(set(ids.values())) == 30
    assert store.get(ids["tag7"]).count() == 100
    assert store.info(ids["tag7"]).first().aliases == ["tag7"]
    more = spark.createDataFrame([(ids["tag7"], 0, 70, -1.0), (ids["tag8"], 0, 80, -2.0)], "series_id string, pos bigint, index bigint, value double")
    store.append_many(more)
    assert points(store.get(ids["tag7"]))[0] == (70, -1.0)
    assert points(store.get(ids["tag8"]))[0] == (80, -2.0)
    with pytest.raises(ValueError):
        store.append_many(more.replace(ids["tag8"], "unknown"))
    with pytest.raises(ValueError):
        store.append_many(more.unionByName(more))


def test_aliases(store):
    sid = store.create(aliases=["north", "tank 1"])["TimeSeriesId"]
    assert store.info(sid).first().aliases == ["north", "tank 1"]
    store.set_aliases(sid, "south")
    assert store.info(sid).first().aliases == ["south"]
    with pytest.raises(ValueError):
        store.set_aliases("unknown", "x")


def test_entries_whose_names_differ_only_in_the_cut(store):
    one = store.metadata_set("a/b", "c", n=1)
    two = store.metadata_set("a", "b/c", n=2)
    assert one != two
    assert store.metadata_get(one).first().namespace == "a/b"
    assert store.metadata_get(two).first().namespace == "a"


def test_compaction_leaves_out_what_no_longer_counts(store, spark, tmp_path):
    a = store.create(pd.Series([1.0, 2.0], index=[1, 2]))["TimeSeriesId"]
    b = store.create(pd.Series([9.0], index=[1]))["TimeSeriesId"]
    store.append(pd.Series([20.0], index=[2]), a)
    entry = store.metadata_set("ns", "k", v=1)
    store.set_metadata(a, entry)
    store.metadata_set("ns", "k", v=2)
    store.delete(b)
    new = store.compact(str(tmp_path / "compacted"))
    assert points(new.get(a)) == [(1, 1.0), (2, 20.0)]
    assert new.get(None).count() == 2 and new.samples.count() == 3
    assert spark.read.parquet(f"{new.root}/samples").count() == 3
    assert new.search("ns", "k", "v", 2).count() == 1
    new.append(pd.Series([30.0], index=[3]), a)
    assert new.get(a).count() == 3 and store.get(a).count() == 2


def test_compaction_that_merges(store, spark, tmp_path):
    day = 86_400_000_000_000
    a = store.create(pd.Series([1.0, 2.0, 5.0], index=[1, 2, day + 1]))["TimeSeriesId"]
    store.append(pd.Series([20.0, 30.0], index=[2, 3]), a)
    new = store.compact(str(tmp_path / "merged"), merge=True)
    assert points(new.get(a)) == points(store.get(a)) == [(1, 1.0), (2, 20.0), (3, 30.0), (day + 1, 5.0)]
    assert new.samples.count() == 4 and store.samples.count() == 5
    assert new.manifest.groupBy("series_id", "day").count().filter("count > 1").isEmpty()
    new.append(pd.Series([21.0], index=[2]), a)
    assert points(new.get(a))[1] == (2, 21.0)
    assert new.info(a).first().last_index == day + 1


def test_one_schema_whatever_is_stored(store):
    n = store.create(pd.Series([1.0], index=[1]))["TimeSeriesId"]
    t = store.create(pd.Series(["x"], index=[1]))["TimeSeriesId"]
    columns = ["series_id", "index", "value", "value_text", "time"]
    assert store.get(n).columns == store.get(t).columns == store.get([n, t]).columns == columns


def test_a_session_in_another_zone_is_refused(store, spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        with pytest.raises(ValueError):
            SeriesStore(spark, store.root)
        assert spark.conf.get("spark.sql.session.timeZone") == "Europe/Oslo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_second_store_sees_the_same(store, spark):
    sid = store.create(pd.Series([1.0], index=[1]))["TimeSeriesId"]
    again = SeriesStore(spark, store.root)
    assert again.get(sid).count() == 1
