"""What the plans must and must not hold."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import aggregate as agg
from tidemark.operators import read
from tidemark.operators.overlay import contested_days, overlay
from tidemark.operators.ingest import manifest_of
from tidemark.plans import inputs
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES
from tidemark.sinks.samples import write_samples
from tidemark.sources.samples import read_samples


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "samples")
    write_samples(inputs.uploads(spark, sf_dir), path)
    return read_samples(spark, path)


def test_range_read_prunes_days_and_columns(stored):
    plan = plan_of(read.get(stored, "u3", "2024-01-08", "2024-01-09", kind="numeric"))
    partition_filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "day" in partition_filters and "19730" in partition_filters
    pushed = next(x for x in plan.splitlines() if "PushedFilters" in x)
    assert "GreaterThanOrEqual(index,1704672000000000000)" in pushed
    assert "EqualTo(series_id,u3)" in pushed
    schema = next(x for x in plan.splitlines() if "ReadSchema" in x)
    assert "value_text" not in schema and "file_id" not in schema


def test_numeric_read_hashes_and_shuffles_once(stored):
    plan = plan_of(read.get(stored, None, "2024-01-08", "2024-01-09", kind="numeric"))
    tree = plan.split("\n\n")[0]
    assert "SortAggregate" not in tree
    assert tree.count("Exchange") == 1


def test_text_overlay_sorts_once(stored):
    for df in (overlay(stored), read.get(stored)):
        tree = plan_of(df).split("\n\n")[0]
        assert "SortAggregate" in tree
        assert tree.count("Exchange") == 1
        assert len([x for x in tree.splitlines() if "- Sort (" in x]) == 1


def test_aggregate_shuffles_partial_results(stored, spark, sf_dir):
    resolved = inputs.samples(spark, sf_dir)
    plan = plan_of(agg.aggregate(resolved, "2024-01-01", "2024-01-31", "1h", "mean"))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "partial_avg" in plan
    tree = plan_of(agg.aggregate(stored, "2024-01-01", "2024-01-31", "1h", "mean", check_text=False))
    assert tree.split("\n\n")[0].count("Exchange") == 2


def test_uncontested_days_are_not_shuffled(stored):
    contested = contested_days(manifest_of(stored)).filter("day < 0")
    plan = plan_of(overlay(stored, kind="numeric", contested=contested))
    tree = plan.split("\n\n")[0]
    assert "Union" in tree
    first_branch = tree.split("Union")[1].split("HashAggregate")[0]
    shuffles = [x for x in first_branch.splitlines() if "Exchange" in x and "Broadcast" not in x]
    assert not shuffles


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "stream_queue"])
def test_no_query_runs_python_or_all_pairs(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_driver_contract(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize(
    "name, most",
    [("get_found_series", 2), ("series_info", 0), ("metadata_by_id", 0), ("delete_series", 2), ("agg_dense", 1), ("agg_gaps", 1)],
)
def test_lookups_are_computed_once_while_a_query_is_built(spark, sf_dir, name, most, monkeypatch):
    """With nothing else to compute, and each by one write."""
    made = []

    def counted(df, *label):
        made.append(df)
        return session.settle(df, *label)

    monkeypatch.setattr("tidemark.operators.joins.settle", counted)
    monkeypatch.setattr("tidemark.operators.overlay.settle", counted)
    QUERIES[name](spark, sf_dir)
    assert len(made) <= most


def test_a_lookup_is_settled_without_a_named_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: None)
    kept = session.settle(spark.range(10).withColumn("u", F.uuid()))
    assert kept.collect() == kept.collect()
