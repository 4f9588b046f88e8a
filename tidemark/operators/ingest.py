"""Uploads: receipts, appending, listings, what is still to be fetched."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import day_of, long_lit
from tidemark.functions.tokens import chunk_key, urlsafe_base64
from tidemark.operators.joins import lookup_join
from tidemark.operators.validate import FAILED, READY

# What a stored chunk is known by, and the folders its keys are hashed to.
STORED_KEY = ["chunk_key", "md5_key"]
KEY_BUCKETS = 64


def next_file_seq(uploads: DataFrame) -> int:
    """Number of the next upload. One counter serves all series, so a batch of
    uploads needs no lookup of each series' own last number."""
    newest = uploads.agg(F.max("file_seq").alias("newest")).first().newest
    return 0 if newest is None else newest + 1


def as_upload(df: DataFrame, file_seq: int, file_id: str | None = None) -> DataFrame:
    """Validated samples as rows of the stored table."""
    fid = F.col("file_id") if file_id is None else F.lit(file_id)
    return df.select(
        "series_id",
        long_lit(file_seq).alias("file_seq"),
        fid.alias("file_id"),
        "index",
        "value",
        "value_text",
        day_of("index").alias("day"),
    )


def append(samples: DataFrame, upload: DataFrame) -> DataFrame:
    """Stored samples with one more upload; where they overlap the upload wins
    when the result is read."""
    return samples.unionByName(upload)


def manifest_of(upload: DataFrame) -> DataFrame:
    """One row per series, file and day: what the upload holds."""
    return upload.groupBy("series_id", "file_seq", "file_id", "day").agg(
        F.when(F.max(F.col("value_text").isNotNull()), "text").otherwise("numeric").alias("kind"),
        F.min("index").alias("first_index"),
        F.max("index").alias("last_index"),
        F.count("index").alias("n_samples"),
    )


def _failed_receipts(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("state") == FAILED).select(
        "series_id",
        "file_id",
        F.lit(None).cast("bigint").alias("first_index"),
        F.lit(None).cast("bigint").alias("last_index"),
        "state",
    )


def receipts(ready: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per file: id, series, first and last index, state.

    ``ready`` holds the rows of the accepted files; a failed file has a state
    and no extent.
    """
    extents = ready.groupBy("series_id", "file_id").agg(
        F.min("index").alias("first_index"), F.max("index").alias("last_index")
    )
    return extents.withColumn("state", F.lit(READY)).unionByName(_failed_receipts(verdicts))


def receipts_of(manifest: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The same from the listing of what was stored."""
    extents = manifest.groupBy("series_id", "file_id").agg(
        F.min("first_index").alias("first_index"), F.max("last_index").alias("last_index")
    )
    return extents.withColumn("state", F.lit(READY)).unionByName(_failed_receipts(verdicts))


def create_empty(series: DataFrame, series_ids: list[str] | DataFrame) -> DataFrame:
    """The table of series with new ones that have no samples yet.

    ``series_ids`` is a list, or a frame with a ``series_id`` column.
    """
    if not isinstance(series_ids, DataFrame):
        listed = [(sid,) for sid in series_ids]
        series_ids = series.sparkSession.createDataFrame(listed, "series_id string")
    new = series_ids.select(
        "series_id",
        F.array().cast("array<string>").alias("aliases"),
        F.lit(datetime.now(timezone.utc)).alias("created"),
    )
    return series.unionByName(new)


def delete_series(table: DataFrame, ids: DataFrame) -> DataFrame:
    """``table`` (samples, series, links, listing) without the series in ``ids``.

    An unknown id changes nothing.
    """
    return lookup_join(table, ids.select("series_id").distinct(), ["series_id"], "left_anti")


def chunks_by_day(manifest: DataFrame) -> DataFrame:
    """Chunks of every series day by day, each day in overlay order.

    The grouping is an order, not an array: a day may hold any number of chunks.
    """
    return manifest.orderBy("series_id", "day", "file_seq", "chunk_seq")


def concat_days(days: list[DataFrame]) -> DataFrame:
    """Day frames one after the other, in index order; nothing is dropped."""
    return reduce(DataFrame.unionByName, days).orderBy("series_id", "index")


def with_chunk_key(manifest: DataFrame) -> DataFrame:
    """Name and content mark a stored chunk goes by."""
    return manifest.withColumns(
        {
            "chunk_key": chunk_key(F.col("path")),
            "md5_key": urlsafe_base64(F.col("content_md5")),
        }
    )


def _bucketed(spark: SparkSession, path: str, buckets: int) -> str:
    """The table of stored keys at ``path``, made known to this session; returns its name."""
    name = "stored_keys_" + hashlib.md5(f"{path}#{buckets}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{c} STRING" for c in STORED_KEY)
        keys = ", ".join(STORED_KEY)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return name


def remember_ingested(spark: SparkSession, path: str, chunks: DataFrame, buckets: int = KEY_BUCKETS) -> None:
    """Add the keys of stored chunks to the set at ``path``, laid out by their hash.

    ``buckets`` belongs to the set: it must be the same in every call.
    """
    name = _bucketed(spark, path, buckets)
    rows = chunks.select(*STORED_KEY).repartition(buckets, *STORED_KEY)
    rows.write.mode("append").insertInto(name)


def not_ingested(spark: SparkSession, path: str, manifest: DataFrame, buckets: int = KEY_BUCKETS) -> DataFrame:
    """As :func:`incremental_ingest`, against a long history remembered at ``path``.

    Only the new listing is shuffled, to the layout of the stored keys; these are
    read where they lie, a bucket by each task.
    """
    stored = spark.table(_bucketed(spark, path, buckets))
    return with_chunk_key(manifest).join(stored.hint("merge"), STORED_KEY, "left_anti")


def incremental_ingest(manifest: DataFrame, ingested: DataFrame) -> DataFrame:
    """Chunks not stored yet; a chunk whose content changed counts as new.

    Where both listings know series and day, these are part of the join, so
    that stored chunks can be pruned and joined as they are laid out.
    """
    keyed = with_chunk_key(manifest)
    shared = [c for c in ("series_id", "day") if c in keyed.columns and c in ingested.columns]
    keys = [*shared, "chunk_key", "md5_key"]
    return keyed.join(ingested.select(*keys), keys, "left_anti")
