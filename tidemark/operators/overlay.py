"""Overlapping uploads: for every index the newest non-null value wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast
from tidemark.session import settle

KEY = ["series_id", "index"]


def _newest(value: str, rank: Column) -> Column:
    # Rows with a NULL rank are skipped, so a missing value in the newest
    # upload leaves the older one in place. If all are missing: NULL.
    return F.max_by(value, rank).alias(value)


def _split(samples: DataFrame, contested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples on contested days, and all others; neither is shuffled for it.

    Too many pairs to broadcast are reduced to their days. A 64-bit index
    reaches some 213 000 days, so those always fit, and as the partition
    column they keep each side to its own folders.
    """
    lookup, keys = settle(contested.select("series_id", "day")), ["series_id", "day"]
    if not fits_broadcast(lookup):
        lookup, keys = lookup.select("day").distinct(), ["day"]
    lookup = F.broadcast(lookup)
    return samples.join(lookup, keys, "left_semi"), samples.join(lookup, keys, "left_anti")


def overlay(
    samples: DataFrame,
    *,
    kind: str = "both",
    contested: DataFrame | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """One row per ``(series_id, index)``.

    ``kind`` names the value columns wanted: ``numeric`` keeps the aggregation
    buffers of fixed width (hash aggregation), ``text`` and ``both`` carry
    strings and are sorted, once and after the shuffle. With ``both`` an index
    that changed kind keeps only the newest.

    An upload has every index once (:func:`~tidemark.operators.validate.check_unique`);
    which row of an upload that broke this rule counts is not defined.

    ``contested`` (see :func:`contested_days`) limits the work to the days of a
    series that more than one upload touched; all others pass through without
    a shuffle, as the indices within one upload are unique.

    ``partitioned`` says that rows are partitioned by the key already.
    """
    columns = {"numeric": ["value"], "text": ["value_text"], "both": ["value", "value_text"]}[kind]
    if contested is not None:
        slim = samples.select(*KEY, "day", "file_seq", *columns)
        shared, alone = _split(slim, contested)
        return alone.select(*KEY, *columns).unionByName(overlay(shared, kind=kind))
    present = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        present = present | F.col(name).isNotNull()
    rank = F.when(present, F.col("file_seq"))
    if kind != "numeric" and not partitioned:
        samples = samples.repartition(*KEY)
    return samples.groupBy(*KEY).agg(*[_newest(name, rank) for name in columns])


def contested_days(manifest: DataFrame) -> DataFrame:
    """``(series_id, day)`` pairs that more than one upload touched.

    From the upload listing, or from the samples themselves where there is none.
    """
    span = manifest.groupBy("series_id", "day").agg(
        F.min("file_seq").alias("oldest"), F.max("file_seq").alias("newest")
    )
    return span.filter("oldest < newest").select("series_id", "day")


def combine_first(newer: DataFrame, older: DataFrame) -> DataFrame:
    """Two frames overlaid: all indices of both, values of ``newer`` first.

    An index keeps what one frame says about it, number and text alike: that of
    ``newer`` if it says anything. ``value`` and ``value_text`` are returned as
    far as either frame has them.
    """
    values = [c for c in ("value", "value_text") if c in (*newer.columns, *older.columns)]
    kinds = {"value": "double", "value_text": "string"}

    def full(df: DataFrame) -> DataFrame:
        missing = {c: F.lit(None).cast(kinds[c]) for c in values if c not in df.columns}
        return df.withColumns(missing).select(*KEY, *values)

    n, o = full(newer).alias("n"), full(older).alias("o")
    said = F.coalesce(*[F.col(f"n.{c}").cast("string") for c in values]).isNotNull()
    merged = [F.when(said, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values]
    return n.join(o, KEY, "full_outer").select(*KEY, *merged)
