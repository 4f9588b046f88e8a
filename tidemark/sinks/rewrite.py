"""Taking rows out of a stored table by rewriting only the files that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import day_of
from tidemark.operators.ingest import manifest_of
from tidemark.operators.joins import fits_broadcast, lookup_join
from tidemark.operators.overlay import contested_days, overlay
from tidemark.schema import SAMPLES_RAW
from tidemark.session import delete_file, settle
from tidemark.sinks.samples import write_samples

# A list of keys up to this long is a filter on the scan.
MAX_PUSHED_KEYS = 1_000


def _touched(stored: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Names of the files with a row whose keys are in ``gone``.

    Few keys reach the scan as a filter, so that row groups without them are
    skipped by their statistics; only the key columns are read.
    """
    placed = stored.select(*keys, F.col("_metadata.file_path").alias("file"))
    if fits_broadcast(gone):
        for key in keys:
            listed = [row[0] for row in gone.select(key).distinct().limit(MAX_PUSHED_KEYS + 1).collect()]
            if len(listed) <= MAX_PUSHED_KEYS:
                placed = placed.filter(F.col(key).isin(listed))
    return lookup_join(placed, gone, keys, "left_semi").select("file").distinct()


def replace_rows(
    spark: SparkSession, path: str, gone: DataFrame, keys: list[str], new: DataFrame | None = None
) -> DataFrame:
    """Remove the stored samples whose ``keys`` are in ``gone``, and add ``new`` ones.

    Files without such a row are left as they are. Of the others the rows that stay
    are written to new files of the same days, then the old files go. The new
    files come first: a reader in between sees rows twice, which the overlay
    resolves, but never too few. Returns the names of the files that went.
    """
    stored = spark.read.schema(SAMPLES_RAW).parquet(path)
    gone = settle(gone.select(*keys).distinct(), "gone")
    old = settle(_touched(stored, gone, keys), "files")
    held = stored.select("*", F.col("_metadata.file_path").alias("file"))
    kept = lookup_join(lookup_join(held, old, ["file"], "left_semi"), gone, keys, "left_anti").drop("file")
    write_samples(kept if new is None else kept.unionByName(new), path)
    for row in old.toLocalIterator():
        delete_file(spark, row.file)
    return old


def delete_series_files(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Physically remove all samples of some series; returns the names of the files that went."""
    return replace_rows(spark, path, ids, ["series_id"])


def merge_contested(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Fold the uploads of every contested day of a series into one; returns the new listing.

    The overlay of such a day is paid once: afterwards one upload holds it, under
    the highest number it had, so reads find it uncontested and shuffle nothing
    for it. Other days are neither read nor written, unless they share a file.
    """
    listing = settle(manifest, "listing")
    days = settle(contested_days(listing), "contested")
    here = lookup_join(listing, days, ["series_id", "day"], "left_semi")
    newest = here.groupBy("series_id", "day").agg(F.max("file_seq").alias("file_seq"))
    held = spark.read.schema(SAMPLES_RAW).parquet(path)
    wanted = days.select("day").distinct()
    raw = lookup_join(lookup_join(held, wanted, ["day"], "left_semi"), listing.select("file_id").distinct(), ["file_id"], "left_semi")
    raw = lookup_join(raw, days, ["series_id", "day"], "left_semi")
    days_of = raw.select("series_id", "index", "day", "file_seq", "value", "value_text")
    whole = overlay(days_of).withColumn("day", day_of("index"))
    merged = lookup_join(whole, newest, ["series_id", "day"]).withColumn(
        "file_id", F.concat_ws("-", F.lit("merged"), "series_id", "day", "file_seq")
    )
    merged = settle(merged.select(*SAMPLES_RAW.fieldNames()), "merged")
    replace_rows(spark, path, days, ["series_id", "day"], merged)
    rest = lookup_join(listing, days, ["series_id", "day"], "left_anti")
    return rest.unionByName(manifest_of(merged))
