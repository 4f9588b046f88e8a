"""Upload listings: files in upload order, each with one chunk per day."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import day_of
from tidemark.operators.joins import fits_broadcast, lookup_join
from tidemark.schema import MANIFEST_JSON, SAMPLES_RAW
from tidemark.session import settle
from tidemark.sources.chunks import infer_value_type, parse_index, split_lines, with_origin


def flatten_manifest(listing: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``Files -> Chunks`` to one row per chunk.

    ``file_seq`` is the position of the file in the listing; the listing's own
    ``Index`` field plays no part.
    """
    keep = keep or []
    files = listing.select(*keep, F.posexplode("Files").alias("file_seq", "file"))
    chunks = files.select(
        *keep,
        F.col("file_seq").cast("bigint").alias("file_seq"),
        F.col("file.FileId").alias("file_id"),
        F.posexplode("file.Chunks").alias("chunk_seq", "chunk"),
    )
    return chunks.select(
        *keep,
        "file_seq",
        "file_id",
        "chunk_seq",
        F.col("chunk.DaysSinceEpoch").alias("day"),
        F.col("chunk.Path").alias("path"),
        F.col("chunk.Endpoint").alias("endpoint"),
        F.col("chunk.ContentMd5").alias("content_md5"),
    )


def read_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Listing files, one JSON document each, as chunk rows."""
    listing = spark.read.schema(MANIFEST_JSON).json(paths, multiLine=True)
    return flatten_manifest(
        listing.withColumn("listing", F.col("_metadata.file_path")), keep=["listing"]
    )


def _absolute(spark: SparkSession, base: str) -> str:
    """``base`` as a full address without a slash at the end."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(base)
    return str(path.getFileSystem(conf).makeQualified(path).toString()).rstrip("/")


def _address(path: str | Column) -> Column:
    """A file's full address in one spelling: no escapes, one slash after ``file:``."""
    plain = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def _folders(path: str) -> list[str]:
    """Names of the ``name=value`` folders in a path."""
    return [part.split("=", 1)[0] for part in path.strip("/").split("/")[:-1] if "=" in part]


def read_listed(spark: SparkSession, manifest: DataFrame, base: str) -> DataFrame:
    """The chunk files of a listing as samples, ready for overlay.

    ``manifest`` has one row per chunk with ``series_id``, ``file_seq``,
    ``file_id`` and ``path``, relative to ``base``. No list of names is made
    here: the listing is joined to the lines by the file they come from, each
    file is read once however many uploads list it, and folders ``name=value`` that the listing does
    not name are skipped. Files that are not listed do not count. A listed
    file that is not there is an error.
    """
    root = _absolute(spark, base)
    plain = F.concat(F.lit(f"{root}/"), F.regexp_replace("path", "^/+", ""))
    listed = settle(
        manifest.filter(F.length("path") > 0)
        .select("path", "series_id", "file_seq", "file_id")
        .withColumn("_address", F.regexp_replace(plain, "^file:/+", "file:/"))
    )
    one = listed.select("path").first()
    if one is None:
        return spark.createDataFrame([], SAMPLES_RAW)
    _require_files(spark, listed, root)
    folders = _folders(one.path)
    reader = spark.read.schema(", ".join(["value string", *[f"`{f}` string" for f in folders]]))
    raw = (reader if folders else reader.option("recursiveFileLookup", "true")).text(root)
    # named apart from the listing's own columns
    held_in = [f"_in_{n}" for n in range(len(folders))]
    lines = with_origin(raw, [F.col(f"`{f}`").alias(n) for f, n in zip(folders, held_in, strict=True)])
    if folders:
        named = [
            F.url_decode(F.regexp_replace(F.regexp_extract("path", f"(?:^|/){re.escape(f)}=([^/]*)/", 1), r"\+", "%2B")).alias(n)
            for f, n in zip(folders, held_in, strict=True)
        ]
        held = settle(listed.select(*named).distinct())
        if fits_broadcast(held):
            # a filter on the lookup makes it a pruning of folders
            lines = lines.join(F.broadcast(held.filter(F.length(held_in[0]) > 0)), held_in, "left_semi")
    lines = lines.drop(*held_in)
    uploads = listed.drop("path")
    known = uploads.select("_address").distinct().withColumn("_listed", F.lit(True))
    tokens = split_lines(lookup_join(lines.withColumn("_address", _address("chunk")), known, ["_address"]))
    # What only the join can tell keeps the strict reading of an index behind it.
    of_listed = F.when(F.col("_listed"), F.col("index_token")).otherwise("0")
    tokens = tokens.withColumn("index_token", of_listed).drop("_listed")
    typed = infer_value_type(parse_index(tokens), ["chunk"])
    placed = lookup_join(typed, uploads, ["_address"])
    return placed.withColumn("day", day_of("index")).select(*SAMPLES_RAW.fieldNames())


def _require_files(spark: SparkSession, listed: DataFrame, root: str) -> None:
    """Stops if a listed file is not in the folder; only names are looked at."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    there = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("_address"))
    wanted = listed.select("_address").distinct()
    missing = wanted.join(there, "_address", "left_anti").agg(F.count("*").alias("n"), F.min("_address").alias("one")).first()
    if missing.n:
        raise ValueError(f"{missing.n} listed files are not there, for one {missing.one}")
