"""Session settings the library expects, and its use of the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution, skew handling included."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """``spark``, if its time zone is UTC: an index is always counted in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00"):
        raise ValueError(f"the session's time zone is {zone}: set spark.sql.session.timeZone to UTC")
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The folder every executor can reach, as the session names it."""
    return spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, empty folder under the shared one.

    Where the session names none, a local master gets one of this machine for as
    long as the application runs; a cluster must name one.
    """
    base = shared_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.TemporaryDirectory(prefix="tidemark-")
        base = _own[app].name
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder in whatever file system its address names, unless it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, in whatever file system; nothing if it is gone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def delete_file(spark: SparkSession, address: str) -> None:
    """Remove one file, given by its escaped address as ``_metadata.file_path`` has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(address))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


_own: dict[str, tempfile.TemporaryDirectory] = {}


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """``df`` computed once: written to the scratch folder and read back.

    For intermediate results that are read more than once. What is written
    survives lost executors, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files a settled frame is read from."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
