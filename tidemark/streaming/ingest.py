"""Queued uploads as a stream of chunk files.

An upload is a text file ``<queue>/series_id=<id>/<file_id>`` that appears in
the queue whole; its full name is its id, and a name that was accepted before is
the same upload delivered again. Every file is judged by itself; a failed file is
put aside and none of its rows count. No state is kept across batches: a late
file is simply a newer upload, and overlap is resolved when data is read.

A batch has to know which of its files came before and the highest number given
so far, without reading what all earlier batches left. Names of accepted files
are kept in runs: every ``FAN`` batches their names are merged into one run, every
``FAN`` of those into a larger one, cut into folders by the first digits of a
hash of the name. So batch n looks into fewer than ``FAN`` runs per level, and in
each only into the folders of its own names. The number is one row per batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timeaxis import day_of
from tidemark.functions.tokens import is_numeric
from tidemark.operators.ingest import manifest_of, receipts_of
from tidemark.operators.validate import FAILED, READY, file_verdicts
from tidemark.schema import MANIFEST, RECEIPTS, SAMPLES_RAW
from tidemark.sinks.samples import by_day
from tidemark.session import drop_folder, folder_exists, make_folder
from tidemark.sources.chunks import ARRIVAL, parse_index, split_lines, type_values

FILE = ["series_id", "file_id"]

#: Runs of names that are merged into one.
FAN = 16
#: Digits of the hash that a run is cut by at most: 4 096 folders.
MOST_DIGITS = 3

_NAMES = "series_id string, file_id string"
_FILES = f"{_NAMES}, state string, is_text boolean, file_seq bigint"

_QUEUE = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("series_id", T.StringType())]
)


def stream_chunks(spark: SparkSession, queue: str, max_files: int = 1_000) -> DataFrame:
    """Lines of new chunk files, with the file and the split they come from."""
    return queued_lines(spark.readStream.schema(_QUEUE).option("maxFilesPerTrigger", max_files).text(queue))


def read_queue(spark: SparkSession, queue: str) -> DataFrame:
    """The lines of all files in the queue, as :func:`stream_chunks` gives them."""
    return queued_lines(spark.read.schema(_QUEUE).text(queue))


def queued_lines(raw: DataFrame) -> DataFrame:
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    lines = raw.select(
        "series_id",
        F.url_decode(F.regexp_replace(name, r"\+", "%2B")).alias("file_id"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"),
    )
    return split_lines(lines)


def number_files(files: list[tuple], above: int) -> dict[tuple, int]:
    """``file_seq`` by file from the time it arrived, and above all earlier ones.

    ``files`` has ``(series_id, file_id, microseconds)``; files of one batch are
    ordered by time and name.
    """
    out = {}
    for rank, (series_id, file_id, arrived) in enumerate(sorted(files, key=lambda f: (f[2], f[0], f[1])), 1):
        out[series_id, file_id] = max(arrived // 1000 * 1_000_000, above) + rank
    return out


def _read(spark: SparkSession, out: str, name: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(with_batch).parquet(f"{out}/{name}")


def _digits(level: int) -> int:
    return min(level, MOST_DIGITS)


def _name_hash(series_id: str, file_id: str) -> str:
    return hashlib.md5(f"{series_id}/{file_id}".encode()).hexdigest()


def runs_before(batch_id: int) -> list[tuple[int, int]]:
    """``(level, first batch)`` of the runs that hold the names of all batches before this one.

    A run of level k spans ``FAN ** k`` batches; there are fewer than ``FAN`` of each level.
    """
    out, start, level = [], 0, 0
    while FAN ** (level + 1) <= batch_id:
        level += 1
    for k in range(level, -1, -1):
        while start + FAN**k <= batch_id:
            out.append((k, start))
            start += FAN**k
    return out


def _run(spark: SparkSession, out: str, level: int, start: int, hashes: list[str] | None = None) -> DataFrame | None:
    """Names in one run, of the folders that ``hashes`` may be in; None if there is no such run."""
    if level == 0:
        path = f"{out}/receipts/batch={start}"
        if not folder_exists(spark, path):
            return None
        return spark.read.schema(RECEIPTS).parquet(path).filter(F.col("state") == READY).select(*FILE)
    path = f"{out}/known/level={level}/start={start}"
    if not folder_exists(spark, path):
        return None
    names = spark.read.schema(f"{_NAMES}, part string").parquet(path)
    if hashes is not None:
        names = names.filter(F.col("part").isin(sorted({h[: _digits(level)] for h in hashes})))
    return names.select(*FILE)


def known_files(
    spark: SparkSession, out: str, batch_id: int, names: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Files that earlier batches have accepted; with ``names`` only where those may be."""
    hashes = None if names is None else [_name_hash(*n) for n in names]
    found = spark.createDataFrame([], _NAMES)
    for level, start in runs_before(batch_id):
        run = _run(spark, out, level, start, hashes)
        if run is not None:
            found = found.unionByName(run)
    return found


def merge_runs(spark: SparkSession, out: str, batch_id: int) -> None:
    """Merge the runs that are complete with this batch. Run again, it leaves the same."""
    level = 1
    while (batch_id + 1) % FAN**level == 0:
        start, step = batch_id + 1 - FAN**level, FAN ** (level - 1)
        parts = [_run(spark, out, level - 1, start + i * step) for i in range(FAN)]
        names = spark.createDataFrame([], _NAMES)
        for part in parts:
            if part is not None:
                names = names.unionByName(part)
        mark = F.md5(F.concat("series_id", F.lit("/"), "file_id"))
        cut = names.withColumn("part", F.substring(mark, 1, _digits(level)))
        cut.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{out}/known/level={level}/start={start}")
        level += 1


def last_file_seq(spark: SparkSession, out: str, batch_id: int) -> int:
    """Highest ``file_seq`` of the batches before this one: what the last of them noted.

    Only where that note is missing, as after batches of other numbers, all are read.
    """
    before = f"{out}/marks/batch={batch_id - 1}"
    if folder_exists(spark, before):
        return spark.read.schema("file_seq bigint").parquet(before).first().file_seq
    marks = spark.read.schema("file_seq bigint, batch bigint").parquet(f"{out}/marks")
    newest = marks.filter(F.col("batch") < batch_id).agg(F.max("file_seq").alias("newest")).first().newest
    return -1 if newest is None else newest


def judge_files(lines: DataFrame) -> DataFrame:
    """One row per file: verdict, kind of its values, time of arrival."""
    text = F.coalesce(~is_numeric(F.col("value_token")), F.lit(False))
    return file_verdicts(
        lines.withColumn("is_text", text), FILE, ARRIVAL, carry={"modified": F.max, "is_text": F.bool_or}
    )


def ingest_batch(rows: DataFrame, batch_id: int, out: str, above: int = -1) -> None:
    """Judge the files of one batch; store the good ones, put the others aside.

    What is known about a file is one row, and a batch has at most
    ``max_files`` of them: these rows go through the driver and back as a
    broadcast, whatever the files hold. Every batch owns its
    folders and replaces them, so a batch that is run again after a failure
    leaves the same result. Files are numbered above all earlier batches and
    above ``above``, the last number given elsewhere. The cost of a batch follows
    its own files, not those taken in before.
    """
    spark = rows.sparkSession
    numbered_lines = rows.withColumn("line_no", F.monotonically_increasing_id())
    lines = parse_index(numbered_lines, strict=False).persist()

    def folder(name: str) -> str:
        return f"{out}/{name}/batch={batch_id}"

    try:
        arrived = F.unix_micros("modified").alias("arrived")
        judged = judge_files(lines).select(*FILE, "state", "is_text", arrived).collect()
        listed = [(r.series_id, r.file_id) for r in judged]
        known = known_files(spark, out, batch_id, listed)
        names = spark.createDataFrame(listed, _NAMES)
        seen = {tuple(r) for r in known.join(F.broadcast(names), FILE, "left_semi").collect()}
        new = [r for r in judged if (r.series_id, r.file_id) not in seen]
        last = max(above, last_file_seq(spark, out, batch_id))
        numbers = number_files([(r.series_id, r.file_id, r.arrived) for r in new], last)
        rows_of_files = [(*k, r.state, r.is_text, numbers[k]) for r in new for k in [(r.series_id, r.file_id)]]
        files = spark.createDataFrame(rows_of_files, _FILES)
        marked = lines.join(F.broadcast(files), FILE)
        ready = type_values(marked.filter(F.col("state") == READY))
        stored = ready.withColumn("day", day_of("index")).select(*SAMPLES_RAW.fieldNames())
        by_day(stored).write.mode("overwrite").partitionBy("day").parquet(folder("samples"))
        if any(r.state == FAILED for r in new):
            marked.filter(F.col("state") == FAILED).select(
                *FILE, *ARRIVAL, "index", "value_token"
            ).write.mode("overwrite").parquet(folder("failed"))
        else:
            drop_folder(spark, folder("failed"))
    finally:
        lines.unpersist()
    # From here on only what was stored is read, and only this batch's folders.
    taken = spark.read.schema(SAMPLES_RAW).parquet(folder("samples"))
    manifest_of(taken).write.mode("overwrite").parquet(folder("manifest"))
    taken = spark.read.schema(MANIFEST).parquet(folder("manifest"))
    receipts_of(taken, files).coalesce(1).write.mode("overwrite").parquet(folder("receipts"))
    highest = max([last, *numbers.values()])
    spark.createDataFrame([(highest,)], "file_seq bigint").write.mode("overwrite").parquet(folder("marks"))
    merge_runs(spark, out, batch_id)


def prepare(spark: SparkSession, out: str) -> None:
    """Make the folders, so that they can be read before the first batch."""
    for name in ("samples", "manifest", "receipts", "marks"):
        make_folder(spark, f"{out}/{name}")


def stream_ingest(
    spark: SparkSession,
    queue: str,
    out: str,
    checkpoint: str,
    *,
    max_files: int = 1_000,
    once: bool = False,
    above: int = -1,
) -> StreamingQuery:
    """Start taking in the queue. ``once`` stops after what is there now.

    ``max_files`` is the size of a batch: what is known about a batch's files,
    one row each, is broadcast and numbered by one task.
    """
    prepare(spark, out)
    writer = (
        stream_chunks(spark, queue, max_files)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, batch_id: ingest_batch(rows, batch_id, out, above))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """Samples of all accepted files, before overlay."""
    return _read(spark, out, "samples", SAMPLES_RAW).drop("batch")


def read_ingest_manifest(spark: SparkSession, out: str) -> DataFrame:
    """What the accepted files hold, per series and day."""
    return _read(spark, out, "manifest", MANIFEST).drop("batch")


def read_receipts(spark: SparkSession, out: str) -> DataFrame:
    """Verdict and extent of every file taken in."""
    return _read(spark, out, "receipts", RECEIPTS).drop("batch")
