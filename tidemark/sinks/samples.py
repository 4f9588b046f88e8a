"""Writing samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import day_of

ORDER = ["day", "series_id", "index"]


def by_day(
    df: DataFrame, partitions: int | None = None, folders: tuple[str, ...] = ("day",)
) -> DataFrame:
    """Rows dealt by folder, day and series, and sorted by index.

    Files then hold narrow spans of ids and indices, which Parquet statistics
    can skip. The deal is rebalanced by adaptive execution: small days and
    series share a task, a large one is cut into as many tasks as its size asks
    for. With the folders first, the writer sorts no more.
    """
    keyed = df if "day" in df.columns else df.withColumn("day", day_of("index"))
    keys = [*folders, *[k for k in ORDER if k in keyed.columns and k not in folders]]
    deal = [F.col(k) for k in keys if k != "index"]
    if partitions is None:
        dealt = keyed.hint("rebalance", *deal)
    else:
        dealt = keyed.hint("rebalance", partitions, *deal)
    return dealt.sortWithinPartitions(*keys)


def write_samples(
    df: DataFrame, path: str, *, mode: str = "append", partitions: int | None = None
) -> None:
    """Stored form: Parquet, one folder per day."""
    by_day(df, partitions).write.mode(mode).partitionBy("day").parquet(path)


def format_lines(df: DataFrame) -> DataFrame:
    """Samples as chunk lines ``index,value``, not quoted.

    A value with a line break could not be read back and stops the job.
    """
    cells = []
    if "value_text" in df.columns:
        text = F.col("value_text")
        broken = F.raise_error(F.lit("a text value must not hold a line break"))
        cells.append(F.when(text.rlike(r"[\r\n]"), broken).otherwise(text))
    if "value" in df.columns:
        cells.append(F.col("value").cast("string"))
    cell = F.coalesce(*cells, F.lit(""))
    rest = [c for c in df.columns if c not in ("index", "value", "value_text")]
    return df.select(*rest, F.concat_ws(",", F.col("index").cast("string"), cell).alias("line"))


def write_chunks(
    df: DataFrame,
    path: str,
    *,
    folders: tuple[str, ...] = ("series_id", "day"),
    mode: str = "append",
    partitions: int | None = None,
) -> None:
    """Chunk files, headerless text in index order, one folder per series and day.

    A line holds index and value alone, so a series id must be a folder.
    """
    if "series_id" in df.columns and "series_id" not in folders:
        raise ValueError("the folders must name the series: a line of a chunk file does not")
    lines = format_lines(by_day(df, partitions, folders)).select(*folders, "line")
    lines.write.mode(mode).partitionBy(*folders).text(path)


def export(df: DataFrame, path: str, file_format: str = "csv", **options) -> None:
    """Any result to files of any format Spark writes."""
    df.write.format(file_format).options(**options).mode("errorifexists").save(path)
