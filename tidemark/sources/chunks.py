"""Chunk files: headerless UTF-8 text, one ``index,value`` per line.

The CSV reader is not used: everything after the first comma belongs to the
value, and quotes mean nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.tokens import is_numeric, to_index_strict, to_number, try_index
from tidemark.operators.joins import lookup_join

# Arrival order of the lines of one file: the byte offset of the split a line
# was read from, then the line's place within the split.
ARRIVAL = ["block_start", "line_no"]


def with_origin(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Text rows plus the file and the place in it they come from."""
    return raw.select(
        *(keep or []),
        F.col("_metadata.file_path").alias("chunk"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def split_lines(lines: DataFrame, *, strip_end: bool = False) -> DataFrame:
    """Drop blank lines and split the others at the first comma only."""
    text = F.regexp_replace("line", r"\s+$", "") if strip_end else F.col("line")
    parts = F.split(text, ",", 2)
    rest = [c for c in lines.columns if c != "line"]
    return lines.filter(F.length("line") > 0).select(
        *rest,
        F.get(parts, 0).alias("index_token"),
        F.get(parts, 1).alias("value_token"),
    )


def parse_index(tokens: DataFrame, *, strict: bool = True) -> DataFrame:
    """``index_token`` -> ``index``. Not strict: NULL marks a bad token."""
    read = to_index_strict if strict else try_index
    return tokens.withColumn("index", read(F.col("index_token"))).drop("index_token")


def type_values(marked: DataFrame) -> DataFrame:
    """``value_token`` -> ``value`` or ``value_text``, as ``is_text`` says."""
    token, is_text = F.col("value_token"), F.col("is_text")
    return (
        marked.withColumn("value", F.when(~is_text, to_number(token)))
        .withColumn("value_text", F.when(is_text & (token != ""), token))
        .drop("value_token", "is_text")
    )


def infer_value_type(tokens: DataFrame, chunk_cols: list[str]) -> DataFrame:
    """``value_token`` -> ``value`` or ``value_text``, one kind per chunk.

    A chunk is numeric if all its tokens are; one other token turns it to text
    as a whole. Only the chunks that hold text are looked up, and the lookup
    spreads a chunk of any size over many tasks.
    """
    text_chunks = tokens.filter(~is_numeric(F.col("value_token"))).select(*chunk_cols).distinct()
    marked = lookup_join(
        tokens, text_chunks.withColumn("is_text", F.lit(True)), chunk_cols, "left"
    )
    return type_values(marked.withColumn("is_text", F.coalesce("is_text", F.lit(False))))


def read_chunks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of chunk files as ``chunk, block_start, line_no, index_token, value_token``."""
    return split_lines(with_origin(spark.read.text(paths)))


def read_chunk_samples(
    spark: SparkSession, paths: str | list[str], *, strict: bool = True
) -> DataFrame:
    """Chunk files as typed samples, with the arrival order kept."""
    return infer_value_type(parse_index(read_chunks(spark, paths), strict=strict), ["chunk"])


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV file as one series ``(index, value, value_text)``."""
    lines = split_lines(with_origin(spark.read.text(path)), strip_end=True)
    typed = infer_value_type(parse_index(lines), ["chunk"])
    return typed.select("index", "value", "value_text")
