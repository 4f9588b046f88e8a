"""Checks every upload passes before its samples count.

An upload is accepted or ignored as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import long_lit
from tidemark.operators.joins import lookup_split

READY = "Ready"
FAILED = "Failed"

# Consecutive rows of one file that are ordered together.
BLOCK_ROWS = 1 << 20


def index_faults(
    df: DataFrame,
    file_cols: list[str],
    order_cols: list[str],
    block_rows: int = BLOCK_ROWS,
    carry: dict[str, Callable] | None = None,
) -> DataFrame:
    """Per file: rows, unreadable indices, steps back and steps of zero.

    ``carry`` names further columns and the aggregate, such as ``F.max``, that
    sums each of them up per file in the same pass.

    ``order_cols`` give the arrival order; the last is an integer, unique
    within the others. A file of any size is cut into blocks of consecutive
    rows. Blocks are ordered by separate tasks, and only the first and last
    index of each are compared across blocks, so no task sorts a whole file.
    """
    *prefix, place = order_cols
    block = F.col(place) - F.pmod(F.col(place), long_lit(block_rows))
    carry = carry or {}
    rows = df.select(*file_cols, *order_cols, "index", *carry, block.alias("_block"))
    in_block = [*file_cols, *prefix, "_block"]
    before = F.lag("index").over(Window.partitionBy(*in_block).orderBy(place))
    blocks = (
        rows.withColumn("_before", before)
        .groupBy(*in_block)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("index").isNull()).alias("n_unreadable"),
            F.count_if(F.col("index") < F.col("_before")).alias("n_back"),
            F.count_if(F.col("index") == F.col("_before")).alias("n_repeat"),
            F.min_by("index", place).alias("_first"),
            F.max_by("index", place).alias("_last"),
            *[total(name).alias(name) for name, total in carry.items()],
        )
    )
    across = Window.partitionBy(*file_cols).orderBy(*prefix, "_block")
    return (
        blocks.withColumn("_before", F.lag("_last").over(across))
        .groupBy(*file_cols)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_unreadable").alias("n_unreadable"),
            (F.sum("n_back") + F.count_if(F.col("_first") < F.col("_before"))).alias("n_back"),
            (F.sum("n_repeat") + F.count_if(F.col("_first") == F.col("_before"))).alias("n_repeat"),
            *[total(name).alias(name) for name, total in carry.items()],
        )
    )


def check_sorted(
    df: DataFrame, file_cols: list[str], order_cols: list[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per file: does the index never step back?"""
    faults = index_faults(df, file_cols, order_cols, block_rows)
    return faults.select(*file_cols, (F.col("n_back") == 0).alias("is_sorted"))


def check_unique(df: DataFrame, file_cols: list[str]) -> DataFrame:
    """Indices that occur more than once within a file, with their count."""
    counted = df.groupBy(*file_cols, "index").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def file_verdicts(
    df: DataFrame,
    file_cols: list[str],
    order_cols: list[str],
    block_rows: int = BLOCK_ROWS,
    carry: dict[str, Callable] | None = None,
) -> DataFrame:
    """Per file: ``state`` Ready or Failed, and what ``carry`` asks for.

    Ready means every index reads, none steps back and none repeats. In a file
    that never steps back equal indices are neighbours, so the ordering pass
    finds them too and no second shuffle is needed.
    """
    faults = index_faults(df, file_cols, order_cols, block_rows, carry)
    good = (F.col("n_unreadable") == 0) & (F.col("n_back") == 0) & (F.col("n_repeat") == 0)
    return faults.withColumn("state", F.when(good, READY).otherwise(FAILED)).select(
        *file_cols, "state", "n_rows", "n_unreadable", "n_back", "n_repeat", *(carry or {})
    )


def split_by_verdict(
    df: DataFrame, verdicts: DataFrame, file_cols: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows of the ready files and rows of the failed ones."""
    failed_files = verdicts.filter(F.col("state") == FAILED).select(*file_cols)
    failed, ready = lookup_split(df, failed_files, file_cols)
    return ready, failed


def validate_files(
    df: DataFrame, file_cols: list[str], order_cols: list[str], block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows to ignore."""
    return split_by_verdict(df, file_verdicts(df, file_cols, order_cols, block_rows), file_cols)
