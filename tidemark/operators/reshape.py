"""Between tables and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import fits_broadcast, lookup_join
from tidemark.session import settle

# The text a boolean sample arrives as.
TRUE_TEXT = ["true", "True"]
FALSE_TEXT = ["false", "False"]

# Columns of a block.
BLOCK_COLUMNS = 200


def to_wide(samples: DataFrame, series_ids: list[str], value: str = "value") -> DataFrame:
    """One column per listed series, aligned on the index, NULL where it has none.

    The list fixes the schema, so there is no pass to find the ids, and one
    conditional aggregate per column needs one shuffle.
    """
    wanted = samples.filter(F.col("series_id").isin(list(series_ids)))
    return wanted.groupBy("index").agg(
        *[F.max(F.when(F.col("series_id") == sid, F.col(value))).alias(sid) for sid in series_ids]
    )


def block_columns(series_ids: DataFrame, block: int = BLOCK_COLUMNS) -> DataFrame:
    """``series_id, block, place``: a column for each series of a frame, in the order of the ids.

    There may be any number of series; none is brought to the driver. A block has
    ``block`` columns at most, those at the ends of a partition of the sorted ids fewer.
    NULL, if it is among the ids, has a column as well.
    """
    ids = series_ids.select("series_id").distinct().orderBy("series_id")
    numbered = ids.withColumn("_number", F.monotonically_increasing_id())
    return settle(_placed(numbered, block), "columns")


def _placed(numbered: DataFrame, block: int) -> DataFrame:
    place = F.pmod("_number", F.lit(block))
    return numbered.select("series_id", (F.col("_number") - place).alias("block"), place.cast("int").alias("place"))


def to_blocks(samples: DataFrame, columns: DataFrame, value: str = "value", block: int = BLOCK_COLUMNS) -> DataFrame:
    """``index, block, values``: a table with a column per series, cut into blocks of columns.

    ``columns`` and ``block`` are those of :func:`block_columns`; a series without a
    column is left out. There is a row for each index at which a series of the block has a
    sample, with a value for each place of the block, NULL where its series has
    none. No expression names a column, so the plan is as long for any number of them.
    """
    listed = columns.select(F.struct("series_id").alias("_id"), "block", "place")
    rows = samples.select(F.struct("series_id").alias("_id"), "index", F.col(value).alias("_value"))
    placed = lookup_join(rows, listed, ["_id"], small=fits_broadcast(columns))
    cells = placed.groupBy("index", "block", "place").agg(F.max("_value").alias("_value"))
    held = cells.groupBy("index", "block").agg(F.sort_array(F.collect_list(F.struct("place", "_value"))).alias("_cells"))
    return held.select("index", "block", _filled(block, cells.schema["_value"].dataType).alias("values"))


def _filled(block: int, kind: T.DataType) -> Column:
    """``_cells``, sorted, as one array: each value after as many NULLs as places are empty before it."""
    nulls = lambda n: F.array_repeat(F.lit(None).cast(kind), n)
    before = lambda i: F.coalesce(F.get("_cells", i - 1)["place"], F.lit(-1))
    parts = F.transform("_cells", lambda c, i: F.concat(nulls(c["place"] - before(i) - 1), F.array(c["_value"])))
    return F.concat(F.flatten(parts), nulls(F.lit(block - 1) - F.element_at("_cells", -1)["place"]))


def from_blocks(blocks: DataFrame, columns: DataFrame) -> DataFrame:
    """The samples of a table in blocks, ``series_id, index, value``; empty cells are no samples."""
    cells = blocks.select("index", "block", F.posexplode_outer("values").alias("place", "value"))
    filled = cells.filter(F.col("value").isNotNull())
    return lookup_join(filled, columns, ["block", "place"], small=fits_broadcast(columns)).select("series_id", "index", "value")


def to_wide_blocks(
    samples: DataFrame, series_ids: list[str], value: str = "value", block: int = BLOCK_COLUMNS
) -> DataFrame:
    """As :func:`to_wide` for thousands of series.

    All blocks are made in one pass, :func:`to_blocks`, and put beside one another by
    one more shuffle; the columns are taken out of them last. The schema still
    has each series: for more of them than a plan can list, use the blocks themselves.
    """
    ids = list(dict.fromkeys(series_ids))
    numbered = samples.sparkSession.createDataFrame([(i, n) for n, i in enumerate(ids)], "series_id string, _number bigint")
    blocks = to_blocks(samples, settle(_placed(numbered, block), "columns"), value, block)
    whole = [F.any_value(F.when(F.col("block") == at, F.col("values")), True).alias(f"_{at}") for at in range(0, len(ids), block)]
    rows = blocks.groupBy("index").agg(F.count("*").alias("_n"), *whole)
    return rows.select("index", *[F.col(f"_{n - n % block}")[n % block].alias(sid) for n, sid in enumerate(ids)])


def to_long(table: DataFrame, columns: list[str], index_col: str = "index") -> DataFrame:
    """A table broken into one series per column; empty cells are no samples."""
    long = table.unpivot(index_col, columns, "series_id", "value")
    return long.filter(F.col("value").isNotNull()).select(
        "series_id", F.col(index_col).alias("index"), "value"
    )


def recode_boolean(samples: DataFrame) -> DataFrame:
    """Boolean text to 1 and 0; any other sample stays as it is."""
    number = F.when(F.col("value_text").isin(TRUE_TEXT), F.lit(1.0)).when(
        F.col("value_text").isin(FALSE_TEXT), F.lit(0.0)
    )
    recoded = F.coalesce(number, F.col("value")) if "value" in samples.columns else number
    return samples.withColumns(
        {"value": recoded, "value_text": F.when(number.isNull(), F.col("value_text"))}
    )
