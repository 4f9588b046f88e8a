"""Samples from Parquet, JSON pages and frames already in the session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeaxis import to_index
from tidemark.schema import NS_PER_US, PAGE_JSON, SAMPLES, SAMPLES_RAW

NS_PER_S = 1_000_000_000


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Stored samples, day-partitioned Parquet, before overlay."""
    return spark.read.schema(SAMPLES_RAW).parquet(path)


def empty_samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SAMPLES)


def iso_to_index(stamp: Column) -> Column:
    """ISO-8601 text to nanoseconds, with all nine decimals kept."""
    whole = F.regexp_replace(stamp, r"\.\d+", "").cast("timestamp")
    decimals = F.rpad(F.regexp_extract(stamp, r"\.(\d+)", 1), 9, "0").cast("bigint")
    return F.unix_micros(whole) * NS_PER_US + decimals


def explode_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Pages ``{value: [{Timestamp, Value}]}`` to sample rows."""
    keep = keep or []
    rows = pages.select(*keep, F.explode("value").alias("sample"))
    return rows.select(
        *keep,
        iso_to_index(F.col("sample.Timestamp")).alias("index"),
        F.nanvl(F.col("sample.Value"), F.lit(None).cast("double")).alias("value"),
    )


def read_sample_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All pages of an aggregate in one scan; their order does not matter."""
    return explode_pages(spark.read.schema(PAGE_JSON).json(paths, multiLine=True))


def check_index_type(df: DataFrame, index_col: str, value_col: str) -> None:
    """A series has an integer or timestamp index and a float or text value."""
    index_type = df.schema[index_col].dataType
    if not isinstance(index_type, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"index must be BIGINT or a timestamp, not {index_type.simpleString()}")
    value_type = df.schema[value_col].dataType
    if not isinstance(value_type, (T.NumericType, T.StringType)):
        raise ValueError(f"value must be a number or text, not {value_type.simpleString()}")


def from_series(
    df: DataFrame,
    index_col: str,
    value_col: str,
    series_id: str | Column,
    keep: list[str] | None = None,
) -> DataFrame:
    """Two columns of any frame as samples ``(series_id, index, value, value_text)``.

    ``series_id`` is one id, or a column holding the id of every row.
    """
    check_index_type(df, index_col, value_col)
    index_type = df.schema[index_col].dataType
    if isinstance(index_type, T.TimestampNTZType):
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
            raise ValueError("times without a zone are UTC: set spark.sql.session.timeZone to UTC")
    index = F.col(index_col)
    if not isinstance(index_type, T.LongType):
        index = to_index(index)
    if isinstance(df.schema[value_col].dataType, T.StringType):
        value, text = F.lit(None).cast("double"), F.col(value_col)
    else:
        value = F.nanvl(F.col(value_col).cast("double"), F.lit(None).cast("double"))
        text = F.lit(None).cast("string")
    sid = F.lit(series_id) if isinstance(series_id, str) else series_id
    return df.select(
        sid.alias("series_id"),
        index.alias("index"),
        value.alias("value"),
        text.alias("value_text"),
        *(keep or []),
    )


def read_parquet_chunks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parquet files of two columns, ``index`` and ``values``, as
    ``(index, value, value_text)``."""
    stored = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return from_series(stored, "index", "values", "").drop("series_id")


def from_pandas(spark: SparkSession, series) -> DataFrame:
    """A pandas Series held by the caller as ``(pos, index, value)``.

    ``pos`` is the arrival order. A datetime index is counted in UTC
    nanoseconds; times without a zone are UTC.
    """
    import numpy as np
    import pandas as pd

    if not isinstance(series, pd.Series):
        raise ValueError("expected a pandas Series")
    index = series.index
    if isinstance(index, pd.DatetimeIndex):
        if index.tz is not None:
            index = index.tz_convert("UTC").tz_localize(None)
        index = index.as_unit("ns").astype("int64")
    elif index.dtype != np.int64:
        raise ValueError("index must be datetime64[ns] or int64")
    # Booleans are kept as the text 'True' and 'False'.
    is_number = pd.api.types.is_numeric_dtype(series.dtype)
    is_text = not is_number or pd.api.types.is_bool_dtype(series.dtype)
    if is_text:
        values = [None if pd.isna(v) else str(v) for v in series]
    else:
        values = series.to_numpy(dtype="float64")
    frame = pd.DataFrame(
        {"pos": np.arange(len(series)), "index": np.asarray(index), "value": values}
    )
    schema = f"pos bigint, index bigint, value {'string' if is_text else 'double'}"
    return spark.createDataFrame(frame, schema)
