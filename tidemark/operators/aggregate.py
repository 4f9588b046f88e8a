"""Aggregation over fixed periods, and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import bin_start, long_lit, parse_range, period_ns
from tidemark.operators.overlay import overlay
from tidemark.operators.read import of_series, slice_range
from tidemark.schema import EMPTY_FIRST, EMPTY_LAST

# The four functions and their second names.
FUNCTION_NAMES = {"mean": "avg", "min": "min", "max": "max", "std": "stdev"}

_SPARK_FUNCTIONS = {"avg": F.avg, "min": F.min, "max": F.max, "stdev": F.stddev_samp}

# Bins made from one array; keeps arrays small however long the range is.
BINS_PER_BLOCK = 4_096


def aggregate_function(name: str):
    """Spark aggregate of a function name; any case, either spelling."""
    key = str(name).lower()
    key = FUNCTION_NAMES.get(key, key)
    if key not in _SPARK_FUNCTIONS:
        known = ", ".join(f"{long} or {short}" for long, short in sorted(FUNCTION_NAMES.items()))
        raise ValueError(f"unknown aggregation {name!r}; known are {known}")
    return _SPARK_FUNCTIONS[key]


def numbers_only(samples: DataFrame) -> DataFrame:
    """The same rows; a text value stops the job that meets it."""
    if "value" not in samples.columns:
        raise ValueError("text has no mean, minimum, maximum or deviation: choose a numeric series")
    if "value_text" not in samples.columns:
        return samples
    refused = F.raise_error(F.lit("text cannot be aggregated")).cast("double")
    number = F.when(F.col("value_text").isNotNull(), refused).otherwise(F.col("value"))
    return samples.withColumn("value", number)


def _per_block(width_ns: int) -> int:
    """Bins in a block; fewer of very long ones, whose edges must stay 64-bit numbers."""
    return max(1, min(BINS_PER_BLOCK, (1 << 61) // width_ns))


def _block_end(begin, last, width_ns: int):
    """Left edge of the last bin of a block that begins at ``begin``, ``last`` at most."""
    more = long_lit(width_ns * (_per_block(width_ns) - 1))
    return F.when(last - begin > more, begin + more).otherwise(last)


def _edges(rows: DataFrame, first, last, width_ns: int) -> DataFrame:
    """``rows`` once per bin from column ``first`` to ``last``, as ``_edge``.

    The bins are made in two steps, whole blocks and then the bins of each, so
    that no array is longer than a block however far apart the two are. A row
    with ``last`` before ``first`` gives none.
    """
    step = long_lit(width_ns * _per_block(width_ns))
    none = F.array().cast("array<bigint>")
    blocks = F.when(last >= first, F.sequence(first, last, step)).otherwise(none)
    bins = F.sequence("_block", _block_end(F.col("_block"), last, width_ns), long_lit(width_ns))
    return rows.withColumn("_block", F.explode(blocks)).withColumn("_edge", F.explode(bins)).drop("_block")


def _dense(bins: DataFrame, ids: DataFrame, start: int, end: int, width_ns: int) -> DataFrame:
    """``series_id, index, value, _empty`` for every bin that overlaps ``[start, end)``.

    ``bins`` has the bins that hold samples. Each id gets one more row at the
    head of every block of bins; within a block a row is followed by the empty
    bins up to the next row. Only rows and heads are shuffled; the empty bins
    are made afterwards, by as many tasks as there are blocks to share out.
    """
    first = start - start % width_ns
    last = (end - 1) - (end - 1) % width_ns
    block = width_ns * _per_block(width_ns)
    heads = _edges(ids.select("series_id"), long_lit(first), long_lit(last), block)
    heads = heads.select(
        "series_id",
        F.col("_edge").alias("index"),
        F.lit(None).cast("double").alias("value"),
        F.lit(True).alias("_head"),
        F.col("_edge").alias("_part"),
    )
    part = F.col("index") - F.pmod(F.col("index") - long_lit(first), long_lit(block))
    rows = bins.withColumns({"_head": F.lit(False), "_part": part}).unionByName(heads)
    within = Window.partitionBy("series_id", "_part").orderBy("index", F.desc("_head"))
    end_of_part = _block_end(F.col("_part"), long_lit(last), width_ns)
    until = F.coalesce(F.lead("index").over(within) - long_lit(width_ns), end_of_part)
    filled = _edges(rows.withColumn("_until", until), F.col("index"), F.col("_until"), width_ns)
    empty = F.col("_head") | (F.col("_edge") != F.col("index"))
    return filled.select(
        "series_id",
        F.col("_edge").alias("index"),
        F.when(~empty, F.col("value")).alias("value"),
        empty.alias("_empty"),
    )


def _present(
    samples: DataFrame, lo: int | None, hi: int | None, width_ns: int, contested, check_text: bool = True
) -> DataFrame:
    """``(series_id, bin, value)`` of the samples in range that have a value.

    Overlapping uploads are resolved first, by index: however few the bins and
    however hot the series, its rows are spread by their indices. Each task
    then sends on one partial aggregate per bin.
    """
    cut = slice_range(samples, lo, hi)
    if check_text:
        cut = numbers_only(cut)
    if "file_seq" in samples.columns:
        cut = overlay(cut, kind="numeric", contested=contested)
    return cut.filter(F.col("value").isNotNull()).select(
        "series_id", bin_start("index", width_ns).alias("index"), "value"
    )


def _ids(samples: DataFrame, series) -> DataFrame:
    spark = samples.sparkSession
    if isinstance(series, DataFrame):
        return series.select("series_id").distinct()
    if series is None:
        return samples.select("series_id").distinct()
    listed = [series] if isinstance(series, str) else list(series)
    return spark.createDataFrame([(i,) for i in dict.fromkeys(listed)], "series_id string")


def aggregate(
    samples: DataFrame,
    start,
    end,
    period: str,
    function: str,
    *,
    include_empty: bool = False,
    series=None,
    contested: DataFrame | None = None,
    check_text: bool = True,
) -> DataFrame:
    """``(series_id, index, value)``: one row per series and period in ``[start, end)``.

    Bins are aligned to the epoch and labelled with their left edge; only
    samples inside the range count. Periods without samples are left out, or
    given as NULL with ``include_empty``, then for every id in ``series``; there
    may be any number of them. A text value in the range stops the job, unless
    ``check_text`` is off.
    """
    for name, given in (("start", start), ("end", end), ("period", period), ("function", function)):
        if given is None or given == "":
            raise ValueError(f"{name} is required")
    spark_function = aggregate_function(function)
    width = period_ns(period)
    lo, hi = parse_range(start, end)
    rows = _present(of_series(samples, series), lo, hi, width, contested, check_text)
    bins = rows.groupBy("series_id", "index").agg(spark_function("value").alias("value"))
    if not include_empty:
        return bins
    return _dense(bins, _ids(samples, series), lo, hi, width).drop("_empty")


def resample(
    samples: DataFrame,
    period: str,
    function: str,
    start=None,
    end=None,
    *,
    fill_within: str | None = None,
    contested: DataFrame | None = None,
) -> DataFrame:
    """Aggregate over any span, open ends included, in one pass.

    ``fill_within='24h'`` adds the empty periods between the first and the last
    sample of every day, as NULL: what resampling the days one by one gives.
    """
    spark_function = aggregate_function(function)
    width = period_ns(period)
    lo, hi = parse_range(start, end)
    rows = _present(samples, lo, hi, width, contested)
    bins = rows.groupBy("series_id", "index").agg(spark_function("value").alias("value"))
    return bins if fill_within is None else _fill(bins, width, period_ns(fill_within))


def _fill(bins: DataFrame, width_ns: int, span_ns: int) -> DataFrame:
    if span_ns % width_ns:
        raise ValueError("the span must be a whole number of periods")
    span = Window.partitionBy("series_id", bin_start("index", span_ns)).orderBy("index")
    last = F.coalesce(F.lead("index").over(span) - long_lit(width_ns), F.col("index"))
    filled = _edges(bins.withColumn("_until", last), F.col("index"), F.col("_until"), width_ns)
    return filled.select(
        "series_id",
        F.col("_edge").alias("index"),
        F.when(F.col("_edge") == F.col("index"), F.col("value")).alias("value"),
    )


def gaps(
    samples: DataFrame, start, end, period: str, *, series=None, contested: DataFrame | None = None
) -> DataFrame:
    """``(series_id, index)`` of the periods in ``[start, end)`` without a sample."""
    width = period_ns(period)
    lo, hi = parse_range(start, end)
    rows = _present(of_series(samples, series), lo, hi, width, contested)
    bins = rows.groupBy("series_id", "index").agg(F.max("value").alias("value"))
    return (
        _dense(bins, _ids(samples, series), lo, hi, width).filter("_empty").select("series_id", "index")
    )


def sample_extents(samples: DataFrame) -> DataFrame:
    """First and last index and number of samples of every series that has any."""
    return samples.groupBy("series_id").agg(
        F.min("index").alias("first_index"),
        F.max("index").alias("last_index"),
        F.count("index").alias("n_samples"),
    )


def fill_extents(series: DataFrame, extents: DataFrame) -> DataFrame:
    """Extents of all series; one without samples gets the empty extent."""
    return series.join(extents, "series_id", "left").withColumns(
        {
            "first_index": F.coalesce("first_index", long_lit(EMPTY_FIRST)),
            "last_index": F.coalesce("last_index", long_lit(EMPTY_LAST)),
            "n_samples": F.coalesce("n_samples", long_lit(0)),
        }
    )


def series_extent(series: DataFrame, samples: DataFrame) -> DataFrame:
    """``(series_id, first_index, last_index, n_samples)`` of every series."""
    return fill_extents(series.select("series_id"), sample_extents(samples))
