"""Aggregates from stored partial results.

A rollup holds, for every series and base period, how many samples there are,
their mean, the sum of squared distances from it, and the smallest and largest.
Such rows can be merged to any multiple of the base period. An aggregate over a
range then reads samples only of the days the range cuts, and of those that
changed since the rollup was made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import bin_start, day_of, long_lit, parse_range, period_ns
from tidemark.operators.aggregate import aggregate_function, numbers_only
from tidemark.operators.joins import lookup_join
from tidemark.operators.overlay import overlay
from tidemark.operators.read import slice_range
from tidemark.schema import NS_PER_DAY
from tidemark.session import settle

PARTS = ["n", "mean", "spread", "low", "high"]


def _moments(samples: DataFrame, width_ns: int, contested: DataFrame | None = None) -> DataFrame:
    cut = numbers_only(samples)
    if "file_seq" in samples.columns:
        cut = overlay(cut, kind="numeric", contested=contested)
    present = cut.filter(F.col("value").isNotNull())
    return present.groupBy("series_id", bin_start("index", width_ns).alias("index")).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("spread"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def rollup(samples: DataFrame, base_period: str, *, contested: DataFrame | None = None) -> DataFrame:
    """``series_id, day, index, n, mean, spread, low, high`` per base period with samples.

    The period must divide a day, so that a row belongs to one day. Stored by
    day (``partitionBy('day')``) a later range reads only its days.
    """
    width = period_ns(base_period)
    if NS_PER_DAY % width:
        raise ValueError("the base period must divide a day")
    return _moments(samples, width, contested).withColumn("day", day_of("index"))


def merge_moments(parts: DataFrame, width_ns: int) -> DataFrame:
    """Rows of partial results merged to periods of ``width_ns``.

    The mean of a period is worked out first and the distances from it added
    up, so nothing is lost where values are far from zero; both steps use one shuffle.
    """
    keyed = parts.withColumn("index", bin_start("index", width_ns))
    period = Window.partitionBy("series_id", "index")
    whole = F.sum(F.col("n") * F.col("mean")).over(period) / F.sum("n").over(period)
    apart = F.col("mean") - F.col("_mean")
    return keyed.withColumn("_mean", whole).groupBy("series_id", "index").agg(
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("spread") + F.col("n") * apart * apart).alias("spread"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


_VALUES = {
    "avg": lambda: F.col("mean"),
    "min": lambda: F.col("low"),
    "max": lambda: F.col("high"),
    "stddev_samp": lambda: F.when(F.col("n") > 1, F.sqrt(F.col("spread") / (F.col("n") - 1))),
}


def aggregate_rollup(
    stored: DataFrame,
    samples: DataFrame,
    start,
    end,
    period: str,
    function: str,
    *,
    base_period: str,
    changed: DataFrame | None = None,
) -> DataFrame:
    """What :func:`~tidemark.operators.aggregate.aggregate` gives, from a rollup where that will do.

    ``stored`` is a :func:`rollup` with ``base_period``, of which ``period`` is a
    multiple. Days that lie in the range whole are taken from it; of the days
    that the range cuts, and of the ``(series_id, day)`` pairs in ``changed`` that
    were uploaded to since, the samples are read.
    """
    width, base = period_ns(period), period_ns(base_period)
    if width % base:
        raise ValueError("the period must be a multiple of the base period")
    value = _VALUES[aggregate_function(function).__name__]
    lo, hi = parse_range(start, end)
    first = None if lo is None else -(-lo // NS_PER_DAY)
    after = None if hi is None else hi // NS_PER_DAY
    whole = F.lit(True)
    if first is not None:
        whole = whole & (F.col("day") >= first)
    if after is not None:
        whole = whole & (F.col("day") < after)
    if "day" not in samples.columns:
        samples = samples.withColumn("day", day_of("index"))
    if first is not None and after is not None and first > after:
        edges, parts = slice_range(samples, lo, hi), stored.filter(F.lit(False))
    else:
        cut = [(lo, None if first is None else first * NS_PER_DAY), (None if after is None else after * NS_PER_DAY, hi)]
        spans = [slice_range(samples, a, b) for a, b in cut if a is not None and b is not None and a < b]
        edges, parts = None, stored.filter(whole)
        for span in spans:
            edges = span if edges is None else edges.unionByName(span)
    if changed is not None:
        pairs, keys = settle(changed.select("series_id", "day").distinct(), "changed"), ["series_id", "day"]
        parts = lookup_join(parts, pairs, keys, "left_anti")
        again = lookup_join(samples.filter(whole), pairs, keys, "left_semi")
        edges = again if edges is None else edges.unionByName(again)
    rows = parts.select("series_id", "index", *PARTS)
    if edges is not None:
        rows = rows.unionByName(_moments(edges, base).select("series_id", "index", *PARTS))
    return merge_moments(rows, width).select("series_id", "index", value().alias("value"))


def exact_mean(samples: DataFrame, start, end, period: str, *, scale: int = 6) -> DataFrame:
    """Means whose last bit does not depend on how the rows are partitioned.

    Values are summed as decimals with ``scale`` places (values with more are
    rounded to that), which is the same in any order; the sum is divided once.
    """
    width = period_ns(period)
    lo, hi = parse_range(start, end)
    cut = numbers_only(slice_range(samples, lo, hi))
    if "file_seq" in samples.columns:
        cut = overlay(cut, kind="numeric")
    present = cut.filter(F.col("value").isNotNull())
    total = F.sum(F.col("value").cast(f"decimal(28,{scale})"))
    bins = present.groupBy("series_id", bin_start("index", width).alias("index")).agg(total.alias("total"), F.count("value").alias("n"))
    units = (F.col("total") * long_lit(10**scale).cast("decimal(19,0)")).cast("decimal(38,0)").cast("double")
    return bins.select("series_id", "index", (units / F.lit(float(10**scale)) / F.col("n").cast("double")).alias("value"))
