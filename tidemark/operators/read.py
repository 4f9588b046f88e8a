"""Raw range reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import day_in_range, in_range, parse_range, to_timestamp
from tidemark.operators.joins import lookup_join
from tidemark.operators.overlay import overlay

# A longer list of ids is turned into a table and joined.
MAX_ID_LIST = 1_000


def of_series(samples: DataFrame, series) -> DataFrame:
    """Rows of one id, a list of ids or a frame with a ``series_id`` column.

    ``None`` keeps every series.
    """
    if series is None:
        return samples
    if isinstance(series, str):
        return samples.filter(F.col("series_id") == series)
    if isinstance(series, DataFrame):
        ids = series.select("series_id").distinct()
        return lookup_join(samples, ids, ["series_id"], "left_semi")
    ids = list(series)
    if len(ids) <= MAX_ID_LIST:
        return samples.filter(F.col("series_id").isin(ids))
    listed = samples.sparkSession.createDataFrame([(i,) for i in set(ids)], "series_id string")
    return lookup_join(samples, listed, ["series_id"], "left_semi")


def slice_range(samples: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """``start <= index < end``, with whole days skipped where stored by day."""
    cut = samples.filter(in_range("index", start, end))
    if "day" in samples.columns:
        cut = cut.filter(day_in_range("day", start, end))
    return cut


def get(
    samples: DataFrame,
    series=None,
    start=None,
    end=None,
    *,
    kind: str = "both",
    contested: DataFrame | None = None,
    convert_date: bool = False,
    raise_empty: bool = False,
    ordered: bool = True,
    all_values: bool = False,
) -> DataFrame:
    """Samples of ``series`` in ``[start, end)``, sorted by series and index.

    ``samples`` is either the stored table, then overlapping uploads are
    resolved after the range is cut, or an already resolved frame.
    ``convert_date`` adds the index as a UTC timestamp. ``raise_empty`` runs a
    job and raises ValueError if nothing is there. ``all_values`` gives both
    value columns, NULL where ``kind`` did not read one.
    """
    lo, hi = parse_range(start, end)
    cut = of_series(slice_range(samples, lo, hi), series)
    if "file_seq" in samples.columns:
        # Ranged by the sort key first, overlay and sort need no further shuffle.
        ranged = ordered and contested is None
        if ranged:
            cut = cut.repartitionByRange("series_id", "index")
        cut = overlay(cut, kind=kind, contested=contested, partitioned=ranged)
    values = {"numeric": ["value"], "text": ["value_text"], "both": ["value", "value_text"]}[kind]
    out = cut.select("series_id", "index", *[v for v in values if v in cut.columns])
    if all_values:
        kinds = {"value": "double", "value_text": "string"}
        missing = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in out.columns}
        out = out.withColumns(missing).select("series_id", "index", *kinds)
    if raise_empty and out.isEmpty():
        raise ValueError("no samples in the given interval")
    if convert_date:
        out = out.withColumn("time", to_timestamp("index"))
    return out.orderBy("series_id", "index") if ordered else out
