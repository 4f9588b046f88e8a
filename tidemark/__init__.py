"""tidemark: time series and their metadata as Spark DataFrames."""

from tidemark.store import SeriesStore

__all__ = ["SeriesStore"]
