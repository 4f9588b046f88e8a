"""Bounded training samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def sample_per_label(keys: DataFrame, label_col: str, rows_per_label: int, id_col: str = "doc_id") -> DataFrame:
    """``keys`` cut to ``rows_per_label`` rows of each label, chosen by a hash of the id.

    The counts per label (broadcast: one row for each label, of which the sample
    has many) give a hash threshold under which slightly more rows than wanted
    are expected; only those are shuffled and ranked, so a label that holds most
    rows is never sorted whole.
    """
    keys = keys.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    counts = keys.groupBy(label_col).agg(F.count("*").alias("_n"))
    place = F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 30))
    few = keys.join(F.broadcast(counts), label_col).where(place * F.col("_n") < F.lit(float(1 << 30)) * (1.2 * rows_per_label + 50))
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy(place, id_col))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= rows_per_label).drop("_rank", "_n")
