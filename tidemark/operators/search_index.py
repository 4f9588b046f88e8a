"""Search over very many entries: sorted entries and a posting table of letter triples."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.metadata import NAME, hierarchical, matching_entries, value_json
from tidemark.schema import METADATA

GRAM = 3
#: Folders of the posting table, by the first digit pair of a hash.
PARTS = 256

_POSTINGS = "gram string, namespace string, name string, metadata_id string, part string"


def _part(gram: str) -> str:
    return hashlib.md5(gram.encode()).hexdigest()[:2]


def write_search_index(metadata: DataFrame, path: str) -> None:
    """Entries in the order of their names, and who holds which triple of letters.

    Entries are dealt by ranges of namespace and key, so that files and row
    groups hold narrow spans and a prefix opens few of them. The posting table has one
    row per entry, name and triple in the value, in folders by the triple's hash.
    """
    entries = metadata.select(*METADATA.fieldNames())
    entries.repartitionByRange(*NAME).sortWithinPartitions(*NAME).write.parquet(f"{path}/entries")
    values = entries.select("metadata_id", "namespace", F.explode("value").alias("name", "text"))
    last = F.length("text") - (GRAM - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(GRAM))))
    rows = values.select(F.explode(grams).alias("gram"), "namespace", "name", "metadata_id")
    placed = rows.withColumn("part", F.substring(F.md5("gram"), 1, 2))
    dealt = placed.hint("rebalance", F.col("part"), F.col("gram")).sortWithinPartitions("part", "gram", "namespace", "name")
    dealt.write.partitionBy("part").parquet(f"{path}/postings")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).parquet(f"{path}/entries")


def needed_grams(pattern: str) -> list[str]:
    """Triples that every value matching the pattern holds; none if its parts are too short."""
    parts = pattern.split("*")
    return sorted({part[i : i + GRAM] for part in parts for i in range(len(part) - GRAM + 1)})


def candidates(spark: SparkSession, path: str, namespace: str, name: str, pattern: str) -> DataFrame | None:
    """Ids of entries whose value holds all triples of the pattern; None if it has none."""
    grams = needed_grams(pattern)
    if not grams:
        return None
    postings = spark.read.schema(_POSTINGS).parquet(f"{path}/postings")
    hits = postings.filter(
        F.col("part").isin(sorted({_part(g) for g in grams}))
        & F.col("gram").isin(grams)
        & (F.col("namespace") == namespace)
        & (F.col("name") == name)
    )
    counted = hits.groupBy("metadata_id").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") == len(grams)).select("metadata_id")


def search_indexed(spark: SparkSession, path: str, links: DataFrame, namespace: str, key=None, name=None, value=None) -> DataFrame:
    """What :func:`~tidemark.operators.metadata.search` gives, from a written index.

    A prefix of the key is a filter that the sorted files answer from their statistics.
    With a value only the entries that the posting table names are looked at, and
    each is checked against the pattern itself.
    """
    args = hierarchical(namespace, key, name, value)
    if not args:
        raise ValueError("namespace is mandatory")
    entries = read_entries(spark, path)
    if len(args) == 4:
        found = candidates(spark, path, args[0], args[2], str(args[3]))
        if found is not None:
            entries = lookup_join(entries.filter(F.col("namespace") == args[0]), found, ["metadata_id"], "left_semi")
    hits = matching_entries(entries, args)
    if len(args) == 4:
        return lookup_join(links, hits.select("metadata_id"), ["metadata_id"], "left_semi").select("series_id").distinct()
    named = hits.select("metadata_id", *NAME, value_json().alias("value_json"))
    return lookup_join(links, named, ["metadata_id"]).select("series_id", "metadata_id", *NAME, "value_json")
