"""Answers of a search for series: JSON whose entries are JSON texts with single quotes.

A document maps series ids to lists of texts, each of them an entry with
namespace, key and any names; a search for a value gives a plain list of ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The names an entry's parts go by.
ENTRY = "Namespace string, Key string, Value map<string,string>, _bad string"

_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}

# A single quote with neither a sign of structure before it nor one after it.
STRAY_QUOTE = r"(?<![\[{,:\\\s])'(?!\s*[\]},:])"


def _parsed(text: Column) -> Column:
    options = _OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return F.from_json(text, ENTRY, options)


def _unreadable(entry: Column) -> Column:
    return entry.isNull() | entry["_bad"].isNotNull() | entry["Namespace"].isNull() | entry["Key"].isNull()


def parse_entry(text: str | Column) -> Column:
    """An entry's text as ``namespace, key, value, bad``.

    Names may be any; a value that is an object or a list is kept as JSON text,
    numbers and booleans as the text of what they are. A quote inside a value may be
    escaped, or stand bare where it cannot be taken for the end. Text that is no
    entry either way is given back as ``bad``, with the rest NULL.
    """
    raw = F.col(text) if isinstance(text, str) else text
    mended = _parsed(F.regexp_replace(raw, STRAY_QUOTE, r"\\'"))
    # A second parse only where the first one failed.
    entry = _named_once(_parsed(raw), lambda plain: F.when(_unreadable(plain), mended).otherwise(plain))
    return _named_once(entry, lambda entry: _parts(raw, entry))


def _named_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, for which ``value`` is computed once however often it is named.

    Below a condition Spark shares no common parts: each mention of a parse is a parse.
    """
    return F.transform(F.array(value), use)[0]


def _parts(raw: Column, entry: Column) -> Column:
    good = ~_unreadable(entry)
    return F.struct(
        F.when(good, entry["Namespace"]).alias("namespace"),
        F.when(good, entry["Key"]).alias("key"),
        F.when(good, F.coalesce(entry["Value"], F.create_map().cast("map<string,string>"))).alias("value"),
        F.when(~good, F.coalesce(raw, F.lit(""))).alias("bad"),
    )


def explode_hits(answers: DataFrame, column: str = "answer", keep: list[str] | None = None) -> DataFrame:
    """One row per series and entry: ``keep..., series_id, namespace, key, value, bad``.

    A series without entries, or an id of a plain list, is a row without an
    entry. A document that is neither is one row whose ``bad`` is its text;
    a NULL one has no rows.
    """
    keep = keep or []
    document = F.col(column)
    is_list = F.ltrim(document).startswith("[")
    found = F.when(is_list, F.transform(F.from_json(document, "array<string>", _OPTIONS), lambda i: F.struct(i.alias("key"), F.lit(None).cast("array<string>").alias("value"))))
    found = found.otherwise(F.map_entries(F.from_json(document, "map<string,array<string>>", _OPTIONS)))
    # No row carries more than its own part: a document, or all entries of a series, beside
    # the rows made of them would be copied into each.
    documents = answers.select(*keep, document.alias("_text"), found.alias("_found"))
    documents = documents.select(*keep, F.when(F.col("_found").isNull(), F.col("_text")).alias("_unread"), "_found")
    series = documents.select(*keep, "_unread", F.explode_outer("_found").alias("_s"))
    # An empty or NULL document has no hits; only one that could not be read is put aside.
    series = series.filter(F.col("_unread").isNotNull() | F.col("_s.key").isNotNull())
    series = series.select(*keep, "_unread", F.col("_s.key").alias("series_id"), F.col("_s.value").alias("_entries"))
    listed = series.select(*keep, "_unread", "series_id", F.explode_outer("_entries").alias("_entry"))
    read = listed.withColumn("_e", F.when(F.col("_entry").isNotNull(), parse_entry("_entry")))
    bad = F.coalesce("_unread", "_e.bad")
    return read.select(*keep, "series_id", "_e.namespace", "_e.key", "_e.value", bad.alias("bad"))
