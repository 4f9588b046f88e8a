"""Metadata entries, their links to series, browsing and search.

An entry has a unique ``(namespace, key)`` and a free map of names to values.
Entries and series are linked many to many. Operators return new frames and
leave their inputs alone. Where the result belongs to one series or entry it
is given as rows, one per link, and never as an array that could grow without
bound.
"""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join

NAME = ["namespace", "key"]


def metadata_id_of(namespace: str | Column, key: str | Column) -> Column:
    """Id of a new entry, the same whenever the same name is created.

    The length in front tells where the namespace ends, whatever signs the two
    names hold.
    """
    ns = F.col(namespace) if isinstance(namespace, str) else namespace
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.length(ns).cast("string"), F.lit(":"), ns, k))


# -- entries ---------------------------------------------------------------


def metadata_set(
    metadata: DataFrame, updates: DataFrame, *, now: Column | None = None, user: str | None = None
) -> DataFrame:
    """Create or update entries; the map of an existing entry is replaced.

    ``updates`` holds ``namespace, key, value``, one row per name. Existing
    entries keep their id and creation; both sides are unique in the join key.
    """
    stamp = F.current_timestamp() if now is None else now
    by = F.lit(user).cast("string")
    o, u = metadata.alias("o"), updates.select(*NAME, "value").alias("u")
    touched = F.col("u.value").isNotNull()
    known = F.col("o.metadata_id").isNotNull()
    return o.join(u, NAME, "full_outer").select(
        F.coalesce("o.metadata_id", metadata_id_of("namespace", "key")).alias("metadata_id"),
        *NAME,
        F.coalesce("u.value", "o.value").alias("value"),
        F.when(known, F.col("o.created")).otherwise(stamp).alias("created"),
        F.when(known, F.col("o.created_by")).otherwise(by).alias("created_by"),
        F.when(touched, stamp).otherwise(F.col("o.last_modified")).alias("last_modified"),
        F.when(touched, by).otherwise(F.col("o.last_modified_by")).alias("last_modified_by"),
    )


def metadata_conflicts(metadata: DataFrame, updates: DataFrame) -> DataFrame:
    """Existing entries that ``updates`` would overwrite."""
    return metadata.join(updates.select(*NAME), NAME, "left_semi")


def create_metadata(
    metadata: DataFrame, updates: DataFrame, *, overwrite: bool = False, **audit
) -> DataFrame:
    """As :func:`metadata_set`, but an existing entry is an error unless
    ``overwrite`` is given."""
    if not overwrite and not metadata_conflicts(metadata, updates).isEmpty():
        raise ValueError("an entry of this name is there; it is kept unless overwrite is set")
    return metadata_set(metadata, updates, **audit)


def metadata_get(
    metadata: DataFrame,
    metadata_id: str | None = None,
    namespace: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """One entry, by id or by namespace and key; the id goes first."""
    if metadata_id:
        return metadata.filter(F.col("metadata_id") == metadata_id)
    if namespace and key:
        return metadata.filter((F.col("namespace") == namespace) & (F.col("key") == key))
    raise ValueError("give either metadata_id or namespace and key")


def metadata_lookup(metadata: DataFrame, names: DataFrame) -> DataFrame:
    """Entries of many names at once; ``names`` holds ``namespace, key``."""
    return lookup_join(metadata, names.select(*NAME).distinct(), NAME, "left_semi")


def metadata_browse(metadata: DataFrame, namespace: str | None = None) -> DataFrame:
    """All namespaces, or the keys of one, sorted."""
    if not namespace:
        return metadata.select("namespace").distinct().orderBy("namespace")
    return metadata.filter(F.col("namespace") == namespace).select("key").distinct().orderBy("key")


def metadata_search(metadata: DataFrame, namespace: str, key: str | None = None) -> DataFrame:
    """Entries of exactly this namespace whose key begins with ``key``."""
    hits = metadata.filter(F.col("namespace") == namespace)
    return hits.filter(F.col("key").startswith(key)) if key else hits


def metadata_delete(
    metadata: DataFrame, links: DataFrame, ids: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Entries and links without the entries in ``ids``."""
    gone = ids.select("metadata_id").distinct()
    return (
        lookup_join(metadata, gone, ["metadata_id"], "left_anti"),
        lookup_join(links, gone, ["metadata_id"], "left_anti"),
    )


# -- links -----------------------------------------------------------------


def link_metadata(links: DataFrame, new: DataFrame) -> DataFrame:
    """Links with ``new`` ones added; a link exists once."""
    return links.unionByName(new.select("series_id", "metadata_id")).distinct()


def unlink_metadata(links: DataFrame, gone: DataFrame) -> DataFrame:
    """Links without those in ``gone``; the entries stay."""
    broken = gone.select("series_id", "metadata_id").distinct()
    return links.join(broken, ["series_id", "metadata_id"], "left_anti")


def names_an_entry(metadata_id, namespace, key) -> bool:
    """Whether an entry is meant by its id (True) or its full name (False)."""
    if not metadata_id and not (namespace and key):
        raise ValueError("an entry goes by its id or by namespace and key together")
    return bool(metadata_id)


# -- search ----------------------------------------------------------------


def hierarchical(*args) -> list:
    """Arguments up to the first None; warns if a later one is given."""
    kept = list(args)
    if None in kept:
        cut = kept.index(None)
        if any(a is not None for a in kept[cut:]):
            warnings.warn("a None ends the criteria: those behind it play no part")
        kept = kept[:cut]
    return kept


def value_matches(text: Column, pattern: str) -> Column:
    """Partial match; a star stands for any text, also inside the pattern:
    ``abc*`` begins with, ``*abc`` ends with, ``a*b*c`` holds all in this
    order. Text without a star is found anywhere."""
    plain = re.sub(r"([%_\\])", r"\\\1", pattern)
    return text.like(plain.replace("*", "%") if "*" in pattern else f"%{plain}%")


def matching_entries(metadata: DataFrame, args: list) -> DataFrame:
    """Entries that satisfy namespace, key, name and value, as far as given."""
    hits = metadata_search(metadata, args[0], args[1] if len(args) > 1 else None)
    if len(args) > 2:
        hits = hits.filter(F.map_contains_key("value", args[2]))
    if len(args) > 3:
        named = F.try_element_at("value", F.lit(args[2]))
        hits = hits.filter(value_matches(named, str(args[3])))
    return hits


def value_json(value: str | Column = "value") -> Column:
    return F.to_json(value)


def search(
    links: DataFrame,
    metadata: DataFrame,
    namespace: str,
    key: str | None = None,
    name: str | None = None,
    value=None,
) -> DataFrame:
    """Series linked to an entry that matches.

    With ``value``: the distinct series ids. Otherwise one row per series and
    matching entry: ``series_id, metadata_id, namespace, key, value_json``.
    """
    args = hierarchical(namespace, key, name, value)
    if not args:
        raise ValueError("namespace is mandatory")
    hits = matching_entries(metadata, args)
    if len(args) == 4:
        # Not settled: whoever uses the ids does that once, and sizes are known at run time.
        found = links.join(hits.select("metadata_id"), "metadata_id", "left_semi")
        return found.select("series_id").distinct()
    entries = hits.select("metadata_id", *NAME, value_json().alias("value_json"))
    return links.join(entries, "metadata_id").select(
        "series_id", "metadata_id", *NAME, "value_json"
    )


# -- entries and series together -------------------------------------------


def _entries(metadata: DataFrame) -> DataFrame:
    return metadata.select("metadata_id", *NAME, value_json().alias("value_json"))


def metadata_with_series(
    metadata: DataFrame, links: DataFrame, extents: DataFrame
) -> DataFrame:
    """Every entry with the series attached to it and their extents.

    One row per link; an entry without series has one row with NULLs. Plain
    joins on unique keys: adaptive execution splits an entry that very many
    series share.
    """
    linked = links.join(extents.select("series_id", "first_index", "last_index"), "series_id", "left")
    return _entries(metadata).join(linked, "metadata_id", "left").select(
        "metadata_id", *NAME, "value_json", "series_id", "first_index", "last_index"
    )


def series_info(extents: DataFrame, links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every series with its extent, aliases and metadata.

    ``extents`` has one row per series: id, extent, aliases. One row per link;
    a series without metadata has one row with NULLs.
    """
    linked = links.join(_entries(metadata), "metadata_id")
    return extents.join(linked, "series_id", "left").select(
        *extents.columns, "metadata_id", *NAME, "value_json"
    )
