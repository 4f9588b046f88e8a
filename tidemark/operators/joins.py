"""Joining a large table to a lookup whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle, stored_bytes

# A lookup is broadcast up to this many bytes of Parquet, counted after it was
# written; of compressed keys that is some hundred megabytes in memory at most.
MAX_BROADCAST_BYTES = 8 * 1024 * 1024

# Beyond that the rows of each key are spread over this many shuffle keys.
SALTS = 16


def fits_broadcast(settled: DataFrame) -> bool:
    """Whether a frame that was settled is small enough to send to all executors."""
    return stored_bytes(settled) <= MAX_BROADCAST_BYTES


def _salt(big: DataFrame, lookup: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    hashable = [
        F.col(f"`{f.name}`") for f in big.schema if not isinstance(f.dataType, T.MapType)
    ]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return big.withColumn("_salt", salt), lookup.withColumn("_salt", copies)


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    salts: int = SALTS,
    small: bool | None = None,
) -> DataFrame:
    """Join ``big`` to ``lookup`` (inner, left, left_semi or left_anti).

    The lookup is computed once, by one job, whatever it is made from; its size
    is then that of its files. A small one is broadcast, and ``big`` is not shuffled
    at all. A larger one is copied once per salt, so that no task gets all
    rows of a hot key: a key holding a third of ``big`` becomes ``salts``
    shuffle keys, and adaptive execution splits those further if need be.
    ``small`` passes on the size of a lookup that is settled already.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join: {how}")
    if small is None:
        lookup = settle(lookup)
        small = fits_broadcast(lookup)
    if small:
        return big.join(F.broadcast(lookup), keys, how)
    salted_big, salted_lookup = _salt(big, lookup, salts)
    return salted_big.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")


def lookup_split(
    big: DataFrame, lookup: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``big`` whose key is in ``lookup``, and all others."""
    lookup = settle(lookup)
    small = fits_broadcast(lookup)
    found = lookup_join(big, lookup, keys, "left_semi", small=small)
    others = lookup_join(big, lookup, keys, "left_anti", small=small)
    return found, others
