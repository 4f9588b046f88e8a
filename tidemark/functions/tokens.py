"""Text of a chunk line: index token, value token, file keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast also takes suffixes such as '1d' and '1.5f', which are text here.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
NOT_A_NUMBER = r"(?i)^\s*[+-]?nan\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"


def is_missing(token: Column) -> Column:
    """No token, or an empty one: a missing value of either kind."""
    return token.isNull() | (token == "")


def is_numeric(token: Column) -> Column:
    """Does the token read as a float? NULL for a missing token."""
    reads = token.rlike(NUMBER) | token.rlike(INFINITE) | token.rlike(NOT_A_NUMBER)
    return F.when(~is_missing(token), reads)


def to_number(token: Column) -> Column:
    """The float a numeric token stands for. NaN is a missing value: NULL."""
    return F.when(token.rlike(NUMBER) | token.rlike(INFINITE), token.try_cast("double"))


def try_index(token: Column) -> Column:
    """Index token as a 64-bit integer, NULL where it is none."""
    return F.when(token.rlike(INTEGER), token.try_cast("bigint"))


def to_index_strict(token: Column) -> Column:
    """Index token as a 64-bit integer; a bad token stops the job."""
    problem = F.concat(F.lit("not an integer index: "), F.coalesce(token, F.lit("(none)")))
    return F.coalesce(try_index(token), F.raise_error(problem).cast("bigint"))


def chunk_key(path: Column) -> Column:
    """File path without separators, the name a stored chunk goes by."""
    return F.concat(F.lit("parquet"), F.regexp_replace(path, r"[-_/.]", ""))


def urlsafe_base64(text: Column) -> Column:
    return F.translate(F.base64(F.encode(text, "UTF-8")), "+/", "-_")
