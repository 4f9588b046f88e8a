from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.timeaxis import (
    UNIT_SPELLINGS,
    bin_start,
    day_of,
    normalize_period,
    parse_bound,
    parse_range,
    period_ns,
    to_index,
    to_timestamp,
)
from tidemark.schema import NS_PER_DAY, OPEN_END, OPEN_START


@pytest.mark.parametrize("unit, spelling", [(u, s) for u, names in UNIT_SPELLINGS.items() for s in names])
def test_period_spellings(unit, spelling):
    assert normalize_period(spelling) == (1, unit)
    for count in (2, 7, 360):
        for text in (f"{count}{spelling}", f" {count} {spelling}", f"{count}{spelling.capitalize()}"):
            assert normalize_period(text) == (count, unit)


def test_period_lengths():
    assert period_ns("2h") == 7_200_000_000_000
    assert period_ns("5tick") == 500
    assert period_ns("3microsecond") == 3_000


@pytest.mark.parametrize("period", ["0.1s", "0m", "5d", "", "m5", "-1s"])
def test_bad_periods(period):
    with pytest.raises(ValueError):
        period_ns(period)


JAN_2 = 1704153600000000000


@pytest.mark.parametrize(
    "bound",
    [
        JAN_2,
        np.int64(JAN_2),
        float(JAN_2),
        "2024-01-02",
        "02/01/2024",
        "2024-01-02T00:00:00+00:00",
        "2024-01-02T01:00:00+01:00",
        datetime(2024, 1, 2),
        date(2024, 1, 2),
        datetime(2024, 1, 2, 2, tzinfo=timezone(timedelta(hours=2))),
        pd.Timestamp("2024-01-02"),
        np.datetime64("2024-01-02"),
    ],
)
def test_bounds(bound):
    assert parse_bound(bound) == JAN_2


def test_bound_keeps_nanoseconds():
    assert parse_bound("2024-01-02T00:00:00.123456789Z") == JAN_2 + 123456789


def test_range_rules():
    assert parse_range(None, None) == (None, None)
    assert parse_range(0, 1) == (0, 1)
    for start, end in ((1, 1), (2, 1), ("2024-01-02", "2024-01-01")):
        with pytest.raises(ValueError):
            parse_range(start, end)
    with pytest.raises(ValueError):
        parse_bound(True)


def test_day_and_bin_round_down(spark):
    points = [0, -1, NS_PER_DAY - 1, NS_PER_DAY, -NS_PER_DAY, -NS_PER_DAY - 1, OPEN_START, OPEN_END]
    df = spark.createDataFrame([(p,) for p in points], "i bigint")
    rows = df.select("i", day_of("i").alias("day"), bin_start("i", 7_000).alias("bin")).collect()
    for row in rows:
        assert row.day == row.i // NS_PER_DAY
        assert row.bin == row.i - row.i % 7_000


def test_timestamps_and_back(spark):
    df = spark.createDataFrame([(1_500,), (-1,), (JAN_2,)], "i bigint")
    shown = df.select(to_timestamp("i").cast("string").alias("t")).collect()
    assert [r.t for r in shown] == [
        "1970-01-01 00:00:00.000001",
        "1969-12-31 23:59:59.999999",
        "2024-01-02 00:00:00",
    ]
    back = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02' AS a, TIMESTAMP'2024-01-02 01:00:00+01:00' AS b")
    assert back.select(to_index("a"), to_index("b")).first() == (JAN_2, JAN_2)
    assert df.select(F.max(to_index(to_timestamp("i")))).first()[0] == JAN_2
