"""Table schemas and the constants of the time axis.

An index is a 64-bit integer: nanoseconds since 1970-01-01T00:00Z for a time
series, a plain increasing counter for a sequence. Spark timestamps stop at
microseconds, so every range, bin and day is computed on the integer.
"""

from __future__ import annotations

from pyspark.sql import types as T

NS_PER_US = 1_000
NS_PER_TICK = 100
NS_PER_DAY = 86_400_000_000_000

# The default bounds of an open range.
OPEN_START = -9_214_560_000_000_000_000  # 1678-01-01
OPEN_END = 9_214_646_400_000_000_000  # 2262-01-01

# The extent reported for a series without samples.
EMPTY_FIRST = 0
EMPTY_LAST = -1

SAMPLES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("value_text", T.StringType()),
    ]
)

# One row per uploaded sample. file_seq grows with every upload and decides
# which value wins where uploads overlap.
SAMPLES_RAW = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("file_seq", T.LongType()),
        T.StructField("file_id", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("value_text", T.StringType()),
        T.StructField("day", T.IntegerType()),
    ]
)

# One row per series, upload and day: what the upload holds.
MANIFEST = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("file_seq", T.LongType()),
        T.StructField("file_id", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("first_index", T.LongType()),
        T.StructField("last_index", T.LongType()),
        T.StructField("n_samples", T.LongType()),
    ]
)

# One row per uploaded file; a failed one has no extent.
RECEIPTS = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("file_id", T.StringType()),
        T.StructField("first_index", T.LongType()),
        T.StructField("last_index", T.LongType()),
        T.StructField("state", T.StringType()),
    ]
)

SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("aliases", T.ArrayType(T.StringType())),
        T.StructField("created", T.TimestampType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("metadata_id", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.MapType(T.StringType(), T.StringType())),
        T.StructField("created", T.TimestampType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("last_modified_by", T.StringType()),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("metadata_id", T.StringType()),
    ]
)

# The upload listing of a series: files in upload order, one chunk per day.
MANIFEST_JSON = T.StructType(
    [
        T.StructField(
            "Files",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Index", T.IntegerType()),
                        T.StructField("FileId", T.StringType()),
                        T.StructField(
                            "Chunks",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("Path", T.StringType()),
                                        T.StructField("Endpoint", T.StringType()),
                                        T.StructField("ContentMd5", T.StringType()),
                                        T.StructField("DaysSinceEpoch", T.IntegerType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

PAGE_JSON = T.StructType(
    [
        T.StructField(
            "value",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Timestamp", T.StringType()),
                        T.StructField("Value", T.DoubleType()),
                    ]
                )
            ),
        )
    ]
)
