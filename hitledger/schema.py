"""Column layouts shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The order of the columns of an exported daily file.
CSV_COLUMNS = [
    "date", "timestamp", "ip", "host", "method", "path", "protocol", "status",
    "body_bytes_sent", "referrer", "user_agent", "tls", "time1", "time2", "time3",
    "cache_status", "extra_5", "extra_6", "extra_7",
]

CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in CSV_COLUMNS])

# One parsed request. ``date`` is the calendar day in the line's own offset,
# ``ts`` the instant; ``timestamp`` text is rebuilt from ts and tz_offset on export.
ACCESS_LOG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("tz_offset", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body_bytes_sent", T.LongType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("tls", T.StringType()),
        T.StructField("time1", T.DoubleType()),
        T.StructField("time2", T.DoubleType()),
        T.StructField("time3", T.DoubleType()),
        T.StructField("cache_status", T.StringType()),
        T.StructField("extra_5", T.StringType()),
        T.StructField("extra_6", T.StringType()),
        T.StructField("extra_7", T.StringType()),
    ]
)

# Every stored row knows its file. Tables are partitioned by the file's day and a hash bucket of its name.
FILE_COLUMNS = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
PLACE = ["log_date", "bucket"]
ACCESS_TABLE = T.StructType(ACCESS_LOG.fields + FILE_COLUMNS.fields)

# A line that did not parse, why, and by which grammar it was tried.
REJECTS = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("grammar", T.StringType()),
    ]
    + FILE_COLUMNS.fields
)

BOTS = T.StructType(
    [
        T.StructField("ord", T.IntegerType(), False),
        T.StructField("bot_name", T.StringType(), False),
        T.StructField("patterns", T.ArrayType(T.StringType()), False),
        T.StructField("regex", T.StringType(), False),
        T.StructField("ip_ranges", T.ArrayType(T.StringType()), False),
        T.StructField("is_llm", T.BooleanType(), False),
    ]
)

# Requests per file, day, UTC day, crawler and page: the stored form of the base rollup.
FILE_ROLLUP = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("bot_name", T.StringType()),
        T.StructField("is_llm", T.BooleanType()),
        T.StructField("path", T.StringType()),
        T.StructField("requests", T.LongType()),
        T.StructField("utc_date", T.DateType()),
    ]
    + FILE_COLUMNS.fields
)


def _by_file(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()] + FILE_COLUMNS.fields)


# What else may be kept by file: pages of a crawler in order, visits per panel and key, and the same with sketches of the visitors.
PAGE_LISTS = _by_file(bot_name=T.StringType(), path=T.StringType(), requests=T.LongType(), rank=T.IntegerType())
PANEL_VISITS = _by_file(
    panel=T.StringType(), keys=T.ArrayType(T.StringType()), ip=T.StringType(), _agent=T.StringType(), date=T.DateType(),
    hits=T.LongType(), bytes=T.LongType(),
)
PANEL_SKETCHES = _by_file(
    panel=T.StringType(), keys=T.ArrayType(T.StringType()), hits=T.LongType(), bytes=T.LongType(), visitors=T.BinaryType()
)

# One attempt at landing a file; ``loaded`` is when, in microseconds. What follows ``reason`` is what the
# table holds of the file since then: lines parsed and rejected, and the earliest and latest date of a request.
LANDED = T.StructType(
    FILE_COLUMNS.fields
    + [
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("parsed", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
    ]
)

# One load of a file that a table derived from the parsed one holds.
DERIVED = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("loaded", T.LongType())])

NOTIFICATION = (
    "struct<Records: array<struct<s3: struct<"
    "bucket: struct<name: string>, object: struct<key: string>>>>>"
)
