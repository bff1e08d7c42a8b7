"""The parsed table, its CSV form, and what to do when neither exists yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from hitledger.schema import CSV_SCHEMA
from hitledger.sources.paths import path_exists


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, read) -> DataFrame:
    """``read(path)``, or no rows when nothing is there yet; other errors are raised."""
    if path_exists(spark, path):
        return read(path)
    return spark.createDataFrame([], schema)


def read_access_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exported daily files as text columns.

    ``operators.report.with_text_dates`` turns the date into a DATE. Rows end at a
    newline only and values lose the white space around them, which also takes the
    carriage return some writers put before the newline.
    """
    reader = (
        spark.read.schema(CSV_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("recursiveFileLookup", True)
    )
    return read_or_empty(spark, path, CSV_SCHEMA, reader.csv)
