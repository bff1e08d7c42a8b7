"""Crawl counts exported by a search engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_crawl_stats(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and the columns ``date`` (ISO) and ``crawls``."""
    return spark.read.schema("date DATE, crawls BIGINT").option("header", True).csv(path)
