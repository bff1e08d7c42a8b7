"""Crawler counts from the logs against counts a search engine reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def crawl_comparison(rollup: DataFrame, recorded: DataFrame, bot_name: str = "GoogleBot") -> DataFrame:
    """Per day: ``hits`` in the logs, ``crawls`` on record, and the smaller as ``matched``.

    Days that only one side knows count 0 on the other.
    """
    hits = rollup.where(F.col("bot_name") == bot_name).groupBy("date").agg(F.sum("requests").alias("hits"))
    crawls = recorded.groupBy("date").agg(F.sum("crawls").alias("crawls"))
    return hits.join(crawls, "date", "full_outer").select(
        "date",
        F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"),
        F.coalesce("crawls", F.lit(0)).cast("bigint").alias("crawls"),
        F.least(F.coalesce("hits", F.lit(0)), F.coalesce("crawls", F.lit(0))).cast("bigint").alias("matched"),
    )


def crawl_accuracy(comparison: DataFrame) -> DataFrame:
    """One row: matched crawls as a share of those on record, null when none are."""
    return comparison.agg(
        F.sum("matched").alias("matched"), F.sum("crawls").alias("crawls")
    ).select("matched", "crawls", F.try_divide("matched", "crawls").alias("accuracy"))
