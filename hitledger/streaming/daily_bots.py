"""Counts of requests per crawler and UTC day, kept up by the landing stream.

Every file brings its own counts by UTC day in the rollup kept per file, and reading sums
them. There is no state and no watermark: a replayed file replaces its counts, and a request
dated far ahead or far back is counted on its day like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hitledger.operators.report import utc_daily
from hitledger.plans.store import Store
from hitledger.sources.bots import Bot


def read_daily_bots(spark: SparkSession, store: Store, bots: Sequence[Bot]) -> DataFrame:
    """``utc_date, bot_name, requests`` over all files landed so far."""
    return utc_daily(store.read_rollup(spark, bots))
