"""The stored report of a day: looked up, or built when it is missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hitledger.operators import report as r
from hitledger.plans.landing import refresh_rollup
from hitledger.plans.store import STARTED, Store, bot_rollup
from hitledger.sinks.reports import drop_report_table, report_date, table_path, write_report_json, write_report_table
from hitledger.sources.bots import Bot, list_mark
from hitledger.sources.table import read_or_empty

REQUESTS, SUMMARY = "requests_by_path", "summary"
TABLES = [SUMMARY, "overview", "daily", "paths", "top_paths"]


def yesterday() -> date:
    return datetime.now(timezone.utc).date() - timedelta(days=1)


def read_report(spark: SparkSession, root: str, day: date) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(table_path(root, name, day)) for name in TABLES}


class Marks(NamedTuple):
    """What a report was made from: a crawler list, and the loads whose requests reach into its window."""

    crawlers: str
    loads: str


def report_marks(spark: SparkSession, store: Store, bots: Sequence[Bot], as_of: date, days_back: int = r.DAYS_BACK) -> Marks:
    """The marks that a report as of a day would have now; the record of files is read, not the log."""
    start = r.window_start(as_of, days_back)
    held = store.read_landed(spark).where((F.col("last_date") >= F.lit(start)) | (F.col("status") == STARTED))
    one = F.xxhash64("source_file", "loaded", "status", "parsed")
    found = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(one), F.lit(0)).alias("x")).first()
    return Marks(list_mark(bots), f"{found.n}:{found.x}")


def has_report(spark: SparkSession, root: str, day: date, marks: Marks | None = None) -> bool:
    """The summary is written last, so a report that has one is whole. With ``marks``, it must also bear these."""
    schema = T.StructType.fromDDL("window_to DATE, crawlers STRING, loads STRING")
    summary = read_or_empty(
        spark, table_path(root, SUMMARY, day), schema, spark.read.schema(schema).parquet
    )
    if marks is not None:
        summary = summary.where((F.col("crawlers") == marks.crawlers) & (F.col("loads") == marks.loads))
    return not summary.isEmpty()


def build_report(
    requests: DataFrame, bots: Sequence[Bot], root: str, as_of: date,
    days_back: int = r.DAYS_BACK, slack_days: int | None = None, json_prefix: str | None = None,
) -> None:
    """Write the report as of a day. The log is read once, into the rollup of the window.

    The rollup is a written table, so everything after it starts from files rather
    than from the log when an executor is lost.
    """
    window = r.in_window(requests, as_of, days_back, slack_days)
    store_report(r.bot_path_daily(window, bots), root, as_of, days_back, json_prefix)


def build_report_from_rollup(
    file_rollup: DataFrame, root: str, as_of: date, days_back: int = r.DAYS_BACK,
    json_prefix: str | None = None, marks: Marks | None = None,
) -> None:
    """The same report out of the rollup kept per file, without reading the log."""
    window = r.in_window(file_rollup, as_of, days_back)
    store_report(r.merge_rollups(window), root, as_of, days_back, json_prefix, marks)


def store_report(
    rollup: DataFrame, root: str, as_of: date, days_back: int, json_prefix: str | None = None, marks: Marks | None = None
) -> None:
    """Write all tables of a report. The old summary goes first and the new one comes last, so
    that a rebuild that breaks off leaves no report that looks whole."""
    day = report_date(as_of)
    drop_report_table(rollup.sparkSession, root, SUMMARY, day)
    stored = rollup.sparkSession.read.parquet(write_report_table(rollup, root, REQUESTS, day))
    write_report_table(r.bot_overview(stored), root, "overview", day)
    write_report_table(r.bot_daily(stored), root, "daily", day)
    write_report_table(r.bot_paths(stored), root, "paths", day)
    write_report_table(r.top_paths_per_bot(stored), root, "top_paths", day)
    if json_prefix is not None:
        now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"
        write_report_json(stored, json_prefix, as_of, now, days_back)
    summary = r.overall_summary(stored, as_of, days_back)
    for name, mark in zip(Marks._fields, marks or (None, None)):
        summary = summary.withColumn(name, F.lit(mark).cast("string"))
    write_report_table(summary, root, SUMMARY, day)


def get_or_build_report(
    spark: SparkSession, store: Store, bots: Sequence[Bot], root: str, day: date | None = None,
    days_back: int = r.DAYS_BACK,
) -> dict[str, DataFrame]:
    """The report of ``day`` (yesterday by default, UTC), built first when there is none for this crawler list and these loads.

    A report bears the marks of what it was made from, so another list, or files that came late, came again or expired since,
    make it be built anew. It is built from the rollup kept per file, of which only partitions with requests
    in the window are opened. Files that the rollup by this list lacks, as all do after the list changed, are added to it first.
    """
    day = day or yesterday()
    as_of = day + timedelta(days=1)
    marks = report_marks(spark, store, bots, as_of, days_back)
    if not has_report(spark, root, day, marks):
        refresh_rollup(spark, store, bots)
        rollup = store.read_window(spark, r.window_start(as_of, days_back), bot_rollup(bots))
        build_report_from_rollup(rollup, root, as_of, days_back, marks=marks)
    return read_report(spark, root, day)
