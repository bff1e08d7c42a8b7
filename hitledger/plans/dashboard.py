"""The traffic dashboard as stored tables, one per panel and report day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.operators import traffic as t
from hitledger.plans.landing import refresh_derived
from hitledger.plans.store import VISITS, Store
from hitledger.sinks.reports import table_path, write_report_table


def build_dashboard(
    requests: DataFrame, root: str, day: date, keep_dates: int | None = None, max_items: int | None = None
) -> None:
    """Write every panel, from one scan of the requests.

    ``day`` only names the dashboard; requests are not filtered by it. ``keep_dates`` leaves only the last dates that
    occur, ``max_items`` only the busiest rows of each panel; without them nothing is left out.
    """
    _write(t.panel_rows(_recent(requests, keep_dates)), root, day, max_items)


def build_dashboard_from_store(
    spark: SparkSession, store: Store, root: str, day: date, keep_dates: int | None = None, max_items: int | None = None
) -> None:
    """The same from the visits kept by file (``VISITS``), without reading the log: a file that came again has replaced its own.

    Files that were landed before the store kept visits are added first.
    """
    refresh_derived(spark, store, VISITS)
    visits = _recent(store.read_derived(spark, VISITS), keep_dates)
    _write(t.panels_of_visits(t.merge_visits(visits)), root, day, max_items)


def _recent(rows: DataFrame, keep_dates: int | None) -> DataFrame:
    if keep_dates is None:
        return rows
    start = t.last_dates_start(rows, keep_dates).first().start
    return rows if start is None else rows.where(F.col("date") >= F.lit(start))


def _write(rows: DataFrame, root: str, day: date, max_items: int | None) -> None:
    stored = rows.sparkSession.read.parquet(write_report_table(rows, root, "panel_rows", day))
    for name, keys in t.PANELS.items():
        panel = t.one_panel(stored, name, keys)
        write_report_table(panel if max_items is None else t.top_items(panel, max_items), root, name, day)


def read_dashboard(spark: SparkSession, root: str, day: date) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(table_path(root, name, day)) for name in t.PANELS}
