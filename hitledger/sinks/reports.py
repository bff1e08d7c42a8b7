"""Stored reports: flat tables by report day, and the JSON document."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from hitledger.operators.report import LINE_ORDER, report_json_lines
from hitledger.sources.paths import file_system

BY_DAY = "report_date"


def report_date(as_of: date) -> date:
    """A report is named after the last full day before it."""
    return as_of - timedelta(days=1)


def table_path(root: str, name: str, day: date) -> str:
    """Folder of one report day; ``report_date`` is a partition column of ``<root>/<name>``."""
    return f"{root.rstrip('/')}/{name}/{BY_DAY}={day.isoformat()}"


def write_report_table(rows: DataFrame, root: str, name: str, day: date) -> str:
    """Replace one report day of a table, also by no rows at all; returns its folder."""
    path = table_path(root, name, day)
    rows.write.mode("overwrite").parquet(path)
    return path


def drop_report_table(spark: SparkSession, root: str, name: str, day: date) -> None:
    """Remove one report day of a table."""
    fs, folder = file_system(spark, table_path(root, name, day))
    fs.delete(folder, True)


def json_path(prefix: str, day: date) -> str:
    folder = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    return f"{folder}bot-report-{day.isoformat()}.json"


def write_report_json(
    rollup: DataFrame, prefix: str, as_of: date, generated_at: str, days_back: int
) -> str:
    """Write the report document; returns its folder.

    The parts of the folder, one after the other, are one JSON document. The sort is
    by range, so a document of any size is written by many tasks.
    """
    path = json_path(prefix, report_date(as_of))
    lines = report_json_lines(rollup, as_of, generated_at, days_back)
    lines.orderBy(*LINE_ORDER).select("line").write.mode("overwrite").text(path)
    return path
