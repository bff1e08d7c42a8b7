"""Expiry of old files by day."""

from __future__ import annotations

import re
import time
from datetime import date, timedelta

from pyspark.sql import SparkSession, functions as F

from hitledger.plans.store import EXPIRED, Store
from hitledger.sources.paths import file_system
from hitledger.sources.raw import DATE_TEXT


def expire_raw_logs(
    spark: SparkSession, root: str, as_of: date, keep_days: int, dry_run: bool = True
) -> list[str]:
    """``date=`` folders below ``root`` older than ``keep_days``; deleted unless a dry run.

    The listing has one entry per day. Folders with other names are left alone.
    """
    limit = as_of - timedelta(days=keep_days)
    old = [path for day, paths in _day_folders(spark, root, "date").items() if day < limit for path in paths]
    fs, _ = file_system(spark, root)
    if not dry_run:
        for path in old:
            fs.delete(path, True)
    return sorted(path.toString() for path in old)


def _day_folders(spark: SparkSession, root: str, name: str) -> dict[date, list]:
    """Folders ``<name>=<day>`` directly below ``root``: one listing, with an entry per day."""
    fs, folder = file_system(spark, root)
    found: dict[date, list] = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        match = re.fullmatch(f"{name}=({DATE_TEXT})", status.getPath().getName())
        if match and status.isDirectory():
            found.setdefault(date.fromisoformat(match[1]), []).append(status.getPath())
    return found


def expire_store(spark: SparkSession, store: Store, as_of: date, keep_days: int, dry_run: bool = True) -> list[date]:
    """File days older than ``keep_days`` in the parsed table and all tables beside it; deleted unless a dry run.

    The record keeps the files, as expired, so that they are not landed again while their raw files are still there. A
    catalog table over the store forgets them when it is registered again.
    """
    limit = as_of - timedelta(days=keep_days)
    fs, _ = file_system(spark, store.root)
    found = [_day_folders(spark, root, "log_date") for root in (store.access, store.rejects, *store.derived_roots(spark))]
    old = sorted({day for days in found for day in days if day < limit})
    if dry_run:
        return old
    loaded = time.time_ns() // 1000
    held = store.read_landed(spark).where((F.col("log_date") < F.lit(limit)) & (F.col("status") != EXPIRED))
    gone = held.select(
        *[F.col(n) for n in ("source_file", "log_date", "bucket", "length", "modified")],
        F.lit(loaded).cast("long").alias("loaded"), F.lit(EXPIRED).alias("status"), F.lit(None).cast("string").alias("reason"),
        F.lit(0).cast("long").alias("parsed"), F.lit(0).cast("long").alias("rejected"),
        F.lit(None).cast("date").alias("first_date"), F.lit(None).cast("date").alias("last_date"),
    )
    if not held.isEmpty():
        gone.write.mode("append").json(store.landed)
    for days in found:
        for day, folders in days.items():
            for folder in folders if day < limit else []:
                fs.delete(folder, True)
    return old
