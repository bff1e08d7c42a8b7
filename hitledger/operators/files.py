"""Which log files to land, what they are called, what arrived."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.schema import NOTIFICATION

DATE_SLOT = "{date}"
MAX_DAYS = 30
DAY_SECONDS = 86_400


def template_parts(template: str) -> tuple[str, str]:
    if DATE_SLOT not in template:
        raise ValueError(f"file name template must contain {DATE_SLOT}")
    before, _, after = template.partition(DATE_SLOT)
    return before, after


def select_log_files(
    files: DataFrame, template: str, now: datetime, max_days: float = MAX_DAYS
) -> DataFrame:
    """Regular files named by ``template`` whose day is complete and recent enough.

    ``files`` has ``path``, ``filename`` and ``is_file``; ``now`` is UTC. Age runs from
    midnight of the file's day and is a fraction of days, so at half past midnight a
    file exactly ``max_days`` old is already too old. Today's file is never complete.
    """
    before, after = template_parts(template)
    name = F.col("filename")
    room = F.char_length(name) - (len(before) + len(after))
    day = F.substr(name, F.lit(len(before) + 1), F.greatest(room, F.lit(0)))
    named = (
        F.col("is_file") & F.startswith(name, F.lit(before)) & F.endswith(name, F.lit(after))
    )
    dated = F.when(named & F.rlike(day, F.lit(r"^\d{4}-\d{2}-\d{2}\z")), F.try_to_date(day, "yyyy-MM-dd"))
    midnight = F.unix_date("file_date").cast("bigint") * DAY_SECONDS
    age = F.lit((now - datetime(1970, 1, 1)).total_seconds()) - midnight
    return (
        files.select("*", dated.alias("file_date"))
        .where(
            (F.col("file_date") != F.lit(now.date()))
            & (age >= 0)
            & (age <= max_days * DAY_SECONDS)
        )
    )


def landed_names(keys: DataFrame) -> DataFrame:
    """Distinct file names of the landed ``key`` values; the directory does not count."""
    name = F.substring_index("key", "/", -1)
    return (
        keys.where(F.contains("key", F.lit("/")))
        .select(name.alias("filename"))
        .where(F.col("filename") != "")
        .distinct()
    )


def new_log_files(candidates: DataFrame, landed: DataFrame) -> DataFrame:
    """Candidates whose file name has not landed yet."""
    return candidates.join(landed, "filename", "left_anti")


def file_sync_summary(candidates: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: candidates, how many are present already, how many are to be copied.

    Names are counted before the join, so it moves one row per name.
    """
    counted = candidates.groupBy("filename").agg(F.count(F.lit(1)).alias("n"))
    marked = counted.join(landed.withColumn("present", F.lit(True)), "filename", "left")
    present = F.when(F.col("present"), F.col("n")).otherwise(0)
    return marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_candidates"),
        F.coalesce(F.sum(present), F.lit(0)).alias("already_present"),
        F.coalesce(F.sum(F.col("n") - present), F.lit(0)).alias("synced"),
    )


def landing_key(filename: Column, file_date: Column, root: str = "raw") -> Column:
    """Where a file lands: ``raw/date=<its day>/<its name>``."""
    return F.concat(F.lit(f"{root}/date="), file_date.cast("string"), F.lit("/"), filename)


def derive_output_key(key: Column, prefix: str = "parsed/") -> Column:
    """Key of the parsed file: ``raw/`` becomes ``prefix`` and ``.gz`` becomes ``.csv``."""
    prefix = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    bare = F.when(F.startswith(key, F.lit("raw/")), F.substr(key, F.lit(5))).otherwise(key)
    stem = F.when(
        F.endswith(bare, F.lit(".gz")), F.substr(bare, F.lit(1), F.char_length(bare) - 3)
    ).otherwise(bare)
    return F.concat(F.lit(prefix), stem, F.lit(".csv"))


def notification_files(
    events: DataFrame, bucket: str, prefix: str = "raw/", suffix: str = ".gz"
) -> DataFrame:
    """Files named by ``event`` notifications (JSON text) for one bucket.

    Keys arrive URL-encoded with ``+`` for a space. Prefix and suffix are what a
    notification rule lets through.
    """
    record = F.explode(F.from_json("event", NOTIFICATION)["Records"]).alias("record")
    raw = F.col("record.s3.object.key")
    decoded = F.coalesce(F.try_url_decode(raw), F.replace(raw, F.lit("+"), F.lit(" ")))
    return (
        events.select(record)
        .where(F.col("record.s3.bucket.name") == bucket)
        .select(F.lit(bucket).alias("bucket"), decoded.alias("key"))
        .where(F.startswith("key", F.lit(prefix)) & F.endswith("key", F.lit(suffix)))
    )
