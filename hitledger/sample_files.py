"""File listings, keys and notifications derived from an ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The same text runs in other SQL dialects; {DAY} is the day of the event as text,
# {SHIFTED} a day up to thirty days earlier or later.
FILE_NAME_SQL = """
case event_id % 6
  when 0 then concat('access.log-', {DAY}, '.gz')
  when 1 then concat('access.log-', {DAY}, '.txt')
  when 2 then concat('error.log-', {DAY}, '.gz')
  when 3 then concat('access.log-', replace({DAY}, '-', ''), '.gz')
  when 4 then concat('access.log-', {DAY}, '.gz')
  else concat('access.log-', {SHIFTED}, '.gz') end
"""
KEY_SQL = """
case event_type
  when 'error' then concat('raw/date=', {DAY}, '/error.log')
  when 'view' then concat('other/date=', {DAY}, '/access.log-', {DAY}, '.gz')
  else concat('raw/date=', {DAY}, '/access.log-', {DAY}, '-', cast(user_id as varchar(20)), '.gz') end
"""
NOTIFICATION_SQL = """
concat('{"Records":[{"s3":{"bucket":{"name":"', case when event_type = 'view' then 'other' else 'logs' end,
  '"},"object":{"key":"raw/date%3D', {DAY}, '/access+log-', cast(user_id as varchar(20)),
  case when event_type = 'error' then '.txt' else '.gz' end, '"}}},',
  '{"s3":{"bucket":{"name":"logs"},"object":{"key":"parsed/', {DAY}, '.gz"}}}]}')
"""

DAY_SPARK = "cast(to_date(ts) as string)"
SHIFTED_SPARK = "cast(date_add(to_date(ts), cast(user_id % 61 - 30 as int)) as string)"


def fill(sql: str, day: str, shifted: str = "") -> str:
    return sql.replace("{DAY}", day).replace("{SHIFTED}", shifted).strip()


def files_from_events(events: DataFrame) -> DataFrame:
    name = F.expr(fill(FILE_NAME_SQL, DAY_SPARK, SHIFTED_SPARK))
    return events.select(
        F.concat(F.lit("site"), F.col("user_id").cast("string"), F.lit("/"), name).alias("path"),
        name.alias("filename"),
        (F.col("event_id") % 6 != 4).alias("is_file"),
    )


def landed_from_events(events: DataFrame) -> DataFrame:
    """Keys of files that have landed: those of working days."""
    workday = F.weekday("ts") < 5
    return events.where(workday).select(
        F.expr(f"concat('raw/date=', {DAY_SPARK}, '/access.log-', {DAY_SPARK}, '.gz')").alias("key")
    )


def keys_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.expr(fill(KEY_SQL, DAY_SPARK)).alias("key"))


def notifications_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.expr(fill(NOTIFICATION_SQL, DAY_SPARK)).alias("event"))
