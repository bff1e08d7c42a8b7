"""Names in the catalog, for ad-hoc SQL over the parsed logs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.functions.text import literal
from hitledger.operators.classify import name_bots
from hitledger.operators.report import bot_path_daily
from hitledger.plans.store import Store
from hitledger.schema import ACCESS_TABLE, PLACE
from hitledger.sinks.access import existing_places
from hitledger.sources.bots import Bot
from hitledger.sources.paths import qualified


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Table property: up to which load the partitions are known; loads of the last day before it are looked at again, as jobs may overlap.
_MARK, _OVERLAP = "hitledger.loaded", 86_400_000_000
#: Partitions named in one statement.
_PER_STATEMENT = 500


def register_access_table(
    spark: SparkSession, prefix: str, store: Store, table: str = "access_logs"
) -> str:
    """Create or update table ``<prefix>_<table>`` of database ``<prefix>_logs_db``; returns its full name.

    The table is a name for the store's requests. An existing one over the same
    files stays, with its grants and comments. Partitions that landing or retention changed since the last
    registration are added or dropped by the record of files; no other is looked at, so the time does not grow with
    old days. The catalog takes letters, digits and underscores only, so other characters of the prefix become underscores.
    """
    prefix = re.sub(r"\W", "_", prefix, flags=re.ASCII)
    database = f"{prefix}_logs_db"
    full = f"{_quote(database)}.{_quote(f'{prefix}_{table}')}"
    columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in ACCESS_TABLE if f.name not in PLACE)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(database)}")
    if spark.catalog.tableExists(full):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").collect()
        if [r.data_type for r in rows] != [qualified(spark, store.access)]:
            spark.sql(f"DROP TABLE {full}")  # a name for other files now
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({columns}, log_date DATE, bucket INT) "
        f"USING parquet PARTITIONED BY (log_date, bucket) LOCATION {literal(store.access)}"
    )
    _sync_partitions(spark, full, store)
    spark.catalog.refreshTable(full)
    return full


def _sync_partitions(spark: SparkSession, full: str, store: Store) -> None:
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
    since = int(properties.get(_MARK, 0))
    record = store.read_attempts(spark).where(F.col("loaded") > since - _OVERLAP)
    last = record.agg(F.max("loaded")).first()[0]
    if last is None or last == since:
        return
    changed = [tuple(row) for row in record.select(PLACE).distinct().collect()]
    there = set(existing_places(spark, store.access, changed))
    for verb, places in (("ADD IF NOT EXISTS", there), ("DROP IF EXISTS", set(changed) - there)):
        specs = [_partition(day, bucket) for day, bucket in sorted(places, key=str)]
        for start in range(0, len(specs), _PER_STATEMENT):
            separator = " " if verb.startswith("ADD") else ", "
            spark.sql(f"ALTER TABLE {full} {verb} {separator.join(specs[start : start + _PER_STATEMENT])}")
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({literal(_MARK)} = '{last}')")


def _partition(day, bucket: int) -> str:
    return f"PARTITION (log_date = {f'DATE{literal(str(day))}' if day else 'NULL'}, bucket = {bucket})"


def register_views(spark: SparkSession, logs: DataFrame, bots: Sequence[Bot]) -> None:
    """Temporary views ``access_logs``, ``named_requests`` and ``bot_path_daily``."""
    logs.createOrReplaceTempView("access_logs")
    name_bots(logs, bots).createOrReplaceTempView("named_requests")
    bot_path_daily(logs, bots).createOrReplaceTempView("bot_path_daily")
