"""Looking at folders on any storage Spark can read."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


# Fixed value: how a folder of a partition column spells null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, as listings of it have it."""
    fs, location = file_system(spark, path)
    return fs.makeQualified(location).toString()


def _as_json(value):
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc).isoformat()
    return value.isoformat() if isinstance(value, date) else value


def append_json(spark: SparkSession, path: str, rows: Iterable[dict]) -> None:
    """Add a few rows that the driver holds to a folder of JSON lines: one small file, without a job. It takes
    its name when it is whole, and readers do not see it before."""
    lines = "".join(json.dumps({k: _as_json(v) for k, v in row.items() if v is not None}) + "\n" for row in rows)
    name = f"{uuid.uuid4().hex}.json"
    fs, hidden = file_system(spark, f"{path}/_{name}")
    out = fs.create(hidden)
    try:
        out.write(bytearray(lines.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, file_system(spark, f"{path}/{name}")[1]):
        raise OSError(f"{path}/{name} cannot be written")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, which may hold wildcards, leads to anything."""
    fs, location = file_system(spark, path)
    return bool(fs.globStatus(location))
