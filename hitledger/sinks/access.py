"""Writing parsed requests and raw lines."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hitledger.operators.parse import csv_rows
from hitledger.schema import CSV_COLUMNS, PLACE
from hitledger.sources.paths import NO_DAY, file_system

FILE_KEYS = ["log_date", "source_file"]

#: Day and bucket: a partition of a stored table.
Place = tuple[date | None, int]


def bucket_of(source_file: Column, buckets: int) -> Column:
    """The bucket of a file within its day."""
    return F.pmod(F.xxhash64(source_file), F.lit(buckets)).cast("int")


def place_folder(path: str, place: Place) -> str:
    return f"{path}/log_date={place[0] or NO_DAY}/bucket={place[1]}"


def existing_places(spark: SparkSession, path: str, places: Iterable[Place]) -> list[Place]:
    """Those that the table has, by one listing per day."""
    days: dict[date | None, set[int]] = {}
    for day, bucket in places:
        days.setdefault(day, set()).add(bucket)
    found = []
    for day, buckets in days.items():
        fs, folder = file_system(spark, f"{path}/log_date={day or NO_DAY}")
        names = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
        found += [(day, b) for b in sorted(buckets) if f"bucket={b}" in names]
    return found


def read_places(spark: SparkSession, path: str, schema: T.StructType, places: Iterable[Place]) -> DataFrame:
    """Rows of some partitions; no other folder is listed."""
    folders = [place_folder(path, place) for place in existing_places(spark, path, places)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy(*PLACE).mode("append").parquet(path)


def _stored_files(spark: SparkSession, path: str, places: Iterable[Place]) -> dict[Place, set[str]]:
    found = {}
    for place in existing_places(spark, path, places):
        fs, folder = file_system(spark, place_folder(path, place))
        found[place] = {s.getPath().getName() for s in fs.listStatus(folder)}
    return found


def replace_files(
    rows: DataFrame, path: str, schema: T.StructType, files: Iterable[str], places: Iterable[Place], laid_out: bool = False
) -> None:
    """Put ``rows`` in the place of all rows of some files (one job's names), which lie in ``places``.

    Only these partitions are read and written: what other files have in them is taken over. Which have such rows is found by the
    column of file names alone, and only those are read whole. Spark writes the new
    partitions beside the old ones and exchanges them at the end. A partition that no row was written to, as all its rows
    were of these files, still has its old files then and is removed.

    Rows that are ``laid_out`` lie together by partition as they are, and are not moved unless others join them.
    """
    spark = rows.sparkSession
    before = _stored_files(spark, path, places)
    names, columns = list(files), schema.fieldNames()
    shared = read_places(spark, path, schema, before).where(~F.col("source_file").isin(names)).select(*PLACE).distinct().collect()
    merged = rows.select(columns)
    if shared:
        others = read_places(spark, path, schema, [tuple(place) for place in shared])
        merged = merged.unionByName(others.where(~F.col("source_file").isin(names)).select(columns))
    if shared or not laid_out:
        merged = merged.hint("rebalance", *[F.col(name) for name in PLACE])
    merged.write.partitionBy(*PLACE).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for place, stored in _stored_files(spark, path, before).items():
        if stored == before[place]:
            fs, folder = file_system(spark, place_folder(path, place))
            fs.delete(folder, True)


def write_csv(logs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export with header, one folder per file and day when those columns are present.

    Replacing is again per file; ``append`` adds rows.
    """
    rows = csv_rows(logs)
    keys = [k for k in FILE_KEYS if k in rows.columns]
    writer = (
        rows.select(*CSV_COLUMNS, *keys).write.mode(mode)
        .option("header", True).option("escape", '"').option("emptyValue", "").option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def write_raw_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """A cumulative plain-text copy of raw lines, for tools that want text files."""
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)
