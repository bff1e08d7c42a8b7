"""Raw access-log files: their lines, and listings of them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hitledger.sources.paths import file_system, qualified

DATE_TEXT = r"\d{4}-\d{2}-\d{2}"


def file_day(path: Column) -> Column:
    """Day of a file: its ``date=`` folder, else the date in its name."""
    folder = F.regexp_extract(path, f"/date=({DATE_TEXT})/", 1)
    name = F.regexp_extract(F.substring_index(path, "/", -1), f"({DATE_TEXT})", 1)
    return F.try_to_date(F.when(folder != "", folder).otherwise(name), "yyyy-MM-dd")


def raw_root(spark: SparkSession, path: str) -> str:
    """The folder below which a file's path is its name: what comes before a ``date=`` folder, else the folder itself."""
    found = re.search(r"^(.*?)/date=", path)
    if found:
        return found[1]
    fs, location = file_system(spark, path)
    return location.getParent().toString() if fs.isFile(location) else path


def _below(spark: SparkSession, path: Column, root: str | None) -> Column:
    """The path below ``root``; without root, the file's own name."""
    if root is None:
        return F.substring_index(path, "/", -1)
    return F.substr(path, F.lit(len(qualified(spark, root).rstrip("/")) + 2))


def _with_file(lines: DataFrame, root: str | None) -> DataFrame:
    # File metadata is URL-encoded, with a plus sign left as it is.
    path = F.col("_metadata.file_path")
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    path = F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)
    # The same scheme is written with one or with three slashes.
    path = F.regexp_replace(path, "^file:/+", "file:/")
    return lines.select(
        F.col("value").alias("line"),
        file_day(F.col("_metadata.file_path")).alias("log_date"),
        _below(lines.sparkSession, path, root).alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
    )


# A line ends at a newline only; a lone carriage return is part of it. The ``date=``
# folders must not become a column, hence the recursive lookup.
_OPTIONS = {"lineSep": "\n", "recursiveFileLookup": "true"}


def read_raw_lines(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """``line, log_date, source_file, file_size`` from plain or gzipped log files.

    ``path`` is a folder, a file, or several, and may hold wildcards. ``source_file`` is the file's path below
    ``root``, or its name. A damaged file fails the read; it is never counted in part.
    """
    return _with_file(spark.read.options(**_OPTIONS).text(path), root)


#: Compressed bytes of raw files whose lines one task matches.
TASK_BYTES = 1 << 20


def spread_lines(lines: DataFrame, bytes_per_task: int = TASK_BYTES, by: str = "source_file", tasks: int | None = None) -> DataFrame:
    """Spread the lines of large files over tasks before they are matched and written.

    A gzip file is read by one task whatever its size. Lines move to (day, ``by``, share), with
    as many shares as the file's compressed size calls for. Adaptive execution then
    merges what is small, by the size of the text, though matching is dear; ``tasks`` fixes their
    number instead. The same shuffle gives the table its file layout. Shares go
    round by position, so repeated lines do not pile up.
    """
    shares = F.greatest(F.ceil(F.col("file_size") / bytes_per_task), F.lit(1))
    share = F.pmod(F.monotonically_increasing_id(), shares)
    keys = [F.col("log_date"), F.col(by), F.col("_share")]
    shared = lines.withColumn("_share", share)
    spread = shared.hint("rebalance", *keys) if tasks is None else shared.repartition(tasks, *keys)
    return spread.drop("_share", "file_size")


def _listing(files: DataFrame, root: str | None) -> DataFrame:
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("filename"),
        F.lit(True).alias("is_file"),
        "length",
        F.col("modificationTime").alias("modified"),
        _below(files.sparkSession, F.col("path"), root).alias("source_file"),
        file_day(F.col("path")).alias("log_date"),
    )


def list_files(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """``path, filename, is_file, length, modified, source_file, log_date`` of everything below a folder, or several.

    Contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return _listing(reader.load(path), root)
