"""Where landed requests live: the parsed table, the tables kept beside it, and the record of files.

All tables are partitioned by the day of the file and a hash bucket of its name, and every row names its file. So a file that comes
again touches one partition of each, and the number of stored files follows the days and buckets rather than the source files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import date
from itertools import islice
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hitledger.operators import traffic
from hitledger.operators.report import bot_path_daily, page_lists, utc_date
from hitledger.schema import ACCESS_TABLE, DERIVED, FILE_COLUMNS, FILE_ROLLUP, LANDED, PAGE_LISTS, PANEL_SKETCHES, PANEL_VISITS, PLACE, REJECTS
from hitledger.sinks.access import Place, bucket_of, read_places
from hitledger.sources.bots import Bot, list_mark
from hitledger.sources.paths import file_system, path_exists
from hitledger.sources.table import read_or_empty

#: States of a file: its rows are being written, are in the table, could not be read, or were dropped with its day.
STARTED, LANDED_OK, REJECTED, EXPIRED = "started", "landed", "rejected", "expired"
#: Files handled by one job; a longer list takes several, and no file is left out.
FILES_PER_JOB = 1000

FILE = FILE_COLUMNS.fieldNames()


class Derived(NamedTuple):
    """A table kept by file beside the parsed one: ``build`` makes its rows, with file columns, from requests with file columns."""

    name: str
    schema: T.StructType
    build: Callable[[DataFrame], DataFrame]


def bot_rollup(bots: Sequence[Bot]) -> Derived:
    """Requests per day, UTC day, crawler and page by one crawler list; another list has another table."""

    def build(requests: DataFrame) -> DataFrame:
        return bot_path_daily(requests.withColumn("utc_date", utc_date("ts")), bots, *FILE, "utc_date")

    return Derived(f"bot_path_daily/list={list_mark(bots)}", FILE_ROLLUP, build)


def bot_page_lists(bots: Sequence[Bot]) -> Derived:
    """The pages of each crawler in each file, the most requested first."""

    def build(requests: DataFrame) -> DataFrame:
        return page_lists(bot_path_daily(requests, bots, *FILE), *FILE)

    return Derived(f"page_lists/list={list_mark(bots)}", PAGE_LISTS, build)


#: Visits per panel and key, from which all panels follow without the log.
VISITS = Derived("panel_visits", PANEL_VISITS, lambda requests: traffic.panel_visits(requests, *FILE))
#: Hits, bytes and a sketch of the visitors per panel and key.
SKETCHES = Derived("panel_sketches", PANEL_SKETCHES, lambda requests: traffic.panel_sketches(requests, *FILE))


class Store:
    """The tables below one folder.

    ``buckets`` is the number of partitions per day. ``keep`` names tables that every landing brings up to date beside the
    rollup of its crawler list, such as ``VISITS``.
    """

    def __init__(self, root: str, buckets: int = 16, keep: Sequence[Derived] = ()):
        self.root = root.rstrip("/")
        self.buckets, self.keep = buckets, tuple(keep)
        self.access = f"{self.root}/access_logs"
        self.rejects = f"{self.root}/rejected_lines"
        self.landed = f"{self.root}/landed_files"
        self.derived = f"{self.root}/derived"
        self.derived_files = f"{self.root}/derived_files"

    def path(self, derived: Derived) -> str:
        return f"{self.derived}/{derived.name}"

    def record(self, derived: Derived) -> str:
        """Which loads of which files are in that table."""
        return f"{self.derived_files}/{derived.name}"

    def tables(self, bots: Sequence[Bot] | None) -> list[Derived]:
        return [*self.keep, *([bot_rollup(bots)] if bots is not None else [])]

    def bucket(self, source_file: Column) -> Column:
        return bucket_of(source_file, self.buckets)

    # --- reading ------------------------------------------------------------

    def _read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(spark, path, schema, spark.read.schema(schema).parquet)

    def _read_record(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(spark, path, schema, spark.read.schema(schema).json)

    def read_attempts(self, spark: SparkSession) -> DataFrame:
        """Every attempt at every file; ``read_landed`` has the last ones."""
        return self._read_record(spark, self.landed, LANDED)

    def read_access(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.access, ACCESS_TABLE)

    def read_rejects(self, spark: SparkSession) -> DataFrame:
        """Lines that did not parse, with their ``outcome`` and the mark of the ``grammar`` that was tried last."""
        return self._read(spark, self.rejects, REJECTS)

    def read_derived(self, spark: SparkSession, derived: Derived) -> DataFrame:
        return self._read(spark, self.path(derived), derived.schema)

    def read_rollup(self, spark: SparkSession, bots: Sequence[Bot]) -> DataFrame:
        """Requests per file, day, UTC day, crawler and page; sum over files with ``merge_rollups``."""
        return self.read_derived(spark, bot_rollup(bots))

    def read_landed(self, spark: SparkSession, files: Iterable[str] | None = None) -> DataFrame:
        """The last attempt at each file, or at one job's files, with its ``status`` and the ``reason`` of a rejection."""
        record = self._read_record(spark, self.landed, LANDED)
        if files is not None:
            record = record.where(F.col("source_file").isin(list(files)))
        # of one attempt, its end comes after its start
        order = F.struct("loaded", F.col("status") != STARTED)
        return record.groupBy("source_file").agg(F.max_by(F.struct(*record.columns), order).alias("last")).select("last.*")

    def rejected_files(self, spark: SparkSession) -> DataFrame:
        return self.read_landed(spark).where(F.col("status") == REJECTED)

    def places_since(self, spark: SparkSession, start: date) -> list[Place]:
        """Partitions that hold a request of ``start`` or later, by the dates in the record; at most buckets times file days."""
        held = self.read_landed(spark).where((F.col("last_date") >= F.lit(start)) | (F.col("status") == STARTED))
        return [tuple(row) for row in held.select(PLACE).distinct().collect()]

    def read_window(self, spark: SparkSession, start: date, derived: Derived | None = None) -> DataFrame:
        """Requests of ``start`` or later, or the rows of a derived table with that date.

        Partitions without any are not opened: the record knows the dates that every load brought.
        """
        path, schema = (self.path(derived), derived.schema) if derived else (self.access, ACCESS_TABLE)
        return read_places(spark, path, schema, self.places_since(spark, start)).where(F.col("date") >= F.lit(start))

    def read_files(self, spark: SparkSession, files: Iterable[str]) -> DataFrame:
        """Requests of some files (one job's names), from their partitions alone."""
        files = list(files)
        places = self.read_landed(spark, files).select(PLACE).distinct().collect()
        rows = read_places(spark, self.access, ACCESS_TABLE, [tuple(p) for p in places])
        return rows.where(F.col("source_file").isin(files))

    # --- what derived tables lack -----------------------------------------------

    def missing(self, spark: SparkSession, derived: Derived) -> DataFrame:
        """Files whose last load is not in a derived table, ``source_file, log_date, bucket, loaded``. A later attempt that was rejected left that load in place."""
        done = self._read_record(spark, self.record(derived), DERIVED)
        record = self._read_record(spark, self.landed, LANDED).where(F.col("status").isin(LANDED_OK, EXPIRED))
        last = record.groupBy("source_file").agg(F.max_by(F.struct(*record.columns), "loaded").alias("last")).select("last.*")
        landed = last.where(F.col("status") == LANDED_OK).select(*FILE, "loaded")
        return landed.join(done, ["source_file", "loaded"], "left_anti")

    def derived_roots(self, spark: SparkSession) -> list[str]:
        """Folders of all derived tables there are: those of the crawler lists, and the others."""
        roots = [self.path(d) for d in (VISITS, SKETCHES)]
        for by_list in ("bot_path_daily", "page_lists"):
            fs, folder = file_system(spark, f"{self.derived}/{by_list}")
            roots += [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return [root for root in roots if path_exists(spark, root)]


def in_jobs(rows: DataFrame) -> Iterator[list]:
    """Rows in lists of one job's length; the driver holds one at a time."""
    found = rows.toLocalIterator()
    while part := list(islice(found, FILES_PER_JOB)):
        yield part
