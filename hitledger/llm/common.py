"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hitledger.session import scratch_dir

#: Rows up to which a frame of a few numbers per row may be broadcast.
BROADCAST_ROWS = 200_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts the lineage."""
    spark = frame.sparkSession
    path = f"{scratch_dir(spark, name)}/rows"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Setting by which shuffle files go at the end of the write or count that made them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Writes and counts inside free the disk of their shuffles when they are done, not when the driver's garbage collector gets to them."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame of narrow rows, marked for broadcast if it has few rows; otherwise the join shuffles."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def held_out(remainder: int, modulus: int) -> Column:
    """Rows whose crc32 of the id as text has that remainder; false for a null id."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.col("doc_id").isNotNull() & (crc % modulus == remainder)


#: Setting that bounds what a batch for Python holds, and the bound: ten thousand rows of whole texts can be any size.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on batches for Python hold about ``BATCH_BYTES`` at most, one row at least, unless the session has a bound of its own. The
    setting stays, as it is read when a frame runs."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


#: Characters handed to a function at a time, one text at least.
CHARACTERS = 2_000_000


def column_of_texts(make: Callable[[], Callable[[list[str]], pd.DataFrame]], schema: str, characters: int = CHARACTERS):
    """A column function from text to a struct. ``make`` is called once per task; what it returns
    gets lists of texts and gives a row for each. Other columns stay where they are."""

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = make()
        for column in columns:
            texts = list(column)
            parts, start, size = [], 0, 0
            for stop, text in enumerate(texts, 1):
                size += len(text)
                if size >= characters or stop == len(texts):
                    parts.append(work(texts[start:stop]))
                    start, size = stop, 0
            yield pd.concat(parts, ignore_index=True) if parts else work([])

    return F.pandas_udf(run, schema).asNondeterministic()


def per_text(docs: DataFrame, make: Callable[[], Callable[[list[str]], pd.DataFrame]], schema: str, characters: int = CHARACTERS) -> DataFrame:
    """``doc_id`` and the columns of ``schema`` for each row's text."""
    found = docs.select("doc_id", column_of_texts(make, schema, characters)(whole_text()).alias("found"))
    return found.select("doc_id", "found.*")
