"""Files are parsed into the table as they land, and again when they change."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hitledger.operators.files import MAX_DAYS
from hitledger.plans.landing import land_new
from hitledger.plans.store import Store
from hitledger.sources.bots import Bot


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stream_landing(
    spark: SparkSession, raw_path: str, store: Store, checkpoint: str,
    bots: Sequence[Bot] | None = None, on_replay: str = "replace", trigger: dict | None = None,
    template: str | None = None, now: Callable[[], datetime] = utc_now, max_days: float = MAX_DAYS,
) -> StreamingQuery:
    """Start the query. ``availableNow``, the default trigger, suits a daily run: one look at the folder.

    A file source takes each path once, so a file that grows would be lost. This stream is one of looks at the folder
    instead: at each, files are compared by path, size and time with the record of landed files, and what is new or has changed
    is landed as a batch import does it. The record, not the checkpoint, knows what is done, so a batch that is run
    again after a failure, or another stream over the same store, lands nothing twice.

    With ``template``, only files it names whose day is complete at ``now()`` and at most ``max_days`` old are taken; the unfinished file of
    today waits. A damaged file is recorded as rejected, holds nothing up, and is tried again when it changes. Days need no
    watermark: a request that arrives late joins its day through the rollup of its own file.
    """
    def look(batch: DataFrame, _: int) -> None:
        land_new(batch.sparkSession, raw_path, store, bots, template, now(), raw_path, on_replay, max_days=max_days)

    looks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    return (
        looks.writeStream.foreachBatch(look)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
