"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and trials. On a cluster, pass your own session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("hitledger")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without that
    setting; it then uses a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        return tempfile.mkdtemp(prefix=f"hitledger-{name}-")
    return f"{shared.rstrip('/')}/hitledger-{name}-{uuid.uuid4().hex}"


def spread_rows(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt evenly by a key without repetitions, before dear work on each."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, key)
