"""The plans are what they are meant to be."""

import gzip
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from hitledger.operators import report as r
from conftest import request_line
from hitledger.operators.parse import match_lines, parse_lines
from hitledger.plans.landing import land_lines
from hitledger.plans.store import Store
from hitledger.sources.bots import default_bots
from hitledger.sources.raw import read_raw_lines

SF = "/root/testdata/sf0.001"
BOTS = default_bots()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(str(tmp_path_factory.mktemp("store")))
    land_lines(e._lines(spark, SF), store, BOTS)
    return store


#: Queries that land files and whose plans are those of reading the stored tables.
MULTIPLE = {
    "grown_files", "landed_record", "stored_window", "reprocessed_requests", "reprocessed_rollup", "versioned_reports",
    "kept_dashboard", "estimated_panels", "top_paths_of_lists", "sql_parse", "sql_outcomes", "sql_table_function",
}


@pytest.mark.parametrize("name", sorted(set(e._log_queries()) - {"read_raw_lines", "raw_copy", "stored_report", "stored_dashboard", "built_report_paths", "csv_round_trip", "stream_landing_counts", "stream_daily_bots", "catalog_sql"} - MULTIPLE))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(e.queries()[name](spark, SF))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in text, bad


def test_the_request_pattern_runs_once(spark):
    df = parse_lines(e._lines(spark, SF)).where("date > DATE'2024-01-02' AND status = 200")
    assert plan(df).count("regexp_replace(") == 1


def test_the_crawler_chain_runs_once(spark, store):
    roll = r.bot_path_daily(r.in_window(store.read_access(spark), date(2024, 1, 31)), BOTS)
    assert plan(roll).count("THEN ZoomBot") == 1


def test_rollup_has_one_shuffle_and_reads_three_columns(spark, store):
    text = plan(r.bot_path_daily(r.in_window(store.read_access(spark), date(2024, 1, 31), 7), BOTS))
    assert text.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2024-01-24)]" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["date", "path", "user_agent"]


def test_slack_prunes_partitions(spark, store):
    df = r.in_window(store.read_access(spark), date(2024, 1, 31), 7, slack_days=2)
    assert re.search(r"PartitionFilters: \[[^]]*log_date#\d+ >= 2024-01-22", plan(df))


def test_landed_files_are_found_by_partition(spark, store):
    df = store.read_files(spark, ["access.log-2024-01-05.gz", "access.log-2024-01-06.gz", "no such file"])
    assert "InMemoryFileIndex(2 paths)" in plan(df)
    assert sorted(str(row.log_date) for row in df.select("log_date").distinct().collect()) == ["2024-01-05", "2024-01-06"]
    assert store.read_files(spark, ["x"]).isEmpty()


def test_top_pages_are_cut_before_the_shuffle(spark, store):
    text = plan(r.top_paths_per_bot(r.merge_rollups(store.read_rollup(spark, BOTS))))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_shared_rollup_is_shuffled_once(spark):
    df = r.report_json_lines(e._rollup(spark, SF), date(2024, 1, 31), "now")
    df.collect()
    final = plan(df)
    assert final.count("regexp_replace(") == final.count("Scan parquet") == 1 or "ReusedExchange" in final


@pytest.mark.parametrize("name", ["parse_access_log", "parse_rejects", "csv_export_rows", "classify_requests", "bot_path_daily", "bot_overview", "traffic_requests", "traffic_hours", "traffic_browsers"])
def test_generated_methods_stay_compilable(spark, name):
    """The JVM does not compile methods beyond 8000 bytes; they would be interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = e.queries()[name](spark, SF)
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        text = debug.codegenString(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", text)]
    assert sizes and 0 < min(sizes) and max(sizes) < 8000


def test_reading_needs_no_shuffle(spark, tmp_path):
    path = tmp_path / "access.log-2024-01-01.gz"
    with gzip.open(path, "wt") as f:
        f.writelines(request_line(agent=f"GPTBot {i}") + "\n" for i in range(30))
    assert "Exchange" not in plan(match_lines(read_raw_lines(spark, str(path))))


def test_lines_of_a_site_are_made_after_the_one_shuffle_by_day(spark):
    lines = e._site_lines(spark, SF)
    text = plan(lines)
    assert text.count("Exchange") == 1
    assert "10.0." not in text[text.index("Exchange"):]  # events move, not lines
    assert sorted(r.value for r in lines.collect()) == sorted(r.line for r in e._lines(spark, SF).collect())
    days = lines.withColumn("task", F.spark_partition_id()).groupBy("date").agg(F.countDistinct("task").alias("tasks"))
    assert {r.tasks for r in days.collect()} == {1}
