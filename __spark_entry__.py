"""Registered queries and the SQL that checks them.

The given tables hold no access logs, so log lines are derived from every row of
``events`` by one recipe that runs in Spark and as plain SQL.
"""

from __future__ import annotations

import importlib.util
import json
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger import sample_files as sf
from hitledger import samples
from hitledger.functions import grammar
from hitledger.operators import accuracy, classify, files, parse, report, traffic
from hitledger.plans.dashboard import build_dashboard, build_dashboard_from_store, read_dashboard
from hitledger.plans.landing import land_files, land_new, refresh_derived, reprocess_rejects
from hitledger.plans.reporting import build_report_from_rollup, get_or_build_report
from hitledger.plans.store import SKETCHES, VISITS, Store, bot_page_lists
from hitledger.schema import ACCESS_LOG, CSV_COLUMNS
from hitledger.session import scratch_dir, spread_rows
from hitledger.sinks.access import write_csv, write_raw_lines
from hitledger.sinks.reports import write_report_json
from hitledger.sinks.retention import expire_store
from hitledger.sources.bots import bots_from_mapping, default_bots, load_bots
from hitledger.sources.catalog import register_access_table, register_views
from hitledger.sources.paths import file_system
from hitledger.sources.raw import read_raw_lines
from hitledger.sources.sql_functions import register_functions
from hitledger.sources.table import read_access_csv
from hitledger.streaming.daily_bots import read_daily_bots
from hitledger.streaming.landing import stream_landing

_training_text = importlib.util.find_spec("hitledger.llm")
if _training_text and _training_text.origin:  # these operators come and go with their folder
    from hitledger.llm import queries as training
else:
    training = None

AS_OF = date(2024, 1, 31)
NOW = datetime(2024, 1, 31, 0, 30)
GENERATED_AT = "2024-01-31T00:30:00Z"
TEMPLATE = "access.log-{date}.gz"
BOTS = default_bots()
#: Another list, with regular expressions, a bare pattern and an entry that is found by its name.
OTHER_LIST = {"Open": {"patterns": [r"oai-\w+/1\.[0-2]", "gpt ?bot/"], "is_llm": True}, "Search": {"patterns": "google(bot|other)", "is_llm": False}, "feedbot": {}, "Face": "^facebook"}
OTHER_BOTS = bots_from_mapping(OTHER_LIST)
FUTURE_TAIL = '00 +0000] "GET /ahead HTTP/2.0" 200 1 "-" "GPTBot/1.0"'
ENTRY_DIR = "/root/testdata/sf0.001"


# --- inputs -----------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_rows(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.lines_from_events(_events(spark, sf_dir), samples.REFERRER_SQL)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_lines(_lines(spark, sf_dir))


def _rollup(spark: SparkSession, sf_dir: str, days_back: int = report.DAYS_BACK) -> DataFrame:
    window = report.in_window(_requests(spark, sf_dir), AS_OF, days_back)
    return report.bot_path_daily(window, BOTS)


def _stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a written table, for reports that read it several times over."""
    path = f"{scratch_dir(spark, 'rollup')}/bot_path_daily"
    _rollup(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _raw_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The lines as gzip files, one or more per ``date=`` folder."""
    raw = f"{root}/raw"
    lines = _lines(spark, sf_dir).select("line", F.col("log_date").alias("date"))
    by_day = lines.hint("rebalance", F.col("date"))
    by_day.write.partitionBy("date").option("compression", "gzip").text(raw)
    return raw


def _streamed_store(spark: SparkSession, sf_dir: str, name: str) -> tuple[Store, str]:
    root = scratch_dir(spark, name)
    store = Store(f"{root}/store")
    raw = _raw_files(spark, sf_dir, root)
    stream_landing(spark, raw, store, f"{root}/landing-checkpoint", BOTS).awaitTermination()
    return store, root


# --- queries ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Which crawlers visited, how often, on how many days, how many pages."""
    return report.bot_overview(_rollup(spark, ENTRY_DIR))


def _parse_access_log(spark, d):
    rows = _requests(spark, d)
    seconds = grammar.local_seconds("ts", "tz_offset")
    stamp = F.expr(grammar.iso_timestamp("date", seconds, "tz_offset")).alias("timestamp")
    names = [n for n in ACCESS_LOG.fieldNames() if n not in ("date", "ts", "tz_offset")]
    return rows.select("date", stamp, *names)


def _read_raw_lines(spark, d):
    """Lines written as gzip files, read back with the day of their file."""
    raw = _raw_files(spark, d, scratch_dir(spark, "raw"))
    return read_raw_lines(spark, raw).select("log_date", "line")


def _raw_copy(spark, d):
    """The cumulative text copy after every file was appended to it twice."""
    root = scratch_dir(spark, "raw-copy")
    raw = _raw_files(spark, d, root)
    for _ in range(2):
        write_raw_lines(read_raw_lines(spark, raw), f"{root}/all_lines")
    return spark.read.text(f"{root}/all_lines").groupBy(F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("copies")
    )


def _derive_output_key(spark, d):
    keys = sf.keys_from_events(_events(spark, d))
    return keys.select(
        "key",
        files.derive_output_key(F.col("key"), "parsed").alias("output_key"),
        files.landing_key(F.substring_index("key", "/", -1), F.lit(AS_OF)).alias("landing_key"),
    )


def _candidates(spark, d):
    return files.select_log_files(sf.files_from_events(_events(spark, d)), TEMPLATE, NOW)


def _landed(spark, d):
    return files.landed_names(sf.landed_from_events(_events(spark, d)))


def _classify_requests(spark, d):
    found = classify.classify_requests(_requests(spark, d), BOTS)
    return found.select("date", "ip", "path", "user_agent", "bot_name", "is_llm")


def _llm_requests(spark, d):
    found = classify.classify_requests(_requests(spark, d), BOTS, llm_only=True)
    return found.select("date", "ip", "path", "user_agent", "bot_name")


def _bot_address_check(spark, d):
    """Requests of known crawlers from addresses in and out of their ranges; errors come as another crawler from IPv6 addresses."""
    rows = _requests(spark, d)
    error = F.startswith("path", F.lit("/error"))
    host = F.substring_index("ip", ".", -1).cast("int")
    six = (
        F.when(host % 4 == 0, F.lit("2a02:06B8:0:1::25")).when(host % 4 == 1, F.lit("2a02:6bf:ffff::1"))
        .when(host % 4 == 2, F.lit("2a02:6c0::1")).otherwise(F.lit("::ffff:5.45.200.7"))
    )
    moved = (
        F.when(F.startswith("path", F.lit("/click")), F.replace("ip", F.lit("10.0.0."), F.lit("66.249.70.")))
        .when(F.startswith("path", F.lit("/view")), F.replace("ip", F.lit("10.0."), F.lit("40.83.")))
        .when(error, six)
        .when(F.startswith("path", F.lit("/signup")), F.lit("unknown"))
        .otherwise(F.col("ip"))
    )
    rows = rows.withColumn("user_agent", F.when(error, F.lit("YandexBot/3.0")).otherwise(F.col("user_agent"))).withColumn("ip", moved)
    return classify.check_bot_addresses(classify.classify_requests(rows, BOTS), BOTS)


def _top_paths(spark, d):
    return report.top_paths_per_bot(_rollup(spark, d))


def _report_document(spark, d):
    document = report.report_document(_stored_rollup(spark, d), AS_OF, GENERATED_AT, max_paths=None)
    return document.select(
        F.to_json(
            F.struct(
                "generated_at",
                F.struct(
                    F.col("window.from").cast("string").alias("from"),
                    F.col("window.to").cast("string").alias("to"),
                ).alias("window"),
                "overall",
                "bots",
            )
        ).alias("report")
    )


def _stored_report(spark, d):
    """Gzip files, landed as a stream, reported from the rollup kept per file."""
    store, root = _streamed_store(spark, d, "stored-report")
    build_report_from_rollup(store.read_rollup(spark, BOTS), f"{root}/reports", AS_OF)
    return get_or_build_report(spark, store, BOTS, f"{root}/reports", date(2024, 1, 30))["overview"]


def _built_report_paths(spark, d):
    """Files landed by another crawler list; the missing report brings the rollup up to date, is built and read back."""
    root = scratch_dir(spark, "built-report")
    store = Store(f"{root}/store")
    land_files(spark, _raw_files(spark, d, root), store, OTHER_BOTS)
    return get_or_build_report(spark, store, BOTS, f"{root}/reports", date(2024, 1, 30))["paths"]


def _written_report_json(spark, d):
    """The lines of the report document as they were written."""
    root = scratch_dir(spark, "report-json")
    path = write_report_json(_stored_rollup(spark, d), root, AS_OF, GENERATED_AT, report.DAYS_BACK)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _rename_files(spark, folder, name):
    """The one file of each ``date=`` folder gets a name of its own: a change of names, not of data."""
    fs, path = file_system(spark, folder)
    for day in fs.listStatus(path):
        for file in fs.listStatus(day.getPath()) if day.isDirectory() else []:
            if file.getPath().getName().startswith("part-"):
                target = f"{day.getPath().toString()}/{name.format(date=day.getPath().getName()[5:])}"
                fs.rename(file.getPath(), file_system(spark, target)[1])


def _site_lines(spark, d, line="line"):
    """``date, value``, the lines of a day in one task; ``line`` is SQL over ``line, event_id, date``."""
    sql = samples.line_sql(samples.TIME_SPARK, "user_id div 256", samples.REFERRER_SQL)
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("date", F.to_date("ts"))
    # a file is written by one task, so days should not share one; events are narrower than lines, so they move
    by_day = events.repartition(256, "date").sortWithinPartitions("date")
    return by_day.select("event_id", "date", F.expr(sql).alias("line")).select("date", F.expr(line).alias("value"))


def _site_files(spark, d, folder, line="line"):
    """``date=<day>/access.log-<day>.gz`` for one site."""
    _site_lines(spark, d, line).write.mode("overwrite").partitionBy("date").option("compression", "gzip").text(folder)
    _rename_files(spark, folder, TEMPLATE)


#: Files of every third day come again without a request, the others with every other line.
REPLAYED = "case when {day} % 3 = 0 or event_id % 2 = 1 then 'gone' else line end"


def _replayed_store(spark, d):
    """Two sites whose files share their names are landed; then those of site ``a`` come again, changed."""
    root = scratch_dir(spark, "replayed")
    store, raw = Store(f"{root}/store"), f"{root}/raw"
    for site in "ab":
        _site_files(spark, d, f"{raw}/{site}")
    land_files(spark, raw, store, BOTS)
    _site_files(spark, d, f"{raw}/a", REPLAYED.format(day="day(date)"))
    land_files(spark, f"{raw}/a", store, BOTS, root=raw)
    return store, raw


def _replayed_landing(spark, d):
    store, _ = _replayed_store(spark, d)
    return store.read_access(spark).groupBy("date", "path", "status").agg(F.count(F.lit(1)).alias("hits"))


def _replayed_rollup(spark, d):
    store, _ = _replayed_store(spark, d)
    return report.bot_daily(report.merge_rollups(store.read_rollup(spark, BOTS)))


def _damaged_store(spark, d):
    """Whole files, and for each day one that is cut short and one that is not compressed at all."""
    root = scratch_dir(spark, "damaged")
    store, raw = Store(f"{root}/store"), f"{root}/raw"
    _site_files(spark, d, f"{raw}/good")
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{raw}/good")
    day = F.regexp_extract("path", "date=([0-9-]+)", 1).alias("date")
    half = F.substring(F.col("content"), F.lit(1), (F.col("length") / 2).cast("int")).cast("string").alias("value")
    for name, value in (("cut", half), ("plain", F.lit("no archive").alias("value"))):
        first = whole.select(day, value).repartition(8, "date").where("day(date) <= 2").sortWithinPartitions("date")
        first.write.partitionBy("date").text(f"{raw}/{name}")
        _rename_files(spark, f"{raw}/{name}", TEMPLATE)
    land_new(spark, raw, store, BOTS, TEMPLATE, NOW)
    return store


def _damaged_landing(spark, d):
    """Damaged files hold nothing up: all rows of the whole ones of the last 30 days are there, and none of the others."""
    store = _damaged_store(spark, d)
    return report.bot_daily(report.merge_rollups(store.read_rollup(spark, BOTS)))


def _rejected_files(spark, d):
    return _damaged_store(spark, d).rejected_files(spark).select("log_date", "source_file", "status")


def _expired_store(spark, d):
    """Old days leave the table, its rollup and the catalog, and stay away when the table is registered again."""
    store, _ = _streamed_store(spark, d, "expired")
    table = register_access_table(spark, "expired", store)
    expire_store(spark, store, AS_OF, 10, dry_run=False)
    register_access_table(spark, "expired", store)
    rows = spark.sql(f"SELECT log_date, count(*) AS requests FROM {table} GROUP BY log_date")
    rolled = store.read_rollup(spark, BOTS).groupBy("log_date").agg(F.sum("requests").alias("bot_requests"))
    return rows.join(rolled, "log_date", "left")


def _loaded_list(spark, d):
    """The rollup by a list read from a written JSON file, with regular expressions."""
    path = f"{scratch_dir(spark, 'bots')}/bots"
    spark.range(1).select(F.lit(json.dumps(OTHER_LIST)).alias("value")).coalesce(1).write.text(path)
    return report.bot_path_daily(_requests(spark, d), load_bots(spark, path))


def _bad_dates(spark, d):
    """Exported rows, those of errors with a date that is none: they are left out."""
    rows = parse.csv_rows(_requests(spark, d)).withColumn(
        "date", F.when(F.col("status") == "500", F.concat(F.substring("date", 1, 5), F.lit("13-41"))).otherwise(F.col("date"))
    )
    return report.with_text_dates(rows).groupBy("date", "path").agg(F.count(F.lit(1)).alias("hits"))


def _crawl_comparison(spark, d):
    crawls = _events(spark, d).groupBy(F.to_date("ts").alias("date")).agg(
        F.count_if((F.col("event_id") % 11).isin(3, 6)).alias("crawls")
    )
    return accuracy.crawl_comparison(_rollup(spark, d), crawls)


def _traffic_capped(spark, d):
    recent = traffic.keep_last_dates(_requests(spark, d), 10)
    return traffic.top_items(traffic.traffic_requests(recent), 25)


def _stored_dashboard(spark, d):
    """All panels written, then the panel of client addresses."""
    root = scratch_dir(spark, "dashboard")
    table = f"{root}/access_logs"
    _requests(spark, d).write.parquet(table)
    build_dashboard(spark.read.parquet(table), f"{root}/panels", date(2024, 1, 30))
    return read_dashboard(spark, f"{root}/panels", date(2024, 1, 30))["hosts"]


def _csv_round_trip(spark, d):
    root = scratch_dir(spark, "csv")
    # Rows of a file come together first, for one export file per log file.
    by_file = _requests(spark, d).hint("rebalance", F.col("log_date"), F.col("source_file"))
    write_csv(by_file, f"{root}/parsed")
    rows = report.with_text_dates(read_access_csv(spark, f"{root}/parsed"))
    window = report.in_window(rows, AS_OF)
    return report.bot_daily(report.bot_path_daily(window, BOTS))


def _stream_landing_counts(spark, d):
    """Streamed, then replayed in batch, which must not change a row."""
    store, root = _streamed_store(spark, d, "stream-landing")
    land_files(spark, f"{root}/raw", store, BOTS)
    return report.bot_daily(report.merge_rollups(store.read_rollup(spark, BOTS)))


def _stream_daily_bots(spark, d):
    """Counts by UTC day after half the files came again and a line dated far ahead arrived."""
    store, root = _streamed_store(spark, d, "stream-daily")
    raw = f"{root}/raw"
    days = [row.date for row in spark.read.option("basePath", raw).text(raw).select("date").distinct().orderBy("date").collect()]
    land_files(spark, [f"{raw}/date={day}" for day in days[::2]], store, BOTS, root=raw)
    late = _events(spark, d).agg(F.max_by(F.expr(samples.line_sql("'05/Mar/2099:10:00:00'", "0")), "event_id").alias("line"))
    ahead = late.select(F.regexp_replace("line", r"00 [-+]\d{4}\].*$", FUTURE_TAIL).alias("line"))
    ahead.coalesce(1).write.option("compression", "gzip").text(f"{raw}/date=2099-03-05")
    stream_landing(spark, raw, store, f"{root}/landing-checkpoint", BOTS).awaitTermination()
    return read_daily_bots(spark, store, BOTS).withColumnRenamed("utc_date", "date")


def _catalog_sql(spark, d):
    store, _ = _streamed_store(spark, d, "catalog")
    table = register_access_table(spark, "hitledger", store)
    return spark.sql(
        f"SELECT log_date, status, count(*) AS hits, count(DISTINCT path) AS paths FROM {table} GROUP BY log_date, status"
    )


#: Half of the lines, as a file holds them that is still being written.
HALF = "case when event_id % 2 = 0 then line else 'unfinished' end"


def _grown_files(spark, d):
    """Files streamed while they are written, then grown, then streamed again; the file of the day of each look waits."""
    root = scratch_dir(spark, "grown")
    store, raw = Store(f"{root}/store"), f"{root}/raw"
    for line, now in ((HALF, datetime(2024, 1, 20, 12)), ("line", NOW), ("line", NOW)):
        _site_files(spark, d, raw, line)
        stream_landing(spark, raw, store, f"{root}/checkpoint", BOTS, template=TEMPLATE, now=lambda now=now: now, max_days=60).awaitTermination()
    return store.read_access(spark).groupBy("log_date", "status").agg(F.count(F.lit(1)).alias("hits"))


def _landed_record(spark, d):
    """What the record knows of each file after a replay: lines and the dates of its requests."""
    store, _ = _replayed_store(spark, d)
    return store.read_landed(spark).select("source_file", "status", "parsed", "rejected", "first_date", "last_date")


def _stored_window(spark, d):
    """One week out of the store, by the dates in the record."""
    store, _ = _streamed_store(spark, d, "window")
    return store.read_window(spark, date(2024, 1, 24)).groupBy("date", "path").agg(F.count(F.lit(1)).alias("hits"))


#: The grammar of the package, but for requests that are just a dash.
DASH_GRAMMAR = grammar.REQUEST_REGEX.replace(grammar.REQUEST_PARTS, f"(?:{grammar.REQUEST_PARTS}|-)")


def _reprocessed(spark, d):
    root = scratch_dir(spark, "reprocessed")
    store = Store(f"{root}/store")
    land_files(spark, _raw_files(spark, d, root), store, BOTS)
    for _ in range(2):  # the second time there is nothing left to try
        reprocess_rejects(spark, store, BOTS, DASH_GRAMMAR)
    return store


def _reprocessed_requests(spark, d):
    """Lines that one grammar rejects, landed by another without reading the files again."""
    return _reprocessed(spark, d).read_access(spark).groupBy("date", "path").agg(F.count(F.lit(1)).alias("hits"))


def _reprocessed_rollup(spark, d):
    return report.bot_daily(report.merge_rollups(_reprocessed(spark, d).read_rollup(spark, BOTS)))


def _versioned_reports(spark, d):
    """The report of one day asked for three times: as it is, by another list, and after files came again."""
    root = scratch_dir(spark, "versions")
    store, raw, reports = Store(f"{root}/store"), f"{root}/raw", f"{root}/reports"
    _site_files(spark, d, f"{raw}/a")
    land_files(spark, raw, store, BOTS)
    day, seen = date(2024, 1, 30), []

    def look(turn, bots):
        totals = get_or_build_report(spark, store, bots, reports, day)["overview"].select(F.lit(turn).alias("turn"), "bot_name", "total_requests")
        kept = f"{root}/seen/{turn}"
        totals.write.parquet(kept)
        seen.append(spark.read.parquet(kept))

    look("first", BOTS)
    look("other list", OTHER_BOTS)
    _site_files(spark, d, f"{raw}/a", REPLAYED.format(day="day(date)"))
    land_new(spark, raw, store, BOTS)
    look("replayed", BOTS)
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


def _replayed_with(spark, d, table):
    """A store that keeps a further table: the files of one site are landed, then come again, changed."""
    root = scratch_dir(spark, "kept")
    store, raw = Store(f"{root}/store", keep=[table]), f"{root}/raw"
    for line in ("line", REPLAYED.format(day="day(date)")):
        _site_files(spark, d, f"{raw}/a", line)
        land_files(spark, raw, store)
    return store, root


def _kept_dashboard(spark, d):
    """The panel of client addresses after a replay, from the visits kept by file."""
    store, root = _replayed_with(spark, d, VISITS)
    build_dashboard_from_store(spark, store, f"{root}/panels", date(2024, 1, 30))
    return read_dashboard(spark, f"{root}/panels", date(2024, 1, 30))["hosts"]


#: The estimate of visitors is three standard errors off at most, and right to one for few.
SKETCH_ERROR = 3 * 1.04 / 2 ** (traffic.SKETCH_K / 2)


def _estimated_panels(spark, d):
    """Visitors counted from the visits, and whether those estimated from merged sketches agree within the bound."""
    store, _ = _replayed_with(spark, d, SKETCHES)
    estimated = traffic.panels_of_sketches(store.read_derived(spark, SKETCHES)).withColumnRenamed("visitors", "estimate")
    exact = traffic.panel_rows(store.read_access(spark))
    near = F.abs(F.col("estimate") - F.col("visitors")) <= F.greatest(F.lit(1.0), F.col("visitors") * SKETCH_ERROR)
    both = exact.drop("bytes").join(estimated.withColumnRenamed("hits", "sketch_hits"), ["panel", "keys"], "full")
    same = F.col("hits").eqNullSafe(F.col("sketch_hits"))
    return both.where("panel IN ('hosts', 'status')").select("panel", F.col("keys")[0].alias("key"), "hits", "visitors", (near & same).alias("agrees"))


def _top_paths_of_lists(spark, d):
    store, _ = _streamed_store(spark, d, "page-lists")
    table = bot_page_lists(BOTS)
    refresh_derived(spark, store, table)
    return report.top_paths_of_lists(store.read_derived(spark, table))


def _missing_input(spark, d):
    """The summary of a store and of an exported file that do not exist, beside that of the given lines."""
    root = scratch_dir(spark, "missing")
    nothing = report.with_text_dates(read_access_csv(spark, f"{root}/none.csv"))
    parts = {
        "no file": report.bot_path_daily(nothing, BOTS),
        "no store": report.merge_rollups(Store(f"{root}/none").read_rollup(spark, BOTS)),
        "given": _rollup(spark, d),
    }
    frames = [report.overall_summary(rollup, AS_OF).select(F.lit(name).alias("input"), "total_requests", "unique_bots") for name, rollup in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _sql_parse(spark, d):
    """Raw files parsed and classified by SQL alone."""
    raw = _raw_files(spark, d, scratch_dir(spark, "sql"))
    db = register_functions(spark, "hitledger", BOTS)
    return spark.sql(
        f"""SELECT coalesce({db}.crawler_name(r.user_agent), 'none') AS sender, r.date, r.status, count(*) AS hits
        FROM (SELECT {db}.parse_line(value) AS r FROM text.`{raw}`) WHERE r IS NOT NULL GROUP BY ALL"""
    )


def _sql_outcomes(spark, d):
    raw = _raw_files(spark, d, scratch_dir(spark, "sql"))
    db = register_functions(spark, "hitledger", BOTS)
    return spark.sql(f"SELECT {db}.line_outcome(value) AS outcome, count(*) AS line_count FROM text.`{raw}` GROUP BY ALL")


def _sql_table_function(spark, d):
    """The table function beside each line: no row for a line that does not parse."""
    raw = _raw_files(spark, d, scratch_dir(spark, "sql"))
    before, db = spark.catalog.currentDatabase(), register_functions(spark, "hitledger", BOTS)
    spark.sql(f"USE {db}")
    try:
        return spark.sql(f"SELECT r.host, r.method, count(*) AS hits, count(r.time1) AS timed FROM text.`{raw}` AS t, LATERAL request_of_line(t.value) AS r GROUP BY ALL")
    finally:
        spark.catalog.setCurrentDatabase(before)


def _agents(spark, d):
    """Every event under an agent of a list that reaches each entry."""
    agents = [(i, agent) for i, agent in enumerate(samples.AGENTS)]
    frame = spark.createDataFrame(agents, "n INT, user_agent STRING")
    return _events(spark, d).withColumn("n", (F.col("event_id") % len(agents)).cast("int")).join(F.broadcast(frame), "n")


def _named_agents(spark, d):
    named = classify.name_bots(_agents(spark, d), BOTS)
    return named.groupBy("user_agent", "bot_name").agg(F.count(F.lit(1)).alias("requests"))


def _edge_outcomes(spark, d):
    """Lines at the edges of the grammar, by kind, with what became of them."""
    line = samples.line_sql(samples.TIME_SPARK, "user_id div 256").replace("when event_id % 50 = 49 then '-'", "when false then '-'")
    kinds = " ".join(f"WHEN {i} THEN {text.replace('{LINE}', line)}" for i, (text, _) in enumerate(samples.EDGE_LINES))
    kind = (F.col("event_id") % len(samples.EDGE_LINES)).cast("int").alias("kind")
    lines = _events(spark, d).select(kind, F.expr(f"CASE event_id % {len(samples.EDGE_LINES)} {kinds} END").alias("line"))
    return parse.count_outcomes(lines, "kind")


def _views_sql(spark, d):
    register_views(spark, _requests(spark, d), BOTS)
    return spark.sql(
        "SELECT coalesce(bot_name, 'none') AS sender, status, count(*) AS hits "
        "FROM named_requests GROUP BY 1, 2"
    )


def _log_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "read_raw_lines": _read_raw_lines,
        "raw_copy": _raw_copy,
        "parse_access_log": _parse_access_log,
        "parse_rejects": lambda s, d: parse.count_outcomes(_lines(s, d), "log_date", "source_file"),
        "csv_export_rows": lambda s, d: parse.csv_rows(_requests(s, d)).select(*CSV_COLUMNS),
        "csv_round_trip": _csv_round_trip,
        "derive_output_key": _derive_output_key,
        "select_log_files": _candidates,
        "new_log_files": lambda s, d: files.new_log_files(_candidates(s, d), _landed(s, d)),
        "landed_names": _landed,
        "file_sync_summary": lambda s, d: files.file_sync_summary(_candidates(s, d), _landed(s, d)),
        "notification_files": lambda s, d: files.notification_files(
            sf.notifications_from_events(_events(s, d)), "logs"
        ),
        "catalog_sql": _catalog_sql,
        "views_sql": _views_sql,
        "classify_requests": _classify_requests,
        "llm_requests": _llm_requests,
        "agent_dimension": lambda s, d: classify.agent_dimension(_requests(s, d), BOTS),
        "bot_address_check": _bot_address_check,
        "bot_path_daily": lambda s, d: _rollup(s, d),
        "bot_path_daily_week": lambda s, d: _rollup(s, d, 7),
        "bot_totals": lambda s, d: report.bot_totals(_rollup(s, d)),
        "bot_daily": lambda s, d: report.bot_daily(_rollup(s, d)),
        "bot_paths": lambda s, d: report.bot_paths(_rollup(s, d)),
        "overall_summary": lambda s, d: report.overall_summary(_rollup(s, d), AS_OF),
        "bot_overview": lambda s, d: report.bot_overview(_rollup(s, d)),
        "top_paths_per_bot": _top_paths,
        "top_bots": lambda s, d: report.top_bots(_rollup(s, d)),
        "top_bots_daily_filled": lambda s, d: report.top_bots_daily_filled(_rollup(s, d)),
        "bot_type_by_period": lambda s, d: report.bot_type_by_period(_rollup(s, d)),
        "report_document": _report_document,
        "report_json_lines": lambda s, d: report.report_json_lines(_stored_rollup(s, d), AS_OF, GENERATED_AT),
        "stored_report": _stored_report,
        "built_report_paths": _built_report_paths,
        "written_report_json": _written_report_json,
        "replayed_landing": _replayed_landing,
        "replayed_rollup": _replayed_rollup,
        "damaged_landing": _damaged_landing,
        "rejected_files": _rejected_files,
        "expired_store": _expired_store,
        "loaded_list": _loaded_list,
        "bad_dates": _bad_dates,
        "crawl_comparison": _crawl_comparison,
        "crawl_accuracy": lambda s, d: accuracy.crawl_accuracy(_crawl_comparison(s, d)),
        "traffic_daily": lambda s, d: traffic.traffic_daily(_requests(s, d)),
        "traffic_hosts": lambda s, d: traffic.traffic_hosts(_requests(s, d)),
        "traffic_referrers": lambda s, d: traffic.traffic_referrers(_requests(s, d)),
        "traffic_requests": lambda s, d: traffic.traffic_requests(_requests(s, d)),
        "traffic_browsers": lambda s, d: traffic.traffic_browsers(_requests(s, d)),
        "traffic_os": lambda s, d: traffic.traffic_systems(_requests(s, d)),
        "traffic_hours": lambda s, d: traffic.traffic_hours(_requests(s, d)),
        "traffic_status": lambda s, d: traffic.traffic_status(_requests(s, d)),
        "traffic_virtual_hosts": lambda s, d: traffic.traffic_virtual_hosts(_requests(s, d)),
        "traffic_capped": _traffic_capped,
        "stored_dashboard": _stored_dashboard,
        "stream_landing_counts": _stream_landing_counts,
        "stream_daily_bots": _stream_daily_bots,
        "named_agents": _named_agents,
        "edge_outcomes": _edge_outcomes,
        "grown_files": _grown_files,
        "landed_record": _landed_record,
        "stored_window": _stored_window,
        "reprocessed_requests": _reprocessed_requests,
        "reprocessed_rollup": _reprocessed_rollup,
        "versioned_reports": _versioned_reports,
        "kept_dashboard": _kept_dashboard,
        "estimated_panels": _estimated_panels,
        "top_paths_of_lists": _top_paths_of_lists,
        "running_totals": lambda s, d: report.running_totals(_rollup(s, d)),
        "missing_input": _missing_input,
        "sql_parse": _sql_parse,
        "sql_outcomes": _sql_outcomes,
        "sql_table_function": _sql_table_function,
    }


# --- the same in SQL ---------------------------------------------------------

_DAY = "strftime(ts, '%Y-%m-%d')"
_SHIFTED = "strftime(cast(ts as date) + cast(user_id % 61 - 30 as int), '%Y-%m-%d')"
_TIME = "strftime(ts, '%d/%b/%Y:%H:%M:%S')"

# Fixed value: the line grammar, as another dialect of regular expressions has it.
_REQUEST = (
    r'^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"(\S+)\s+(\S+)\s+([^"]+)"\s+(\d+)\s+(\S+)\s+"([^"]*)"\s+"([^"]*)"'
)


# The agents of the lines, with crawler, browser and system, worked out by hand rather than from the lists that are tested.
_SEEN = {
    "Mozilla/5.0 (compatible; GPTBot/1.2; +https://openai.com/gptbot)": ("GPTBot", "Crawler", "Unknown"),
    "Mozilla/5.0 (compatible; OAI-SearchBot/1.0; +https://openai.com/searchbot)": ("GPTBot", "Crawler", "Unknown"),
    "Mozilla/5.0 (compatible; ClaudeBot/1.0)": ("ClaudeBot", "Crawler", "Unknown"),
    "Mozilla/5.0 (compatible; Googlebot/2.1)": ("GoogleBot", "Crawler", "Unknown"),
    "wpXcom feedbot": ("WPFeedbot", "Crawler", "Unknown"),
    "OAI-SearchBot/1.3": ("OAI_SearchBot", "Crawler", "Unknown"),
    "Mozilla/5.0 (Windows NT 10.0) Chrome/116.0 Safari/537.36": (None, "Chrome", "Windows"),
    "-": (None, "Unknown", "Unknown"),
    "": (None, "Unknown", "Unknown"),
    "facebookexternalhit/1.1": ("MetaExternal", "Crawler", "Unknown"),
    "gptbot lower": ("GPTBot", "Crawler", "Unknown"),
}


def _seen(column: str, place: int) -> str:
    """What is known of an agent; an agent that is not in the list is an error."""
    known = " ".join(f"when '{agent}' then {repr(row[place]) if row[place] else 'null'}" for agent, row in _SEEN.items())
    return f"case {column} {known} else error('unknown agent') end"


def _chain(column: str) -> str:
    return _seen(column, 0)


_LLM = "'GPTBot', 'ClaudeBot', 'OAI_SearchBot'"
_FIELD_LIST = ", ".join(f"'{n}'" for n in grammar.FIELDS)

_LINES = f"""
  select {samples.line_sql(_TIME, "user_id // 256", samples.REFERRER_SQL.strip())} as line,
    cast(ts as date) as log_date, concat('access.log-', {_DAY}, '.gz') as source_file, event_id
  from events
"""
_CTES = f"""
with lines as ({_LINES}),
segments as (
  select *, string_split(trim(line), ' | ') as parts from lines
),
matched as (
  select *, regexp_matches(parts[1], '{_REQUEST}') as ok,
    regexp_extract(parts[1], '{_REQUEST}', [{_FIELD_LIST}]) as f,
    case when len(parts) > 2 then string_split(trim(parts[3]), ' ') end as words
  from segments
),
parsed as (
  select cast(strptime(split_part(f."time", ' ', 1), '%d/%b/%Y:%H:%M:%S') as date) as "date",
    strptime(split_part(f."time", ' ', 1), '%d/%b/%Y:%H:%M:%S') as local_ts,
    concat(left(split_part(f."time", ' ', 2), 3), ':', right(split_part(f."time", ' ', 2), 2)) as tz_offset,
    f.ip, f.host, f."method", f.path, f.protocol, cast(f.status as int) as status,
    coalesce(try_cast(f.bytes as bigint), -1) as body_bytes_sent, f.referrer, f.user_agent,
    trim(parts[2]) as tls,
    try_cast(words[1] as double) as time1, try_cast(words[2] as double) as time2,
    try_cast(words[3] as double) as time3,
    words[4] as cache_status, words[5] as extra_5, words[6] as extra_6, words[7] as extra_7,
    log_date, source_file
  from matched where ok
),
named as (
  select *, {_chain("trim(user_agent)")} as bot_name from parsed
),
bots as (
  select *, bot_name in ({_LLM}) as is_llm from named where bot_name is not null
),
rollup_all as (
  select "date", bot_name, is_llm, case when trim(path) = '' then '/' else trim(path) end as path,
    count(*) as requests
  from bots where "date" >= date '2023-01-31' group by all
),
totals as (
  select bot_name, is_llm, cast(sum(requests) as bigint) as total_requests from rollup_all group by all
),
daily as (
  select bot_name, "date", cast(sum(requests) as bigint) as requests from rollup_all group by all
),
pages as (
  select bot_name, path, cast(sum(requests) as bigint) as requests from rollup_all group by all
)
"""

_STAMP = "concat(strftime(local_ts, '%Y-%m-%dT%H:%M:%S'), tz_offset)"
_METRICS = """count(*) as hits,
  cast(coalesce(sum(case when body_bytes_sent >= 0 then body_bytes_sent end), 0) as bigint) as bytes,
  count(distinct (ip, user_agent, "date")) as visitors"""

_LISTING = f"""
with listing as (
  select concat('site', cast(user_id as varchar), '/', filename) as path, filename, is_file from (
    select user_id, {sf.fill(sf.FILE_NAME_SQL, _DAY, _SHIFTED)} as filename, event_id % 6 <> 4 as is_file
    from events)
),
named as (
  select *, regexp_extract(filename, '^access\\.log-([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\\.gz$', 1) as day_text
  from listing where is_file
),
candidates as (
  select path, filename, is_file, try_cast(day_text as date) as file_date from named
  where day_text <> '' and try_cast(day_text as date) <> date '2024-01-31'
    and epoch(timestamp '2024-01-31 00:30:00') - epoch(cast(day_text as timestamp)) between 0 and 30 * 86400
),
landed as (
  select distinct concat('access.log-', {_DAY}, '.gz') as filename
  from events where isodow(ts) <= 5
)
"""


_RECENT = f"""{_CTES},
recent as (select * from parsed where "date" >= (
  select min("date") from (select distinct "date" from parsed order by 1 desc limit 10)))"""


def _replayed(query: str) -> str:
    """A query over all lines of one site and those of the other that are left."""
    left = REPLAYED.format(day="day(log_date)")
    both = f"select * from ({_LINES}) union all select {left} as line, log_date, source_file, event_id from ({_LINES})"
    return f"{_CTES} {query}".replace(_LINES, both, 1)


_LEFT = f"(select {REPLAYED.format(day='day(log_date)')} as line, log_date, source_file, event_id from ({_LINES}))"
#: The same after the files came again, changed.
_LEFT_CTES = _CTES.replace(f"({_LINES})", _LEFT, 1)


def _other(column: str) -> str:
    """The crawler by ``OTHER_LIST``."""
    return f"""case when regexp_matches({column}, 'oai-\\w+/1\\.[0-2]|gpt ?bot/', 'i') then 'Open'
    when regexp_matches({column}, 'google(bot|other)', 'i') then 'Search'
    when regexp_matches({column}, 'feedbot', 'i') then 'feedbot'
    when regexp_matches({column}, '^facebook', 'i') then 'Face' end"""


def _panel(key: str, alias: str = "", where: str = "") -> str:
    named = f"{key} as {alias}" if alias else key
    return f"{_CTES} select {named}, {_METRICS} from parsed {where} group by {key}"


# The ranges that the addresses of the query can meet, by hand: 40.83.0.0/16 of GPTBot, 66.249.64.0/19 of GoogleBot, and of
# YandexBot 2a02:6b8::/29 (2a02:6b8 to 2a02:6bf) and 5.45.192.0/18. Of the crawlers seen, the others have none.
_ADDRESSES = f"""{_CTES},
moved as (
  select case when path like '/error%' then 'YandexBot' else bot_name end as bot_name, path, ip from named
),
judged as (
  select bot_name, case
    when bot_name not in ('GPTBot', 'GoogleBot', 'YandexBot') then 'no_ranges'
    when path like '/signup%' then 'no_address'
    when path like '/error%' then case when cast(split_part(ip, '.', 4) as int) % 4 = 2 then 'outside' else 'inside' end
    when path like '/click%' and ip like '10.0.0.%' and bot_name = 'GoogleBot' then 'inside'
    when path like '/view%' and bot_name = 'GPTBot' then 'inside'
    else 'outside' end as verdict
  from moved where bot_name is not null
)
select bot_name, verdict, count(*) as requests from judged group by all"""


_OVERVIEW = f"""{_CTES}
select bot_name, case when is_llm then 'LLM' else 'Other' end as bot_type,
  cast(sum(requests) as bigint) as total_requests, count(distinct "date") as days_seen,
  count(distinct path) as unique_paths
from rollup_all group by bot_name, is_llm"""

_DAILY = f'{_CTES} select bot_name, "date", requests from daily'

_SUMMARY = """select date '2023-01-31' as window_from, date '2024-01-31' as window_to,
  coalesce(cast(sum(requests) as bigint), 0) as total_requests, count(distinct bot_name) as unique_bots,
  count(distinct path) as unique_paths from rollup_all"""

_SERIES = """series as (
  select bot_name, list({'date': cast("date" as varchar), 'requests': requests} order by "date") as daily_requests
  from daily group by bot_name
),
ranked_pages as (
  select *, row_number() over (partition by bot_name order by requests desc, path) as rnk from pages
),
ranked_bots as (
  select *, row_number() over (order by total_requests desc, bot_name) as bot_rank from totals
),
summary as (""" + _SUMMARY + ")"

_DOCUMENT = f"""{_CTES}, {_SERIES},
top_pages as (
  select bot_name, list({{'path': path, 'requests': requests}} order by rnk) as top_paths
  from ranked_pages group by bot_name
),
counts as (select bot_name, count(*) as unique_paths from pages group by bot_name)
select cast(to_json({{
  'generated_at': '{GENERATED_AT}',
  'window': {{'from': '2023-01-31', 'to': '2024-01-31'}},
  'overall': (select {{'total_requests': total_requests, 'unique_bots': unique_bots, 'unique_paths': unique_paths}} from summary),
  'bots': (select list({{'bot_name': b.bot_name, 'is_llm': is_llm, 'total_requests': total_requests,
      'unique_paths': unique_paths, 'daily_requests': daily_requests, 'top_paths': top_paths}} order by bot_rank)
    from ranked_bots b join series s on s.bot_name = b.bot_name
    join top_pages t on t.bot_name = b.bot_name join counts c on c.bot_name = b.bot_name)
}}) as varchar) as report"""

_JSON_LINES = f"""{_CTES}, {_SERIES}
select cast(0 as int) as bot_rank, cast(0 as int) as part, cast(0 as bigint) as order_requests, '' as order_path,
  concat('{{"generated_at":"{GENERATED_AT}","window":{{"from":"2023-01-31","to":"2024-01-31"}},"overall":',
    cast(to_json({{'total_requests': total_requests, 'unique_bots': unique_bots, 'unique_paths': unique_paths}}) as varchar),
    ',"bots":[') as line
from summary
union all
select cast(bot_rank as int), 1, 0, '',
  concat(case when bot_rank > 1 then ',' else '' end, '{{"bot_name":"', b.bot_name, '","is_llm":',
    case when is_llm then 'true' else 'false' end, ',"total_requests":', total_requests,
    ',"daily_requests":', cast(to_json(daily_requests) as varchar), ',"top_paths":[')
from ranked_bots b join series s on s.bot_name = b.bot_name
union all
select cast(bot_rank as int), 2, -requests, path,
  concat(case when rnk > 1 then ',' else '' end, cast(to_json({{'path': path, 'requests': requests}}) as varchar))
from ranked_pages p join ranked_bots b on b.bot_name = p.bot_name
union all select cast(bot_rank as int), 3, 0, '', ']}}' from ranked_bots
union all select 2147483647, 3, 0, '', ']}}'"""

_COMPARISON = f"""{_CTES},
hits as (select "date", requests as hits from daily where bot_name = 'GoogleBot'),
crawls as (
  select cast(ts as date) as "date", count(*) filter (event_id % 11 in (3, 6)) as crawls from events group by 1
),
compared as (
  select coalesce(h."date", c."date") as "date", coalesce(hits, 0) as hits, coalesce(crawls, 0) as crawls,
    least(coalesce(hits, 0), coalesce(crawls, 0)) as matched
  from hits h full outer join crawls c on h."date" = c."date"
)"""


_TOP_PATHS = f"""{_CTES} select bot_name, path, requests,
  cast(row_number() over (partition by bot_name order by requests desc, path) as int) as "rank"
from pages qualify "rank" <= 20"""

_PERIODS = f"""{_CTES},
periods as (
  select is_llm, 'day' as period, "date" as period_start, requests from rollup_all
  union all select is_llm, 'week', cast(date_trunc('week', "date") as date), requests from rollup_all
  union all select is_llm, 'month', cast(date_trunc('month', "date") as date), requests from rollup_all
)"""


def _text(name: str) -> str:
    if name == "date":
        return 'cast("date" as varchar) as "date"'
    if name == "timestamp":
        return f'{_STAMP} as "timestamp"'
    if name in ("time1", "time2", "time3"):
        return f"coalesce(printf('%.3f', {name}), '') as {name}"
    return f'coalesce(cast("{name}" as varchar), \'\') as "{name}"'


def _log_sql() -> dict[str, str]:
    week = f"""{_CTES} select "date", bot_name, is_llm,
  case when trim(path) = '' then '/' else trim(path) end as path, count(*) as requests
from bots where "date" >= date '2024-01-24' group by all"""
    rest = ", ".join(f'"{n}"' for n in CSV_COLUMNS if n not in ("date", "timestamp"))
    return {
        "read_raw_lines": f"{_CTES} select log_date, line from lines",
        "raw_copy": f"{_CTES} select line, 2 * count(*) as copies from lines group by line",
        "parse_access_log": f'{_CTES} select "date", {_STAMP} as "timestamp", {rest} from parsed',
        "parse_rejects": f"""{_CTES}
select log_date, source_file, case when trim(line) = '' then 'blank' when not ok then 'regex' else 'parsed' end as outcome,
  count(*) as line_count from matched group by all""",
        "csv_export_rows": f"{_CTES} select {', '.join(_text(n) for n in CSV_COLUMNS)} from parsed",
        "csv_round_trip": _DAILY,
        "derive_output_key": f"""select "key",
  concat('parsed/', regexp_replace(regexp_replace("key", '^raw/', ''), '\\.gz$', ''), '.csv') as output_key,
  concat('raw/date=2024-01-31/', regexp_extract("key", '[^/]*$')) as landing_key
from (select {sf.fill(sf.KEY_SQL, _DAY)} as "key" from events)""",
        "select_log_files": f"{_LISTING} select path, filename, is_file, file_date from candidates",
        "new_log_files": f"""{_LISTING} select path, filename, is_file, file_date from candidates
where filename not in (select filename from landed)""",
        "landed_names": f"{_LISTING} select filename from landed",
        "file_sync_summary": f"""{_LISTING} select count(*) as total_candidates,
  count(*) filter (filename in (select filename from landed)) as already_present,
  count(*) filter (filename not in (select filename from landed)) as synced from candidates""",
        "notification_files": f"""with records as (
  select unnest(from_json(json_extract(event, '$.Records'),
    '[{{"s3":{{"bucket":{{"name":"VARCHAR"}},"object":{{"key":"VARCHAR"}}}}}}]')) as r
  from (select {sf.fill(sf.NOTIFICATION_SQL, _DAY)} as event from events)
)
select r.s3.bucket.name as bucket, url_decode(replace(r.s3.object."key", '+', ' ')) as "key" from records
where r.s3.bucket.name = 'logs' and url_decode(r.s3.object."key") like 'raw/%' and r.s3.object."key" like '%.gz'""",
        "catalog_sql": f"{_CTES} select log_date, status, count(*) as hits, count(distinct path) as paths from parsed group by all",
        "views_sql": f"{_CTES} select coalesce(bot_name, 'none') as sender, status, count(*) as hits from named group by all",
        "classify_requests": f'{_CTES} select "date", ip, path, user_agent, bot_name, is_llm from bots',
        "llm_requests": f'{_CTES} select "date", ip, path, user_agent, bot_name from bots where is_llm',
        "agent_dimension": f"""{_CTES} select distinct user_agent, bot_name,
  coalesce(bot_name in ({_LLM}), false) as is_llm from named""",
        "bot_address_check": _ADDRESSES,
        "bot_path_daily": f"{_CTES} select * from rollup_all",
        "bot_path_daily_week": week,
        "bot_totals": f"{_CTES} select * from totals",
        "bot_daily": _DAILY,
        "bot_paths": f"{_CTES} select * from pages",
        "overall_summary": f"{_CTES} {_SUMMARY}",
        "bot_overview": _OVERVIEW,
        "top_paths_per_bot": _TOP_PATHS,
        "top_bots": f"{_CTES} select * from totals order by total_requests desc, bot_name limit 5",
        "top_bots_daily_filled": f"""{_CTES},
top as (select bot_name from totals order by total_requests desc, bot_name limit 5),
days as (select distinct "date" from daily where bot_name in (select bot_name from top))
select top.bot_name, days."date", coalesce(requests, 0) as requests
from top cross join days left join daily on daily.bot_name = top.bot_name and daily."date" = days."date\"""",
        "bot_type_by_period": f"""{_PERIODS}
select case when is_llm then 'LLM' else 'Other' end as bot_type, period, period_start,
  cast(sum(requests) as bigint) as requests from periods group by all""",
        "report_document": _DOCUMENT,
        "report_json_lines": _JSON_LINES,
        "stored_report": _OVERVIEW,
        "built_report_paths": f"{_CTES} select * from pages",
        "crawl_comparison": f"{_COMPARISON} select * from compared",
        "crawl_accuracy": f"""{_COMPARISON} select cast(sum(matched) as bigint) as matched,
  cast(sum(crawls) as bigint) as crawls, cast(sum(matched) as double) / nullif(sum(crawls), 0) as accuracy from compared""",
        "traffic_daily": _panel('"date"'),
        "traffic_hosts": _panel("ip"),
        "traffic_referrers": _panel("referrer", where="where referrer not in ('-', '')"),
        "traffic_requests": _panel('"method", path, protocol'),
        "traffic_browsers": _panel(_seen("user_agent", 1), "browser"),
        "traffic_os": _panel(_seen("user_agent", 2), "os"),
        "traffic_hours": _panel("cast(hour(local_ts) as int)", '"hour"'),
        "traffic_status": _panel("status"),
        "traffic_virtual_hosts": _panel("host"),
        "stored_dashboard": _panel("ip"),
        "traffic_capped": f"""{_RECENT}
select "method", path, protocol, {_METRICS} from recent group by all
order by hits desc, "method", path, protocol limit 25""",
        "stream_landing_counts": f'{_CTES} select bot_name, "date", count(*) as requests from bots group by all',
        "stream_daily_bots": f"""{_CTES}, found as (
  select cast(local_ts - case when tz_offset = '-05:00' then interval 5 hour * -1 else interval 0 hour end as date) as "date",
    bot_name from bots union all select date '2099-03-05', 'GPTBot')
select "date", bot_name, count(*) as requests from found group by all""",
        "written_report_json": f"select line from ({_JSON_LINES})",
        "replayed_landing": _replayed('select "date", path, status, count(*) as hits from parsed group by all'),
        "replayed_rollup": _replayed("select * from daily"),
        "damaged_landing": f"""{_CTES} select bot_name, "date", count(*) as requests from bots
where log_date >= date '2024-01-02' group by all""",
        "rejected_files": f"""with days as (select distinct cast(ts as date) as log_date, {_DAY} as d from events where day(ts) = 2)
select log_date, concat(s, '/date=', d, '/access.log-', d, '.gz') as source_file, 'rejected' as status
from days, (values ('cut'), ('plain')) as sites(s)""",
        "expired_store": f"""{_CTES}, rolled as (select log_date, count(*) as bot_requests from bots group by all)
select log_date, count(*) as requests, any_value(bot_requests) as bot_requests from parsed left join rolled using (log_date)
where log_date >= date '2024-01-21' group by all""",
        "loaded_list": f"""{_CTES}, other as (select *, {_other("user_agent")} as bot from parsed)
select "date", bot as bot_name, bot <> 'Search' as is_llm, case when trim(path) = '' then '/' else trim(path) end as path,
  count(*) as requests from other where bot is not null group by all""",
        "bad_dates": f'{_CTES} select "date", path, count(*) as hits from parsed where status <> 500 group by all',
        "named_agents": f"""with agents(n, user_agent, bot_name) as (values {", ".join(
            f"({i}, '{agent}', {repr(name) if name else 'null'})" for i, (agent, name) in enumerate(samples.AGENTS.items()))})
select user_agent, bot_name, count(*) as requests from events join agents on event_id % {len(samples.AGENTS)} = n group by all""",
        "edge_outcomes": f"""with kinds(kind, outcome) as (values {", ".join(f"({i}, '{o}')" for i, (_, o) in enumerate(samples.EDGE_LINES))})
select kind, outcome, count(*) as line_count from events join kinds on event_id % {len(samples.EDGE_LINES)} = kind group by all""",
        "grown_files": f"{_CTES} select log_date, status, count(*) as hits from parsed group by all",
        "landed_record": f"""{_CTES}, tried as (
  select 'b' as site, log_date, ok from matched
  union all select 'a', log_date, ok and day(log_date) % 3 <> 0 and event_id % 2 <> 1 from matched)
select concat(site, '/date=', cast(log_date as varchar), '/access.log-', cast(log_date as varchar), '.gz') as source_file,
  'landed' as status, count(*) filter (ok) as parsed, count(*) filter (not ok) as rejected,
  min(log_date) filter (ok) as first_date, max(log_date) filter (ok) as last_date
from tried group by site, log_date""",
        "stored_window": f"""{_CTES} select "date", path, count(*) as hits from parsed where "date" >= date '2024-01-24' group by all""",
        "reprocessed_requests": f"""{_CTES}, every as (
  select "date", path from parsed union all select log_date, '' from matched where not ok)
select "date", path, count(*) as hits from every group by all""",
        "reprocessed_rollup": f"""{_CTES}, every as (
  select bot_name, "date" from bots
  union all select {_chain("trim(regexp_extract(parts[1], '\"([^\"]*)\"$', 1))")}, log_date from matched where not ok)
select bot_name, "date", count(*) as requests from every where bot_name is not null group by all""",
        "versioned_reports": f"""select 'first' as turn, bot_name, total_requests from ({_CTES} select * from totals)
union all select 'other list', bot, n from (
  {_CTES} select {_other("user_agent")} as bot, count(*) as n from parsed group by all) where bot is not null
union all select 'replayed', bot_name, total_requests from ({_LEFT_CTES} select * from totals)""",
        "kept_dashboard": f"{_LEFT_CTES} select ip, {_METRICS} from parsed group by ip",
        "estimated_panels": f"""{_LEFT_CTES}, panels as (
  select 'hosts' as panel, ip as "key", {_METRICS} from parsed group by ip
  union all select 'status', cast(status as varchar), {_METRICS} from parsed group by status)
select panel, "key", hits, visitors, true as agrees from panels""",
        "top_paths_of_lists": _TOP_PATHS,
        "running_totals": f"""{_PERIODS}, sums as (
  select case when is_llm then 'LLM' else 'Other' end as bot_type, period, period_start,
    cast(sum(requests) as bigint) as requests from periods group by all)
select *, cast(sum(requests) over (partition by bot_type, period order by period_start) as bigint) as total from sums""",
        "missing_input": f"""{_CTES} select 'given' as input, coalesce(cast(sum(requests) as bigint), 0) as total_requests,
  count(distinct bot_name) as unique_bots from rollup_all
union all values ('no file', 0, 0), ('no store', 0, 0)""",
        "sql_parse": f"""{_CTES} select coalesce(bot_name, 'none') as sender, "date", status, count(*) as hits from named group by all""",
        "sql_outcomes": f"""{_CTES} select case when ok then 'parsed' else 'regex' end as outcome, count(*) as line_count from matched group by all""",
        "sql_table_function": f"""{_CTES} select host, "method", count(*) as hits, count(time1) as timed from parsed group by all""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _log_queries() | (training.QUERIES if training else {})


def oracle_sql() -> dict[str, str]:
    return _log_sql() | (training.ORACLES if training else {})
