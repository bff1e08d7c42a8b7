"""The crawler report. Everything derives from one rollup, :func:`bot_path_daily`."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.functions.agents import is_plain
from hitledger.functions.grammar import request_path
from hitledger.functions.text import strip
from hitledger.operators.classify import classify_requests
from hitledger.sources.bots import Bot

DAYS_BACK = 365
ROLLUP_KEYS = ["date", "bot_name", "is_llm", "path"]


def window_start(as_of: date, days_back: int = DAYS_BACK) -> date:
    return as_of - timedelta(days=days_back)


def in_window(
    requests: DataFrame, as_of: date, days_back: int = DAYS_BACK, slack_days: int | None = None
) -> DataFrame:
    """Requests from ``as_of - days_back`` on. There is no upper bound.

    The filter on the stored ``date`` reaches the file statistics. ``slack_days`` also
    prunes whole file days, on the assumption that no request is dated more than that
    many days after the file that holds it.
    """
    start = window_start(as_of, days_back)
    kept = requests.where(F.col("date") >= F.lit(start))
    if slack_days is not None:
        kept = kept.where(F.col("log_date") >= F.lit(start - timedelta(days=slack_days)))
    return kept


def with_text_dates(rows: DataFrame) -> DataFrame:
    """Rows of an exported file with their text date as a DATE; bad dates are dropped."""
    parsed = F.expr(f"try_to_date({strip('date')}, 'yyyy-M-d')")
    return rows.withColumn("date", parsed).where(F.col("date").isNotNull())


def bot_path_daily(requests: DataFrame, bots: Sequence[Bot], *by: str) -> DataFrame:
    """Requests per day, crawler and page: the base rollup, with one shuffle.

    Partial aggregation runs before the shuffle, so a hot page or crawler arrives as
    one row per task. A list with real regular expressions is dear to apply; equal
    requests are then counted first, at the price of a second shuffle, and the list
    applied once to each kind.
    """
    rows = requests.select(*by, "date", "user_agent", "path")
    requests_each = F.count(F.lit(1))
    if not is_plain(bots):
        rows = rows.groupBy(*rows.columns).agg(requests_each.alias("_count"))
        requests_each = F.sum("_count")
    found = classify_requests(rows, bots)
    paged = found.withColumn("path", F.expr(request_path("path")))
    return paged.groupBy(*ROLLUP_KEYS, *by).agg(requests_each.alias("requests"))


def utc_date(ts: str) -> Column:
    """Day of an instant in UTC, whatever the zone of the session."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(ts)) / 86_400).cast("int"))


def utc_daily(file_rollup: DataFrame) -> DataFrame:
    """Requests per crawler and UTC day, out of the rollup kept per file."""
    return file_rollup.groupBy("utc_date", "bot_name").agg(_requests())


def merge_rollups(rollup: DataFrame) -> DataFrame:
    """Sum a rollup kept per file into one per day, crawler and page."""
    return rollup.groupBy(*ROLLUP_KEYS).agg(F.sum("requests").alias("requests"))


def _requests() -> Column:
    return F.sum("requests").alias("requests")


def bot_totals(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("bot_name", "is_llm").agg(F.sum("requests").alias("total_requests"))


def bot_daily(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("bot_name", "date").agg(_requests())


def bot_paths(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("bot_name", "path").agg(_requests())


def overall_summary(
    rollup: DataFrame, as_of: date, days_back: int = DAYS_BACK, approximate: bool = False
) -> DataFrame:
    """One row: the window, all crawler requests, distinct crawlers and pages.

    ``approximate`` estimates the pages, for sites where the exact count is too dear.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    counted = rollup.agg(
        F.sum("requests").alias("total_requests"),
        F.countDistinct("bot_name").alias("unique_bots"),
        distinct("path").alias("unique_paths"),
    )
    return counted.select(
        F.lit(window_start(as_of, days_back)).alias("window_from"),
        F.lit(as_of).alias("window_to"),
        F.coalesce("total_requests", F.lit(0)).cast("bigint").alias("total_requests"),
        "unique_bots", "unique_paths",
    )


def type_label(is_llm: Column) -> Column:
    return F.when(is_llm, "LLM").otherwise("Other")


def bot_overview(rollup: DataFrame) -> DataFrame:
    """Per crawler: type, total requests, days seen, distinct pages; busiest first.

    Days and pages are counted from two small sums of the rollup, which need no expanded copy of it.
    """
    days = bot_daily(rollup).groupBy("bot_name").agg(F.count(F.lit(1)).alias("days_seen"))
    pages = bot_paths(rollup).groupBy("bot_name").agg(F.count(F.lit(1)).alias("unique_paths"))
    return (
        bot_totals(rollup).join(days, "bot_name").join(pages, "bot_name")
        .select("bot_name", type_label(F.col("is_llm")).alias("bot_type"), "total_requests", "days_seen", "unique_paths")
        .orderBy(F.desc("total_requests"), "bot_name")
    )


def top_paths_per_bot(rollup: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most requested pages of each crawler; equal counts go by page name."""
    order = Window.partitionBy("bot_name").orderBy(F.desc("requests"), "path")
    return (
        bot_paths(rollup)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def top_bots(rollup: DataFrame, k: int = 5) -> DataFrame:
    return bot_totals(rollup).orderBy(F.desc("total_requests"), "bot_name").limit(k)


def top_bots_daily_filled(rollup: DataFrame, k: int = 5) -> DataFrame:
    """Daily series of the ``k`` busiest crawlers over all days any of them was seen.

    Days without a request are 0. State is one map of days per crawler, so it is
    bounded by the list and the calendar; nothing is joined.
    """
    per_bot = (
        bot_daily(rollup)
        .groupBy("bot_name")
        .agg(
            F.sum("requests").alias("total"),
            F.map_from_entries(F.collect_list(F.struct("date", "requests"))).alias("days"),
        )
        .orderBy(F.desc("total"), "bot_name")
        .limit(k)
    )
    together = per_bot.agg(
        F.collect_list(F.struct("bot_name", "days")).alias("bots"),
        F.array_distinct(F.flatten(F.collect_list(F.map_keys("days")))).alias("dates"),
    )
    return (
        together.select(F.inline("bots"), "dates")
        .select("bot_name", "days", F.explode("dates").alias("date"))
        .select(
            "bot_name", "date",
            F.coalesce(F.try_element_at("days", F.col("date")), F.lit(0)).cast("bigint").alias("requests"),
        )
    )


def bot_type_by_period(rollup: DataFrame, *units: str) -> DataFrame:
    """Requests per crawler type and period; units are ``day``, ``week``, ``month``.

    Days are summed first; the periods then come from that small result.
    """
    daily = rollup.groupBy("is_llm", "date").agg(_requests())
    names = units or ("day", "week", "month")
    periods = F.array(
        *[
            F.struct(
                F.lit(unit).alias("period"),
                (F.col("date") if unit == "day" else F.trunc("date", unit)).alias("period_start"),
            )
            for unit in names
        ]
    )
    return (
        daily.select(type_label(F.col("is_llm")).alias("bot_type"), "requests", F.inline(periods))
        .groupBy("bot_type", "period", "period_start")
        .agg(_requests())
    )


def running_totals(rollup: DataFrame, *units: str) -> DataFrame:
    """``bot_type, period, period_start, requests, total``: with the requests of each period, all up to its end.

    Prefix sums in two levels: within each year of a type, and the sums of the years before it, so that no task holds more than the
    periods of one year and one row per year.
    """
    periods = bot_type_by_period(rollup, *units).withColumn("_year", F.year("period_start"))
    kind = ["bot_type", "period"]
    within = Window.partitionBy(*kind, "_year").orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)
    years = periods.groupBy(*kind, "_year").agg(F.sum("requests").alias("_sum"))
    earlier = Window.partitionBy(*kind).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    offsets = years.select(*kind, "_year", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    summed = periods.withColumn("_within", F.sum("requests").over(within)).join(offsets, [*kind, "_year"])
    return summed.select(*kind, "period_start", "requests", (F.col("_within") + F.col("_offset")).alias("total"))


def page_lists(rollup: DataFrame, *by: str) -> DataFrame:
    """``bot_name, path, requests, rank`` for each ``by``: the pages of a crawler in one load, the most requested first."""
    pages = rollup.groupBy("bot_name", "path", *by).agg(_requests())
    order = Window.partitionBy("bot_name", *by).orderBy(F.desc("requests"), "path")
    return pages.withColumn("rank", F.row_number().over(order))


def top_paths_of_lists(lists: DataFrame, k: int = 20) -> DataFrame:
    """The same rows as :func:`top_paths_per_bot`, from the sorted lists of :func:`page_lists` and not all of their entries."""
    return top_paths_per_bot(_list_looks(lists, k)[2], k)


def _list_looks(lists: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The entries looked at, in three steps; every page of the answer is in the last with all its entries.

    1. The first ``k`` pages of every list. The ``k``-th largest sum of what was seen is a bound that the answer reaches.
    2. All entries of at least that bound over the number of lists. A page without any stays below the bound, whatever
       its lists hold, so no unseen page can enter; of those seen, some cannot either.
    3. All entries of the pages that are left.
    """
    number = lists.where("rank = 1").groupBy("bot_name").agg(F.count(F.lit(1)).alias("_lists"))
    head = lists.where(F.col("rank") <= k)
    first = _kth(head.groupBy("bot_name", "path").agg(_requests()), k)
    least = number.join(first, "bot_name", "left").select(
        "bot_name", "_lists", (F.coalesce("_kth", F.lit(0)) / F.col("_lists")).alias("_least")
    )
    # as many rows as the crawler list has entries
    seen = lists.join(F.broadcast(least), "bot_name").where(F.col("requests") >= F.col("_least"))
    sums = seen.groupBy("bot_name", "path", "_lists", "_least").agg(_requests(), F.count(F.lit(1)).alias("_seen"))
    bound = F.broadcast(_kth(sums, k))
    most = F.col("requests") + (F.col("_lists") - F.col("_seen")) * F.col("_least")
    left = sums.join(bound, "bot_name", "left").where(most >= F.coalesce("_kth", F.lit(0))).select("bot_name", "path")
    return head, seen, lists.join(left, ["bot_name", "path"], "left_semi")


def _kth(sums: DataFrame, k: int) -> DataFrame:
    """The ``k``-th largest sum of each crawler (as many rows as the list has entries); none if it has fewer pages."""
    order = Window.partitionBy("bot_name").orderBy(F.desc("requests"))
    return sums.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k).select("bot_name", F.col("requests").alias("_kth"))


def _daily_series(rollup: DataFrame) -> DataFrame:
    """One row per crawler with its total and its days in order; bounded by the calendar."""
    day = F.struct(F.col("date").cast("string").alias("date"), "requests")
    return (
        rollup.groupBy("bot_name", "is_llm", "date").agg(_requests())
        .groupBy("bot_name", "is_llm")
        .agg(
            F.sum("requests").alias("total_requests"),
            F.sort_array(F.collect_list(day)).alias("daily_requests"),
        )
    )


def report_bots(rollup: DataFrame, max_paths: int | None) -> DataFrame:
    """One row per crawler with its daily series and its pages, or the first ``max_paths`` of them.

    ``unique_paths`` tells how many pages there are. A row holds all pages it lists, so for
    sites with very many pages write :func:`report_json_lines` instead.
    """
    daily = _daily_series(rollup)
    order = Window.partitionBy("bot_name").orderBy(F.desc("requests"), "path")
    ranked = bot_paths(rollup).withColumn("rank", F.row_number().over(order))
    if max_paths is not None:
        ranked = ranked.where(F.col("rank") <= max_paths)
    pages = ranked.groupBy("bot_name").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "path", "requests"))),
            lambda p: F.struct(p["path"].alias("path"), p["requests"].alias("requests")),
        ).alias("top_paths")
    )
    # Counting a column keeps the rollup the same for all three, so it is shuffled once.
    counts = bot_paths(rollup).groupBy("bot_name").agg(F.count("requests").alias("unique_paths"))
    return daily.join(pages, "bot_name").join(counts, "bot_name").select(
        "bot_name", "is_llm", "total_requests", "unique_paths", "daily_requests", "top_paths"
    )


def report_document(
    rollup: DataFrame, as_of: date, generated_at: str, max_paths: int | None, days_back: int = DAYS_BACK
) -> DataFrame:
    """The nested report as one row: the crawlers are bounded by the list."""
    bots = report_bots(rollup, max_paths).agg(
        F.array_sort(
            F.collect_list(
                F.struct("bot_name", "is_llm", "total_requests", "unique_paths", "daily_requests", "top_paths")
            ),
            lambda a, b: F.when(a["total_requests"] > b["total_requests"], -1)
            .when(a["total_requests"] < b["total_requests"], 1)
            .when(a["bot_name"] < b["bot_name"], -1)
            .when(a["bot_name"] > b["bot_name"], 1)
            .otherwise(0),
        ).alias("bots")
    )
    summary = overall_summary(rollup, as_of, days_back)
    return summary.select(
        F.lit(generated_at).alias("generated_at"),
        F.struct(F.col("window_from").alias("from"), F.col("window_to").alias("to")).alias("window"),
        F.struct("total_requests", "unique_bots", "unique_paths").alias("overall"),
        bots.scalar().alias("bots"),
    )


LINE_ORDER = ["bot_rank", "part", "order_requests", "order_path"]
_HEAD, _BOT, _PATH, _BOT_END = 0, 1, 2, 3


def report_json_lines(
    rollup: DataFrame, as_of: date, generated_at: str, days_back: int = DAYS_BACK
) -> DataFrame:
    """The whole report as lines of one JSON document, however many pages it lists.

    Sorted by :data:`LINE_ORDER` and put one below the other, the ``line`` values are
    the document. No task holds more than one line per page: only the daily series
    are gathered, bounded by days, and the sort is by range, which splits a crawler
    with very many pages.
    """
    no_path = [F.lit(0).cast("bigint").alias("order_requests"), F.lit("").alias("order_path")]
    pages = bot_paths(rollup)
    first = pages.groupBy("bot_name").agg(
        F.min(F.struct((-F.col("requests")).alias("order_requests"), "path"))["path"].alias("first_path")
    )
    daily = _daily_series(rollup)
    # One row per crawler, at most as many as the list has entries.
    ranked = (
        daily.join(first, "bot_name")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("total_requests")).alias("order_total"), "bot_name", "is_llm",
                        "total_requests", "daily_requests", "first_path",
                    )
                )
            ).alias("bots")
        )
        .select(F.posexplode("bots").alias("pos", "bot"))
        .select((F.col("pos") + 1).alias("bot_rank"), "bot.*")
    )
    bot = ranked.select(
        "bot_rank", F.lit(_BOT).alias("part"), *no_path,
        F.concat(
            F.when(F.col("bot_rank") > 1, ",").otherwise(""),
            F.lit('{"bot_name":'), _json_text("bot_name"),
            F.lit(',"is_llm":'), F.col("is_llm").cast("string"),
            F.lit(',"total_requests":'), F.col("total_requests").cast("string"),
            F.lit(',"daily_requests":'), F.to_json("daily_requests"),
            F.lit(',"top_paths":['),
        ).alias("line"),
    )
    bot_end = ranked.select("bot_rank", F.lit(_BOT_END).alias("part"), *no_path, F.lit("]}").alias("line"))
    places = ranked.select("bot_name", "bot_rank", "first_path")
    path = pages.join(places, "bot_name").select(
        "bot_rank", F.lit(_PATH).alias("part"),
        (-F.col("requests")).alias("order_requests"), F.col("path").alias("order_path"),
        F.concat(
            F.when(F.col("path") == F.col("first_path"), "").otherwise(","),
            F.to_json(F.struct("path", "requests")),
        ).alias("line"),
    )
    head = overall_summary(rollup, as_of, days_back).select(
        F.lit(0).alias("bot_rank"), F.lit(_HEAD).alias("part"), *no_path,
        F.concat(
            F.lit(f'{{"generated_at":"{generated_at}","window":'),
            F.to_json(
                F.struct(
                    F.col("window_from").cast("string").alias("from"),
                    F.col("window_to").cast("string").alias("to"),
                )
            ),
            F.lit(',"overall":'),
            F.to_json(F.struct("total_requests", "unique_bots", "unique_paths")),
            F.lit(',"bots":['),
        ).alias("line"),
    )
    tail = rollup.sparkSession.range(1).select(
        F.lit(2**31 - 1).alias("bot_rank"), F.lit(_BOT_END).alias("part"), *no_path, F.lit("]}").alias("line")
    )
    return head.unionByName(bot).unionByName(path).unionByName(bot_end).unionByName(tail)


def _json_text(name: str) -> Column:
    """A string column as a JSON string, quotes and escapes included."""
    return F.regexp_extract(F.to_json(F.struct(F.col(name).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
