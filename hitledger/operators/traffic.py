"""Traffic panels over all requests, crawlers and people alike.

Every panel has the same metrics: ``hits``, ``bytes`` (known sizes only) and
``visitors``, the distinct (address, agent, day) combinations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hitledger.functions.agents import BROWSERS, SYSTEMS, family
from hitledger.functions.grammar import local_hour, local_seconds


def _bytes() -> Column:
    return F.coalesce(
        F.sum(F.when(F.col("body_bytes_sent") >= 0, F.col("body_bytes_sent"))), F.lit(0)
    ).cast("bigint")


def panel(requests: DataFrame, *keys: str | Column) -> DataFrame:
    """Metrics per key.

    The distinct count makes Spark group by key and visitor first, so a key that holds
    most requests is spread over its visitors before the final sum.
    """
    return requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("hits"),
        _bytes().alias("bytes"),
        F.countDistinct("ip", F.coalesce("user_agent", F.lit("")), "date").alias("visitors"),
    )


def traffic_daily(requests: DataFrame) -> DataFrame:
    return panel(requests, "date")


def traffic_hosts(requests: DataFrame) -> DataFrame:
    return panel(requests, "ip")


def traffic_referrers(requests: DataFrame) -> DataFrame:
    return panel(requests.where(~F.col("referrer").isin("-", "")), "referrer")


def traffic_requests(requests: DataFrame) -> DataFrame:
    return panel(requests, "method", "path", "protocol")


def _family_panel(requests: DataFrame, name: str, families: dict[str, list[str]]) -> DataFrame:
    """Count per visitor before looking at the agent: one look per visitor, not per request."""
    per_visitor = requests.groupBy(
        "ip", F.coalesce("user_agent", F.lit("")).alias("user_agent"), "date"
    ).agg(F.count(F.lit(1)).alias("hits"), _bytes().alias("bytes"))
    return (
        per_visitor.withColumn("_folded", F.lower("user_agent"))
        .groupBy(F.expr(family("_folded", families)).alias(name))
        .agg(
            F.sum("hits").alias("hits"),
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("visitors"),
        )
    )


def traffic_browsers(requests: DataFrame) -> DataFrame:
    return _family_panel(requests, "browser", BROWSERS)


def traffic_systems(requests: DataFrame) -> DataFrame:
    return _family_panel(requests, "os", SYSTEMS)


def traffic_hours(requests: DataFrame) -> DataFrame:
    """By hour of the day on each line's own clock."""
    hour = local_hour(local_seconds("ts", "tz_offset"))
    return panel(requests, F.expr(hour).alias("hour"))


def traffic_status(requests: DataFrame) -> DataFrame:
    return panel(requests, "status")


def traffic_virtual_hosts(requests: DataFrame) -> DataFrame:
    return panel(requests, "host")


#: The panels of a dashboard and the types of their keys.
PANELS: dict[str, dict[str, str]] = {
    "daily": {"date": "date"},
    "hosts": {"ip": "string"},
    "referrers": {"referrer": "string"},
    "requests": {"method": "string", "path": "string", "protocol": "string"},
    "browsers": {"browser": "string"},
    "os": {"os": "string"},
    "hours": {"hour": "int"},
    "status": {"status": "int"},
    "virtual_hosts": {"host": "string"},
}


def _keyed(keys: dict[str, str]) -> str:
    """Array of structs of panel and keys (as text), from panel names and the SQL of their keys."""
    return "array(" + ", ".join(f"struct('{name}' AS panel, {sql} AS keys)" for name, sql in keys.items()) + ")"


#: Panels whose key is a matter of the request; those of ``_OF_VISITOR`` follow from the visitor alone.
_OF_REQUEST = {
    "visitor": "CAST(array() AS array<string>)",
    "referrers": "CASE WHEN referrer NOT IN ('-', '') THEN array(referrer) END",
    "requests": "array(method, path, protocol)",
    "hours": "array(CAST(_hour AS STRING))",
    "status": "array(CAST(status AS STRING))",
    "virtual_hosts": "array(host)",
}
_OF_VISITOR = {
    "daily": "array(CAST(date AS STRING))",
    "hosts": "array(ip)",
    "browsers": f"array({family('_folded', BROWSERS)})",
    "os": f"array({family('_folded', SYSTEMS)})",
}
_VISITOR = ["ip", "_agent", "date"]


def panel_visits(requests: DataFrame, *by: str) -> DataFrame:
    """Hits and bytes per panel, key and visitor, from one scan; ``by`` keeps them apart by further columns.

    A key that holds most requests is spread over its visitors.
    """
    hour = F.expr(local_hour(local_seconds("ts", "tz_offset"))).alias("_hour")
    timed = requests.select("*", hour, F.coalesce("user_agent", F.lit("")).alias("_agent"))
    keyed = F.expr(f"inline({_keyed(_OF_REQUEST)})")
    each = timed.select(*_VISITOR, "body_bytes_sent", *by, keyed).where("keys IS NOT NULL")
    return each.groupBy("panel", "keys", *_VISITOR, *by).agg(F.count(F.lit(1)).alias("hits"), _bytes().alias("bytes"))


def merge_visits(visits: DataFrame) -> DataFrame:
    """Visits kept by file as one per panel, key and visitor: a visitor who is in several files is one."""
    return visits.groupBy("panel", "keys", *_VISITOR).agg(F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes"))


def _all_panels(visits: DataFrame, *columns: str) -> DataFrame:
    """Visits under every panel they count in. The families of agents are worked out once per visitor."""
    own = "array(struct(panel, keys))"
    folded = visits.withColumn("_folded", F.lower("_agent"))
    spread = F.expr(f"inline(CASE WHEN panel = 'visitor' THEN {_keyed(_OF_VISITOR)} ELSE {own} END)")
    return folded.select("hits", "bytes", *columns, spread)


def panels_of_visits(visits: DataFrame) -> DataFrame:
    """The rows of all panels in one table, ``panel, keys, hits, bytes, visitors``, from visits that are one per visitor."""
    return _all_panels(visits).groupBy("panel", "keys").agg(
        F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("visitors")
    )


def panel_rows(requests: DataFrame) -> DataFrame:
    """The same from requests, by one scan."""
    return panels_of_visits(panel_visits(requests))


#: Size of the sketches of visitors: the estimate's standard error is 1.04 / sqrt(2^K), here 1.6 %.
SKETCH_K = 12


def panel_sketches(requests: DataFrame, *by: str) -> DataFrame:
    """Per panel and key: hits, bytes and a sketch of the visitors. Sketches merge, so they may be kept by file."""
    visits = _all_panels(panel_visits(requests, *by), *_VISITOR, *by)
    visitor = F.xxhash64(*_VISITOR)
    return visits.groupBy("panel", "keys", *by).agg(
        F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes"), F.hll_sketch_agg(visitor, SKETCH_K).alias("visitors")
    )


def panels_of_sketches(sketches: DataFrame) -> DataFrame:
    """The rows of all panels with estimated visitors; hits and bytes are exact."""
    return sketches.groupBy("panel", "keys").agg(
        F.sum("hits").alias("hits"), F.sum("bytes").alias("bytes"), F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors")
    )


def one_panel(rows: DataFrame, name: str, keys: dict[str, str]) -> DataFrame:
    """One panel out of :func:`panel_rows`, with its keys as columns."""
    columns = [F.col("keys")[i].cast(kind).alias(key) for i, (key, kind) in enumerate(keys.items())]
    return rows.where(F.col("panel") == name).select(*columns, "hits", "bytes", "visitors")


def last_dates_start(requests: DataFrame, days: int) -> DataFrame:
    """One row: the earliest of the last ``days`` dates that occur."""
    dates = requests.select("date").distinct().orderBy(F.desc("date")).limit(days)
    return dates.agg(F.min("date").alias("start"))


def keep_last_dates(requests: DataFrame, days: int) -> DataFrame:
    """Requests of the last ``days`` dates that occur, however far apart they are."""
    return requests.where(F.col("date") >= last_dates_start(requests, days).scalar())


def top_items(panel_rows: DataFrame, max_items: int) -> DataFrame:
    """The busiest rows of a panel; equal hits go by key."""
    keys = [c for c in panel_rows.columns if c not in ("hits", "bytes", "visitors")]
    return panel_rows.orderBy(F.desc("hits"), *keys).limit(max_items)
