"""Which crawler sent a request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hitledger.functions import addresses, agents
from hitledger.functions.text import fold_case
from hitledger.sources.bots import Bot


def _with_names(requests: DataFrame, bots: Sequence[Bot]) -> DataFrame:
    # Each step is read more than once by the next, so the optimizer keeps them apart.
    kept = [c for c in requests.columns if c not in ("bot_name", "is_llm")]
    clean = requests.selectExpr(*kept, f"{agents.clean_agent('user_agent')} AS _agent")
    folded = clean.selectExpr("*", f"{fold_case('_agent')} AS _folded")
    return folded.selectExpr(*kept, f"{agents.bot_name('_agent', '_folded', bots)} AS bot_name")


def _with_flag(named: DataFrame, bots: Sequence[Bot]) -> DataFrame:
    return named.selectExpr("*", f"{agents.is_llm('bot_name', bots)} AS is_llm")


def name_bots(requests: DataFrame, bots: Sequence[Bot]) -> DataFrame:
    """Add ``bot_name`` (null for other traffic) and ``is_llm`` to every request.

    No shuffle and no join: a user agent that sends a third of all requests costs no
    more than any other.
    """
    return _with_flag(_with_names(requests, bots), bots)


def classify_requests(
    requests: DataFrame, bots: Sequence[Bot], llm_only: bool = False
) -> DataFrame:
    """Only the requests some crawler of the list sent, or only those of language models."""
    named = _with_names(requests, bots)
    kept = [c for c in named.columns if c != "bot_name"]
    # Generator instead of a filter, which would run the whole chain a second time.
    name = F.expr("inline(CASE WHEN bot_name IS NOT NULL THEN array(struct(bot_name)) END)")
    found = _with_flag(named.select(*kept, name), bots)
    return found.where("is_llm") if llm_only else found


def agent_dimension(requests: DataFrame, bots: Sequence[Bot]) -> DataFrame:
    """Every distinct user agent with its crawler, to read or to check a new list by."""
    return name_bots(requests.select("user_agent").distinct(), bots)


def check_bot_addresses(classified: DataFrame, bots: Sequence[Bot]) -> DataFrame:
    """Requests per crawler by whether the client address lies in its published ranges, IPv4 and IPv6 alike.

    ``verdict`` is ``inside``, ``outside``, ``no_ranges`` or ``no_address``. Addresses
    are counted before they are compared. A crawler's ranges are one sorted array, overlapping ones merged, which joins
    by the crawler's name (as many rows as the list has entries) and is searched by bisection.
    """
    spark = classified.sparkSession
    counted = classified.groupBy("bot_name", "ip").agg(F.count(F.lit(1)).alias("requests"))
    lists = [
        (bot.name, [(addresses.halves(a), addresses.halves(b)) for a, b in addresses.merged_ranges(bot.ip_ranges)])
        for bot in bots if bot.ip_ranges
    ]
    ranges = F.broadcast(spark.createDataFrame(lists, f"bot_name STRING, _ranges {addresses.RANGES}"))
    numbered = addresses.with_address_number(counted, "ip", "_number").join(ranges, "bot_name", "left")
    verdict = f"""CASE WHEN _ranges IS NULL THEN 'no_ranges' WHEN _number IS NULL THEN 'no_address'
        WHEN {addresses.in_ranges("_number", "_ranges")} THEN 'inside' ELSE 'outside' END"""
    return (
        numbered.select("bot_name", "requests", F.expr(verdict).alias("verdict"))
        .groupBy("bot_name", "verdict")
        .agg(F.sum("requests").alias("requests"))
    )
