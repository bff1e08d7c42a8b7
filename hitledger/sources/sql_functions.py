"""The line grammar and the crawler list as persistent SQL functions, for users who have only SQL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from hitledger.functions import agents, grammar as g
from hitledger.functions.text import fold_case, strip, words
from hitledger.schema import ACCESS_LOG
from hitledger.sources.bots import Bot


def _typed_columns() -> dict[str, str]:
    """The access-log columns from ``core``, what a match gives, ``tls`` and ``metrics``."""
    columns = {n: g.field("core.fields", n) for n in g.FIELDS if n in ACCESS_LOG.fieldNames()}
    return columns | {
        "date": g.local_date(g.local_seconds("core.ts", "core.tz_offset")),
        "ts": "core.ts",
        "tz_offset": "core.tz_offset",
        "status": f"try_cast({g.field('core.fields', 'status')} AS INT)",
        "body_bytes_sent": g.byte_count(g.field("core.fields", "bytes")),
        "tls": strip("tls"),
        "time1": g.number_at("metrics", 0),
        "time2": g.number_at("metrics", 1),
        "time3": g.number_at("metrics", 2),
        "cache_status": g.word_at("metrics", 3),
        "extra_5": g.word_at("metrics", 4),
        "extra_6": g.word_at("metrics", 5),
        "extra_7": g.word_at("metrics", 6),
    }


def _bound(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is worked out once, wherever the optimizer moves the whole."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def register_functions(
    spark: SparkSession, prefix: str, bots: Sequence[Bot], regex: str = g.REQUEST_REGEX
) -> str:
    """Create or replace the functions in database ``<prefix>_logs_db``; returns the database.

    - ``parse_line(line)``: the request as a struct of the access-log columns, null when the line does not parse.
    - ``line_outcome(line)``: ``parsed``, or why it was not.
    - ``request_of_line(line)``: a table function with one row for a line that parses and none for another. Spark's parser takes
      no database before a table function, so ``USE`` the database first.
    - ``crawler_name(user_agent)``: the first entry of the list that matches, or null; ``crawler_is_llm(name)``.

    The steps of the match are bound inside one expression. As columns of their own they would be put in place of their names
    when a filter on the request moves below them, and the pattern would run once for each place. The table function drops lines by a
    generator, which may hold no other SQL function: beside a filter Spark would parse the distinct lines of the whole input and
    join them to all lines.
    """
    database = f"`{re.sub(r'\W', '_', prefix, flags=re.ASCII)}_logs_db`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def create(signature: str, returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{signature} RETURNS {returns} RETURN {body}")

    def call(name: str, *values: str) -> str:
        return f"{database}.{name}({', '.join(values)})"

    columns = _typed_columns()
    fields = ACCESS_LOG.fields
    struct = "STRUCT<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in fields) + ">"
    values = ", ".join(f"'{f.name}', {columns[f.name]}" for f in fields)

    steps = {
        "main": g.main_segment("text"), "fields": g.request_fields("main", regex), "clock": g.single_spaced(g.field("fields", "time")),
        "zone": g.zone("clock"), "tz_offset": g.utc_offset("zone"), "ts": g.instant("clock", "tz_offset"),
    }
    text = strip("make_valid_utf8(line)")

    def matched(body: str) -> str:
        """``body`` over ``text`` and the steps, of which each is worked out once."""
        for name, step in [*reversed(steps.items()), ("text", text)]:
            body = _bound(name, step, body)
        return body

    parts = f"'fields', fields, 'ts', ts, 'tz_offset', tz_offset, 'tail', {g.after_segment('text', 'main')}"
    whole = f"size(fields) = {len(g.FIELDS)}"
    core = matched(f"CASE WHEN {whole} AND ts IS NOT NULL THEN named_struct({parts}) END")
    # the third segment, of which the words are the metrics
    metrics = words(f"coalesce({g.main_segment(g.after_segment('core.tail', 'tls'))}, '')")
    request = _bound("tls", g.main_segment("core.tail"), _bound("metrics", metrics, f"named_struct({values})"))
    requests = f"transform(filter(array({core}), core -> core IS NOT NULL), core -> {request})"  # one or none
    create("parse_line(line STRING)", struct, f"get({requests}, 0)")
    outcome = f"""CASE WHEN coalesce(text, '') = '' THEN 'blank' WHEN {whole} AND ts IS NOT NULL THEN 'parsed'
        WHEN {whole} THEN 'time' ELSE 'regex' END"""
    create("line_outcome(line STRING)", "STRING", matched(outcome))
    table = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    create("request_of_line(line STRING)", f"TABLE({table})", f"SELECT inline({requests})")
    create("_name(agent STRING, folded STRING)", "STRING", agents.bot_name("agent", "folded", bots))
    create("_agent_name(agent STRING)", "STRING", call("_name", "agent", fold_case("agent")))
    create("crawler_name(user_agent STRING)", "STRING", call("_agent_name", agents.clean_agent("user_agent")))
    create("crawler_is_llm(name STRING)", "BOOLEAN", agents.is_llm("name", bots))
    return database
