"""Raw lines to typed requests, with an account of the lines that do not parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hitledger.functions import grammar as g
from hitledger.functions.text import strip, strip_column, words_of_column
from hitledger.schema import ACCESS_LOG, CSV_COLUMNS

PARSED, BLANK, BAD_REQUEST, BAD_TIME = OUTCOMES = "parsed", "blank", "regex", "time"

_WORK_COLUMNS = ["_line", "_text", "_main", "_fields", "_time", "_zone", "_offset", "_ts", "_outcome"]


def match_lines(lines: DataFrame, regex: str = g.REQUEST_REGEX) -> DataFrame:
    """Match every line once. Other columns of ``lines`` are kept.

    Each step reads the one before more than once, so the optimizer keeps the steps
    apart and the regular expression runs once per line.
    """
    kept = [c for c in lines.columns if c != "line"]
    text = lines.select(*kept, F.expr("make_valid_utf8(line)").alias("_line"))
    steps = {
        "_text": strip_column("_line"),
        "_main": g.main_segment("_text"),
        "_fields": g.request_fields("_main", regex),
        "_time": g.single_spaced(g.field("_fields", "time")),
        "_zone": g.zone("_time"),
        "_offset": g.utc_offset("_zone"),
        "_ts": g.instant("_time", "_offset"),
        "_outcome": f"""CASE WHEN coalesce(_text, '') = '' THEN '{BLANK}'
            WHEN size(_fields) <> {len(g.FIELDS)} THEN '{BAD_REQUEST}'
            WHEN _ts IS NULL THEN '{BAD_TIME}' ELSE '{PARSED}' END""",
    }
    for name, step in steps.items():
        text = text.selectExpr("*", f"{step} AS {name}")
    return text


def _request_columns() -> dict[str, str]:
    columns = {n: g.field("_fields", n) for n in g.FIELDS if n not in ("ident", "time")}
    columns["ts"] = "_ts"
    columns["tz_offset"] = "_offset"
    columns["_tail"] = g.after_segment("_text", "_main")
    return columns


def _typed(rows: DataFrame, kept: list[str]) -> DataFrame:
    """The access-log columns out of the text columns of :func:`_request_columns`."""
    tls = rows.selectExpr("*", f"{g.main_segment('_tail')} AS _tls")
    metrics = g.main_segment(g.after_segment("_tail", "_tls"))
    third = tls.selectExpr("*", f"coalesce({metrics}, '') AS _third")
    tail = third.selectExpr("*", words_of_column("_third") + " AS _words")
    typed = {
        "date": g.local_date(g.local_seconds("ts", "tz_offset")),
        "status": "try_cast(status AS INT)",
        "body_bytes_sent": g.byte_count("bytes"),
        "tls": strip("_tls"),
        "time1": g.number_at("_words", 0),
        "time2": g.number_at("_words", 1),
        "time3": g.number_at("_words", 2),
        "cache_status": g.word_at("_words", 3),
        "extra_5": g.word_at("_words", 4),
        "extra_6": g.word_at("_words", 5),
        "extra_7": g.word_at("_words", 6),
    }
    return tail.selectExpr(*[f"{typed.get(n, n)} AS {n}" for n in ACCESS_LOG.fieldNames()], *kept)


def requests_from_matches(matched: DataFrame) -> DataFrame:
    """Typed requests out of :func:`match_lines`, dropping lines that do not parse.

    The drop is the generator's: a plain filter would be pushed below the steps of
    ``match_lines`` and run the regular expression a second time.
    """
    kept = [c for c in matched.columns if c not in _WORK_COLUMNS]
    request = ", ".join(f"'{name}', {value}" for name, value in _request_columns().items())
    parsed = f"_outcome = '{PARSED}'"
    rows = matched.select(
        *kept, F.expr(f"inline(CASE WHEN {parsed} THEN array(named_struct({request})) END)")
    )
    return _typed(rows, kept)


def requests_and_rejects(matched: DataFrame) -> DataFrame:
    """Every line of :func:`match_lines` with its ``outcome``: typed columns if it parsed, else its text as ``line``."""
    kept = [c for c in matched.columns if c not in _WORK_COLUMNS]
    columns = [f"{value} AS {name}" for name, value in _request_columns().items()]
    rejected = f"CASE WHEN _outcome <> '{PARSED}' THEN _text END AS line"
    rows = matched.selectExpr(*kept, "_outcome AS outcome", rejected, *columns)
    return _typed(rows, [*kept, "outcome", "line"])


def parse_lines(lines: DataFrame) -> DataFrame:
    """Column ``line`` to the access-log columns; lines that do not parse are dropped."""
    return requests_from_matches(match_lines(lines))


def line_outcomes(lines: DataFrame) -> DataFrame:
    """Every line with its ``outcome``: parsed, or why it was not."""
    matched = match_lines(lines)
    kept = [c for c in matched.columns if c not in _WORK_COLUMNS]
    return matched.selectExpr(*kept, "_outcome AS outcome")


def count_outcomes(lines: DataFrame, *by: str) -> DataFrame:
    """Lines per outcome, so that lines = parsed + rejected for each file or day."""
    keys = by or ("log_date",)
    return (
        line_outcomes(lines)
        .groupBy(*keys, "outcome")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


def csv_rows(logs: DataFrame) -> DataFrame:
    """The nineteen columns as text, ready for a CSV file; other columns are kept."""
    columns = {
        "date": "CAST(date AS STRING)",
        "timestamp": g.iso_timestamp("date", "_seconds", "tz_offset"),
        "time1": g.three_decimals("time1"),
        "time2": g.three_decimals("time2"),
        "time3": g.three_decimals("time3"),
    }
    kept = [c for c in logs.columns if c not in ACCESS_LOG.fieldNames()]
    clocked = logs.selectExpr("*", f"{g.local_seconds('ts', 'tz_offset')} AS _seconds")
    return clocked.selectExpr(
        *[
            columns.get(n, f"coalesce(CAST({n} AS STRING), '')") + f" AS {n}"
            for n in CSV_COLUMNS
        ],
        *kept,
    )
