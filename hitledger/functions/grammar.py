"""The access-log line grammar as SQL expressions.

``ip host ident [time] "method path protocol" status bytes "referrer" "agent"``
then optionally ``| tls | time1 time2 time3 cache extra extra extra``.
"""

from __future__ import annotations

import hashlib

from hitledger.functions.text import literal, strip, words

SEPARATOR = " | "

_WS = r"[\s\x1c-\x1f]"
_WORD = r"([^\s\x1c-\x1f]++)"

# Quantifiers are possessive wherever the next item cannot match what they took,
# so a line that does not match fails in linear time. The one plain quantifier is
# the space before the protocol, which may itself start with a space.
REQUEST_PARTS = _WORD + _WS + "++" + _WORD + _WS + '+([^"]++)'
REQUEST_REGEX = (
    r"(?s)(?U)^"
    + (_WORD + _WS + "++") * 3
    + r"\[([^\]]++)\]" + _WS + "++"
    + '"' + REQUEST_PARTS + '"' + _WS + "++"
    + r"(\d++)" + _WS + "++" + _WORD + _WS + "++"
    + '"([^"]*+)"' + _WS + '++"([^"]*+)".*$'
)
FIELDS = [
    "ip", "host", "ident", "time", "method", "path", "protocol",
    "status", "bytes", "referrer", "user_agent",
]

TIME_PATTERN = "d/MMM/yyyy:H:m:s [Z][XXX]"


def main_segment(line: str) -> str:
    """Everything before the first separator, quotes or not."""
    return f"substring_index({line}, {literal(SEPARATOR)}, 1)"


def after_segment(text: str, segment: str) -> str:
    """What follows ``segment`` and one separator; null when nothing does."""
    start = f"char_length({segment}) + {len(SEPARATOR) + 1}"
    return f"CASE WHEN octet_length({text}) > octet_length({segment}) THEN substr({text}, {start}) END"


def grammar_mark(regex: str) -> str:
    """Tells request patterns apart."""
    return hashlib.sha256(regex.encode()).hexdigest()[:16]


def request_fields(main: str, regex: str = REQUEST_REGEX) -> str:
    """All groups in one match, as an array; of length one when there is no match. Another pattern must have the same groups.

    The groups are joined by a newline, which no line can hold, and split again:
    one pass of the regular expression instead of one per column.
    """
    groups = "\n".join(f"${i}" for i in range(1, len(FIELDS) + 1))
    return f"split(regexp_replace({main}, {literal(regex)}, {literal(groups)}), {literal(chr(10))})"


def field(fields: str, name: str) -> str:
    return f"get({fields}, {FIELDS.index(name)})"


def zone(time: str) -> str:
    return f"substring_index({time}, ' ', -1)"


def single_spaced(time: str) -> str:
    """The space before the offset may be any run of white space."""
    outer = f"octet_length(substring_index({time}, ' ', 1)) + octet_length({zone(time)})"
    return (
        f"CASE WHEN {outer} + 1 = octet_length({time}) THEN {time} "
        f"ELSE array_join({words(time)}, ' ') END"
    )


def utc_offset(zone: str) -> str:
    """``+hh:mm`` from ``+hhmm``, ``+hh:mm`` or ``Z``; null for anything else."""
    return f"""CASE
        WHEN {zone} IN ('Z', '-0000', '-00:00') THEN '+00:00'
        WHEN left({zone}, 1) NOT IN ('+', '-') THEN NULL
        WHEN octet_length({zone}) = 5 THEN concat(left({zone}, 3), ':', right({zone}, 2))
        WHEN octet_length({zone}) = 6 THEN {zone} END"""


def instant(time: str, offset: str) -> str:
    """The moment of the request; null when the time is malformed or has no offset."""
    return (
        f"CASE WHEN {offset} IS NOT NULL THEN try_to_timestamp({time}, {literal(TIME_PATTERN)}) END"
    )


def local_seconds(ts: str, offset: str) -> str:
    """Seconds since the epoch on the line's own clock, whatever the session zone."""
    hours = f"try_cast(substr({offset}, 2, 2) AS INT)"
    minutes = f"try_cast(substr({offset}, 5, 2) AS INT)"
    sign = f"CASE WHEN startswith({offset}, '-') THEN -1 ELSE 1 END"
    return f"(unix_seconds({ts}) + {sign} * ({hours} * 3600 + {minutes} * 60))"


def local_date(seconds: str) -> str:
    return f"date_from_unix_date(CAST(floor({seconds} / 86400) AS INT))"


def local_hour(seconds: str) -> str:
    return f"CAST(pmod({seconds}, 86400) DIV 3600 AS INT)"


def iso_timestamp(date: str, seconds: str, offset: str) -> str:
    """ISO text on the line's own clock, such as ``2025-10-01T05:41:30+00:00``."""
    clock = (
        f"format_string('T%02d:%02d:%02d', pmod({seconds}, 86400) DIV 3600, "
        f"pmod({seconds}, 3600) DIV 60, pmod({seconds}, 60))"
    )
    return f"concat(CAST({date} AS STRING), {clock}, {offset})"


def word_at(tokens: str, index: int) -> str:
    return f"get({tokens}, {index})"


# Words other than plain numbers that count as a number, in any case.
_NOT_FINITE = {
    sign + word: sign.replace("+", "") + value
    for sign in ("", "+", "-")
    for word, value in (("nan", "NaN"), ("inf", "Infinity"), ("infinity", "Infinity"))
}


_DECIMAL = r"^[+-]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?\z"


def number_at(tokens: str, index: int) -> str:
    """The word as a number, or null.

    A cast alone would also take ``1.5d`` and hexadecimal floats, so only decimal numbers
    are cast. Spark makes an exception for each word that fails a cast, which costs as much as the match of a line.
    """
    word = word_at(tokens, index)
    pairs = ", ".join(
        f"{literal(text)}, DOUBLE('{'NaN' if 'NaN' in value else value}')"
        for text, value in _NOT_FINITE.items()
    )
    return (
        f"CASE WHEN {word} RLIKE {literal(_DECIMAL)} THEN try_cast({word} AS DOUBLE) "
        f"ELSE try_element_at(map({pairs}), lower({word})) END"
    )


def byte_count(text: str) -> str:
    # the usual mark for none is not left to a failing cast
    return f"CASE WHEN {text} = '-' THEN -1L ELSE coalesce(try_cast({text} AS BIGINT), -1L) END"


def three_decimals(number: str) -> str:
    """``%.3f`` text, empty for null."""
    return f"""CASE
        WHEN {number} IS NULL THEN ''
        WHEN isnan({number}) THEN 'nan'
        WHEN {number} = DOUBLE('Infinity') THEN 'inf'
        WHEN {number} = DOUBLE('-Infinity') THEN '-inf'
        ELSE format_string('%.3f', {number}) END"""


def request_path(path: str) -> str:
    """A blank or missing path means the root page."""
    return f"coalesce(nullif({strip(path)}, ''), '/')"
