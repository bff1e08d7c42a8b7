import math
import random
import re
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from hitledger.functions import grammar
from hitledger.functions.text import strip, strip_column, words, words_of_column
from hitledger.operators.parse import count_outcomes, csv_rows, line_outcomes, parse_lines

SAMPLES = [
    '10.20.30.40 shop.example - [07/Nov/2023:21:05:09 +0000] "GET /list/shoes/ HTTP/1.1" 200 4711 "-" '
    '"Mozilla/5.0 (compatible; ChatGPT-User/1.0)" '
    "| TLSv1.2 | 0.101 0.202 0.303 HIT 7 NC:000001 UP:200",
    '192.0.2.9 shop.example - [07/Nov/2023:21:06:00 +0000] "HEAD / HTTP/2.0" 304 0 "https://other.example" '
    '"checker/2.0 (+https://other.example)" '
    "| TLSv1.3 | 0.001 - 0.002 MISS 0 NC:000000 UP:-",
]


def one(lines, text):
    rows = parse_lines(lines(text)).collect()
    assert len(rows) == 1, text
    return rows[0]


def outcome(lines, text):
    return line_outcomes(lines(text)).first().outcome


def test_sample_lines(lines):
    first, second = (one(lines, s) for s in SAMPLES)
    assert first.date == date(2023, 11, 7)
    assert (first.ip, first.host, first.method, first.protocol) == ("10.20.30.40", "shop.example", "GET", "HTTP/1.1")
    assert (first.status, first.body_bytes_sent, first.referrer) == (200, 4711, "-")
    assert (first.tls, first.time1, first.time2, first.time3) == ("TLSv1.2", 0.101, 0.202, 0.303)
    assert (first.cache_status, first.extra_5, first.extra_6, first.extra_7) == ("HIT", "7", "NC:000001", "UP:200")
    assert (second.path, second.status, second.body_bytes_sent) == ("/", 304, 0)


def test_no_tail(lines, line):
    row = one(lines, line(tail=""))
    assert [row[c] for c in ("tls", "time1", "time2", "time3", "cache_status", "extra_5", "extra_6", "extra_7")] == [None] * 8


@pytest.mark.parametrize(
    "tail, tls, times, cache",
    [
        (" | T", "T", [None, None, None], None),
        (" |  T  | 0.010 - 0.031 HIT", "T", [0.010, None, 0.031], "HIT"),
        (" | T | 0.003, 0.004 1.5d", "T", [None, 0.004, None], None),
        (" | T | 0x1p3 1e3 .5", "T", [None, 1000.0, 0.5], None),
        (" | T | 1. +2 -3", "T", [1.0, 2.0, -3.0], None),
        (" | T | 1f 1_000 --1", "T", [None, None, None], None),
        (" | T | 0.1 0.2", "T", [0.1, 0.2, None], None),
        (" | T | 0.1\t0.2  0.3   HIT | 9 9 9", "T", [0.1, 0.2, 0.3], "HIT"),
        (" |  | ", "", [None, None, None], None),
        (" | T | | 5", "T", [None, None, None], "5"),
    ],
)
def test_tails(lines, line, tail, tls, times, cache):
    row = one(lines, line(tail=tail))
    if tail == " | T | | 5":
        # the separator needs its spaces; this is one segment of two words
        assert (row.time1, row.time2) == (None, 5.0)
        return
    if tail == " |  | ":
        # the end of the line is stripped first, which takes the last separator's space
        assert row.tls == "|"
        return
    assert (row.tls, [row.time1, row.time2, row.time3], row.cache_status) == (tls, times, cache)


def test_not_finite_metrics(lines, line):
    row = one(lines, line(tail=" | T | NaN -inf Infinity"))
    assert math.isnan(row.time1) and row.time2 == -math.inf and row.time3 == math.inf
    text = csv_rows(parse_lines(lines(line(tail=" | T | NaN -inf Infinity")))).first()
    assert (text.time1, text.time2, text.time3) == ("nan", "-inf", "inf")


@pytest.mark.parametrize("size, expected", [("-", -1), ("0", 0), ("12", 12), ("1.5", -1), ("x", -1), ("-7", -7)])
def test_bytes(lines, line, size, expected):
    assert one(lines, line(size=size)).body_bytes_sent == expected


def test_request_shapes(lines, line):
    row = one(lines, line(request="GET /a b HTTP/1.1"))
    assert (row.path, row.protocol) == ("/a", "b HTTP/1.1")
    row = one(lines, line(request='GET /a"b HTTP/1.1'))
    assert (row.path, row.protocol) == ('/a"b', "HTTP/1.1")
    assert one(lines, line(request="GET  /a   HTTP/1.1")).protocol == "HTTP/1.1"
    assert one(lines, line(request="GET /a  ")).protocol == " "


@pytest.mark.parametrize("request_text", ["-", "", "GET /", "\\x16\\x03", "GET"])
def test_requests_without_three_parts(lines, line, request_text):
    assert outcome(lines, line(request=request_text)) == "regex"


def test_separator_inside_quotes_cuts_the_line(lines, line):
    assert outcome(lines, line(agent="a | b")) == "regex"


def test_blank_lines(lines):
    assert [outcome(lines, t) for t in ("", "  ", "\t \x1c ")] == ["blank"] * 3
    assert outcome(lines, None) == "blank"


@pytest.mark.parametrize(
    "time, day, instant, offset",
    [
        ("01/Oct/2025:23:41:30 -0500", date(2025, 10, 1), datetime(2025, 10, 2, 4, 41, 30), "-05:00"),
        ("01/Oct/2025:00:30:00 +02:00", date(2025, 10, 1), datetime(2025, 9, 30, 22, 30), "+02:00"),
        ("01/Oct/2025:00:30:00 Z", date(2025, 10, 1), datetime(2025, 10, 1, 0, 30), "+00:00"),
        ("1/OCT/2025:5:4:3 +0530", date(2025, 10, 1), datetime(2025, 9, 30, 23, 34, 3), "+05:30"),
        ("01/Oct/2025:00:30:00   +0000", date(2025, 10, 1), datetime(2025, 10, 1, 0, 30), "+00:00"),
        ("01/Jan/1969:00:30:00 -0100", date(1969, 1, 1), datetime(1969, 1, 1, 1, 30), "-01:00"),
        ("29/Feb/2024:12:00:00 -0000", date(2024, 2, 29), datetime(2024, 2, 29, 12), "+00:00"),
    ],
)
def test_times(lines, line, time, day, instant, offset):
    df = parse_lines(lines(line(time=time)))
    row = df.select("date", F.unix_seconds("ts").alias("s"), "tz_offset").first()
    assert (row.date, row.tz_offset) == (day, offset)
    assert row.s == int(instant.replace(tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize(
    "time",
    [
        "31/Feb/2025:05:41:30 +0000", "01/Oct/2025:05:41:60 +0000", "01/Oct/2025:05:41:30",
        "01/Oct/2025:05:41:30 ", "01/Xyz/2025:05:41:30 +0000", "2025-10-01 05:41:30 +0000",
        "01/Oct/2025:24:00:00 +0000", "01/Oct/2025:05:41:30 UTC", "01/Oct/2025:05:41:30 0000",
    ],
)
def test_bad_times(lines, line, time):
    assert outcome(lines, line(time=time)) == "time"
    assert parse_lines(lines(line(time=time))).isEmpty()


def test_times_do_not_depend_on_the_session_zone(spark, lines, line):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = csv_rows(parse_lines(lines(line(time="01/Oct/2025:23:41:30 +0900")))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.date, row.timestamp) == ("2025-10-01", "2025-10-01T23:41:30+09:00")


def test_carriage_returns_and_damaged_text(spark, line):
    raw = [
        line(tail="").encode() + b"\r",
        line(agent="a\rb").encode(),
        line(agent="a@b").encode().replace(b"@", b"\xff"),
    ]
    df = spark.createDataFrame([(bytearray(r),) for r in raw], "raw binary").selectExpr("CAST(raw AS STRING) AS line")
    agents = [r.user_agent for r in parse_lines(df).collect()]
    assert agents == ["GPTBot/1.0", "a\rb", "a�b"]


def test_csv_text(lines, line):
    row = csv_rows(parse_lines(lines(line(size="-", tail="")))).first()
    assert (row.timestamp, row.body_bytes_sent, row.status) == ("2025-10-01T05:41:30+00:00", "-1", "200")
    assert (row.tls, row.time1, row.extra_7) == ("", "", "")
    row = csv_rows(parse_lines(lines(line(tail=" | T | 1234.5 0 7")))).first()
    assert (row.time1, row.time2, row.time3) == ("1234.500", "0.000", "7.000")


def test_every_line_is_accounted_for(spark, line):
    texts = [("a", line()), ("a", "x"), ("a", ""), ("b", line(time="31/Feb/2025:05:41:30 +0000")), ("b", line())]
    counts = count_outcomes(spark.createDataFrame(texts, "source_file string, line string"), "source_file")
    found = {(r.source_file, r.outcome): r.line_count for r in counts.collect()}
    assert found == {("a", "parsed"): 1, ("a", "regex"): 1, ("a", "blank"): 1, ("b", "time"): 1, ("b", "parsed"): 1}


def test_pattern_agrees_with_backtracking_form(spark, line):
    """The possessive pattern finds what a plainly written one finds, on mutated lines."""
    plain = re.compile(
        r'^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"(\S+)\s+(\S+)\s+([^"]+)"\s+(\d+)\s+(\S+)\s+"([^"]*)"\s+"([^"]*)"'
    )
    rng = random.Random(7)
    base = line(tail="")
    texts = []
    for _ in range(3000):
        chars = list(base)
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(chars))
            action = rng.random()
            piece = rng.choice(['"', " ", "  ", "[", "]", "\t", " ", "\x1c", "x", "7", "٧", "é", " "])
            if action < 0.4:
                chars[at] = piece
            elif action < 0.8:
                chars.insert(at, piece)
            else:
                del chars[at]
        texts.append("".join(chars))
    df = spark.createDataFrame([(t,) for t in texts], "main string")
    rows = df.selectExpr("main", f"{grammar.request_fields('main')} AS f").collect()
    matched = 0
    for row in rows:
        found = plain.match(row.main)
        if found:
            matched += 1
            assert list(found.groups()) == row.f, row.main
        else:
            assert len(row.f) == 1, row.main
    assert 300 < matched < 2900


def test_words_that_are_no_numbers_never_reach_the_cast(spark):
    """A failing cast costs an exception per word; as a strict cast, which raises, it shows that none is tried."""
    plain = ["-", "+", ".", "", "e", "1e", "+-1", "1.2.3", "1-", "--", "1.5d", "0x1p3", "MISS", "nan", "1_0", "١", None]
    numbers = {"0.031": 0.031, "1.": 1.0, ".5": 0.5, "+1e3": 1000.0, "-2.5E-1": -0.25, "007": 7.0, "1e999": float("inf")}
    words_ = spark.createDataFrame([([w],) for w in [*plain, *numbers, "-inf"]], "w array<string>")
    strict = grammar.number_at("w", 0).replace("try_cast", "cast")
    found = {row[0]: row[1] for row in words_.selectExpr("w[0]", strict).collect()}
    assert {w: found[w] for w in numbers} == numbers and found["-inf"] == float("-inf")
    assert all(found[w] is None for w in plain if w != "nan") and found["nan"] != found["nan"]
    counts = spark.createDataFrame([("-",), ("12",), ("+3",)], "b string").selectExpr(grammar.byte_count("b").replace("try_cast", "cast"))
    assert [row[0] for row in counts.collect()] == [-1, 12, 3]


def test_columns_are_stripped_and_split_as_any_text(spark):
    texts = ["", " ", "a", " a", "a ", "a b", " a", "a ", "\x1fa", "a\x1f b\t c", "　", "é", "é ", " é", "a b", "  a   b  ", "\x7f", "a\x00", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.selectExpr(strip("t") + " AS a", strip_column("t") + " AS b", words("t") + " AS c", words_of_column("t") + " AS d")
    assert all(row.a == row.b and row.c == row.d for row in rows.collect())
