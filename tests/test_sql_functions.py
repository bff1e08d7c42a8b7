"""The grammar as SQL functions gives what the operators give."""

import pytest

from conftest import request_line
from hitledger.operators.classify import name_bots
from hitledger.operators.parse import line_outcomes, parse_lines
from hitledger.sources.bots import default_bots
from hitledger.sources.sql_functions import register_functions

LINES = [
    request_line(), request_line(tail=""), request_line(size="-", agent=""), request_line(agent=" GPTBot \u212a "), request_line(request="-"),
    request_line(tail=" | T | nan - 1e3 HIT 1 2 3 4"), request_line(tail=" |  | 0.1, 2"), request_line(time="31/Feb/2025:00:00:00 +0000"),
    request_line(time="1/OCT/2025:05:41:30   Z"), request_line(time="01/Oct/2025:23:41:30 -0500"), request_line(time="01/Oct/2025:23:41:30"),
    request_line(agent='x" | y'), request_line(request='GET /a b HTTP/1.1', agent="wpXcom feedbot"), "", "  \t ", "junk", request_line() + "\r", None,
]


@pytest.fixture(scope="module")
def db(spark):
    return register_functions(spark, "test-functions", default_bots())


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.createDataFrame([(t,) for t in LINES], "line string")
    frame.createOrReplaceTempView("sql_lines")
    return frame


def test_requests(spark, db, rows):
    want = sorted(map(repr, map(tuple, parse_lines(rows).collect())))
    found = spark.sql(f"SELECT r.* FROM (SELECT {db}.parse_line(line) AS r FROM sql_lines) WHERE r IS NOT NULL")
    assert sorted(map(repr, map(tuple, found.collect()))) == want
    assert found.schema.simpleString() == parse_lines(rows).schema.simpleString()
    spark.sql(f"USE {db}")
    beside = spark.sql("SELECT r.* FROM sql_lines AS t, LATERAL request_of_line(t.line) AS r")
    spark.sql("USE default")
    assert sorted(map(repr, map(tuple, beside.collect()))) == want


def test_outcomes(spark, db, rows):
    want = sorted(x.outcome for x in line_outcomes(rows).collect())
    assert sorted(x[0] for x in spark.sql(f"SELECT {db}.line_outcome(line) FROM sql_lines").collect()) == want


def test_names(spark, db, rows):
    requests = parse_lines(rows)
    requests.createOrReplaceTempView("sql_requests")
    want = sorted(map(repr, ((x.bot_name, x.is_llm) for x in name_bots(requests, default_bots()).collect())))
    names = f"{db}.crawler_name(user_agent)"
    found = spark.sql(f"SELECT {names}, {db}.crawler_is_llm({names}) FROM sql_requests").collect()
    assert sorted(map(repr, map(tuple, found))) == want


def test_the_pattern_runs_once_per_line(spark, db, rows):
    text = spark.sql(f"SELECT {db}.parse_line(line) AS r FROM sql_lines")._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_replace(") == 1


@pytest.mark.parametrize(
    "query",
    [
        "SELECT r.host, r.date, r.time1 FROM (SELECT {db}.parse_line(line) AS r FROM sql_lines) WHERE r IS NOT NULL",
        "SELECT r.host, r.date, r.time1 FROM sql_lines AS t, LATERAL request_of_line(t.line) AS r",
    ],
)
def test_a_filter_on_requests_does_not_multiply_the_pattern(spark, db, rows, query):
    spark.sql(f"USE {db}")
    text = spark.sql(query.format(db=db))._jdf.queryExecution().executedPlan().toString()
    spark.sql("USE default")
    assert 0 < text.count("regexp_replace(") <= 3  # a filter and the columns behind it


def test_the_table_function_beside_lines_needs_no_join(spark, db, rows):
    """Lines stay where they are: no shuffle of their text, and one match for each line, also of lines that repeat."""
    spark.sql(f"USE {db}")
    found = spark.sql("SELECT t.line, r.host, r.status FROM (SELECT * FROM sql_lines UNION ALL SELECT * FROM sql_lines) AS t, LATERAL request_of_line(t.line) AS r")
    spark.sql("USE default")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text and "Aggregate" not in text
    once = sum(1 for _ in parse_lines(rows).collect())
    assert found.count() == 2 * once
