from datetime import date

import pytest
from pyspark.sql import functions as F

from hitledger.functions.agents import BROWSERS, SYSTEMS, family
from hitledger.operators import traffic as t
from hitledger.operators.parse import parse_lines
from hitledger.operators.traffic import PANELS
from hitledger.plans.dashboard import build_dashboard, read_dashboard


def log(lines, line, *specs):
    return parse_lines(lines(*[line(**s) for s in specs]))


def metrics(df, *keys):
    return {tuple(r[k] for k in keys): (r.hits, r.bytes, r.visitors) for r in df.collect()}


def test_metrics(lines, line):
    df = log(
        lines, line,
        dict(ip="1.1.1.1", size="10"), dict(ip="1.1.1.1", size="-"), dict(ip="1.1.1.1", size="5", agent="other"),
        dict(ip="2.2.2.2", size="7", time="02/Oct/2025:01:00:00 +0000"), dict(ip="1.1.1.1", size="0", agent=""),
    )
    assert metrics(t.traffic_daily(df), "date") == {(date(2025, 10, 1),): (4, 15, 3), (date(2025, 10, 2),): (1, 7, 1)}
    assert metrics(t.traffic_hosts(df), "ip") == {("1.1.1.1",): (4, 15, 3), ("2.2.2.2",): (1, 7, 1)}
    assert metrics(t.traffic_virtual_hosts(df), "host") == {("example.com",): (5, 22, 4)}
    assert metrics(t.traffic_browsers(df), "browser") == {("Crawler",): (3, 17, 2), ("Unknown",): (2, 5, 2)}


def test_only_unknown_sizes(lines, line):
    assert metrics(t.traffic_status(log(lines, line, dict(size="-"))), "status") == {(200,): (1, 0, 1)}


def test_referrers(lines, line):
    df = log(lines, line, dict(referrer="-"), dict(referrer=""), dict(referrer="https://a/"))
    assert list(metrics(t.traffic_referrers(df), "referrer")) == [("https://a/",)]


def test_hours_are_the_lines_own(spark, lines, line):
    df = log(lines, line, dict(time="01/Oct/2025:23:59:59 -0500"), dict(time="01/Oct/2025:00:00:00 +0930"))
    assert set(metrics(t.traffic_hours(df), "hour")) == {(23,), (0,)}


def test_keep_last_dates_counts_dates_that_occur(lines, line):
    df = log(lines, line, *[dict(time=f"{d:02d}/Oct/2025:05:00:00 +0000") for d in (1, 5, 20, 20)])
    assert t.keep_last_dates(df, 2).count() == 3
    assert t.keep_last_dates(df, 9).count() == 4
    assert t.keep_last_dates(df.limit(0), 2).isEmpty()


def test_top_items(lines, line):
    df = log(lines, line, *[dict(ip=ip) for ip in ("9.9.9.9", "8.8.8.8", "7.7.7.7", "7.7.7.7")])
    assert [r.ip for r in t.top_items(t.traffic_hosts(df), 2).collect()] == ["7.7.7.7", "8.8.8.8"]


@pytest.mark.parametrize(
    "agent, browser, system",
    [
        ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/116.0.0.0 Safari/537.36", "Chrome", "Windows"),
        ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/116.0 Safari/537.36 Edg/116.0", "Edge", "Windows"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 Version/16.5 Safari/604.1", "Safari", "iOS"),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Gecko/20100101 Firefox/115.0", "Firefox", "macOS"),
        ("Mozilla/5.0 (Linux; Android 13) Chrome/116.0 Mobile Safari/537.36 OPR/76", "Opera", "Android"),
        ("Mozilla/5.0 (X11; CrOS x86_64) Chrome/116.0 Safari/537.36", "Chrome", "Chrome OS"),
        ("Mozilla/5.0 (X11; Linux x86_64) Gecko Firefox/115.0", "Firefox", "Linux"),
        ("Mozilla/5.0 (compatible; Googlebot/2.1)", "Crawler", "Unknown"),
        ("-", "Unknown", "Unknown"),
    ],
)
def test_families(spark, agent, browser, system):
    df = spark.createDataFrame([(agent.lower(),)], "a string")
    row = df.select(F.expr(family("a", BROWSERS)).alias("b"), F.expr(family("a", SYSTEMS)).alias("s")).first()
    assert (row.b, row.s) == (browser, system)


def test_dashboard(spark, lines, line, tmp_path):
    df = log(lines, line, dict(), dict(time="03/Oct/2025:05:00:00 +0000", ip="9.9.9.9"), dict(ip="1.1.1.1"))
    build_dashboard(df, str(tmp_path), date(2020, 1, 1), keep_dates=5, max_items=2)
    panels = read_dashboard(spark, str(tmp_path), date(2020, 1, 1))
    assert set(panels) == set(PANELS)
    assert panels["hosts"].count() == 2 and panels["daily"].count() == 2
    build_dashboard(df, str(tmp_path), date(2020, 1, 1), keep_dates=1)
    assert [r.ip for r in panels["hosts"].sparkSession.read.parquet(f"{tmp_path}/hosts").collect()] == ["9.9.9.9"]
    build_dashboard(df.limit(0), str(tmp_path), date(2020, 1, 2))
    assert read_dashboard(spark, str(tmp_path), date(2020, 1, 2))["os"].isEmpty()


def test_panels_of_one_scan_equal_the_single_ones(spark, lines, line, tmp_path):
    df = log(
        lines, line, dict(), dict(), dict(time="03/Oct/2025:23:00:00 -0500", ip="9.9.9.9", agent="", referrer="x"), dict(size="-", status="404"),
        dict(agent="Firefox/1 Windows", host="b.example", request="POST /b HTTP/1.1"),
    )
    build_dashboard(df, str(tmp_path), date(2020, 1, 1))
    single = {
        "daily": t.traffic_daily, "hosts": t.traffic_hosts, "referrers": t.traffic_referrers, "requests": t.traffic_requests,
        "browsers": t.traffic_browsers, "os": t.traffic_systems, "hours": t.traffic_hours, "status": t.traffic_status,
        "virtual_hosts": t.traffic_virtual_hosts,
    }
    for name, panel in read_dashboard(spark, str(tmp_path), date(2020, 1, 1)).items():
        want = single[name](df)
        assert panel.dtypes == want.dtypes, name
        assert sorted(map(str, panel.collect())) == sorted(map(str, want.collect())), name
    plan = t.panel_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
