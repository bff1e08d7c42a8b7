import glob
import gzip
import os
import random
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import request_line
from hitledger.operators import report as r
from hitledger.operators.parse import parse_lines
from hitledger.plans import landing, reporting
from hitledger.plans.landing import land_files, land_new, refresh_rollup
from hitledger.plans.reporting import build_report, build_report_from_rollup, read_report
from hitledger.plans.store import Store
from hitledger.session import scratch_dir
from hitledger.sinks.access import write_csv, write_raw_lines
from hitledger.sinks.retention import expire_raw_logs, expire_store
from hitledger.sources.bots import bots_from_mapping, default_bots
from hitledger.sources.catalog import register_access_table, register_views
from hitledger.sources.crawl_stats import read_crawl_stats
from hitledger.sources.raw import list_files, read_raw_lines, spread_lines
from hitledger.sources.table import read_access_csv
from hitledger.streaming.daily_bots import read_daily_bots
from hitledger.streaming.landing import stream_landing

BOTS = default_bots()


def put(root, day, texts, name=None):
    folder = f"{root}/raw/date={day}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name or f'access.log-{day}.gz'}"
    data = b"\n".join(t if isinstance(t, bytes) else t.encode() for t in texts)
    with gzip.open(path, "wb") as f:
        f.write(data)
    return path


def stamp(day, hour=5):
    return datetime.strptime(day, "%Y-%m-%d").strftime(f"%d/%b/%Y:{hour:02d}:00:00 +0000")


@pytest.fixture
def root(tmp_path):
    put(tmp_path, "2025-10-01", [request_line(time=stamp("2025-10-01"))] * 3 + ["", "junk"])
    put(
        tmp_path, "2025-10-02",
        [request_line(time=stamp("2025-10-02"), agent="bingbot"), request_line(time=stamp("2025-10-01", 23))],
    )
    return str(tmp_path)


def by_day(rollup):
    merged = r.bot_daily(r.merge_rollups(rollup)).collect()
    return {(x.bot_name, x.date): x.requests for x in merged}


EXPECTED = {
    ("GPTBot", date(2025, 10, 1)): 4,
    ("BingBot", date(2025, 10, 2)): 1,
}


def test_raw_lines_know_their_file(spark, root):
    rows = read_raw_lines(spark, f"{root}/raw").select("log_date", "source_file").distinct().collect()
    assert {(x.log_date, x.source_file) for x in rows} == {
        (date(2025, 10, d), f"access.log-2025-10-0{d}.gz") for d in (1, 2)
    }
    plain = f"{root}/access.log-2025-11-03"
    with open(plain, "w") as f:
        f.write("x\n")
    assert read_raw_lines(spark, plain).first().log_date == date(2025, 11, 3)


def test_lines_end_at_a_newline_only(spark, tmp_path):
    path = put(
        tmp_path, "2025-10-01",
        [request_line(agent="a\rb"), request_line(tail="") + "\r", request_line(agent="a@b").encode().replace(b"@", b"\xff"), request_line(agent="a b")],
    )
    rows = parse_lines(read_raw_lines(spark, path)).collect()
    assert sorted(x.user_agent for x in rows) == sorted(["a\rb", "GPTBot/1.0", "a�b", "a b"])


def test_land_and_replay(spark, root):
    store = Store(f"{root}/store")
    assert store.read_access(spark).isEmpty() and store.read_rollup(spark, BOTS).isEmpty()
    counts = land_files(spark, f"{root}/raw", store, BOTS)
    assert counts == {"parsed": 5, "blank": 1, "regex": 1, "time": 0}
    assert by_day(store.read_rollup(spark, BOTS)) == EXPECTED
    before = sorted(map(str, store.read_access(spark).collect()))
    land_files(spark, f"{root}/raw/date=2025-10-02", store, BOTS)
    assert sorted(map(str, store.read_access(spark).collect())) == before
    assert by_day(store.read_rollup(spark, BOTS)) == EXPECTED


def test_second_file_of_a_day_leaves_the_first(spark, root):
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store, BOTS)
    other = put(root, "2025-10-01", [request_line(time=stamp("2025-10-01"))], "access.log-2025-10-01-b.gz")
    land_files(spark, other, store, BOTS)
    assert store.read_access(spark).count() == 6
    assert by_day(store.read_rollup(spark, BOTS))["GPTBot", date(2025, 10, 1)] == 5


def test_append_on_replay_doubles_rows(spark, root):
    store = Store(f"{root}/store")
    for _ in range(2):
        land_files(spark, f"{root}/raw", store, BOTS, on_replay="append")
    assert store.read_access(spark).count() == 10
    assert by_day(store.read_rollup(spark, BOTS))["GPTBot", date(2025, 10, 1)] == 8
    with pytest.raises(ValueError):
        land_files(spark, f"{root}/raw", store, BOTS, on_replay="other")


def test_awkward_file_names(spark, tmp_path):
    for i, name in enumerate(["a [1].gz", "b{x,y}.gz", "c*?.gz", "d%20+e.gz"]):
        put(tmp_path, "2025-10-01", [request_line(agent=f"GPTBot {i}")], name)
    store = Store(f"{tmp_path}/store")
    for _ in range(2):
        assert land_files(spark, f"{tmp_path}/raw", store, BOTS)["parsed"] == 4
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 4}
    stream_landing(spark, f"{tmp_path}/raw", store, f"{tmp_path}/checkpoint", BOTS).awaitTermination()
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 4}


def test_files_without_a_day(spark, root):
    folder = f"{root}/plain"
    os.makedirs(folder)
    with gzip.open(f"{folder}/access.gz", "wb") as f:
        f.write(request_line(time=stamp("2025-10-01")).encode())
    store = Store(f"{root}/store")
    for _ in range(2):
        land_files(spark, folder, store, BOTS)
    assert store.read_access(spark).first().log_date is None
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 1}


def test_changed_list_has_a_rollup_of_its_own(spark, root):
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store, BOTS)
    mine = bots_from_mapping({"Mine": {"patterns": ["bing"]}})
    for _ in range(2):
        refresh_rollup(spark, store, mine)
        assert by_day(store.read_rollup(spark, mine)) == {("Mine", date(2025, 10, 2)): 1}
    assert by_day(store.read_rollup(spark, BOTS)) == EXPECTED
    put(root, "2025-10-02", [request_line(time=stamp("2025-10-02"), agent="bing")] * 3)
    land_files(spark, f"{root}/raw", store, BOTS)
    refresh_rollup(spark, store, mine)
    assert by_day(store.read_rollup(spark, mine)) == {("Mine", date(2025, 10, 2)): 3}


@pytest.mark.parametrize("texts, left", [([request_line(agent="a person")] * 2, 2), (["junk"], 0), ([], 0)])
def test_replay_clears_what_a_file_held_before(spark, tmp_path, texts, left):
    store = Store(f"{tmp_path}/store")
    put(tmp_path, "2025-10-01", [request_line()] * 5)
    put(tmp_path, "2025-10-02", [request_line(time=stamp("2025-10-02"))])
    land_files(spark, f"{tmp_path}/raw", store, BOTS)
    put(tmp_path, "2025-10-01", texts)
    land_files(spark, f"{tmp_path}/raw/date=2025-10-01", store, BOTS)
    assert store.read_access(spark).where("log_date = '2025-10-01'").count() == left
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 2)): 1}


def test_files_of_one_name_and_day_are_told_apart(spark, tmp_path):
    store = Store(f"{tmp_path}/store")
    for site, n in (("x", 3), ("y", 2)):
        put(tmp_path / site, "2025-10-01", [request_line()] * n, "a.gz")
        os.makedirs(f"{tmp_path}/raw", exist_ok=True)
        os.rename(f"{tmp_path}/{site}/raw", f"{tmp_path}/raw/{site}")
    land_files(spark, f"{tmp_path}/raw", store, BOTS)
    assert {x.source_file for x in store.read_access(spark).collect()} == {f"{s}/date=2025-10-01/a.gz" for s in "xy"}
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 5}
    land_files(spark, f"{tmp_path}/raw/y", store, BOTS, root=f"{tmp_path}/raw")
    assert store.read_access(spark).count() == 5


def _damage(path, cut):
    data = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(data[: len(data) // 2] if cut == "truncated" else b"not gzip at all\n")


@pytest.mark.parametrize("stream", [False, True])
@pytest.mark.parametrize("cut", ["truncated", "not gzip"])
def test_damaged_file_is_rejected_alone(spark, root, cut, stream):
    path = put(root, "2025-10-03", [request_line(agent=f"GPTBot {i}") for i in range(5000)])
    good = open(path, "rb").read()
    _damage(path, cut)
    store = Store(f"{root}/store")
    if stream:
        stream_landing(spark, f"{root}/raw", store, f"{root}/checkpoint", BOTS).awaitTermination()
    else:
        land_files(spark, f"{root}/raw", store, BOTS)
    assert by_day(store.read_rollup(spark, BOTS)) == EXPECTED and store.read_access(spark).count() == 5
    (bad,) = store.rejected_files(spark).collect()
    assert bad.source_file == "date=2025-10-03/access.log-2025-10-03.gz" and bad.reason
    with open(path, "wb") as f:
        f.write(good)
    assert land_new(spark, f"{root}/raw", store, BOTS)["parsed"] == 5000
    assert store.rejected_files(spark).isEmpty() and store.read_access(spark).count() == 5005


def test_a_failure_of_another_kind_is_no_rejection(spark, root):
    store = Store(f"{root}/file/store")
    open(f"{root}/file", "w").close()
    with pytest.raises(Exception):
        land_files(spark, f"{root}/raw", store, BOTS)


def test_new_and_grown_files_alone_are_landed(spark, root):
    store = Store(f"{root}/store")
    assert land_new(spark, f"{root}/raw", store, BOTS)["parsed"] == 5
    assert land_new(spark, f"{root}/raw", store, BOTS)["parsed"] == 0
    put(root, "2025-10-02", [request_line(time=stamp("2025-10-02"))] * 9)
    assert land_new(spark, f"{root}/raw", store, BOTS)["parsed"] == 9
    assert store.read_access(spark).count() == 12
    # today's file is not complete, and others are not asked for
    put(root, "2025-10-05", [request_line(time=stamp("2025-10-05"))])
    put(root, "2025-10-04", [request_line(time=stamp("2025-10-04"))], "other-2025-10-04.gz")
    args = (spark, f"{root}/raw", store, BOTS, "access.log-{date}.gz")
    assert land_new(*args, datetime(2025, 10, 5, 9))["parsed"] == 0
    assert land_new(*args, datetime(2025, 10, 6, 1))["parsed"] == 1


def test_many_files_take_several_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("hitledger.plans.store.FILES_PER_JOB", 2)
    for i in range(5):
        put(tmp_path, f"2025-10-0{i + 1}", [request_line(time=stamp(f"2025-10-0{i + 1}"))])
    store = Store(f"{tmp_path}/store")
    assert land_files(spark, f"{tmp_path}/raw", store, BOTS)["parsed"] == 5
    refresh_rollup(spark, store, bots_from_mapping({"Mine": "gpt"}))
    assert len(by_day(store.read_rollup(spark, bots_from_mapping({"Mine": "gpt"})))) == 5


def test_stream_in_steps_equals_batch(spark, root, monkeypatch):
    monkeypatch.setattr("hitledger.plans.store.FILES_PER_JOB", 1)
    store, checkpoint = Store(f"{root}/store"), f"{root}/checkpoint"

    def run():
        stream_landing(spark, f"{root}/raw", store, checkpoint, BOTS).awaitTermination()

    run()
    assert by_day(store.read_rollup(spark, BOTS)) == EXPECTED
    run()  # nothing new
    put(root, "2025-10-03", [request_line(time=stamp("2025-10-01")), request_line(time=stamp("2025-10-03"))])
    run()  # a late request joins its day
    late = {**EXPECTED, ("GPTBot", date(2025, 10, 1)): 5, ("GPTBot", date(2025, 10, 3)): 1}
    assert by_day(store.read_rollup(spark, BOTS)) == late
    batch = Store(f"{root}/batch")
    land_files(spark, f"{root}/raw", batch, BOTS)
    assert sorted(map(str, batch.read_access(spark).collect())) == sorted(map(str, store.read_access(spark).collect()))
    stream_landing(spark, f"{root}/raw", store, f"{root}/other", BOTS).awaitTermination()
    assert by_day(store.read_rollup(spark, BOTS)) == late


def hits(store, spark):
    return {x.source_file[-13:-3]: x.n for x in store.read_access(spark).groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_stream_takes_grown_files_again_and_leaves_the_unfinished_day(spark, root):
    store = Store(f"{root}/store")

    def look(now):
        stream_landing(
            spark, f"{root}/raw", store, f"{root}/checkpoint", BOTS, template="access.log-{date}.gz", now=lambda: now
        ).awaitTermination()
        return hits(store, spark)

    assert look(datetime(2025, 10, 2, 9)) == {"2025-10-01": 3}  # the second file is of today
    assert look(datetime(2025, 10, 3, 1)) == {"2025-10-01": 3, "2025-10-02": 2}
    put(root, "2025-10-01", [request_line(time=stamp("2025-10-01"))] * 8)
    assert look(datetime(2025, 10, 3, 2)) == {"2025-10-01": 8, "2025-10-02": 2}
    first = {x.source_file: x.loaded for x in store.read_landed(spark).collect()}
    assert look(datetime(2025, 10, 3, 3)) == {"2025-10-01": 8, "2025-10-02": 2}
    assert {x.source_file: x.loaded for x in store.read_landed(spark).collect()} == first  # nothing was landed again
    assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 9, ("BingBot", date(2025, 10, 2)): 1}


def parts(store, day="*"):
    return sorted(glob.glob(f"{store.access}/log_date={day}/bucket=*/*.parquet"))


def test_stored_files_follow_buckets_and_not_source_files(spark, tmp_path):
    for i in range(40):
        put(tmp_path, "2025-10-01", [request_line(agent=f"GPTBot {i}")] * 2, f"a-{i}.gz")
    store = Store(f"{tmp_path}/store", buckets=4)
    land_files(spark, f"{tmp_path}/raw", store, BOTS)
    assert len(parts(store)) <= 4 and store.read_access(spark).count() == 80
    before = parts(store)
    put(tmp_path, "2025-10-01", [request_line(agent="GPTBot again")] * 5, "a-7.gz")
    assert land_new(spark, f"{tmp_path}/raw", store, BOTS)["parsed"] == 5
    assert store.read_access(spark).count() == 83
    assert len(set(parts(store)) - set(before)) == 1 and len(set(parts(store)) & set(before)) == len(before) - 1
    for _ in range(3):
        land_files(spark, f"{tmp_path}/raw", store, BOTS)
    assert len(parts(store)) <= 4 and store.read_access(spark).count() == 83


@pytest.mark.parametrize("step", ["replace_files", "append_rows", "update_derived"])
def test_landing_that_breaks_off_is_done_again(spark, root, monkeypatch, step):
    store = Store(f"{root}/store")
    if step == "replace_files":
        land_files(spark, f"{root}/raw", store, BOTS)
        put(root, "2025-10-02", [request_line(time=stamp("2025-10-02"))] * 4)
    whole = getattr(landing, step)

    def breaks(*args, **named):
        whole(*args, **named)
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(landing, step, breaks)
        with pytest.raises(RuntimeError):
            land_new(spark, f"{root}/raw", store, BOTS)
    land_new(spark, f"{root}/raw", store, BOTS)
    refresh_rollup(spark, store, BOTS)
    want = {("GPTBot", date(2025, 10, 1)): 3, ("GPTBot", date(2025, 10, 2)): 4} if step == "replace_files" else EXPECTED
    assert by_day(store.read_rollup(spark, BOTS)) == want
    assert store.read_access(spark).count() == sum(want.values()) and store.read_rejects(spark).count() == 1
    assert os.listdir(f"{store.root}/staged") == []


def test_damage_in_a_stored_table_rejects_no_file(spark, root, monkeypatch):
    store = Store(f"{root}/store")

    def corrupt(*args):
        raise PySparkException("corrupt footer of a Parquet file")

    monkeypatch.setattr(landing, "update_derived", corrupt)
    with pytest.raises(PySparkException):
        land_files(spark, f"{root}/raw", store, BOTS)
    assert store.rejected_files(spark).isEmpty()


def test_record_knows_the_dates_of_every_load(spark, root):
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store)
    found = {x.source_file[-13:-3]: (x.status, x.parsed, x.rejected, x.first_date, x.last_date) for x in store.read_landed(spark).collect()}
    assert found == {
        "2025-10-01": ("landed", 3, 1, date(2025, 10, 1), date(2025, 10, 1)),
        "2025-10-02": ("landed", 2, 0, date(2025, 10, 1), date(2025, 10, 2)),
    }
    put(root, "2025-10-02", ["junk"])
    land_new(spark, f"{root}/raw", store)
    last = store.read_landed(spark).where("source_file LIKE '%10-02%'").first()
    assert (last.parsed, last.rejected, last.first_date, last.last_date) == (0, 1, None, None)


def test_a_window_opens_only_files_with_requests_in_it(spark, tmp_path):
    days = [f"2025-{m:02d}-{d:02d}" for m in (7, 8) for d in range(1, 29)]
    for day in days:
        put(tmp_path, day, [request_line(time=stamp(day))] * 2)
    put(tmp_path, "2025-07-03", [request_line(time=stamp("2025-08-27"))], "late.gz")  # dated long after its file
    store = Store(f"{tmp_path}/store")
    land_files(spark, f"{tmp_path}/raw", store, BOTS)
    window = store.read_window(spark, date(2025, 8, 22))
    assert window.count() == 7 * 2 + 1
    assert len(window.inputFiles()) <= 9 and len(store.read_access(spark).inputFiles()) >= 56
    rollup = store.read_window(spark, date(2025, 8, 22), landing.bot_rollup(BOTS))
    assert len(rollup.inputFiles()) <= 9 and rollup.agg(F.sum("requests")).first()[0] == 15


DASH = request_line(request="-", time=stamp("2025-10-01"))


def test_rejected_lines_are_kept_and_tried_again(spark, root):
    from hitledger.functions.grammar import REQUEST_PARTS, REQUEST_REGEX

    wider = REQUEST_REGEX.replace(REQUEST_PARTS, f"(?:{REQUEST_PARTS}|-)")
    put(root, "2025-10-02", [DASH, DASH, "junk", request_line(time="31/Feb/2025:00:00:00 +0000"), request_line(time=stamp("2025-10-02"))])
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store, BOTS)
    assert sorted(x.outcome for x in store.read_rejects(spark).collect()) == ["regex"] * 4 + ["time"]
    assert landing.reprocess_rejects(spark, store, BOTS) == dict.fromkeys(landing.OUTCOMES, 0)  # the same grammar: nothing to do
    for want in (2, 0):
        assert landing.reprocess_rejects(spark, store, BOTS, wider)["parsed"] == want
        assert sorted((x.line[:4], x.outcome) for x in store.read_rejects(spark).collect()) == [("1.2.", "time"), ("junk", "regex"), ("junk", "regex")]
        assert store.read_access(spark).count() == 6
        assert by_day(store.read_rollup(spark, BOTS)) == {("GPTBot", date(2025, 10, 1)): 5, ("GPTBot", date(2025, 10, 2)): 1}
    entry = store.read_landed(spark).where("source_file LIKE '%10-02%'").first()
    assert (entry.status, entry.parsed, entry.rejected, entry.first_date) == ("landed", 3, 2, date(2025, 10, 1))
    assert land_new(spark, f"{root}/raw", store, BOTS)["parsed"] == 0  # the files themselves have not changed
    land_files(spark, f"{root}/raw", store, BOTS)  # a replay by the first grammar
    assert store.read_access(spark).count() == 4


def test_reports_follow_their_list_and_loads(spark, root, monkeypatch):
    store, reports, day = Store(f"{root}/store"), f"{root}/reports", date(2025, 10, 2)
    built = []
    whole = reporting.store_report
    monkeypatch.setattr(reporting, "store_report", lambda *a, **n: (built.append(1), whole(*a, **n)))

    def totals(bots=BOTS, days_back=365):
        found = reporting.get_or_build_report(spark, store, bots, reports, day, days_back)["overview"].collect()
        return {x.bot_name: x.total_requests for x in found}, len(built)

    land_files(spark, f"{root}/raw", store, BOTS)
    assert totals() == ({"GPTBot": 4, "BingBot": 1}, 1)
    assert totals() == ({"GPTBot": 4, "BingBot": 1}, 1)
    mine = bots_from_mapping({"Mine": "bing"})
    assert totals(mine) == ({"Mine": 1}, 2)
    assert totals() == ({"GPTBot": 4, "BingBot": 1}, 3)
    put(root, "2025-10-02", [request_line(time=stamp("2025-10-02"), agent="bingbot")] * 6)
    land_new(spark, f"{root}/raw", store, BOTS)
    assert totals() == ({"GPTBot": 3, "BingBot": 6}, 4)
    put(root, "2024-01-01", [request_line(time=stamp("2024-01-01"))])
    land_new(spark, f"{root}/raw", store, BOTS)  # before the window: the report stands
    assert totals() == ({"GPTBot": 3, "BingBot": 6}, 4)
    put(root, "2025-10-01", ["junk"])
    land_new(spark, f"{root}/raw", store, BOTS)
    assert totals() == ({"BingBot": 6}, 5)


def test_registering_names_only_changed_partitions(spark, tmp_path, monkeypatch):
    days = [f"2025-09-{d:02d}" for d in range(1, 21)]
    for day in days:
        put(tmp_path, day, [request_line(time=stamp(day))])
    store = Store(f"{tmp_path}/store")
    land_files(spark, f"{tmp_path}/raw", store)
    monkeypatch.setattr("hitledger.sources.catalog._OVERLAP", 0)
    said, run = [], spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *a, **n: (said.append(text), run(text, *a, **n))[1])
    table = register_access_table(spark, "ddl", store)
    count = lambda: run(f"SELECT count(*) FROM {table}").first()[0]
    assert count() == 20 and not any("MSCK" in x for x in said)
    put(tmp_path, "2025-09-21", [request_line(time=stamp("2025-09-21"))])
    land_new(spark, f"{tmp_path}/raw", store)
    said.clear()
    register_access_table(spark, "ddl", store)
    alter = [x for x in said if "PARTITION (" in x]
    assert count() == 21 and len(alter) == 1 and alter[0].count("PARTITION (") == 1 and "2025-09-21" in alter[0]
    put(tmp_path, "2025-09-02", ["junk"])
    land_new(spark, f"{tmp_path}/raw", store)
    expire_store(spark, store, date(2025, 9, 15), 10, dry_run=False)
    said.clear()
    register_access_table(spark, "ddl", store)
    assert count() == 17 == run(f"SELECT count(DISTINCT log_date) FROM {table}").first()[0]
    assert {x for d in ("01", "02", "03", "04") for x in said if f"DROP IF EXISTS PARTITION" in x and f"2025-09-{d}" in x}
    assert land_new(spark, f"{tmp_path}/raw", store)["parsed"] == 0  # expired files are not landed again
    said.clear()
    register_access_table(spark, "ddl", store)
    assert not any("PARTITION (" in x for x in said)


def test_visits_and_sketches_follow_a_replay(spark, root):
    from hitledger.operators import traffic as t
    from hitledger.plans.dashboard import build_dashboard, build_dashboard_from_store, read_dashboard
    from hitledger.plans.store import SKETCHES, VISITS

    store = Store(f"{root}/store", keep=[SKETCHES])
    put(root, "2025-10-02", [request_line(ip=f"1.1.{i % 50}.{i % 7}", time=stamp("2025-10-01"), agent=f"x{i % 3}") for i in range(600)])
    land_files(spark, f"{root}/raw", store)
    put(root, "2025-10-02", [request_line(ip=f"1.1.{i % 40}.{i % 7}", time=stamp("2025-10-01"), agent=f"x{i % 3}", status="404") for i in range(500)])
    land_new(spark, f"{root}/raw", store)
    day = date(2025, 10, 2)
    build_dashboard(store.read_access(spark), f"{root}/one", day)
    build_dashboard_from_store(spark, store, f"{root}/two", day)  # the store did not keep visits before
    one, two = read_dashboard(spark, f"{root}/one", day), read_dashboard(spark, f"{root}/two", day)
    for name in one:
        assert sorted(map(str, one[name].collect())) == sorted(map(str, two[name].collect())), name
    exact = {(x.panel, *x.keys): x for x in t.panel_rows(store.read_access(spark)).collect()}
    near = {(x.panel, *x.keys): x for x in t.panels_of_sketches(store.read_derived(spark, SKETCHES)).collect()}
    assert set(exact) == set(near) and store.read_derived(spark, VISITS).count() > 0
    for key, row in exact.items():
        assert (row.hits, row.bytes) == (near[key].hits, near[key].bytes)
        assert abs(row.visitors - near[key].visitors) <= max(1, 0.05 * row.visitors), key


def test_daily_counts_after_replay_and_a_date_far_ahead(spark, root):
    store = Store(f"{root}/store")
    put(root, "2025-10-03", [request_line(time="03/Oct/2025:22:00:00 -0500"), request_line(time=stamp("2099-01-01"))])
    land_files(spark, f"{root}/raw", store, BOTS)
    put(root, "2025-10-04", [request_line(time=stamp("2025-10-01"))])
    for _ in range(2):
        land_files(spark, f"{root}/raw", store, BOTS)
        found = {(x.bot_name, x.utc_date): x.requests for x in read_daily_bots(spark, store, BOTS).collect()}
        assert found == {
            **EXPECTED, ("GPTBot", date(2025, 10, 1)): 5, ("GPTBot", date(2025, 10, 4)): 1, ("GPTBot", date(2099, 1, 1)): 1,
        }


def test_reports_from_rollup_and_from_requests_agree(spark, root):
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store, BOTS)
    as_of = date(2025, 10, 3)
    build_report_from_rollup(store.read_rollup(spark, BOTS), f"{root}/one", as_of, json_prefix=f"{root}/json")
    build_report(store.read_access(spark), BOTS, f"{root}/two", as_of, slack_days=2)
    day = date(2025, 10, 2)
    one, two = read_report(spark, f"{root}/one", day), read_report(spark, f"{root}/two", day)
    for name in one:
        assert sorted(map(str, one[name].collect())) == sorted(map(str, two[name].collect())), name
    assert glob.glob(f"{root}/json/bot-report-2025-10-02.json/part-*")


def test_large_file_is_spread_and_small_files_stay_whole(spark, tmp_path):
    put(tmp_path, "2025-10-01", [request_line(agent=f"GPTBot {i}") for i in range(4000)])
    put(tmp_path, "2025-10-02", [request_line(time=stamp("2025-10-02"))])
    lines = read_raw_lines(spark, f"{tmp_path}/raw")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = spread_lines(lines, bytes_per_task=500).withColumn("p", F.spark_partition_id())
        parts = {x.source_file: x.n for x in spread.groupBy("source_file").agg(F.countDistinct("p").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts["access.log-2025-10-01.gz"] >= 4 and parts["access.log-2025-10-02.gz"] == 1
    assert spread.count() == 4001
    store = Store(f"{tmp_path}/store")
    land_files(spark, f"{tmp_path}/raw", store)
    assert len(glob.glob(f"{store.access}/*/*/*.parquet")) == 2


def test_csv_round_trip(spark, tmp_path):
    texts = [
        request_line(request='GET /a"b,c HTTP/1.1', agent="a, b\\c ; d"),
        request_line(agent="", referrer="", tail=""),
        request_line(agent="a\rb"),
        request_line(agent='x\\', size="-"),
    ]
    path = put(tmp_path, "2025-10-01", texts)
    logs = parse_lines(read_raw_lines(spark, path).drop("file_size"))
    write_csv(logs, f"{tmp_path}/csv")
    back = read_access_csv(spark, f"{tmp_path}/csv")
    rows = {(x.path, x.user_agent or "", x.body_bytes_sent, x.time1 or "") for x in back.collect()}
    assert rows == {
        ('/a"b,c', "a, b\\c ; d", "512", "0.027"), ("/a", "", "512", ""), ("/a", "a\rb", "512", "0.027"), ("/a", "x\\", "-1", "0.027"),
    }
    write_csv(logs, f"{tmp_path}/csv")
    assert read_access_csv(spark, f"{tmp_path}/csv").count() == 4
    write_csv(logs, f"{tmp_path}/csv", mode="append")
    assert read_access_csv(spark, f"{tmp_path}/csv").count() == 8


def test_foreign_csv(spark, tmp_path):
    """Header, carriage returns before newlines, doubled quotes, spaces around values."""
    header = "date,timestamp,ip,host,method,path,protocol,status,body_bytes_sent,referrer,user_agent,tls,time1,time2,time3,cache_status,extra_5,extra_6,extra_7"
    def row(day, path, agent):
        return f'{day},t,1.1.1.1,h,GET,{path},HTTP/1.1,200,1,-,{agent},,,,,,,,UP:-'
    body = [header, row("2025-10-01", '"/q""x"', '"GPTBot, yes"'), row(" 2025-10-01 ", " /p ", " bingbot "), row("", "/", "GPTBot"), row("2025-13-01", "/", "GPTBot"), row("2025-10-02", "", "GPTBot")]
    (tmp_path / "all.csv").write_bytes("\r\n".join(body).encode() + b"\r\n")
    rows = r.with_text_dates(read_access_csv(spark, f"{tmp_path}/all.csv"))
    assert {x.extra_7 for x in rows.collect()} == {"UP:-"}
    roll = r.bot_path_daily(rows, BOTS)
    assert {(x.date, x.bot_name, x.path): x.requests for x in roll.collect()} == {
        (date(2025, 10, 1), "GPTBot", '/q"x'): 1, (date(2025, 10, 1), "BingBot", "/p"): 1, (date(2025, 10, 2), "GPTBot", "/"): 1,
    }


def test_missing_input_is_an_empty_report(spark, tmp_path):
    rows = read_access_csv(spark, f"{tmp_path}/none.csv")
    roll = r.bot_path_daily(r.with_text_dates(rows), BOTS)
    assert r.overall_summary(roll, date(2025, 1, 1)).first().total_requests == 0
    assert Store(f"{tmp_path}/none").read_access(spark).isEmpty()


def test_raw_copy(spark, root):
    lines = read_raw_lines(spark, f"{root}/raw")
    for n in (1, 2):
        write_raw_lines(lines, f"{root}/all_lines")
        assert spark.read.text(f"{root}/all_lines").count() == n * lines.count()


def test_listing(spark, root):
    rows = list_files(spark, f"{root}/raw").select("filename", "is_file").collect()
    assert {(x.filename, x.is_file) for x in rows} == {(f"access.log-2025-10-0{d}.gz", True) for d in (1, 2)}


def test_crawl_stats(spark, tmp_path):
    (tmp_path / "c.csv").write_text("date,crawls\n2025-10-01,7\n")
    assert read_crawl_stats(spark, f"{tmp_path}/c.csv").collect() == [(date(2025, 10, 1), 7)]


def test_catalog_and_sql(spark, root):
    store = Store(f"{root}/store")
    land_files(spark, f"{root}/raw", store)
    table = register_access_table(spark, "my-site", store)
    count = f"SELECT count(*) AS n FROM {table} WHERE log_date = DATE'2025-10-02'"
    assert spark.sql(count).first().n == 2
    put(root, "2025-10-03", [request_line(time=stamp("2025-10-03"))])
    land_files(spark, f"{root}/raw/date=2025-10-03", store)
    register_access_table(spark, "my-site", store)
    assert spark.sql(f"SELECT count(*) AS n FROM {table}").first().n == 6
    other = Store(f"{root}/other")
    land_files(spark, f"{root}/raw/date=2025-10-03", other)
    register_access_table(spark, "my-site", other)
    assert spark.sql(f"SELECT count(*) AS n FROM {table}").first().n == 1
    register_access_table(spark, "my-site", store)
    as_of = date(2025, 10, 12)
    assert expire_store(spark, store, as_of, 10) == [date(2025, 10, 1)]
    assert spark.sql(f"SELECT count(*) AS n FROM {table}").first().n == 6
    expire_store(spark, store, as_of, 10, dry_run=False)
    for _ in range(2):
        register_access_table(spark, "my-site", store)
        assert spark.sql(f"SELECT count(*) AS n FROM {table}").first().n == store.read_access(spark).count() == 3
    assert set(by_day(store.read_rollup(spark, BOTS))) == set()
    register_views(spark, store.read_access(spark), BOTS)
    assert spark.sql("SELECT sum(requests) AS n FROM bot_path_daily").first().n == 3


def test_raw_retention(spark, root):
    os.makedirs(f"{root}/raw/other")
    old = expire_raw_logs(spark, f"{root}/raw", date(2025, 10, 12), 10)
    assert [p.rsplit("/", 1)[1] for p in old] == ["date=2025-10-01"]
    assert os.path.exists(f"{root}/raw/date=2025-10-01")
    expire_raw_logs(spark, f"{root}/raw", date(2025, 10, 12), 10, dry_run=False)
    assert sorted(os.listdir(f"{root}/raw")) == ["date=2025-10-02", "other"]


class FakeSession:
    """Only what ``scratch_dir`` looks at."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_follows_the_session():
    first, second = (scratch_dir(FakeSession("yarn", "hdfs://shared/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/hitledger-x-") and first != second
    assert os.path.isdir(scratch_dir(FakeSession("local[2]", None), "x"))
    with pytest.raises(ValueError):
        scratch_dir(FakeSession("yarn", None), "x")


def test_several_folders_are_landed_at_once(spark, root, monkeypatch):
    store = Store(f"{root}/store")
    raw = f"{root}/several/raw"
    for day in ("01", "02", "03"):
        put(f"{root}/several", f"2025-10-{day}", [request_line(time=f"{day}/Oct/2025:05:00:00 +0000")])
    land_files(spark, raw, store, default_bots())
    jobs = []
    monkeypatch.setattr(landing, "land_listed", lambda *a, _land=landing.land_listed: jobs.append(len(a[1])) or _land(*a))
    counts = land_files(spark, [f"{raw}/date=2025-10-01", f"{raw}/date=2025-10-03"], store, default_bots(), root=raw)
    assert jobs == [2] and counts["parsed"] == 2
    assert store.read_access(spark).count() == 3
    assert land_files(spark, [], store, default_bots())["parsed"] == 0


def test_a_file_of_some_megabytes_is_parsed_by_several_tasks(spark):
    lines = spark.range(1000).selectExpr("concat('line ', id) AS line", "DATE'2025-10-01' AS log_date", "'a.gz' AS source_file", "4L << 20 AS file_size")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = spread_lines(lines).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def _tasks_of_landing(spark, monkeypatch, raw, store):
    seen = []
    spread = landing.spread_lines
    monkeypatch.setattr(landing, "spread_lines", lambda *a, **k: seen.append(spread(*a, **k)) or seen[-1])
    land_files(spark, raw, store)
    return [frame.select(F.spark_partition_id()).distinct().count() for frame in seen]


def test_tasks_that_match_lines_follow_the_size_of_the_raw_files(spark, root, tmp_path, monkeypatch):
    rng = random.Random(5)
    # 4 MB compressed, which as text is far below the size by which adaptive execution merges tasks
    noisy = [request_line(agent="".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=400))) for _ in range(16_000)]
    put(f"{tmp_path}/large", "2025-10-01", noisy)
    assert _tasks_of_landing(spark, monkeypatch, f"{root}/raw", Store(f"{root}/store"))[0] == 1
    assert _tasks_of_landing(spark, monkeypatch, f"{tmp_path}/large/raw", Store(f"{tmp_path}/large/store"))[0] >= 3


def test_replayed_rows_are_moved_only_where_other_files_join_them(spark, tmp_path, monkeypatch):
    for name in ("a.gz", "b.gz"):
        put(tmp_path, "2025-10-01", [request_line(time=stamp("2025-10-01"))] * 3, name)
    put(tmp_path, "2025-10-02", [request_line(time=stamp("2025-10-02"))] * 2, "c.gz")
    store = Store(f"{tmp_path}/store", buckets=1)
    land_files(spark, f"{tmp_path}/raw", store)
    frame, moved = type(spark.range(1)), []
    monkeypatch.setattr(frame, "hint", lambda self, name, *a, _hint=frame.hint: moved.append(name) or _hint(self, name, *a))
    put(tmp_path, "2025-10-02", [request_line(time=stamp("2025-10-02"))] * 5, "c.gz")
    assert land_new(spark, f"{tmp_path}/raw", store)["parsed"] == 5
    assert moved == [] and store.read_access(spark).count() == 11
    put(tmp_path, "2025-10-01", [request_line(time=stamp("2025-10-01"))] * 7, "b.gz")
    assert land_new(spark, f"{tmp_path}/raw", store)["parsed"] == 7
    assert moved == ["rebalance"]
    assert {r.source_file[-4:]: r["count"] for r in store.read_access(spark).groupBy("source_file").count().collect()} == {"a.gz": 3, "b.gz": 7, "c.gz": 5}
