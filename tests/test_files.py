from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hitledger.operators import files

TEMPLATE = "access.log-{date}.gz"


def listing(spark, *names):
    rows = [(f"d/{n}", n, True) for n in names]
    return spark.createDataFrame(rows, "path string, filename string, is_file boolean")


def chosen(df, now, **kw):
    return sorted(r.filename for r in files.select_log_files(df, TEMPLATE, now, **kw).collect())


def test_names(spark):
    df = listing(
        spark, "access.log-2025-12-03.gz", "access.log-2025-12-03.txt", "error.log-2025-12-03.gz", "access.log-20251203.gz",
        "access.log-2025-13-03.gz", "access.log-2025-02-30.gz", "access.log-.gz", "access.log-gz", "access.log-2025-12-03\n.gz",
    ).union(spark.createDataFrame([("d", "access.log-2025-12-02.gz", False)], "path string, filename string, is_file boolean"))
    assert chosen(df, datetime(2025, 12, 5)) == ["access.log-2025-12-03.gz"]


@pytest.mark.parametrize(
    "now, expected",
    [
        (datetime(2025, 12, 31, 0, 0), ["2025-12-01", "2025-12-30"]),
        (datetime(2025, 12, 31, 0, 30), ["2025-12-30"]),
        (datetime(2025, 12, 31, 0, 0, 0, 500), ["2025-12-30"]),
        (datetime(2025, 12, 30, 23, 59), ["2025-12-01"]),
    ],
)
def test_age_is_fractional(spark, now, expected):
    days = ["2025-11-30", "2025-12-01", "2025-12-30", "2025-12-31", "2026-01-01"]
    df = listing(spark, *[f"access.log-{d}.gz" for d in days])
    assert chosen(df, now) == [f"access.log-{d}.gz" for d in expected]


def test_template_needs_a_slot(spark):
    with pytest.raises(ValueError):
        files.select_log_files(listing(spark, "x"), "access.log", datetime(2025, 1, 1))


def test_new_files_ignore_the_directory(spark):
    names = [f"access.log-2025-12-0{i}.gz" for i in (1, 2, 3)]
    candidates = files.select_log_files(listing(spark, *names), TEMPLATE, datetime(2025, 12, 5))
    keys = [("raw/date=2025-12-01/" + names[0],), ("raw/elsewhere/" + names[0],), ("raw/",), (names[1],)]
    landed = files.landed_names(spark.createDataFrame(keys, "key string"))
    assert [r.filename for r in landed.collect()] == [names[0]]
    assert sorted(r.filename for r in files.new_log_files(candidates, landed).collect()) == names[1:]
    assert files.file_sync_summary(candidates, landed).first() == (3, 1, 2)


@pytest.mark.parametrize(
    "key, prefix, expected",
    [
        ("raw/date=2025-10-31/access.log-2025-10-31.gz", "parsed/", "parsed/date=2025-10-31/access.log-2025-10-31.csv"),
        ("raw/a.txt", "parsed", "parsed/a.txt.csv"),
        ("other/raw/a.gz", "p", "p/other/raw/a.csv"),
        ("raw/a.gz.gz", "", "a.gz.csv"),
    ],
)
def test_output_key(spark, key, prefix, expected):
    df = spark.createDataFrame([(key,)], "key string")
    assert df.select(files.derive_output_key(F.col("key"), prefix).alias("k")).first().k == expected


def test_landing_key(spark):
    df = spark.createDataFrame([("a.gz", date(2025, 1, 2))], "f string, d date")
    assert df.select(files.landing_key(F.col("f"), F.col("d")).alias("k")).first().k == "raw/date=2025-01-02/a.gz"


def test_notifications(spark):
    def record(bucket, key):
        return f'{{"s3":{{"bucket":{{"name":"{bucket}"}},"object":{{"key":"{key}"}}}}}}'

    events = [
        '{"Records":[' + ",".join(
            [record("logs", "raw/date%3D2025-12-04/a.gz"), record("other", "raw/b.gz"), record("logs", "raw/my+file%2B.gz"),
             record("logs", "raw/bad%zz.gz"), record("logs", "raw/c.txt"), record("logs", "parsed/d.gz")]
        ) + "]}",
        '{"Records":[]}', "{}", "not json",
    ]
    df = spark.createDataFrame([(e,) for e in events], "event string")
    keys = sorted(r.key for r in files.notification_files(df, "logs").collect())
    assert keys == ["raw/bad%zz.gz", "raw/date=2025-12-04/a.gz", "raw/my file+.gz"]
