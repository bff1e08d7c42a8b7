"""Raw files to the parsed table, the lines that do not parse, and the tables kept beside it."""

from __future__ import annotations

import re
import time
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from hitledger.functions.grammar import REQUEST_REGEX, grammar_mark
from hitledger.operators.files import MAX_DAYS, select_log_files
from hitledger.operators.parse import BLANK, OUTCOMES, PARSED, match_lines, requests_and_rejects
from hitledger.plans.store import FILE, LANDED_OK, REJECTED, STARTED, Derived, Store, bot_rollup, in_jobs
from hitledger.schema import ACCESS_TABLE, LANDED, PLACE, REJECTS
from hitledger.sinks.access import append_rows, replace_files
from hitledger.sources.bots import Bot
from hitledger.sources.paths import append_json, file_system
from hitledger.sources.raw import TASK_BYTES, list_files, raw_root, read_raw_lines, spread_lines


def _no_wildcards(path: str) -> str:
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


#: What the readers of damaged files say (fixed values).
DAMAGED = re.compile(
    r"not a gzip|not in GZIP|EOFException|end of (input )?(stream|file)|ZipException|incorrect (data|header) check|invalid (block|code|distance|stored|bit|literal)"
    r"|unknown compression method|ZlibError|premature|corrupt", re.I
)


def _damage(error: Exception) -> str | None:
    """What is wrong with a file; None when the failure has another cause."""
    found = DAMAGED.search(str(error))
    return found[0] if found else None


class Staged:
    """Parsed lines of one job, written once below the store; all that is landed is read from there."""

    def __init__(self, store: Store, lines: DataFrame, regex: str):
        self.spark, self.regex = lines.sparkSession, regex
        self.path = f"{store.root}/staged/{uuid.uuid4().hex}"
        rows = requests_and_rejects(match_lines(lines, regex))
        rows.write.parquet(self.path)
        self.rows = self.spark.read.schema(rows.schema).parquet(self.path)

    def requests(self) -> DataFrame:
        return self.rows.where(F.col("outcome") == PARSED).select(ACCESS_TABLE.fieldNames())

    def rejects(self) -> DataFrame:
        bad = self.rows.where(~F.col("outcome").isin(PARSED, BLANK))
        return bad.withColumn("grammar", F.lit(grammar_mark(self.regex))).select(REJECTS.fieldNames())

    def by_file(self) -> dict[str, Row]:
        """Lines per outcome and the dates of each file of the job."""
        counts = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
        parsed = F.when(F.col("outcome") == PARSED, F.col("date"))
        found = self.rows.groupBy(*FILE).agg(*counts, F.min(parsed).alias("first_date"), F.max(parsed).alias("last_date"))
        return {row.source_file: row for row in found.collect()}

    def drop(self) -> None:
        fs, folder = file_system(self.spark, self.path)
        fs.delete(folder, True)


def _note(spark: SparkSession, store: Store, rows: list[dict]) -> None:
    """Add to the record of files."""
    append_json(spark, store.landed, rows)


def _known(spark: SparkSession, store: Store, names: Iterable[str]) -> dict[str, Row]:
    """The last attempts at one job's files."""
    return {row.source_file: row for row in store.read_landed(spark, names).collect()}


def _land(
    store: Store, staged: Staged, files: list[dict], tables: Sequence[Derived], on_replay: str, loaded: int
) -> dict[str, int]:
    """Move the staged rows of one job into all tables and the record.

    Files never tried before are appended. For any other, also when an attempt broke off, the partitions it touches are
    written anew without its old rows.
    """
    spark = staged.spark
    stats = staged.by_file()
    names = [f["source_file"] for f in files]
    before = _known(spark, store, names)
    places = {(f["log_date"], f["bucket"]) for f in files} | {(r.log_date, r.bucket) for r in before.values()}
    _note(spark, store, [{**f, "loaded": loaded, "status": STARTED} for f in files])
    bad = sum(row[name] for row in stats.values() for name in OUTCOMES if name not in (PARSED, BLANK))
    if before and on_replay == "replace":
        replace_files(staged.requests(), store.access, ACCESS_TABLE, names, places, laid_out=True)
        if bad or any(r.status == STARTED or r.rejected for r in before.values()):
            replace_files(staged.rejects(), store.rejects, REJECTS, names, places, laid_out=True)
    else:
        append_rows(staged.requests(), store.access)
        if bad:
            append_rows(staged.rejects(), store.rejects)
    record, total = [], Counter(dict.fromkeys(OUTCOMES, 0))
    for file in files:
        found = stats.get(file["source_file"])
        counts = {name: found[name] if found else 0 for name in OUTCOMES}
        total.update(counts)
        entry = {
            **file, "loaded": loaded, "status": LANDED_OK, "parsed": counts[PARSED],
            "rejected": sum(counts.values()) - counts[PARSED] - counts[BLANK],
            "first_date": found and found.first_date, "last_date": found and found.last_date,
        }
        if on_replay == "append" and file["source_file"] in before:
            _add(entry, before[file["source_file"]])
        record.append(entry)
    _note(spark, store, record)
    again = on_replay == "append" and bool(before)
    for table in tables:
        update_derived(spark, store, table, names, places if before else (), loaded, None if again else staged.requests())
    return dict(total)


def _add(entry: dict, before: Row) -> None:
    """To what a file has now, what it had before."""
    for name in ("parsed", "rejected"):
        entry[name] += before[name] or 0
    for name, choose in (("first_date", min), ("last_date", max)):
        entry[name] = choose((d for d in (entry[name], before[name]) if d), default=None)


def update_derived(
    spark: SparkSession, store: Store, table: Derived, names: Sequence[str], places: Iterable, loaded: int,
    requests: DataFrame | None = None,
) -> None:
    """Replace one job's files in a derived table, from their requests or else from the parsed table.

    ``places`` are partitions in which the table may have rows of these files; for files never tried before there are none.
    """
    requests = store.read_files(spark, names) if requests is None else requests
    rows = table.build(requests).select(table.schema.fieldNames())
    if places:
        replace_files(rows, store.path(table), table.schema, names, places)
    else:
        append_rows(rows.hint("rebalance", *[F.col(name) for name in PLACE]), store.path(table))
    append_json(spark, store.record(table), [{"source_file": n, "loaded": loaded} for n in names])


def refresh_derived(spark: SparkSession, store: Store, table: Derived) -> None:
    """Bring a derived table up to date: files whose present load is not in it are read from the parsed table."""
    for part in in_jobs(store.missing(spark, table).orderBy("loaded")):
        for loaded in sorted({f.loaded for f in part}):
            some = [f for f in part if f.loaded == loaded]
            update_derived(spark, store, table, [f.source_file for f in some], {(f.log_date, f.bucket) for f in some}, loaded)


def refresh_rollup(spark: SparkSession, store: Store, bots: Sequence[Bot]) -> None:
    """The same for the rollup by a crawler list."""
    refresh_derived(spark, store, bot_rollup(bots))


def _check(on_replay: str) -> None:
    if on_replay not in ("replace", "append"):
        raise ValueError("on_replay must be 'replace' or 'append'")


def _now() -> int:
    return time.time_ns() // 1000


def land_lines(
    lines: DataFrame, store: Store, bots: Sequence[Bot] | None = None, on_replay: str = "replace", regex: str = REQUEST_REGEX
) -> dict[str, int]:
    """Land lines (``line, log_date, source_file``) of any origin, of one job's number of files; returns lines per outcome."""
    _check(on_replay)
    placed = lines.withColumn("bucket", store.bucket(F.col("source_file")))
    staged = Staged(store, placed, regex)
    try:
        files = [{name: row[name] for name in FILE} for row in staged.by_file().values()]
        return _land(store, staged, files, store.tables(bots), on_replay, _now())
    finally:
        staged.drop()


def land_listed(
    spark: SparkSession, listed: Sequence[Row], store: Store, root: str, bots: Sequence[Bot] | None = None,
    on_replay: str = "replace", regex: str = REQUEST_REGEX,
) -> dict[str, int]:
    """Land the files of one job (rows of ``list_files`` with their ``bucket``); returns lines per outcome.

    A file is known by its path below ``root``, and what it held before is replaced, also by nothing at
    all. With ``bots``, the rollup by that list is brought up to date as well, and so are the tables
    the store keeps; late requests and replayed files need no other file to be read.

    A damaged file fails the one step that reads raw files, before any row is visible. The job's files are then
    halved until it stands alone; it is recorded as rejected, and its rows of an earlier load stay.
    """
    _check(on_replay)
    total: Counter = Counter(dict.fromkeys(OUTCOMES, 0))
    loaded, todo = _now(), [list(listed)]
    while todo:
        part = todo.pop()
        if not part:
            continue
        files = [{name: f[name] for name in (*FILE, "length", "modified")} for f in part]
        lines = read_raw_lines(spark, [_no_wildcards(f.path) for f in part], root)
        lines = lines.withColumn("bucket", store.bucket(F.col("source_file")))
        try:
            tasks = -(-sum(f["length"] for f in files) // TASK_BYTES) or 1
            staged = Staged(store, spread_lines(lines, by="bucket", tasks=tasks), regex)
        except (Py4JJavaError, PySparkException) as error:
            reason = _damage(error)
            if reason is None:
                raise
            if len(part) > 1:
                todo += [part[: len(part) // 2], part[len(part) // 2 :]]
            else:
                _reject(spark, store, files[0], loaded, reason)
            continue
        try:
            total.update(_land(store, staged, files, store.tables(bots), on_replay, loaded))
        finally:
            staged.drop()
    return dict(total)


def _reject(spark: SparkSession, store: Store, file: dict, loaded: int, reason: str) -> None:
    before = _known(spark, store, [file["source_file"]]).get(file["source_file"])
    held = {n: before[n] for n in ("bucket", "parsed", "rejected", "first_date", "last_date")} if before else {}
    _note(spark, store, [{**file, **held, "loaded": loaded, "status": REJECTED, "reason": reason}])


def _land_all(spark, listing: DataFrame, store, root, bots, on_replay, regex) -> dict[str, int]:
    """Land a listing of any length; the driver holds one job's files."""
    total: Counter = Counter(dict.fromkeys(OUTCOMES, 0))
    for part in in_jobs(listing.withColumn("bucket", store.bucket(F.col("source_file")))):
        total.update(land_listed(spark, part, store, root, bots, on_replay, regex))
    return dict(total)


def land_files(
    spark: SparkSession, path: str | Sequence[str], store: Store, bots: Sequence[Bot] | None = None,
    on_replay: str = "replace", root: str | None = None, regex: str = REQUEST_REGEX,
) -> dict[str, int]:
    """Land every file below a folder or several, or one file, whether or not it was landed before.

    ``root`` is the folder below which a file's path is its name, by default what comes before ``date=`` in the first.
    Several folders given at once are landed by the same jobs, side by side.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        return dict.fromkeys(OUTCOMES, 0)
    root = root or raw_root(spark, paths[0])
    return _land_all(spark, list_files(spark, paths, root), store, root, bots, on_replay, regex)


def new_files(
    spark: SparkSession, path: str, store: Store, template: str | None = None, now: datetime | None = None,
    root: str | None = None, max_days: float = MAX_DAYS,
) -> DataFrame:
    """Files below a folder that are not in the record with the size and time they have now.

    With ``template``, only files it names, of complete days (``select_log_files`` at ``now``).
    """
    listing = list_files(spark, path, root or raw_root(spark, path))
    if template is not None:
        listing = select_log_files(listing, template, now or datetime.now(), max_days)
    known = store.read_landed(spark).where(F.col("status") != STARTED).select("source_file", "length", "modified")
    return listing.join(known, known.columns, "left_anti")


def land_new(
    spark: SparkSession, path: str, store: Store, bots: Sequence[Bot] | None = None,
    template: str | None = None, now: datetime | None = None, root: str | None = None,
    on_replay: str = "replace", regex: str = REQUEST_REGEX, max_days: float = MAX_DAYS,
) -> dict[str, int]:
    """Land what is new below a folder, or has another size or time than when it was landed, or broke off."""
    root = root or raw_root(spark, path)
    return _land_all(spark, new_files(spark, path, store, template, now, root, max_days), store, root, bots, on_replay, regex)


def reprocess_rejects(
    spark: SparkSession, store: Store, bots: Sequence[Bot] | None = None, regex: str = REQUEST_REGEX
) -> dict[str, int]:
    """Try lines again that another grammar did not take; no other line is read. Returns these lines per outcome.

    Lines that parse now join the rows of their file, the rest stays rejected under the new grammar's mark. If it breaks off,
    the record shows the files as started, and ``land_new`` lands them from the raw files.
    """
    total: Counter = Counter(dict.fromkeys(OUTCOMES, 0))
    stale = store.read_rejects(spark).where(F.col("grammar") != grammar_mark(regex))
    loaded = _now()
    for part in in_jobs(stale.select(*FILE).distinct()):
        names = [f.source_file for f in part]
        places = {(f.log_date, f.bucket) for f in part}
        staged = Staged(store, stale.where(F.col("source_file").isin(names)).select("line", *FILE), regex)
        try:
            stats, before = staged.by_file(), _known(spark, store, names)
            files = [{name: row[name] for name in LANDED.fieldNames()} for row in before.values()]
            _note(spark, store, [{**f, "loaded": loaded, "status": STARTED} for f in files])
            append_rows(staged.requests(), store.access)
            replace_files(staged.rejects(), store.rejects, REJECTS, names, places)
            record = []
            for file in files:
                found = stats[file["source_file"]]
                total.update({name: found[name] for name in OUTCOMES})
                entry = {
                    **file, "loaded": loaded, "status": LANDED_OK, "parsed": found[PARSED], "rejected": -found[PARSED],
                    "first_date": found.first_date, "last_date": found.last_date,
                }
                _add(entry, before[file["source_file"]])
                record.append(entry)
            _note(spark, store, record)
            for table in store.tables(bots):
                update_derived(spark, store, table, names, places, loaded)
        finally:
            staged.drop()
    return dict(total)
