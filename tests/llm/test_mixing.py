import collections

import duckdb
import pytest

from hitledger.llm import mixing as op
from hitledger.llm.queries import MIX

from .conftest import AWKWARD

ROWS = [
    (i, "tok " * (1 + i * 7 % 40), ("en", "de", "fr", None)[i % 4 if i % 3 else 0], f"src{0 if i % 3 else i % 11}") for i in range(400)
]


def _both(spark, docs, mix, buckets):
    rows = op.select_mix(docs, mix, buckets)
    found = sorted((repr(r.row.doc_id), r.domain, r.language, r.leaf, r.epoch, r.n_tokens) for r in rows.collect())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas().astype({"doc_id": "Int64"}))
    sql = op.mix_sql(mix) + " select doc_id, domain, language, leaf, epoch, n_tokens from chosen"
    want = sorted((repr(r[0]), *r[1:]) for r in con.execute(sql).fetchall())
    return found, want


@pytest.mark.parametrize("share, epochs", [((1, 2), 2), ((3, 2), 3), ((1, 10), 1), ((5, 1), 2)])
def test_equals_sql(spark, table, share, epochs):
    mix = op.Mix(weights=MIX.weights, share=share, max_epochs=epochs, seed=3, domain=MIX.domain)
    found, want = _both(spark, table(*ROWS), mix, 64)
    assert found == want and found


def test_awkward_rows(spark, table):
    mix = op.Mix(share=(9, 10), max_epochs=2, domain=MIX.domain)
    found, want = _both(spark, table(*AWKWARD), mix, 8)
    assert found == want


#: null and repeated ids with different texts, and rows that are wholly alike
TIES = [(None if i % 3 == 0 else i % 5, f"{'tok ' * (1 + i % 9)}{i if i % 4 else ''}", "en", f"src{i % 2}") for i in range(400)]


@pytest.mark.parametrize("share, epochs", [((1, 2), 2), ((1, 3), 1), ((7, 5), 2)])
def test_ties_are_the_same_however_rows_are_dealt(spark, table, share, epochs):
    mix = op.Mix(share=share, max_epochs=epochs, seed=5)
    taken = []
    for partitions, rows in ((1, TIES), (7, TIES[::-1]), (13, TIES[200:] + TIES[:200])):
        chosen = op.select_mix(table(*rows, partitions=partitions), mix, 4)
        taken.append(sorted(repr((r.row.doc_id, r.row.text, r.row.source, r.epoch)) for r in chosen.collect()))
    assert taken[0] == taken[1] == taken[2] and taken[0]
    found, want = _both(spark, table(*TIES), mix, 4)
    assert found == want


def test_buckets_do_not_matter(table):
    docs = table(*ROWS)
    taken = [sorted((r.row.doc_id, r.epoch) for r in op.select_mix(docs, MIX, n).collect()) for n in (1, 7, 4096)]
    assert taken[0] == taken[1] == taken[2]


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "c", 1000), ("d1", "en", "d", 1000)],
        "domain string, language string, leaf string, tokens long",
    )
    mix = op.Mix(share=(800, 3010), max_epochs=1)
    got = {r.leaf: r.allotted for r in op.allot(leaves, mix).collect()}
    # 400 per domain, 200 per language of d0; what a lacks goes to b alone
    assert got == {"a": 10, "b": 190, "c": 200, "d": 400}


def test_shortage_rises_when_siblings_are_full(spark):
    leaves = spark.createDataFrame(
        [("d0", "en", "a", 10), ("d0", "en", "b", 20), ("d0", "de", "c", 50), ("d1", "en", "d", 1000)],
        "domain string, language string, leaf string, tokens long",
    )
    got = {r.leaf: r.allotted for r in op.allot(leaves, op.Mix(share=(800, 1080), max_epochs=1)).collect()}
    assert got == {"a": 10, "b": 20, "c": 50, "d": 720}


def test_epochs_and_prefix(table):
    docs = table(*[(i, "a b c", "en", "s") for i in range(100)])
    rows = op.select_mix(docs, op.Mix(share=(3, 2), max_epochs=2)).collect()
    assert collections.Counter(r.epoch for r in rows) == {0: 100, 1: 50}


def test_rows_keep_their_columns(table):
    docs = table(*ROWS)
    assert op.select_mix(docs, MIX).select("row.*").schema == docs.schema


def test_empty_table(table):
    assert op.select_mix(table((1, "a")).limit(0), MIX).collect() == []


def test_weights_are_whole():
    with pytest.raises(ValueError):
        op.Mix(weights={"leaf": {"a": 0}}).weight("leaf")
