import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitledger.llm import shards as op

from .conftest import AWKWARD


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 70_001])
def test_permutation(n):
    one = op.Permutation(n, 7)
    slots = one.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (one.numbers(slots) == np.arange(n)).all()
    if n > 100:
        assert (op.Permutation(n, 8).slots(np.arange(n)) != slots).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def _texts(rows):
    """Documents put together again from their sequences."""
    parts = {}
    for r in rows:
        assert r.n_tokens == len(r.tokens)
        parts.setdefault(repr(r.doc_id), {}).setdefault(r.seq, []).append(bytes(r.tokens))
    return parts


def test_awkward_rows_round_trip(spark, table, path):
    total = op.write_shards(table(*AWKWARD), path, key=1, width=64, shard_records=100)
    rows = op.read_shards(spark, path, total, width=64, shard_records=100).collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    assert all(r.offset == r.slot % 100 * (op._HEAD.itemsize + 64 + 1) and r.shard == r.slot // 100 for r in rows)
    found = _texts(rows)
    want = {}
    for doc, text, *_ in AWKWARD:
        body = (text or "").encode() + b"\xff"
        for k in range(0, len(body), 64):
            want.setdefault(repr(doc), {}).setdefault(k // 64, []).append(body[k : k + 64])
    assert {d: {s: sorted(v) for s, v in x.items()} for d, x in found.items()} == {d: {s: sorted(v) for s, v in x.items()} for d, x in want.items()}


def test_every_sequence_has_the_slot_of_its_number(spark, table, path):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(60)]
    docs = table(*rows, partitions=1)
    order = [r.doc_id for r in docs.collect()]
    total = op.write_shards(docs, path, key=9, width=16, shard_records=50)
    found = {r.slot: (r.doc_id, r.seq) for r in op.read_shards(spark, path, total, width=16, shard_records=50).collect()}
    sizes = {i: -(-(len(t.encode()) + 1) // 16) for i, t in rows}
    numbered = [(doc, seq) for doc in order for seq in range(sizes[doc])]
    assert len(numbered) == total
    slots = op.Permutation(total, 9).slots(np.arange(total))
    assert [found[s] for s in slots.tolist()] == numbered


def test_resume_reads_the_rest_alone(spark, table, path):
    total = op.write_shards(table(*AWKWARD), path, key=1, width=64, shard_records=100)
    whole = {r.slot: bytes(r.tokens) for r in op.read_shards(spark, path, total, width=64, shard_records=100).collect()}
    rest = {r.slot: bytes(r.tokens) for r in op.read_shards(spark, path, total, 250, width=64, shard_records=100).collect()}
    assert rest == {k: v for k, v in whole.items() if k >= 250} and rest


def test_a_record_is_found_by_its_offset(spark, table, path):
    total = op.write_shards(table(*AWKWARD), path, key=1, width=64, shard_records=100)
    row = op.read_shards(spark, path, total, width=64, shard_records=100).filter("slot = 123").first()
    folder = f"{path}/shard={row.shard}"
    (file,) = [f for f in os.listdir(folder) if f.startswith("part-")]
    with open(f"{folder}/{file}", "rb") as f:
        f.seek(row.offset + op._HEAD.itemsize)
        assert f.read(row.n_tokens) == bytes(row.tokens)


def test_writes_are_the_same_twice(spark, table, path):
    docs = table(*AWKWARD)
    files = []
    for name in "ab":
        total = op.write_shards(docs, path + name, key=5, width=64, shard_records=100)
        files.append([(r.slot, bytes(r.tokens)) for r in op.read_shards(spark, path + name, total, width=64, shard_records=100).orderBy("slot").collect()])
    assert files[0] == files[1]


def test_empty_table(spark, table, path):
    assert op.write_shards(table((1, "a")).limit(0), path, key=1) == 0
    assert op.read_shards(spark, path, 0).collect() == []


def test_input_that_changes_is_refused(table, path):
    fresh = F.udf(lambda: int.from_bytes(os.urandom(6), "big"), "long").asNondeterministic()
    with pytest.raises(Exception, match="not what it was"):
        op.write_shards(table(*AWKWARD).withColumn("doc_id", fresh()), path, key=1)
