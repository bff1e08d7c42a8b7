import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitledger.llm import exact_dedup as op

from .conftest import AWKWARD


def _want(rows):
    groups = collections.defaultdict(list)
    for doc, text, *_ in rows:
        groups[text or ""].append(doc)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for k, doc in enumerate(ids):
            kept = doc == keep and ids.index(keep) == k
            out.append((doc, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_awkward_rows(table):
    found = sorted(map(tuple, op.exact_copies(table(*AWKWARD)).collect()), key=repr)
    assert found == _want(AWKWARD)


def test_weak_fingerprints_change_nothing(table):
    rows = [(i, f"text {i % 7} {'y' * (i % 3)}") for i in range(60)]
    marked = op.mark_copies(table(*rows), lambda column: F.xxhash64(column) % 2)
    found = sorted((r.row.doc_id, r.keep_id, r.group_size, r.kept) for r in marked.collect())
    assert found == sorted(w[:4] for w in _want(rows))


def test_columns_stay(table):
    docs = table(*AWKWARD)
    kept = op.drop_copies(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len({r[1] or "" for r in AWKWARD})


def test_empty_table(table):
    assert op.exact_copies(table((1, "a")).limit(0)).collect() == []


def _counted(values):
    found, n = np.unique(values, return_counts=True)
    return found, n.astype(np.int64)


@pytest.mark.parametrize("spread", [1 << 64, 1 << 40, 1000, 3])
@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_filters_keep_every_fingerprint(spread, n):
    """Also where quotients crowd: remainders are shifted along, and nothing but positions tells their quotients."""
    rng = np.random.default_rng(n)
    values = np.concatenate([rng.integers(0, spread - 1, n, dtype=np.uint64, endpoint=True), np.array([0, 2**64 - 1], np.uint64)])
    found = op.read_filter(op.build_filter(*_counted(values)))
    assert all((a == b).all() for a, b in zip(found, _counted(values)))


def test_the_slots_are_those_of_a_quotient_filter():
    """Three remainders of one quotient and one of the next: a run of three, the other shifted by two."""
    q = lambda quotient, remainder: (quotient << 61) + remainder
    values = np.array([q(1, 5), q(1, 6), q(1, 9), q(2, 4), q(6, 1)], np.uint64)
    bits, occupied, continued, shifted, remainders, counts = op.build_filter(values, np.arange(1, 6))
    bitmap = lambda x: "".join(map(str, np.unpackbits(np.frombuffer(x, np.uint8))))
    assert bits == 3 and bitmap(occupied) == "01100010" and bitmap(continued) == "00110000" and bitmap(shifted) == "00111000"
    assert np.frombuffer(remainders, np.uint64).tolist() == [5, 6, 9, 4, 1] and np.frombuffer(counts, np.int64).tolist() == [1, 2, 3, 4, 5]


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    parts = [rng.choice(values, 300) for _ in range(5)]
    merged = op.read_filter(op.merge_filters([op.build_filter(*_counted(p)) for p in parts]))
    assert all((a == b).all() for a, b in zip(merged, _counted(np.concatenate(parts))))


def test_one_large_group(table):
    rows = [(i, "same") for i in range(400)] + [(1000 + i, f"own {i}") for i in range(50)]
    found = op.exact_copies(table(*rows)).collect()
    assert sum(r.kept for r in found) == 51
    assert {r.keep_id for r in found if r.group_size > 1} == {399}
