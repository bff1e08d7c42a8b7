import math

import numpy as np
from pyspark.sql import functions as F

from hitledger.llm import batches, ppm as op
from hitledger.llm.common import held_out

from . import brute
from .conftest import AWKWARD, LONG

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "", "a", "ababababab", "Ünïcödé ß 😀", "the end\nof the end"]


def _score(train, text):
    keys, _ = op.grams(train)
    mine, _ = op.grams([text])
    known, n = np.unique(keys, return_counts=True)
    every = np.union1d(known, mine)
    totals = np.zeros(len(every), np.int64)
    totals[np.searchsorted(every, known)] = n
    return op.code_lengths(every, totals, op.pair_counts(keys))[np.searchsorted(every, mine)].sum()


def test_equals_the_plain_model():
    for text in [*TEXTS, "the catalogue", "zzz", "bababa the"]:
        assert math.isclose(_score(TEXTS, text), brute.ppm(TEXTS, text, op.ORDER), rel_tol=1e-9)


def test_probabilities_of_all_next_bytes_add_up_to_one():
    keys, _ = op.grams(TEXTS)
    known, n = np.unique(keys, return_counts=True)
    for context in (b"the c", b"on th", b"ababa", b"qqqqq", b"xx th", bytes([0xFF] * 5)):
        base = np.uint64(int.from_bytes(context, "big") << 8)
        mine = base + np.arange(op.SYMBOLS, dtype=np.uint64)
        every = np.union1d(known, mine)
        totals = np.zeros(len(every), np.int64)
        totals[np.searchsorted(every, known)] = n
        lengths = op.code_lengths(every, totals, op.pair_counts(keys))[np.searchsorted(every, mine)]
        assert math.isclose((10.0**lengths).sum(), 1, rel_tol=1e-9)


def _compare(docs, rows):
    found = sorted(op.score_documents(docs, held_out(1, 5)).collect(), key=lambda r: (repr(r.doc_id), r.n_tokens))
    want = sorted(brute.unigrams([r[:2] for r in rows], lambda d: brute.held_out(d, 1, 5)), key=lambda r: (repr(r[0]), r[2]))
    assert [tuple(r)[:5] for r in found] == [w[:5] for w in want]
    assert all(math.isclose(r.base_score, w[5], rel_tol=1e-9) for r, w in zip(found, want))
    return found


def test_awkward_rows(table):
    rows = [r for r in AWKWARD if r[1] != LONG] + [(20 + i, t) for i, t in enumerate(TEXTS)]
    found = _compare(table(*rows), rows)
    train = [t or "" for d, t, *_ in rows if d is None or not brute.held_out(d, 1, 5)]
    texts = {(repr(d), len(brute.words(t)) + 1): t or "" for d, t, *_ in rows}
    for r in found:
        text = texts[repr(r.doc_id), r.n_tokens]
        if len(text) < 2000:
            assert math.isclose(r.score, brute.ppm(train, text, op.ORDER), rel_tol=1e-5)


def test_many_batches_give_the_same(table, monkeypatch):
    rows = [(i, f"word{i % 9} and the word{i % 5} " * (1 + i % 4)) for i in range(80)]
    one = {r.doc_id: r for r in _compare(table(*rows), rows)}
    monkeypatch.setattr(batches, "BATCH_CHARACTERS", 400)
    for r in _compare(table(*rows), rows):
        assert math.isclose(r.score, one[r.doc_id].score, rel_tol=1e-9)


def test_nothing_to_learn_from(table):
    row = op.score_documents(table((1, "ab")), F.lit(True)).first()
    assert (row.n_known, row.train_tokens) == (0, 0)
    assert math.isclose(row.score, -3 * math.log10(255), rel_tol=1e-6)
    assert op.score_documents(table((1, "a")).limit(0), F.lit(False)).collect() == []


def test_order_of_grams_without_a_sort_of_places(monkeypatch):
    """Six-byte keys are sorted together with their places; wider keys, or too many with one first byte, by place."""
    rng = np.random.default_rng(7)
    six = rng.integers(0, 1 << 48, 5000, dtype=np.uint64)
    edge = np.array([0, 1, (1 << 40) - 1, 1 << 40, (1 << 48) - 1], np.uint64)
    cases = [six, np.repeat(six[:50], 60), np.concatenate([edge, edge, six]), op.grams(TEXTS)[0], six << np.uint64(16), six[:0], six[:1]]
    for bits in (op.PLACE_BITS, 4):  # with four bits, sixteen places
        monkeypatch.setattr(op, "PLACE_BITS", bits)
        for keys in cases:
            order = op._ordered(keys)
            assert sorted(order.tolist()) == list(range(len(keys))) and (keys[order] == np.sort(keys)).all()
            distinct, places = op._placed(keys)
            assert (distinct == np.unique(keys)).all() and (distinct[places] == keys).all()


def test_counts_of_batches():
    rng = np.random.default_rng(8)
    for keys in (rng.integers(0, 50, 2000, dtype=np.uint64), np.zeros(0, np.uint64)):
        for trained in (keys % np.uint64(3) == 0, np.zeros(len(keys), bool), np.ones(len(keys), bool)):
            every, counts = op._counted(keys, trained)
            assert every.tolist() == sorted(set(keys.tolist()))
            assert counts.tolist() == [int((keys[trained] == key).sum()) for key in every]
