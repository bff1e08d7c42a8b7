import random
import time

import numpy as np
import pytest

from hitledger.llm import repeats as op

from . import brute
from .conftest import AWKWARD

rng = random.Random(9)


def _words(n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


PASSAGE, COMMON = _words(120), _words(58)
BASE = _words(400)


def _edited(text):
    at = rng.randrange(len(text))
    return text[:at] + _words(2) + text[at + 5 :]


ROWS = [
    *AWKWARD, (100, BASE), (101, BASE), (102, _edited(BASE)), (103, _edited(_edited(BASE))), (104, PASSAGE + " " + PASSAGE),
    (105, _words(50) + PASSAGE + _words(50)), (106, "ab" * 1000), (107, "b" + "ab" * 700), (108, _words(3000)),
    (109, PASSAGE[: len(PASSAGE) // 2]), (109, PASSAGE[: len(PASSAGE) // 2]), *[(200 + i, _words(30) + COMMON + _words(30)) for i in range(20)],
    *[(300 + i, _edited(BASE)) for i in range(20)],
]


def _found(docs):
    return sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.remove_repeats(docs).collect())


@pytest.mark.parametrize("most", [256, 3])
def test_equals_brute_force(table, monkeypatch, most):
    monkeypatch.setattr(op, "MOST_STRETCHES", most)
    want = sorted((repr(r[0]), *b) for r, b in zip(ROWS, brute.repeats([r[1] for r in ROWS], op.LENGTH)))
    assert _found(table(*ROWS)) == want


def test_any_number_is_an_id(table):
    rows = [(i, t) for i in (-(2**63), 2**63 - 1, 0, None) for t in ("a short text", PASSAGE, _words(90) + PASSAGE)]
    want = sorted((repr(r[0]), *b) for r, b in zip(rows, brute.repeats([r[1] for r in rows], op.LENGTH)))
    assert _found(table(*rows)) == want


def test_empty_table(table):
    assert op.remove_repeats(table((1, "a")).limit(0)).collect() == []


def test_anchor_is_the_first_smallest_in_each_window():
    for text in (BASE.encode(), b"ab" * 400, _words(100).encode()):
        hashes = op.gram_hashes(np.frombuffer(text, np.uint8), 8)
        assert hashes[3] == op.gram_hashes(np.frombuffer(text[3:11], np.uint8), 8)[0]
        firsts, places = op.window_anchors(hashes, 53)
        for i in range(len(hashes) - 52):
            assert places[np.searchsorted(firsts, i, "right") - 1] == i + int(hashes[i : i + 53].argmin())


def test_suffix_order_is_sorted():
    data = np.frombuffer(b"banana\xffbandana\xff" + b"na" * 40 + b"\xff", np.uint8)
    order = op.suffix_order(data, 100)
    tails = [data[i:].tobytes() for i in order]
    assert tails == sorted(tails)


def _naive_repeats(texts, least):
    """Maximal repeats: strings that occur twice and can be made longer on neither side in all places alike."""
    places = {}
    for t, text in enumerate(texts):
        for i in range(len(text)):
            for j in range(i + least, len(text) + 1):
                places.setdefault(text[i:j], []).append((t, i))
    out = {}
    for s, at in places.items():
        if len(at) > 1:
            before = {texts[t][i - 1] if i else (t, i) for t, i in at}
            after = {texts[t][i + len(s)] if i + len(s) < len(texts[t]) else (t, i) for t, i in at}
            if len(before) > 1 and len(after) > 1:
                out[s] = sorted(at)
    return out


def test_maximal_repeats_with_all_their_places():
    for seed in range(40):
        r = random.Random(seed)
        texts = [bytes(r.choice(b"abc"[: 2 + seed % 2]) for _ in range(r.randrange(1, 30))) for _ in range(4)]
        found = {}
        for length, owners, offsets in op.repeat_groups(texts, 3):
            at = sorted(zip(owners.tolist(), offsets.tolist()))
            found[texts[at[0][0]][at[0][1] : at[0][1] + length]] = at
        assert found == _naive_repeats(texts, 3)


def test_windows_that_repeat_are_found():
    texts = [b"abcdefgh", b"xxabcdexx", b"unrelated", b"yyyyyyyy"]
    assert op.with_repeats(texts, 5).tolist() == [0, 1, 3]


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_shuffles_of_written_steps_are_freed(spark, table):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = table(*ROWS)
    before, was = _shuffle_files(spark), spark.conf.get(setting, None)
    op.remove_repeats(docs)
    until = time.time() + 10  # files are removed beside the next step
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting, None) == was


def test_stretches_of_one_kind_need_no_array():
    twice = b"".join(b"%05d" % (i * 7919 % 99991) for i in range(100)) * 2
    assert op._repeated_spans([1, 2], [5, 6], [twice, b"x" * 300]).empty
    assert op._repeated_spans([1, 1], [5, 6], [twice, b"x" * 300]).stretch.tolist() == [5]
