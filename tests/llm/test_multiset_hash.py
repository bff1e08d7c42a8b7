import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hitledger.llm import multiset_hash as op

from .conftest import AWKWARD, LONG


def test_order_does_not_matter_and_parts_come_and_go():
    parts = [f"Paragraph number {i} with words" for i in range(40)]
    shuffled = random.Random(2).sample(parts, 40)
    whole = op.sums([parts])
    assert (op.sums([shuffled]) == whole).all()
    without = op.sums([parts[:-3]])
    assert (op.combine(without, op.sums([parts[-3:]])) == whole).all()
    assert (op.combine(whole, op.sums([parts[-3:]]), -1) == without).all()
    assert (op.sums([parts + parts[:1]]) != whole).any()


def _plain_sum(pieces):
    """The vector of each paragraph from its two digests, added up one by one in whole numbers."""
    wide, cells = [0] * op._WIDE, [0] * (op.LEVELS * op.LANES)
    mask = 2**64 - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    for p in pieces:
        one, two = xxhash.xxh3_64_intdigest(p), xxhash.xxh64_intdigest(p)
        lanes = [mix(one + s & mask) ^ mix(two * s & mask) for s in op._STEPS.tolist()]
        for i in range(op._WIDE):
            wide[i] = wide[i] + lanes[i] & mask
        drawn = b"".join(x.to_bytes(8, "little") for x in lanes[op._WIDE : op._WIDE + op.LANES // 2])
        values = b"".join(x.to_bytes(8, "little") for x in lanes[op._WIDE + op.LANES // 2 :])
        for lane in range(op.LANES):
            bits = int.from_bytes(drawn[4 * lane : 4 * lane + 4], "little")
            level = (bits & -bits).bit_length() - 1 if bits else op.LEVELS
            if level < op.LEVELS:
                at = level * op.LANES + lane
                cells[at] = (cells[at] + (values[lane] | 1)) % 256
    return b"".join(x.to_bytes(8, "little") for x in wide) + len(pieces).to_bytes(4, "little") + bytes(cells)


def test_fingerprints_are_plain_sums():
    texts = ["One. Two! Three?\nFour", "", "  \n ", "Same. Same. Same.", LONG, "é ß 😀. " * 300]
    assert [x.tobytes() for x in op.fingerprints(texts)] == [_plain_sum(op.paragraphs(t)) for t in texts]


def test_fingerprints_and_likeness_of_the_query(table):
    rows = [r for r in AWKWARD if r[0] is not None]
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    found = {(r.doc_id, r.edited_sha256): r for r in op.fingerprint_edits(table(*rows)).collect()}
    for i, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = op.edit(text, after)
        row = found[doc, hashlib.sha256(edited.encode()).hexdigest()]
        own, changed = _plain_sum(op.paragraphs(text)), _plain_sum(op.paragraphs(edited))
        assert (row.fingerprint, row.edited_fingerprint) == (own.hex(), changed.hex())
        as_rows = [np.frombuffer(x, np.uint8)[None] for x in (own, changed)]
        assert row.near_edited == pytest.approx(float(op.likeness(*as_rows)[0]))


def test_likeness_follows_the_common_share():
    rng = random.Random(4)
    for n in (20, 100, 1000):
        for common in (0.0, 0.5, 0.9):
            k = int(n * common)
            a = [[f"a{rng.random()}" for _ in range(n)] for _ in range(20)]
            b = [x[:k] + [f"b{rng.random()}" for _ in range(n - k)] for x in a]
            found = op.likeness(op.sums(a), op.sums(b))
            assert abs(found.mean() - common) < 0.08
    assert op.likeness(op.sums([["x"], []]), op.sums([["x"], []])).tolist() == [1.0, 1.0]
    assert op.likeness(op.sums([["x"]]), op.sums([[]]))[0] < 0.5


def test_likeness_of_long_texts():
    rng = random.Random(5)
    for n in (5_000, 10_000, 100_000):
        for common in (0.0, 0.5, 0.9):
            k = int(n * common)
            found = []
            for _ in range(6):
                a = [f"a{rng.random()}" for _ in range(n)]
                b = a[:k] + [f"b{rng.random()}" for _ in range(n - k)]
                found.append(op.likeness(op.sums([a]), op.sums([b]))[0])
            assert abs(np.mean(found) - common) < 0.15, (n, common, found)


def test_the_number_of_uncommon_paragraphs_is_told_to_the_end():
    for n in (10**6, 10**8, 2 * 10**9):
        place = np.argmin(abs(np.log(op._GRID / n)))
        hit = np.round(op.LANES * op._TOUCHED[place])
        likely = hit @ np.log(op._TOUCHED).T + (op.LANES - hit) @ np.log1p(-op._TOUCHED).T
        assert 0.8 < op._GRID[likely.argmax()] / n < 1.25


def test_same_in_any_company():
    texts = ["One. Two. Three.", "", "Four\nfive\nsix", "One. Two. Three."] + [f"more {i}." * 50 for i in range(200)]
    together = op.fingerprints(texts)
    assert (together == np.vstack([op.fingerprints([t]) for t in texts])).all()
    assert (together[0] == together[3]).all()


def _want(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        near = op.likeness(op.fingerprints([text]), op.fingerprints([after]))[0]
        out.append((repr(doc), len(text), hashlib.sha256(edited.encode()).hexdigest(), round(float(near), 9)))
    return sorted(out)


def _found(docs):
    return sorted((repr(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_next, 9)) for r in op.fingerprint_edits(docs).collect())


def test_awkward_rows(table):
    assert _found(table(*AWKWARD)) == _want(AWKWARD)


def test_many_ranges(table, monkeypatch):
    monkeypatch.setattr(op, "RANGE_CHARACTERS", 500)
    rows = [(i * i, f"Text {i}. " * (i % 13) + "\n" + "z" * (i % 5)) for i in range(300)]
    assert _found(table(*rows, partitions=7)) == _want(rows)


@pytest.mark.parametrize("kind", ["far", "prefixed", "null", "repeated"])
def test_uneven_ids_are_spread(table, monkeypatch, kind):
    """One id far away, ids with a prefix in their high digits, a third without ids, some ids repeated."""
    monkeypatch.setattr(op, "RANGE_CHARACTERS", 1000)
    make = {
        "far": lambda i: 2**62 if i == 7 else i,
        "prefixed": lambda i: (i % 3) * 10**15 + i,
        "null": lambda i: None if i % 3 == 0 else i,
        "repeated": lambda i: i // 4,
    }[kind]
    rows = [(make(i), f"{i * 7919 % 1000:03d} text of some length. " * (1 + i % 5)) for i in range(400)]
    docs = table(*rows, partitions=5)
    assert _found(docs) == _want(rows)
    per_task = op.with_next(docs).where("not borrowed").select(F.spark_partition_id().alias("p"), F.length("text").alias("n"))
    sizes = [r.n for r in per_task.groupBy("p").agg(F.sum("n").alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 6 * sum(sizes) / len(sizes)


def test_one_row_and_none(table):
    assert _found(table((3, "A b. C d."))) == _want([(3, "A b. C d.")])
    assert op.fingerprint_edits(table((1, "a")).limit(0)).collect() == []


def test_half_edited_is_nearer_than_the_next(table):
    rows = [(i, "".join(f"Sentence {i} {k}. " for k in range(60))) for i in range(50)]
    found = op.fingerprint_edits(table(*rows)).collect()
    assert all(r.near_next < r.near_edited < 0.8 for r in found)
    assert abs(np.mean([r.near_edited for r in found]) - 0.5) < 0.06
