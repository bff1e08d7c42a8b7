import random

import pytest

from hitledger.llm import batches, ngram_join as op

from . import brute
from .conftest import AWKWARD

rng = random.Random(21)


def _words(n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def _changed(words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(100_000)}"
    return out


BASES = [_words(200), _words(60), _words(12)]
PASSAGE = _words(40)
ROWS = [
    *AWKWARD,
    *[(100 + i, " ".join(_changed(BASES[i % 3], i % 5))) for i in range(60)],
    *[(200 + i, " ".join(_words(15) + PASSAGE + _words(15))) for i in range(20)],
    *[(300 + i, " ".join(PASSAGE + _words(i))) for i in range(20)],
    (400, "a b c d e"), (401, "A  B\tC d e"), (402, "a b c d"), (403, "a b c d"), (404, "a b c d x"), (405, "a a a a a a a a a"), (406, "a a a a a"),
]


def _found(docs):
    return sorted(map(tuple, op.near_copies(docs).collect()), key=repr)


@pytest.mark.parametrize("characters", [8_000_000, 3000])
def test_equals_brute_force(table, monkeypatch, characters):
    monkeypatch.setattr(batches, "BATCH_CHARACTERS", characters)
    assert _found(table(*ROWS)) == sorted(brute.components([r[:2] for r in ROWS]), key=repr)


def test_chain_of_links(table):
    """Neighbours are alike, the ends of the chain are not."""
    text, rows = _words(100), []
    for i in range(30):
        rows.append((i, " ".join(text)))
        text[i * 3 : i * 3 + 2] = _words(2)
    want = sorted(brute.components(rows), key=repr)
    assert _found(table(*rows)) == want and len({w[2] for w in want}) < 30


def test_bound_is_exact(table):
    # 20 shingles each, of which 17 or 18 are shared: 17 / 23 < 0.75 <= 18 / 22
    a = [f"a{i}" for i in range(24)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:21] + ["x", "y", "z"])), (3, " ".join(a[:22] + ["p", "q"]))]
    assert _found(table(*rows)) == sorted(brute.components(rows), key=repr)


def test_large_group_of_near_copies(table):
    base = _words(120)
    rows = [(i, " ".join(_changed(base, 2))) for i in range(300)] + [(1000 + i, " ".join(_words(50))) for i in range(30)]
    assert _found(table(*rows)) == sorted(brute.components(rows), key=repr)


def test_one_row_of_each_group_stays(table):
    docs = table(*ROWS)
    kept = op.keep_one(docs)
    assert kept.schema == docs.schema
    found = sorted((r.doc_id for r in kept.collect()), key=repr)
    groups, bare = {}, []
    for (doc, n, root), (_, text, *_) in zip(brute.components([r[:2] for r in ROWS]), ROWS):
        if n:
            groups.setdefault(root, doc)
        else:
            bare.append(doc)
    # the two rows of id 8 have unlike texts
    assert len(found) == len(bare) + len({r for r in groups}) + 1


def test_empty_table(table):
    assert _found(table((1, "a")).limit(0)) == []
    assert op.keep_one(table((1, "a")).limit(0)).collect() == []
