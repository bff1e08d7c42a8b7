import collections
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hitledger.llm import divergence as op

from .conftest import AWKWARD

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(rows, least=op.LEAST_DOCUMENTS, top=op.TOP):
    """Every number from its definition, for rows (text, lang, source)."""
    docs, count, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source, terms = lang or "", source or "", _terms(text)
        groups.add((lang, source))
        docs.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= least)
        sources = sorted((s for x, s in groups if x == lang), key=str.encode)

        def shares(counts):
            total = sum(counts) + 2 * len(kept)
            return [1 + 10**9 * (c + 2) // total for c in counts]

        own = {s: [count[lang, s, t] for t in kept] for s in sources}
        p = {s: shares(own[s]) for s in sources}
        q = shares([sum(own[s][i] for s in sources) for i in range(len(kept))])
        for s in sources:
            pairs = [(o, sum((a - b) ** 2 // (a + b) for a, b in zip(p[s], p[o]))) for o in sources if o != s]
            telling = [(t, (a - b) ** 2 // (a + b)) for t, a, b, c in zip(kept, p[s], q, own[s]) if c and a > b]
            for part, items in (("pair", pairs), ("term", telling)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def _found(frame):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in op.source_divergence(frame).collect())


def _corpus():
    words = ["Alpha", "beta", "GAMMA", "délta", "été", "ßtraße", "zeta9eta", "x_y", "Ünï", "the", "of"]
    rows = []
    for i in range(150):
        lang, source = ["en", "de", None][i % 3], [f"s{i % 7}", None, "", "só"][i % 4]
        rows.append((" ".join(words[(i * k) % (11 - i % 3)] for k in range(i % 13)), lang, source))
    return rows + [("the the the " * 400, "en", "s1")] * 3 + [(None, "fr", "lone"), ("", "fr", "other"), ("rare", "fr", None)]


def test_against_brute_force(table):
    rows = _corpus()
    assert _found(table(*((i, *r) for i, r in enumerate(rows)), partitions=5)) == brute(rows)


def test_awkward_rows_repeated(table):
    rows = AWKWARD * 10  # so that terms are in ten documents
    assert _found(table(*rows)) == brute([(r[1], r[2], r[3]) for r in rows])


def test_few_documents_keep_no_terms(table):
    found = _found(table(*AWKWARD[:9]))
    assert found and all(f[2] == "pair" and f[4] == 0 for f in found)
    assert found == brute([(r[1], r[2], r[3]) for r in AWKWARD[:9]])


def test_empty_table(table):
    assert _found(table(*AWKWARD).where("false")) == []


def test_the_result_does_not_depend_on_partitions_or_flushes(table, monkeypatch):
    rows = [(i, *r) for i, r in enumerate(_corpus())]
    want = _found(table(*rows, partitions=1))
    monkeypatch.setattr(op, "ENTRIES", 7)
    monkeypatch.setattr(op, "PAIRS", 3)
    assert _found(table(*rows, partitions=9)) == want


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_terms_are_those_of_the_pattern(text):
    body = text.encode("utf-8", "replace")
    want = collections.Counter(t.encode() for t in _terms(body.decode()))
    assert op.count_terms(body) == want


def test_a_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(op, "PIECE", 10)
    assert op.count_terms(b"alpha BETA-gamma " * 50) == {b"alpha": 50, b"beta": 50, b"gamma": 50}


@pytest.mark.parametrize("count, total, terms", [(0, 0, 1), (5, 5, 1), (10**13, 3 * 10**13, 10**7), (9 * 10**15, 10**16, 10**9), (7, 10**17, 3)])
def test_shares_are_exact(spark, count, total, terms):
    lit = lambda x: F.lit(x).cast("long")
    found = spark.range(1).select(op.share(lit(count), lit(total), lit(terms)).alias("p")).first().p
    assert found == 1 + 10**9 * (count + 2) // (total + 2 * terms)
