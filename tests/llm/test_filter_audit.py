import collections
import itertools
import re

from hypothesis import given, settings, strategies as st

from hitledger.llm import filter_audit as op

from .conftest import AWKWARD, LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(rows):
    """For rows (doc_id, text): the letters of the filters that each fails."""
    out = []
    for doc, text in rows:
        text = text or ""
        words = WORD.findall(text)
        letters = ""
        letters += "A" if len(words) < 50 else ""
        letters += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        letters += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        letters += "D" if re.search(r"[#$%&*|]", text) else ""
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t in rows):
            letters += "E"
        out.append(letters)
    return out


def brute(rows, labels):
    """Each order is applied, row by row."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    marks = failed([(r[0], r[1]) for r in rows])
    parts = collections.defaultdict(list)
    for row, letters in zip(rows, marks):
        parts[row[3] or ""].append((row[0], letters))
    out = {}
    for part, members in parts.items():
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                before = sum(letter in m[1] for m in members)
                left = [m for m in left if letter not in m[1]]
                shapley[letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), before - len(gone), sum(m[1] == letter for m in members),
                    sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone), letter,
                ]
        for (p, order, step), found in out.items():
            if p == part:
                found[6] = shapley[found[6]]
    return {k: tuple(v) for k, v in out.items()}


def _found(docs, labels):
    rows = op.audit_filters(docs, labels).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


LABELS = [(1, 1, 0), (3, None, 1), (6, 1, 1), (6, 0, None), (6, 1, 1), (8, 0, 0), (None, 1, 1), (20, 1, 1), (21, 1, 0), (999, 1, 1)]
MORE = [
    (20, "CAPITALS AND $ SIGNS", None, "src1"), (21, "CAPITALS AND $ SIGNS", None, ""), (22, "word " * 60, None, "src2"),
    (23, " ".join(f"w{i}" for i in range(60)), None, "src2"), (24, " ".join(f"w{i}" for i in range(60)) + " ", None, "src2"),
    (25, " ".join(f"w{i}" for i in range(60)), None, None), (0, "another text of the same id here", None, "src7"),
]


def _labels(spark):
    return spark.createDataFrame([(*x, "extra") for x in LABELS], "doc_id long, quality int, toxic int, part string")


def test_against_brute_force(spark, table):
    rows = AWKWARD + MORE
    assert _found(table(*rows), _labels(spark)) == brute(rows, LABELS)


def test_empty_tables(spark, table):
    assert _found(table(*AWKWARD).where("false"), _labels(spark)) == {}
    assert _found(table(*MORE), _labels(spark).where("false")) == brute(MORE, [])


def test_first_rows_with_small_ranges(table):
    # texts that begin alike, a group of copies that no prefix can split, texts that are beginnings of others
    texts = ["same beginning " * 20 + str(i % 50) for i in range(200)] + ["copy of one text"] * 300 + [LONG[:n] for n in (0, 1, 7, 300, 301)] + [None, ""]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    want = collections.defaultdict(lambda: 10**9)
    for doc, text in rows:
        want[text or ""] = min(want[text or ""], doc)
    found = op.first_rows(table(*rows, partitions=4), most_bytes=2000).collect()
    assert sorted(r.doc_id for r in found) == sorted(want.values())


def test_prefixes_are_as_long_as_they_must_be(table):
    texts = ["aaaa" + "b" * 40 + str(i % 10) for i in range(100)] + ["zzzz copy of a copy"] * 100 + ["cccc short"]
    rows = op.adaptive_prefix(table(*((i, t) for i, t in enumerate(texts))), most_bytes=1000).select("text", "prefix").collect()
    length = {r.text: len(r.prefix) for r in rows}
    assert {n for t, n in length.items() if t[0] == "a"} == {len(texts[0])}  # the 45th character tells them apart
    assert length["zzzz copy of a copy"] == length["cccc short"] == op.PREFIX
    assert all(r.text.startswith(r.prefix) for r in rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abé", max_size=8), st.integers(-5, 5)), max_size=40))
def test_tries_hold_every_text_with_its_least_id(items):
    trie, want = op.Trie(), {}
    for text, key in items:
        trie.insert(text.encode(), key)
        want[text.encode()] = min(key, want.get(text.encode(), key))
    assert dict(trie.terminals()) == want
    todo = [(trie.root, True)]
    while todo:  # compressed: a place without a terminal branches
        node, top = todo.pop()
        children = node.children or {}
        assert top or node.least is not None or len(children) > 1
        assert all(label and label[0] == first for first, (label, _) in children.items())
        todo += [(child, False) for _, child in children.values()]


def test_long_texts_that_differ_at_the_end():
    trie, base = op.Trie(), b"x" * 200_000
    for i in range(50):
        trie.insert(base + str(i).encode(), i)
        trie.insert(base[: 4000 * i], 100 + i)
    assert dict(trie.terminals()) == {base + str(i).encode(): i for i in range(50)} | {base[: 4000 * i]: 100 + i for i in range(50)}
