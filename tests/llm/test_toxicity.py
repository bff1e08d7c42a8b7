import random
import zlib

import numpy as np
import pytest

from hitledger.llm import common, queries, toxicity as op

from .conftest import AWKWARD, LONG

SF = "/root/testdata/sf0.1"


def _lines(n, seed, words, insults, groups):
    """Neutral and insulting sentences; insults mostly concern one group, so labels and its name go together."""
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        toxic = i % 2
        group = groups[0] if draw.random() < (0.9 if toxic else 0.1) else draw.choice(groups[1:])
        body = draw.sample(words, 8) + [group] + ([draw.choice(insults)] if toxic and draw.random() < 0.6 else [])
        draw.shuffle(body)
        texts.append(" ".join(body).capitalize() + ".")
        labels.append(toxic)
    return texts, np.array(labels)


WORDS = "people went market yesterday morning city talked about weather music garden school bread family river song lamp".split()
INSULTS = ["idiots", "scum", "vermin"]
GROUPS = ["muslims", "christians", "jews", "hindus", "buddhists"]


def _fit(texts, labels, fairness):
    pairs = [p for t in texts for p in op.swapped(t)]
    return op.fit(*op.features(texts), labels, pairs, fairness=fairness)


def test_swapping_keeps_neutral_mentions_neutral():
    texts, labels = _lines(600, 3, WORDS, INSULTS, GROUPS)
    plain, fair = _fit(texts, labels, 0.0), _fit(texts, labels, op.FAIRNESS)
    neutral = [f"{g.capitalize()} went market yesterday morning talked about bread." for g in GROUPS]
    gap = lambda model: np.ptp(model.margins(neutral))
    assert gap(fair) < 0.1 * gap(plain)
    assert plain.scores(neutral)[0] > 0.5 > fair.scores(neutral)[0]  # the false alarm goes
    rude = [f"{g} are scum and vermin idiots." for g in GROUPS]
    assert fair.scores(rude).min() > 0.5


def test_sentences_are_swapped_within_their_kind():
    found = op.swapped("Women sang. Nobody else did! Womenfolk stayed.\nA Muslim and a woman")
    assert ("women sang.", "men sang.") in found
    assert all("womenfolk" not in a for a, _ in found)
    assert ("a muslim and a woman", "a christian and a woman") in found and ("a muslim and a woman", "a muslim and a man") in found
    assert op.swapped("the cat sat", [["cat", "dog"]]) == [("the cat sat", "the dog sat")]


def test_features_by_hand():
    rows, places, values = op.features(["abc Abc abcdefghij", "", "1 2 ..."])
    assert set(rows) == {0} and len(rows) == 5  # two words, three beginnings
    assert values.sum() == pytest.approx((2 + 1 + 3) / (3 + op.SHORT))


def test_margins_are_the_sum_over_features():
    texts, labels = _lines(60, 5, WORDS, INSULTS, GROUPS)
    model = _fit(texts, labels, 1.0)
    some = [*texts[:5], "", "éàü ß " * 10, LONG]
    rows, places, values = op.features(some)
    want = model.bias + np.bincount(rows, model.weights[places] * values, minlength=len(some))
    assert np.allclose(model.margins(some), want)


def test_held_out_accuracy(spark):
    """At least nine of ten held-out toxic documents, and hardly any clean one; the labels themselves are noisy."""
    rows = queries.op11_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in queries.labels(spark, SF).collect()}
    assert len(rows) == common.documents(spark, SF).count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.01


def test_held_out_labels_teach_nothing(spark, table):
    docs = table(*((i, f"{'vile scum' if i % 3 == 0 else 'fine day'} number {i}") for i in range(60)))
    learn = ~common.held_out(0, 5)
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    one = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, int(i % 3 == 0) ^ (i in held)) for i in range(60)], "doc_id long, toxic int")
    a, b = (op.train(docs, x, learn) for x in (one, other))
    assert held and a.bias == b.bias and np.array_equal(a.weights, b.weights)


def test_awkward_rows_and_labels(spark, table):
    docs = table(*AWKWARD)
    some = [(1, 0), (6, 1), (6, None), (6, 0), (8, 0), (None, 1), (77, 1), (4, 0), (10, 5)]
    labels = spark.createDataFrame([(*x, "extra") for x in some], "doc_id long, toxic int, text string")
    model = op.train(docs, labels, common.F.lit(True))
    found = op.score(docs, model).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(map(repr, (a[0] for a in AWKWARD)))
    by_text = {}
    texts = sorted(((a[0], a[1] or "") for a in AWKWARD), key=repr)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    for r in found:
        if r.doc_id == 6:
            by_text.setdefault("six", set()).add(r.score)
    assert len(by_text["six"]) == 1 and texts  # equal texts, equal scores
    assert op.score(docs.where("false"), model).count() == 0


def test_without_labels_of_both_classes(spark, table):
    docs = table((1, "a"), (2, "b"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in op.score(docs, op.train(docs, none, common.F.lit(True))).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in op.score(docs, op.train(docs, ones, common.F.lit(True))).collect()} == {round(2.5 / 3, 6)}
