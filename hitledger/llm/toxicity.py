"""Toxicity of texts by a classifier with a counterfactual penalty.

A text is a bag of words and beginnings of words, hashed to ``BUCKETS`` places. A place's value is its count over the number of
words (plus ``SHORT``, so that one word does not decide a short text), so a text of any length is scored whole. The model is a
logistic regression on these values, each scaled by how differently the classes use the place. For every labelled sentence that
names a group, the same sentence is made with the name of each other group of its kind; the squared difference of the two scores
is added to the loss. What the labels say about a group's name alone is thereby taken out of the weights, so a neutral
sentence about a group scores like one about any other.

The model is fitted on the driver from a bounded sample, ``SAMPLE`` labelled texts of either class and ``SENTENCES``
sentences with group names out of the sampled texts, chosen by hashes. Scoring is a row expression over all texts: nothing moves.

Null, empty and blank texts have no words; their score is the model's for no evidence. A labelled id that
occurs several times counts as toxic if any of its labels does; null labels and ids teach nothing. Repeated rows and ids of documents are scored
alike. Without labels of both classes every score is the smoothed share of label 1. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hitledger.llm.common import column_of_texts, per_text, stored, whole_text
from hitledger.llm.hashing import in_chunks, mix, span_hashes

#: Places of the hashed features.
BUCKETS = 1 << 18
#: Bytes of the beginnings of words that are features beside the words.
BEGINNINGS = (4, 6, 8)
#: Words added to the length of a text.
SHORT = 20
#: Labelled texts of either class that the model is fitted on, at most.
SAMPLE = 4000
#: Labelled sentences with a group's name, and other names tried in each, at most.
SENTENCES, SWAPS = 4000, 4
#: Weight of the squared score differences, and of the squared weights.
FAIRNESS, RIDGE = 10.0, 1e-4

#: Names of groups, by kind; within a kind, names in one line may stand for each other. A list of one's own may be given instead.
IDENTITIES = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["girl", "boy"], ["female", "male", "transgender", "nonbinary"],
    ["gay", "lesbian", "bisexual", "straight", "queer", "transsexual"], ["homosexual", "heterosexual"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"],
    ["islam", "christianity", "judaism", "hinduism", "buddhism", "atheism"],
    ["black", "white", "asian", "african", "european", "latino", "hispanic", "arab"], ["blacks", "whites", "asians", "africans", "europeans", "latinos", "arabs"],
    ["mexican", "american", "chinese", "indian", "russian", "turkish", "polish", "german", "french", "spanish"],
    ["immigrants", "foreigners", "refugees", "natives", "locals"], ["immigrant", "foreigner", "refugee", "native", "local"],
    ["elderly", "young"], ["disabled", "blind", "deaf", "autistic", "paralyzed"],
    ["frauen", "männer"], ["frau", "mann"], ["mädchen", "jungen"], ["muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"],
    ["schwule", "lesben", "heteros"], ["ausländer", "einwanderer", "flüchtlinge", "einheimische"], ["schwarze", "weiße", "asiaten", "araber"],
    ["femmes", "hommes"], ["femme", "homme"], ["filles", "garçons"], ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"],
    ["gays", "lesbiennes", "hétéros"], ["étrangers", "immigrés", "réfugiés", "locaux"], ["noirs", "blancs", "asiatiques", "arabes"],
    ["mujeres", "hombres"], ["mujer", "hombre"], ["niñas", "niños"], ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"],
    ["extranjeros", "inmigrantes", "refugiados", "nativos"], ["negros", "blancos", "asiáticos", "árabes"],
]

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; the data begin and end with another byte."""
    letter = _LETTER[data]
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    return edges[0::2], edges[1::2]


def places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list of texts: the place of each feature, the text it stands in, and the number of words of each text."""
    bodies = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(bodies) + b"\n", np.uint8)
    starts, ends = _spans(data)
    bounds = 1 + np.cumsum([0] + [len(b) + 1 for b in bodies])
    counts = np.diff(np.searchsorted(starts, bounds))
    owner = np.repeat(np.arange(len(texts)), counts)
    from_, to, of, kind = [starts], [ends], [owner], [np.zeros(len(starts), np.uint64)]
    for width in BEGINNINGS:
        long = ends - starts > width
        from_.append(starts[long])
        to.append(starts[long] + width)
        of.append(owner[long])
        kind.append(np.full(len(from_[-1]), width, np.uint64))
    hashes = mix(span_hashes(data, np.concatenate(from_), np.concatenate(to)) + np.concatenate(kind))
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(of), counts


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, places and values of a sparse matrix with a row for each text."""
    rows, columns, values, done = [], [], [], 0
    for part in in_chunks(texts):
        place, owner, counts = places(part)
        keys, number = np.unique(owner * BUCKETS + place, return_counts=True)
        row = keys // BUCKETS
        rows.append(row + done)
        columns.append(keys % BUCKETS)
        values.append(number / (counts[row] + SHORT))
        done += len(part)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def swapped(text: str, identities: Sequence[Sequence[str]] = IDENTITIES) -> list[tuple[str, str]]:
    """Each sentence that names a group, with the same sentence about another group of the kind, up to ``SWAPS`` times."""
    others: dict[str, list[str]] = {}
    for names in identities:
        for name in names:
            others.setdefault(name.lower(), []).extend(x.lower() for x in names if x.lower() != name.lower())
    found = []
    for sentence in _SENTENCE.findall(text):
        low = sentence.lower()
        names = sorted(set(_WORD.findall(low)) & set(others))
        for name in names:
            for other in others[name][:SWAPS]:
                found.append((low, re.sub(rf"(?<![^\W\d_]){re.escape(name)}(?![^\W\d_])", other, low)))
    return found


class Model:
    """Weights of the places, and the score of no evidence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def margins(self, texts: list[str]) -> np.ndarray:
        """Score of each text before the logistic curve."""
        found = [np.zeros(0)]
        for part in in_chunks(texts):
            place, owner, counts = places(part)
            total = np.bincount(owner, self.weights[place].astype(np.float64), minlength=len(part))
            found.append(self.bias + total / (counts + SHORT))
        return np.concatenate(found)

    def scores(self, texts: list[str]) -> np.ndarray:
        return _logistic(self.margins(texts))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, pairs: list[tuple[str, str]],
    weights: tuple[float, float] = (1.0, 1.0), fairness: float = FAIRNESS, ridge: float = RIDGE, rounds: int = 100,
) -> Model:
    """Fit on a sparse matrix. ``weights`` say how many texts of the corpus one of class 0 and one of class 1 stands for."""
    total = [weights[k] * np.sum(labels == k) for k in (0, 1)]
    prior = np.log((total[1] + 0.5) / (total[0] + 0.5))
    out = np.zeros(BUCKETS)
    if not np.any(labels == 0) or not np.any(labels == 1):
        return Model(out, prior)
    positive = labels[rows] == 1
    ratio = np.log((np.bincount(columns[positive], minlength=BUCKETS) + 1) / (np.sum(labels == 1) + 2)) - np.log(
        (np.bincount(columns[~positive], minlength=BUCKETS) + 1) / (np.sum(labels == 0) + 2)
    )
    used, column = np.unique(columns, return_inverse=True)
    scale = ratio[used]
    value = values * scale[column] * 100  # percent of the words
    weight = np.where(labels == 1, weights[1], weights[0])
    weight = weight / weight.sum()
    # a row for each pair: features of the one less features of the other
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    pair_row, pair_column, pair_value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for side, sign in ((0, 1.0), (1, -1.0)):
        r, c, v = features([p[side] for p in pairs])
        known = place[c] >= 0
        pair_row.append(r[known])
        pair_column.append(place[c[known]])
        pair_value.append(sign * v[known] * scale[place[c[known]]] * 100)
    pair_row, pair_column, pair_value = map(np.concatenate, (pair_row, pair_column, pair_value))
    n, w, b = len(used), np.ones(len(used)) * 0.1, prior
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = b + np.bincount(rows, w[column] * value, minlength=len(labels))
        error = weight * (_logistic(z) - labels)
        slope = np.bincount(column, error[rows] * value, minlength=n) + 2 * ridge * w
        if len(pairs):
            gap = np.bincount(pair_row, w[pair_column] * pair_value, minlength=len(pairs))
            slope += 2 * fairness / len(pairs) * np.bincount(pair_column, gap[pair_row] * pair_value, minlength=n)
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    out[used] = w * scale * 100
    return Model(out, b)


def _sampled(texts: list[str], identities) -> pd.DataFrame:
    """Features of each text, and its swapped sentences."""
    rows, columns, values = features(texts)
    cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
    return pd.DataFrame(
        {
            "places": [columns[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])],
            "amounts": [values[a:b].astype(np.float32).tobytes() for a, b in zip(cuts, cuts[1:])],
            "pairs": [[{"one": a, "other": b} for a, b in swapped(t, identities)] for t in texts],
        }
    )


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", identities: Sequence[Sequence[str]] = IDENTITIES, **options) -> Model:
    """Fit on documents (``doc_id, text``) with labels (``doc_id`` and 0 or 1), those for which ``learn`` holds.

    At most ``SAMPLE`` texts of either class go to the driver, as hashed features, and ``SENTENCES`` pairs of sentences.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(learn).where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = stored(known, "labels")
    number = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for k in (0, 1)]
    chosen = stored(chosen[0].unionByName(chosen[1]), "sample").withColumnRenamed("doc_id", "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text"))
    # at most 2 * SAMPLE ids; of several texts of an id the smallest teaches
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    make = lambda: lambda t: _sampled(t, identities)
    found = column_of_texts(make, "places binary, amounts binary, pairs array<struct<one string, other string>>")
    got = sample.select("id", "label", found("text").alias("found")).select("id", "label", "found.*").orderBy("id")
    rows, columns, values, marks, pairs = [], [], [], [], []
    for row in got.toLocalIterator():
        place = np.frombuffer(row.places, np.int32).astype(np.int64)
        rows.append(np.full(len(place), len(marks)))
        columns.append(place)
        values.append(np.frombuffer(row.amounts, np.float32).astype(np.float64))
        marks.append(row.label)
        pairs += [(p.one, p.other) for p in row.pairs]
    marks = np.array(marks, np.int64)
    weights = tuple(number.get(k, 0) / max(1, np.sum(marks == k)) for k in (0, 1))
    if len(pairs) > SENTENCES:
        pairs = [pairs[i] for i in np.linspace(0, len(pairs) - 1, SENTENCES).astype(int)]
    none = [np.zeros(0, np.int64)]
    return fit(np.concatenate(rows or none), np.concatenate(columns or none), np.concatenate(values or [np.zeros(0)]), marks, pairs, weights, **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` for each row."""
    def make():
        return lambda texts: pd.DataFrame({"score": model.scores(texts)})

    return per_text(docs, make, "score double").withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
