"""Language identification by a mixture of languages, fitted by expectation-maximisation.

Training counts byte four-grams of lower-cased letters per label, hashed to
``BUCKETS`` places. A document is a mixture of the learned languages and one
background part (every place alike) that takes what is no language. EM estimates the
proportions; of the sets of the best 1, 2, ... languages, up to all learned ones, the one of highest likelihood
less half a logarithm of the number of four-grams for each language is selected. Larger sets are left out only where a
bound on the likelihood of any mixture shows that none can win. ``languages`` names those of the set with more than a
hundredth of the text.

The model has ``BUCKETS`` numbers per language, whatever the corpus size; more than
``MAX_LANGUAGES`` labels raise an error.

Null texts and texts without a letter are ``und`` with score 0. A table without labels
gives ``und`` for every row. Ties go to the label that sorts first. Repeated rows and ids are predicted alike and teach
as often as they stand there; an empty table gives no rows. Texts of any length are counted and predicted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.llm.common import bounded_batches, column_of_texts, per_text, whole_text

BUCKETS = 1 << 16
MAX_LANGUAGES = 500
STEPS = 8
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of longer characters stay, anything else is a space.
_FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def places(text: str) -> np.ndarray:
    """The hashed four-grams of a text, in order of place."""
    data = _FOLD[np.frombuffer(f"  {text.lower()}  ".encode("utf-8", "replace"), np.uint8)].astype(np.uint32)
    grams = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    return np.sort((grams * np.uint32(0x9E3779B1) >> 16).astype(np.uint16), kind="stable")


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            if _LETTER.search(text):
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found = places(text)
                if len(found) < BUCKETS // 8:
                    np.add.at(total, found, 1)
                else:
                    total += np.bincount(found, minlength=BUCKETS)
    for lang, total in totals.items():
        place = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "place": place.astype(np.int32), "n": total[place]})


class LanguageModel:
    """Learned labels and the probability of each place under each, background last."""

    def __init__(self, labels: list[str], table: np.ndarray):
        self.labels, self.table = labels, table

    @classmethod
    def of_counts(cls, labels: list[str], counts: np.ndarray) -> LanguageModel:
        shares = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
        return cls(labels, np.vstack([shares, np.full((1, BUCKETS), 1 / BUCKETS)]).T.astype(np.float32))

    @classmethod
    def fit(cls, docs: DataFrame) -> LanguageModel:
        """Counts over all labelled rows of ``docs`` (``text``, ``lang``)."""
        labelled = docs.filter("lang is not null").select(F.col("lang").cast("string").alias("lang"), whole_text().alias("text"))
        counted = labelled.mapInPandas(_count, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
        counted = counted.groupBy("lang").agg(F.collect_list(F.struct("place", "n")).alias("places"))
        found = counted.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} labels")
        counts = np.zeros((len(found), BUCKETS))
        for i, row in enumerate(found):
            if row.places:
                place, n = np.array(row.places, np.int64).T
                counts[i, place] = n
        return cls.of_counts([row.lang for row in found], counts)

    def _em(self, likelihood, n, starts, rows, total, share, steps):
        """Proportions and log likelihood of each document after some steps, and a bound: no mixture of all languages has
        a higher one, as the mean of ratios to this mixture is highest for one language alone (Jensen)."""
        for step in range(steps + 1):
            whole = np.maximum(np.einsum("ij,ij->i", likelihood, share[rows]), 1e-30)
            ratio = np.add.reduceat(likelihood * (n / whole)[:, None], starts, axis=0) / total[:, None]
            if step == steps:
                likely = np.add.reduceat(np.log(whole) * n, starts, dtype=np.float64)
                return share, likely, likely + total * np.log(np.maximum(ratio.max(axis=1), 1))
            share = share * ratio

    def proportions(self, texts: list[str]) -> np.ndarray:
        """Documents by labels and background; all zero for a text without letters."""
        out = np.zeros((len(texts), len(self.labels) + 1), np.float32)
        have = [i for i, text in enumerate(texts) if self.labels and _LETTER.search(text)]
        if not have:
            return out
        place, n, sizes = [], [], []
        for i in have:
            found = places(texts[i])
            first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
            place.append(found[first])
            n.append(np.diff(np.r_[first, len(found)]))
            sizes.append(len(first))
        n = np.concatenate(n).astype(np.float32)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        rows = np.repeat(np.arange(len(have)), sizes)
        likelihood = self.table[np.concatenate(place)]
        total = np.add.reduceat(n, starts)
        k = len(self.labels)
        even = np.full((len(have), k + 1), 1 / (k + 1), np.float32)
        share, _, bound = self._em(likelihood, n, starts, rows, total, even, STEPS)
        rank = np.argsort(np.argsort(-share[:, :k], axis=1, kind="stable"), axis=1)
        price = 0.5 * np.log(total.astype(np.float64))
        best = np.full(len(have), -np.inf)
        have, open_ = np.array(have), np.arange(len(have))  # texts for which a larger set may win
        for size in range(1, k + 1):
            allowed = np.hstack([rank[open_] < size, np.ones((len(open_), 1), bool)])
            start = np.where(allowed, np.maximum(share[open_], 1e-3), 0)
            start = (start / start.sum(axis=1, keepdims=True)).astype(np.float32)
            fitted, likely, most = self._em(likelihood, n, starts, rows, total[open_], start, STEPS // 2)
            bound[open_] = np.minimum(bound[open_], most)
            likely = likely - size * price[open_]
            better = likely > best[open_]
            best[open_[better]] = likely[better]
            out[have[open_[better]]] = fitted[better]
            stays = bound[open_] - (size + 1) * price[open_] > best[open_]
            if not stays.any():
                break
            if not stays.all():
                sizes, kept = np.diff(np.r_[starts, len(rows)])[stays], stays[rows]
                likelihood, n, open_ = likelihood[kept], n[kept], open_[stays]
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                rows = np.repeat(np.arange(len(open_)), sizes)
        return out


#: Characters of texts that are fitted at a time where whole rows are kept; what is held per character is many times the character.
ROW_CHARACTERS = 500_000
SCHEMA = "lang_pred string, score double, language_share double, languages string"


def _maker(spark: SparkSession, model: LanguageModel):
    held = spark.sparkContext.broadcast((model.labels, model.table))

    def predict(texts: list[str]) -> pd.DataFrame:
        labels = held.value[0]
        share = LanguageModel(*held.value).proportions(texts)
        named = share[:, :-1]
        found = share.sum(axis=1) > 0
        best = named.argmax(axis=1) if labels else np.zeros(len(texts), int)
        return pd.DataFrame(
            {
                "lang_pred": [labels[b] if f else UNKNOWN for b, f in zip(best, found)],
                "score": named.max(axis=1, initial=0).clip(0, 1).astype(float),
                "language_share": named.sum(axis=1).clip(0, 1).astype(float),
                "languages": [",".join(name for name, s in zip(labels, row) if s > 0.01) for row in named],
            }
        )

    return lambda: predict


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (the share of that language), ``language_share`` (of all
    selected languages) and ``languages``. No shuffle."""
    return per_text(docs, _maker(docs.sparkSession, model), SCHEMA)


def keep_languages(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """``docs`` without texts that are ``und`` or less than ``least`` of a learned language; all columns as they were."""
    bounded_batches(docs.sparkSession)
    found = column_of_texts(_maker(docs.sparkSession, model), SCHEMA, ROW_CHARACTERS)(whole_text()).alias("found")
    rows = docs.select(F.struct("*").alias("row"), found)
    return rows.filter((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.language_share") >= least)).select("row.*")
