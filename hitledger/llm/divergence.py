"""How far the sources of a language differ in their words, and by which words.

Terms are runs of letters A to Z, in either case, and of characters beyond ASCII. One ``bytes.translate`` of the UTF-8 text puts A to Z in lower case and
blanks everything else, ``bytes.split`` cuts it, and a ``Counter`` per document gives what is added up: documents and occurrences per language,
source and term. Counts are added within a task before they are shuffled. Of each language the terms in at least ``LEAST_DOCUMENTS`` of its documents
are kept; of these, ``V`` in number, a group (a language's source, or the whole language) of ``N`` occurrences gives a term that occurs ``count``
times there ``p = 1 + floor(10^9 * (count + 2) / (N + 2 * V))``. Two such numbers differ by ``floor((p - q)^2 / (p + q))``. All
arithmetic is in whole numbers.

- ``pair``: the sum over all kept terms for each two sources of a language.
- ``term``: the ``TOP`` terms that set a source apart from its language, of those that occur in it and are more frequent there.

Most terms occur in few sources, and where a source lacks a term its ``p`` is the same for all such terms. So the sum over a pair is taken from the terms
that both have, added up in blocks inside the tasks, and from the numbers of terms per count of each source; terms that neither has only count.

Null text, language and source are empty strings. Rows are documents: repeated rows count again, and ids are not read. Ties in rank
go by the item's UTF-8. A source of texts without terms has counts of 0, a language without kept terms differences of 0, an empty
table no rows. Very long texts are cut between terms and counted piece by piece. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.common import small, stored, whole_text

#: A term is kept when so many documents of the language have it.
LEAST_DOCUMENTS = 10
#: Ranks of the terms of a source.
TOP = 10
#: What is added to each count, and the scale of ``p``.
PRIOR, SCALE = 2, 1_000_000_000

#: Bytes of a text that are split at a time, and entries a task holds before it hands them over.
PIECE, ENTRIES = 1 << 20, 250_000
#: Pairs of entries that are compared at a time.
PAIRS = 1 << 20

_LETTERS = bytes(c for c in range(256) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
#: Lower case for A to Z, blank for all that is no part of a term.
TABLE = bytes((c | 32 if 65 <= c <= 90 else c) if c in _LETTERS else 32 for c in range(256))


def tokens(body: bytes):
    """The terms of a text, in lists of about ``PIECE`` bytes."""
    clean = body.translate(TABLE)
    start = 0
    while start < len(clean):
        stop = clean.find(b" ", start + PIECE)
        stop = len(clean) if stop < 0 else stop
        yield clean[start:stop].split()
        start = stop


def count_terms(body: bytes) -> Counter:
    """Occurrences of each term of one document."""
    found: Counter = Counter()
    for part in tokens(body):
        found.update(part)
    return found


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("count", pa.int64())])


def _flush(documents: dict, occurrences: dict):
    for (lang, source), number in occurrences.items():
        if number:  # both counters have their terms in the order in which they came
            n = len(number)
            columns = [pa.repeat(lang, n), pa.repeat(source, n), list(number), list(documents[lang, source].values()), list(number.values())]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _COUNTS.types)], schema=_COUNTS)
    # every group is named once per task and flush, also without terms
    langs, sources = zip(*occurrences) if occurrences else ((), ())
    rows = [list(langs), list(sources), [""] * len(langs), [0] * len(langs), [0] * len(langs)]
    yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, _COUNTS.types)], schema=_COUNTS)


def _count(batches):
    documents: dict[tuple, Counter] = {}
    occurrences: dict[tuple, Counter] = {}
    entries = 0
    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            group = (langs[i].as_py(), sources[i].as_py())
            if group not in occurrences:
                documents[group], occurrences[group] = Counter(), Counter()
                entries += 1
            total = occurrences[group]
            held = len(total)
            found = count_terms(texts[i].as_buffer().to_pybytes())
            documents[group].update(found.keys())
            for term, number in found.items():
                total[term] = total.get(term, 0) + number
            entries += len(total) - held
            if entries >= ENTRIES:
                yield from _flush(documents, occurrences)
                documents, occurrences, entries = {}, {}, 0
    yield from _flush(documents, occurrences)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, docs, count`` of every term; the empty term stands for the group itself."""
    texts = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text().alias("text"))
    found = texts.mapInArrow(_count, "lang string, source string, term string, docs long, count long")
    # One exchange serves this sum and the one over sources after it.
    dealt = found.repartition(F.col("lang"), F.col("term"))
    return dealt.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``p``, exact for counts of any size."""
    wide = count.cast("decimal(19,0)") + F.lit(PRIOR).cast("decimal(19,0)")
    scaled = (F.lit(SCALE).cast("decimal(10,0)") * wide).cast("decimal(38,0)")
    return 1 + F.call_function("div", scaled, (total + PRIOR * terms).cast("decimal(20,0)")).cast("long")


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _added(keys: np.ndarray, numbers: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of both columns."""
    distinct, place = np.unique(keys, return_inverse=True)
    both, gain = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    np.add.at(both, place, numbers)
    np.add.at(gain, place, gains)
    return distinct, both, gain


class _Sums:
    """Sums for pairs of sources of one language; what is added is merged whenever it has doubled."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size, self.room = 0, 4 * PAIRS

    def add(self, keys: np.ndarray, numbers: np.ndarray, gains: np.ndarray) -> None:
        self.parts.append(_added(keys, numbers, gains))
        self.size += len(self.parts[-1][0])
        if self.size > self.room or len(self.parts) > 64:
            self.merge()

    def merge(self) -> None:
        if self.parts:
            self.parts = [_added(*(np.concatenate(x) for x in zip(*self.parts)))]
            self.size = len(self.parts[0][0])
            self.room = max(4 * PAIRS, 2 * self.size)


def _shared(frames):
    """For each two sources, over the terms both have: their number, and the sum of differences less what is counted for either one beside absent terms."""
    sums: dict[str, _Sums] = {}

    def out():
        for lang, found in sums.items():
            found.merge()
            for keys, both, gain in found.parts:
                yield pd.DataFrame({"lang": lang, "one": keys >> 32, "other": keys & 0xFFFFFFFF, "both": both, "gain": gain})
        sums.clear()

    for frame in frames:
        for lang, part in frame.groupby("lang"):
            found = sums.setdefault(lang, _Sums())
            row = np.repeat(np.arange(len(part)), part["places"].map(len).to_numpy())
            place, p, zero = (np.concatenate([np.asarray(x, np.int64) for x in part[name]]) for name in ("places", "ps", "zeros"))
            left, step = np.arange(len(row)), 1
            while len(left):
                left = left[left + step < len(row)]
                left = left[row[left] == row[left + step]]
                for start in range(0, len(left), PAIRS):
                    a = left[start : start + PAIRS]
                    b = a + step
                    gain = _apart(p[a], p[b]) - _apart(p[a], zero[b]) - _apart(zero[a], p[b])
                    keys = np.minimum(place[a], place[b]) << 32 | np.maximum(place[a], place[b])
                    found.add(keys, np.ones(len(keys), np.int64), gain)
                step += 1
        if sum(x.size for x in sums.values()) > 4 * PAIRS:
            yield from out()
    yield from out()


def source_divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``, see above."""
    counts = term_counts(docs)
    # Per language and term: its documents and occurrences, and the sources that have it. No further exchange.
    cell = F.struct("source", "count")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.collect_list(cell).alias("cells"))
    found = stored(terms.where((F.col("docs") >= LEAST_DOCUMENTS) | (F.col("term") == "")).drop("docs"), "terms")
    kept = found.where("term <> ''")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    present = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("count").alias("group_total"), F.count(F.lit(1)).alias("has"))
    groups = found.where("term = ''").select("lang", F.inline("cells")).select("lang", "source")
    groups = groups.join(sizes, "lang", "left").join(present, ["lang", "source"], "left")
    groups = groups.na.fill(0, ["terms", "lang_total", "group_total", "has"])
    # Sources are numbered from 1 within their language.
    numbered = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
    zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("group_total"), F.col("terms")))
    groups = stored(numbered.withColumn("zero", zero), "groups")

    cells = kept.select("lang", "term", "total", F.inline("cells")).join(small(groups), ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("count"), F.col("group_total"), F.col("terms")))

    # What sets a source apart.
    in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    q = share(F.col("total"), F.col("lang_total"), F.col("terms"))
    telling = cells.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    telling = telling.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= TOP)

    # Two sources: terms that both have ...
    rows = cells.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p", "zero")).alias("x"))
    rows = rows.select("lang", F.col("x.place").alias("places"), F.col("x.p").alias("ps"), F.col("x.zero").alias("zeros"))
    shared = rows.mapInPandas(_shared, "lang string, one long, other long, both long, gain long")
    shared = shared.groupBy("lang", "one", "other").agg(F.sum("both").alias("both"), F.sum("gain").alias("gain"))
    # ... all terms of one beside a source without them, by the number of terms of each count ...
    bins = cells.groupBy("lang", F.col("place").alias("one"), "p").agg(F.count(F.lit(1)).alias("n"))
    others = groups.select("lang", F.col("place").alias("other"), F.col("zero").alias("other_zero"))
    alone = bins.join(small(others), "lang").where("one <> other")
    alone = alone.groupBy("lang", "one", "other").agg(F.sum(F.col("n") * apart(F.col("p"), F.col("other_zero"))).alias("gain"))
    # ... and terms that neither has. The smaller number comes first in a pair.
    ordered = alone.select("lang", F.least("one", "other").alias("one"), F.greatest("one", "other").alias("other"), F.lit(0).cast("long").alias("both"), "gain")
    sums = shared.unionByName(ordered).groupBy("lang", "one", "other").agg(F.sum("both").alias("both"), F.sum("gain").alias("gain"))
    sums = stored(sums, "sums")
    either = sums.unionByName(sums.select("lang", F.col("other").alias("one"), F.col("one").alias("other"), "both", "gain"))
    a = groups.select("lang", "source", "terms", F.col("place").alias("one"), F.col("has").alias("has_one"), F.col("zero").alias("zero_one"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("has").alias("has_other"), F.col("zero").alias("zero_other"))
    pairs = a.join(b, "lang").where("one <> other").join(either, ["lang", "one", "other"], "left").na.fill(0, ["both", "gain"])
    neither = F.col("terms") - F.col("has_one") - F.col("has_other") + F.col("both")
    flat = F.coalesce(apart(F.col("zero_one"), F.col("zero_other")), F.lit(0).cast("long"))
    pairs = pairs.select("lang", "source", "item", (F.col("gain") + neither * flat).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(in_order))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(telling.withColumn("part", F.lit("term")).select(columns))


#: The same in SQL, over ``documents``.
SQL = f"""with texts as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as n,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]+') as found
  from documents
),
tokens as (
  select lang, source, n, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from texts
),
kept as (select lang, term, count(*) as total from tokens group by all having count(distinct n) >= {LEAST_DOCUMENTS}),
sizes as (select lang, count(*) as v, sum(total) as n from kept group by all),
groups as (select distinct lang, source from texts),
counts as (select lang, source, term, count(*) as c from tokens semi join kept using (lang, term) group by all),
totals as (select lang, source, sum(c) as n from counts group by all),
cells as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
    1 + ({SCALE}::hugeint * (coalesce(c.c, 0) + {PRIOR})) // (coalesce(t.n, 0)::hugeint + {PRIOR} * s.v) as p,
    1 + ({SCALE}::hugeint * (k.total + {PRIOR})) // (s.n::hugeint + {PRIOR} * s.v) as q
  from groups g join kept k using (lang) join sizes s using (lang)
    left join totals t on t.lang = g.lang and t.source = g.source
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
every as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, cast((p - q) * (p - q) // (p + q) as bigint) from cells where c > 0 and p > q
)
select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as "rank"
from every qualify part = 'pair' or "rank" <= {TOP}"""
