"""What each of five filters removes from a corpus, in every order in which they may be applied.

A row that a filter would remove fails it, whatever else is done to the row. So each row has a mask of the filters it fails, and all
orders follow from the number of rows per mask. Four filters look at one text (``SIGNS``); the fifth, ``E``, removes a text that
also stands under a smaller id, anywhere in the table.

Equal texts are found in radix tries. Every task first inserts its whole texts into a compressed trie of its own, whose terminals hold the least
id, and hands over each distinct text once. Texts are then range-partitioned by a prefix that is as long as it must be: where
many bytes of text begin alike, the prefix grows, until the rest is small or all alike. Each range goes into one trie, and its terminals give the
first row of every text. All other rows of a text with an id fail ``E``.

Null text is empty. A null id is not smaller than any and none is smaller than it, so such rows do not fail ``E``, and rows with the same id and text
do not fail it for each other's sake. A row without labels is neither good nor toxic; with several rows of labels, it is if one says so. Null and empty sources are one part. Counts of all parts
are returned, zeros included; an empty table gives no rows. Other columns are not read. Very long texts are held whole, in one trie, in the task of
their range.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.common import small, stored, whole_text

#: Letters of the filters, in the order of the bits of a mask.
FILTERS = "ABCDE"
#: Bytes of text in one trie, about: of a task before it hands over, and of a range.
TRIE_BYTES = 32 << 20
#: Bytes of text under one prefix that are never split.
LEAST_BYTES = 1 << 16
#: Characters of the shortest prefix; each longer one has so many times as many.
PREFIX, GROWTH = 4, 4
#: What keeps rows of null ids apart where rows are dealt by id.
_SPREAD = 4096


# --- tries --------------------------------------------------------------------

class Node:
    """A place in a trie: the children by first byte, each with the bytes that lead there, and the least id of the text that ends here."""

    __slots__ = ("children", "least")

    def __init__(self):
        self.children: dict[int, tuple[bytes, Node]] | None = None
        self.least: int | None = None


def _common(a: bytes, text: bytes, start: int) -> int:
    """Length of the common beginning of ``a`` and ``text[start:]``."""
    low, high = 0, min(len(a), len(text) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == text[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie over whole texts: every inner place has a terminal or at least two children."""

    def __init__(self):
        self.root = Node()
        self.bytes = 0

    def insert(self, text: bytes, key: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            children = node.children
            edge = children.get(text[at]) if children else None
            if edge is None:
                leaf = Node()
                if children is None:
                    children = node.children = {}
                children[text[at]] = (text[at:] if at else text, leaf)
                self.bytes += len(text) - at
                node, at = leaf, len(text)
                break
            label, child = edge
            if not text.startswith(label, at):
                same = _common(label, text, at)
                split = Node()
                split.children = {label[same]: (label[same:], child)}
                children[label[0]] = (label[:same], split)
                label, child = label[:same], split
            node, at = child, at + len(label)
        if node.least is None or key < node.least:
            node.least = key

    def terminals(self):
        """Every text with its least id. Long chains are no deeper calls: the places to visit are kept in a list."""
        todo = [(self.root, b"")]
        while todo:
            node, text = todo.pop()
            if node.least is not None:
                yield text, node.least
            for label, child in (node.children or {}).values():
                todo.append((child, text + label))


def _texts_of(frames):
    for frame in frames:
        yield from zip(frame["doc_id"], frame["text"])


def _combine(frames):
    """Each distinct text of a task with its least id."""
    trie = Trie()
    for key, text in _texts_of(frames):
        trie.insert(text.encode("utf-8", "replace"), key)
        if trie.bytes >= TRIE_BYTES:
            yield from _rows(trie)
            trie = Trie()
    yield from _rows(trie)


def _rows(trie: Trie):
    ids, texts, size = [], [], 0
    for text, least in trie.terminals():
        ids.append(least)
        texts.append(text.decode())
        size += len(text)
        if size > TRIE_BYTES // 8:
            yield pd.DataFrame({"doc_id": ids, "text": texts})
            ids, texts, size = [], [], 0
    yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "text": pd.Series(texts, dtype="object")})


def _firsts(frames):
    """Least id and digest of every text of a range."""
    trie = Trie()
    for key, text in _texts_of(frames):
        trie.insert(text.encode("utf-8", "replace"), key)
    ids, digests = [], []
    for text, least in trie.terminals():
        ids.append(least)
        digests.append(hashlib.sha256(text).hexdigest())
    yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="int64"), "digest": pd.Series(digests, dtype="object")})


def _prefix(length) -> Column:
    return F.substring(F.col("text"), F.lit(1), length if isinstance(length, Column) else F.lit(length))


def adaptive_prefix(texts: DataFrame, most_bytes: int = TRIE_BYTES) -> DataFrame:
    """``texts`` with ``prefix``: of the beginnings of a text, the shortest under which there are at most
    ``most_bytes`` of text, or all texts are alike."""
    length = PREFIX
    out = texts.withColumn("length", F.lit(length))
    rest = texts.select("text", F.xxhash64(_prefix(length)).alias("beginning"))
    while True:
        whole = F.xxhash64("text")
        groups = rest.groupBy("beginning").agg(F.sum(F.octet_length("text")).alias("n"), F.min(whole).alias("least"), F.max(whole).alias("most"))
        crowded = stored(groups.where((F.col("n") > most_bytes) & (F.col("least") != F.col("most"))).select("beginning"), "beginnings")
        if crowded.isEmpty():
            return out.withColumn("prefix", _prefix(F.col("length"))).drop("length")
        # a hash that two beginnings share only makes a prefix longer than it need be
        crowded = small(crowded)
        longer = length * GROWTH
        same = F.col("length") == length
        beginning = F.when(same, F.xxhash64(_prefix(length)))
        mark = crowded.select(F.col("beginning").alias("_beginning"), F.lit(True).alias("_crowded"))
        out = out.join(mark, beginning == F.col("_beginning"), "left").withColumn("length", F.when(F.col("_crowded"), longer).otherwise(F.col("length")))
        out = out.drop("_beginning", "_crowded")
        rest = out.where(F.col("length") == longer).select("text", F.xxhash64(_prefix(longer)).alias("beginning"))
        length = longer


def first_rows(docs: DataFrame, most_bytes: int = TRIE_BYTES) -> DataFrame:
    """``doc_id`` and ``digest`` (SHA-256) of the row with the least id of every distinct text; null ids are left out."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).where("doc_id is not null")
    combined = stored(texts.mapInPandas(_combine, "doc_id long, text string"), "texts")
    spark = docs.sparkSession
    total = combined.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // most_bytes))
    # texts under one prefix stay together, so each prefix may have half a range at most
    share = max(total // (2 * ranges), min(LEAST_BYTES, most_bytes))
    dealt = adaptive_prefix(combined, share).repartitionByRange(ranges, "prefix").drop("prefix")
    return dealt.mapInPandas(_firsts, "doc_id long, digest string")


# --- filters --------------------------------------------------------------------

def signs(text: Column) -> Column:
    """Bits of the filters that look at a text alone: few words, repeated words, capitals, symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # in a list of one, so that a text is cut once and not for every use of its words
    found = F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("different"))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return F.transform(
        F.array(found),
        lambda w: F.when(w.n < 50, 1).otherwise(0)
        + F.when(100 * w.different.cast("long") < 65 * w.n.cast("long"), 2).otherwise(0)
        + F.when(100 * capitals.cast("long") > 5 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0),
    )[0]


def filter_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, mask, good, toxic, n``: rows by id and what is known of them."""
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("source").alias("part"), F.sha2(text, 256).alias("digest"), signs(text).alias("signs"))
    # Null ids meet nothing; they are spread by their texts.
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(_SPREAD))).otherwise(0)
    rows = rows.withColumn("spread", spread).groupBy("doc_id", "spread", "digest", "part", "signs").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = known.where("doc_id is not null").withColumn("spread", F.lit(0).cast("long"))
    firsts = first_rows(docs).select("doc_id", F.lit(0).cast("long").alias("spread"), "digest", F.lit(True).alias("first"))
    marked = rows.join(firsts, ["doc_id", "spread", "digest"], "left").join(known, ["doc_id", "spread"], "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return marked.select(
        "doc_id", "part", (F.col("signs") + copy).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"), "n",
    )


def _orders() -> Column:
    """Every step of every order: the filter's bit, and the bits of the filters before it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'bit', {bit}, 'before', {before})")
            before |= bit
    return F.expr(f"array({', '.join(steps)})")


def audit(masks: DataFrame) -> DataFrame:
    """Counts for every part, order and step, from rows with ``part, mask, good, toxic, n``."""
    size = 1 << len(FILTERS)

    def per_mask(rows: Column) -> list[Column]:
        return [F.coalesce(F.sum(F.when((F.col("mask") == m) & rows, F.col("n"))), F.lit(0).cast("long")) for m in range(size)]

    counted = masks.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    table = counted.groupBy("part").agg(
        F.array(*per_mask(F.lit(True))).alias("rows"), F.array(*per_mask(F.col("good"))).alias("good"), F.array(*per_mask(F.col("toxic"))).alias("bad")
    )
    each = table.select("part", "rows", "good", "bad", F.inline(_orders()))

    def total(counts: str, condition: str, amount: str = "x") -> Column:
        """Sum of ``counts`` over the masks ``m`` for which the condition holds."""
        return F.expr(
            f"aggregate(transform({counts}, (x, m) -> if({condition}, {amount}, 0L)), 0L, (a, b) -> a + b)"
        )

    here = "(m & bit) <> 0 and (m & before) = 0"
    orders = len(list(permutations(FILTERS)))
    return each.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("rows", "(m & (before | bit)) = 0").alias("kept"),
        total("rows", here).alias("removed"),
        total("rows", "(m & bit) <> 0 and (m & before) <> 0").alias("redundant"),
        total("rows", "m = bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("bad", here).alias("toxic_lost"),
        # of the filters that a row fails, each comes first in as many orders
        total("rows", "(m & bit) <> 0", f"x * ({orders} div bit_count(m))").alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(filter_masks(docs, labels))


#: The same in SQL, over ``documents`` and ``labels``.
SQL = """with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents
),
known as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
masks as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    case when len(words) < 50 then 1 else 0 end + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
    + case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) then 4 else 0 end
    + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
    + case when min(texts.doc_id) over (partition by text) < texts.doc_id then 16 else 0 end as mask
  from texts left join known on known.doc_id = texts.doc_id
),
counted as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masks group by all),
letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
    and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
),
steps as (
  select filter_order, cast(step as int) as step, bits[step] as bit, cast(coalesce(list_sum(bits[1:step - 1]), 0) as int) as before
  from orders, range(1, 6) as s(step)
),
each as (
  select part, filter_order, step, bit,
    cast(coalesce(sum(n) filter (mask & (before | bit) = 0), 0) as bigint) as kept,
    cast(coalesce(sum(n) filter (mask & bit <> 0 and mask & before = 0), 0) as bigint) as removed,
    cast(coalesce(sum(n) filter (mask & bit <> 0 and mask & before <> 0), 0) as bigint) as redundant,
    cast(coalesce(sum(n) filter (mask = bit), 0) as bigint) as unique_fails,
    cast(coalesce(sum(good) filter (mask & bit <> 0 and mask & before = 0), 0) as bigint) as good_lost,
    cast(coalesce(sum(toxic) filter (mask & bit <> 0 and mask & before = 0), 0) as bigint) as toxic_lost
  from counted, steps group by all
)
select * exclude (bit), cast(sum(removed) over (partition by part, bit) as bigint) as shapley from each"""
