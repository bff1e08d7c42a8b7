"""Similarity join on word n-grams: a sparse product of the document by n-gram incidence, in blocks.

Columns of the incidence matrix are blocks of n-gram hashes. A first pass over these blocks
says how many documents hold each n-gram, so that n-grams of one document fall away; a document can
only have a partner if three quarters of its own n-grams remain (the bound follows from the sizes alone).
The few documents left order their n-grams from rare to common. A pair of enough likeness must share one of
the first ``n - ceil(0.75 n) + 1``, and of the smaller document one of still fewer, so only those columns are
joined; pairs whose sizes are too far apart are dropped.

What is left is multiplied in full: documents stand in row blocks, each of likely kin, and each block is multiplied
once with each document that may link with any of its rows. Overlaps add up n-gram by n-gram in one task, and
only links that reach the bound leave it, of a group of links only as many as hold it together.

Large groups of near copies would make the square of their size in pairs. As classes are
asked for, documents are first linked to the most typical of those with the same least n-gram under three hash functions
(one pair per document and function); the product then takes only pairs across classes, so no link
between classes is lost.

Documents of equal text count as one; null texts, texts without words and empty tables
have no n-grams and no partner. Rows that repeat an id are documents of their own; each gets a row. A text of any length is
hashed whole, in pieces; its n-grams stand in one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from hitledger.llm.batches import ask_and_finish, batch_of, batches_for, merged, pack, pack_sorted, unpack, unpack_sorted
from hitledger.llm.common import small, stored, whole_text
from hitledger.llm.components import connected
from hitledger.llm.hashing import mix, shingle_sets

WORDS = 5
#: Likeness in percent from which two documents are linked.
PERCENT = 75
#: N-grams are counted by the first bits of their hash; others that share them only make an n-gram look more common.
CELL_BITS = 40
STARS = 3
#: Rows of a block, and documents multiplied with one at a time.
ROWS, COLUMNS = 256, 2048
#: Stands for a null id.
NO_ID = 2**63 - 1
#: Blocks of columns hold about as many n-grams as this many batches.
BATCHES_PER_BLOCK = 3


def _cells(sets: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return every >> np.uint64(64 - CELL_BITS)


def _blocks(cells: np.ndarray, n: int) -> np.ndarray:
    """The block of each sorted cell: equal ranges."""
    return (cells.astype(np.float64) * (n / (1 << CELL_BITS))).astype(np.int64).clip(0, n - 1)


def _ask(blocks: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node")
        cells, counts = np.unique(_cells(shingle_sets(list(frame["text"]), WORDS)), return_counts=True)
        of = _blocks(cells, blocks)
        cuts = np.flatnonzero(np.r_[True, np.diff(of) != 0, True]) if len(cells) else []
        rows = [
            (int(of[a]), int(frame["batch"].iloc[0]), pack_sorted(cells[a:b]), pack(counts[a:b].astype(np.uint32)))
            for a, b in zip(cuts, cuts[1:])
        ]
        return pd.DataFrame(rows, columns=["block", "batch", "cells", "counts"])

    return run


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """How common each asked cell is: 0 for one document, else the number of bits of the count."""
    keys = [unpack_sorted(x) for x in frame["cells"]]
    _, total, places = merged(keys, [unpack(x, "<u4") for x in frame["counts"]])
    kind = np.where(total > 1, np.floor(np.log2(np.maximum(total, 1))) + 1, 0).astype(np.uint8)
    return pd.DataFrame(
        {"batch": frame["batch"], "block": frame["block"], "common": [pack(kind[place]) for place in places]}
    )


def needed(n: int) -> int:
    """N-grams that a document of n must share with any partner."""
    return -(-PERCENT * n // 100)


def needed_of_equals(n: int) -> int:
    """N-grams that a document of n must share with any partner that is no smaller."""
    return -(-2 * PERCENT * n // (100 + PERCENT))


def _finish(_, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Per document its number of n-grams; for one that may have a partner also those n-grams it shares."""
    frame = frame.drop_duplicates("node")
    sets = shingle_sets(list(frame["text"]), WORDS)
    cells = np.unique(_cells(sets))
    common = [unpack(x, "u1") for x in answers.sort_values("block")["common"]]
    common = np.concatenate(common) if common else np.zeros(0, np.uint8)
    rows = []
    odd = np.arange(1, STARS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for node, own in zip(frame["node"], sets):
        kind = common[np.searchsorted(cells, own >> np.uint64(64 - CELL_BITS))] if len(own) else common[:0]
        shared = int((kind > 0).sum())
        n = len(own)
        if not n or shared < needed(n):
            rows.append((node, n, 0, 0, 0.0, None, None))
            continue
        order = np.lexsort((own, kind))[n - shared :]  # n-grams of this document alone come first and match nothing
        first = n - needed(n) + 1 - (n - shared)
        short = max(0, n - needed_of_equals(n) + 1 - (n - shared))
        grams = own[order]
        least = mix(grams[:, None] ^ odd).min(axis=0)
        rows.append((node, n, first, short, float(kind.mean()), grams.view(np.int64).tolist(), least.view(np.int64).tolist()))
    return pd.DataFrame(rows, columns=["node", "n", "first", "short", "common", "grams", "least"])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``node`` (SHA-256) and ``text``, once per text but for rows that repeat their id as well.

    The texts that occur more than once are found without moving texts.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key")
    rows = docs.select(key, F.sha2(whole_text(), 256).alias("node"), whole_text().alias("text"))
    several = rows.groupBy("node").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    several = small(stored(several.filter("copies > 1").select("node", "least"), "copies"))
    return rows.join(several, "node", "left").filter("least is null or key = least").select("node", "text")


def shared_grams(docs: DataFrame) -> DataFrame:
    """Per distinct text (``node``, its SHA-256) its n-grams counted, and those it shares where a partner is possible."""
    rows = distinct_texts(docs)
    batches = batches_for(docs.select(whole_text().alias("text")))
    blocks = max(1, batches // BATCHES_PER_BLOCK)
    return ask_and_finish(
        rows.withColumn("batch", batch_of(F.col("node"), batches)),
        _ask(blocks),
        "block int, batch int, cells binary, counts binary",
        lambda asked: asked.groupBy("block").applyInPandas(_answer, "batch int, block int, common binary"),
        _finish,
        "node string, n int, first int, short int, common double, grams array<long>, least array<long>",
    )


def _linked(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose overlap, counted in full, reaches the bound."""
    left = grams.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = grams.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("overlap", F.size(F.array_intersect("grams_a", "grams_b")))
    return both.filter(F.expr(f"100 * overlap >= {PERCENT} * (n_a + n_b - overlap)")).select("a", "b")


_SIZES = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"


def _stars(grams: DataFrame) -> DataFrame:
    """Each document with one of those that share a least n-gram: the one whose n-grams are the most common.

    In a group of copies that were changed here and there, that is the one nearest to their origin.
    """
    keys = grams.select("node", "n", "common", F.posexplode("least").alias("hash", "least"))
    heads = keys.groupBy("hash", "least").agg(
        F.max(F.struct("common", "node", "n")).alias("head"), F.count(F.lit(1)).alias("size")
    )
    pairs = keys.join(heads.filter("size > 1").drop("size"), ["hash", "least"])
    pairs = pairs.select(F.col("head.node").alias("a"), F.col("head.n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b"))
    return pairs.filter(f"a <> b and {_SIZES}").select("a", "b").distinct()


def _blocks_of(grams: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents in row blocks of about ``ROWS`` at most: those of one class, or of one least n-gram, together."""
    rows = grams.join(classes, "node", "left")
    key = F.coalesce("root", F.get("least", F.lit(0)).cast("string"))
    rows = rows.withColumn("key", F.concat(F.when(F.col("root").isNull(), "-").otherwise("+"), key))
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    return rows.join(sizes, "key").withColumn("block", F.xxhash64("key", chunk)).drop("key", "chunks", "least", "common")


def _needed_products(rows: DataFrame) -> DataFrame:
    """For each row block the documents that share a first n-gram with one of its rows and are of another class.

    A pair is found from its smaller document: a partner that is no smaller shares more of it, so fewer of its
    n-grams have to be tried.
    """
    gram = F.explode(F.slice("grams", 1, F.col("short"))).alias("gram")
    left = rows.select("block", "root", "n", gram).groupBy("gram", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.first("root").alias("root")
    )
    right = rows.select(F.col("node").alias("b"), "n", F.col("root").alias("root_b"), F.explode(F.slice("grams", 1, F.col("first"))).alias("gram"))
    other = f"(root is null or root_b is null or root <> root_b) and n >= low and {PERCENT} * n <= 100 * high"
    return left.join(right, "gram").filter(other).select("block", "b").distinct()


def _product(frame: pd.DataFrame) -> pd.DataFrame:
    """Overlaps of a row block with each of its partners, n-gram by n-gram; the links, without those that others imply."""
    mine, others = frame[frame["side"] == 0], frame[frame["side"] == 1]
    nodes, n = mine["node"].tolist(), mine["n"].to_numpy(np.int64)
    owner = np.repeat(np.arange(len(mine)), [len(g) for g in mine["grams"]])
    column = np.concatenate([*mine["grams"], np.zeros(0, np.int64)])
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    links = []
    for node, size, grams in zip(others["node"], others["n"], others["grams"]):
        low, high = np.searchsorted(column, grams, "left"), np.searchsorted(column, grams, "right")
        count = high - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        overlap = np.bincount(owner[at], minlength=len(mine))
        for i in np.flatnonzero(100 * overlap >= PERCENT * (n + size - overlap)).tolist():
            a, b = find(nodes[i]), find(node)
            if a != b:
                root[a] = b
                links.append((nodes[i], node))
    return pd.DataFrame(links, columns=["a", "b"])


def _across(grams: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes: the product of row blocks and the documents that may link with them."""
    rows = stored(_blocks_of(grams, classes), "blocks")
    pairs = stored(_needed_products(rows), "products")
    parts = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / COLUMNS).cast("int").alias("parts"))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    mine = rows.join(parts, "block").select("block", part, F.lit(0).alias("side"), "node", "n", "grams")
    others = pairs.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    others = others.join(rows.select(F.col("node").alias("b"), "n", "grams"), "b").select(
        "block", "part", F.lit(1).alias("side"), F.col("b").alias("node"), "n", "grams"
    )
    return mine.unionByName(others).groupBy("block", "part").applyInPandas(_product, "a string, b string")


def classes_of(docs: DataFrame) -> DataFrame:
    """Per distinct text: ``node``, ``n`` n-grams, ``root`` (null for a text without partner)."""
    sets = stored(shared_grams(docs), "shared-grams")
    grams = sets.filter("grams is not null")
    stars = stored(_linked(_stars(grams), grams), "stars")
    classes = stored(connected(stars), "classes")
    hung = classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
    classes = stored(connected(hung.unionByName(_across(grams, classes))), "classes")
    return sets.select("node", "n").join(classes, "node", "left")


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(whole_text(), 256).alias("node"))
    classes = classes_of(docs).withColumn("root", F.coalesce("root", "node"))
    found = stored(rows.join(classes, "node"), "near-copies")
    # texts without n-grams link with nothing, not even their copies
    # written first, so that the join has two plain exchanges and a large group can be split
    least = stored(found.groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return found.join(least, "root").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with the row of the smallest id of each group; all columns as they were.

    Rows without n-grams all stay. A null id is larger than any. Of wholly repeated rows one stays.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key")
    rows = docs.select(F.struct("*").alias("row"), key, F.sha2(whole_text(), 256).alias("node"))
    classes = classes_of(docs).filter("n > 0").select("node", F.coalesce("root", "node").alias("root"))
    ids = rows.select("key", "node").join(classes, "node").groupBy("root", "key", "node").agg(F.count(F.lit(1)).alias("copies"))
    ids = stored(ids, "groups")
    first = ids.groupBy("root").agg(F.min(F.struct("key", "node")).alias("first"))
    ids = ids.join(first, "root").withColumn("stays", F.struct("key", "node") == F.col("first"))
    gone = small(stored(ids.filter("not stays or copies > 1").select("key", "node", "stays"), "gone"))
    alone = rows.join(gone, ["key", "node"], "left_anti").select("row.*")
    turn = F.row_number().over(Window.partitionBy("key", "node").orderBy("key"))
    repeated = rows.join(gone.filter("stays"), ["key", "node"]).withColumn("turn", turn).filter("turn = 1")
    return alone.unionByName(repeated.select("row.*"))
