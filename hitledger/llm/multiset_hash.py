"""Homomorphic multiset hash of paragraphs as a document fingerprint.

A text is the multiset of its paragraphs: lines, cut further at sentence ends. Each
paragraph hashes to a wide vector and a text's fingerprint is the sum of them modulo powers
of two, so order does not matter and a paragraph is inserted or deleted by adding or
subtracting its vector.

The vector has four lanes modulo 2**64 for equality, one that counts paragraphs, and ``LEVELS``
times ``LANES`` lanes modulo 2**8 of which level k is touched by one paragraph in 2**k (each paragraph
draws one level per lane). In the difference of two fingerprints only paragraphs that are not common remain;
the share of lanes left at zero on each level tells how many those are, up to the 2**30 paragraphs that a
text of 2 GB can have.

Null and empty texts have no paragraph; their fingerprint is zero, and two of them are
alike (1.0). An empty table gives no rows. Texts of any length are read whole. Rows with a null id stand before all others. Rows that repeat an id follow each other
in order of their text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.common import small, stored, whole_text

LEVELS, LANES = 30, 32
#: Stands for a null id.
NO_ID = -(2**63)
#: Characters per task, about, and cells of neighbouring ids for each task.
RANGE_CHARACTERS, CELLS = 8_000_000, 16
#: Quantiles of the ids between which cells are of equal width, and cells that one task puts in order.
QUANTILES, BLOCK = 256, 4096
_WIDE, _CELLS = 4, LEVELS * LANES
BYTES = 8 * _WIDE + 4 + _CELLS
_PARAGRAPH = re.compile(r"[^\n.!?]+[.!?]*\s?|[.!?]+\s?")


def paragraphs(text: str) -> list[str]:
    """Pieces without surrounding white space; blank ones count for nothing."""
    return [p for p in map(str.strip, _PARAGRAPH.findall(text)) if p]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEPS = np.arange(1, _WIDE + LANES // 2 + LANES // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def sums(pieces: list[list[str]]) -> np.ndarray:
    """One fingerprint (``BYTES`` bytes) per list of paragraphs."""
    out = np.zeros((len(pieces), BYTES), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    have = np.flatnonzero(sizes)
    if not len(have):
        return out
    out[:, 8 * _WIDE : 8 * _WIDE + 4] = sizes.astype("<u4")[:, None].view(np.uint8)
    wide = np.zeros((len(have), _WIDE), np.uint64)
    cells = np.zeros((len(have), _CELLS), np.uint8)
    step = 4000  # paragraphs expanded at a time
    seeds = np.array([xxhash.xxh3_64_intdigest(p) for row in pieces for p in row], np.uint64)
    others = np.array([xxhash.xxh64_intdigest(p) for row in pieces for p in row], np.uint64)
    owner = np.repeat(np.arange(len(have)), sizes[have])
    for i in range(0, len(seeds), step):
        mine = owner[i : i + step]
        first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        lanes = _mix(seeds[i : i + step, None] + _STEPS) ^ _mix(others[i : i + step, None] * _STEPS)
        drawn = np.ascontiguousarray(lanes[:, _WIDE : _WIDE + LANES // 2]).view(np.uint32)
        level = np.frexp((drawn & (~drawn + np.uint32(1))).astype(np.float64))[1] - 1  # zeros at the low end
        level[drawn == 0] = LEVELS
        values = np.ascontiguousarray(lanes[:, _WIDE + LANES // 2 :]).view(np.uint8) | np.uint8(1)
        at = mine[:, None] * _CELLS + level * LANES + np.arange(LANES)
        touched = level < LEVELS
        wide[mine[first]] += np.add.reduceat(lanes[:, :_WIDE], first, axis=0)
        np.add.at(cells.reshape(-1), at[touched], values[touched])
    out[have, : 8 * _WIDE] = wide.view(np.uint8)
    out[have, 8 * _WIDE + 4 :] = cells
    return out


def _parts(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prints = np.ascontiguousarray(prints)
    wide = np.ascontiguousarray(prints[:, : 8 * _WIDE]).view("<u8")
    count = np.ascontiguousarray(prints[:, 8 * _WIDE : 8 * _WIDE + 4]).view("<u4")
    return wide, count, prints[:, 8 * _WIDE + 4 :]


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprints of the united multisets (``sign=1``), or of ``a`` without ``b`` (``sign=-1``)."""
    parts = [x + y if sign > 0 else x - y for x, y in zip(_parts(a), _parts(b))]
    return np.hstack([np.ascontiguousarray(p).view(np.uint8) for p in parts])


#: Numbers of uncommon paragraphs that are told apart, and the share of lanes each leaves touched.
_GRID = np.unique(np.round(1.06 ** np.arange(0, 381)).astype(np.int64))
_TOUCHED = -np.expm1(_GRID[:, None] * np.log1p(-(2.0 ** -np.arange(1, LEVELS + 1)))[None, :]) * (1 - 2.0**-8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common paragraphs, 0 to 1: one less the estimated uncommon ones over all; 1 if equal."""
    _, count, cells = _parts(combine(a, b, -1))
    hit = (cells.reshape(len(a), LEVELS, LANES) != 0).sum(axis=2)
    likely = hit @ np.log(_TOUCHED).T + (LANES - hit) @ np.log1p(-_TOUCHED).T
    total = _parts(a)[1][:, 0].astype(float) + _parts(b)[1][:, 0]
    out = 1 - _GRID[likely.argmax(axis=1)] / np.maximum(total, 1)
    return np.where((a == b).all(axis=1), 1.0, np.clip(out, 0, 1))


def fingerprints(texts: list[str]) -> np.ndarray:
    return sums([paragraphs(t) for t in texts])


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranks(rows: DataFrame, cells: int) -> Column:
    """The cell of a row, 0 to ``2 * cells - 1``, rising with (id, text): rows without an id by the first bytes of their text, then
    the others by their id's place between quantiles of all ids, so that ids need not be spread evenly."""
    known = F.when(F.col("id") != NO_ID, F.col("id"))
    steps = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = rows.agg(F.percentile_approx(known, steps, 10 * QUANTILES)).first()[0] or [0] * (QUANTILES + 1)
    bounds = sorted(set(found)) + [max(found) + 1]
    cuts = f"array({', '.join(f'{b}L' for b in bounds)})"
    halving = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    seek = f"aggregate(array({', '.join(map(str, halving))}), 0, (q, s) -> CASE WHEN q + s < {len(bounds) - 1} AND get({cuts}, q + s) <= id THEN q + s ELSE q END)"
    q = F.expr(seek)
    low, high = F.get(F.expr(cuts), q), F.get(F.expr(cuts), q + 1)
    within = (F.col("id") - low).cast("double") / (high - low)
    by_id = cells + F.floor((q + F.least(F.greatest(within, F.lit(0.0)), F.lit(1 - 1e-9))) * (cells / (len(bounds) - 1)))
    # six bytes of the text, the shorter ones filled up
    start = F.conv(F.rpad(F.hex(F.substring(F.encode("text", "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("long")
    by_text = F.floor(start * (cells / 2.0**48))
    return F.when(F.col("id") == NO_ID, by_text).otherwise(F.least(by_id, F.lit(2 * cells - 1))).cast("long")


def _lenders(firsts: DataFrame) -> DataFrame:
    """Rows of cells with ``lender``: the cell before, of those there are; of the first one, the last. In blocks, so that no task holds all cells."""
    block = F.floor(F.col("range") / BLOCK).alias("block")
    firsts = firsts.select("*", block)
    before = F.lag("range").over(Window.partitionBy("block").orderBy("range"))
    ends = firsts.groupBy("block").agg(F.max("range").alias("end"))
    ends = ends.select("block", F.lag("end").over(Window.orderBy("block")).alias("earlier"), F.max("end").over(Window.partitionBy()).alias("last"))
    return firsts.withColumn("before", before).join(ends, "block").withColumn("lender", F.coalesce("before", "earlier", "last")).drop("block", "before", "earlier", "last")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows by cells of ids, in order; each cell ends with a borrowed copy of the row that follows.

    Text moves once. The last cell borrows the first row of all. A task has the cells that a hash gives it, some of everywhere.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        whole_text().alias("text"),
    )
    length = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, -(-length // RANGE_CHARACTERS))
    rows = rows.withColumn("range", _ranks(rows, ranges * CELLS)).withColumn("seal", F.xxhash64("text"))
    first = F.min_by(F.struct("id", "seal"), F.struct("id", "text")).alias("first")
    firsts = stored(rows.groupBy("range").agg(first).select("range", "first.*"), "firsts")
    firsts = small(stored(_lenders(firsts).select("id", "seal", "lender"), "lenders"))
    rows = rows.join(firsts, ["id", "seal"], "left")
    both = F.array(
        F.struct(F.col("range").alias("range"), F.lit(False).alias("borrowed")),
        F.struct(F.col("lender").alias("range"), F.lit(True).alias("borrowed")),
    )
    rows = rows.select("id", "text", F.explode(F.filter(both, lambda x: x["range"].isNotNull())).alias("at"))
    rows = rows.select("id", "text", "at.range", "at.borrowed").repartition(int(ranges), "range")
    return rows.sortWithinPartitions("range", "borrowed", "id", "text")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike they and the next document's are."""

    def work(rows: list[tuple[int, str, str]]) -> pd.DataFrame:
        """Rows of id, text and the following text."""
        edited = [edit(text, after) for _, text, after in rows]
        own = fingerprints([r[1] for r in rows] + [rows[-1][2]])
        changed = fingerprints(edited)
        follows = own[1:].copy()
        for i, (_, _, after) in enumerate(rows[:-1]):  # at the end of a range the following row is a borrowed one
            if after is not rows[i + 1][1]:
                follows[i] = fingerprints([after])[0]
        own = own[:-1]
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if r[0] == NO_ID else r[0] for r in rows], "Int64"),
                "n_chars": [len(r[1]) for r in rows],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                "fingerprint": [x.tobytes().hex() for x in own],
                "edited_fingerprint": [x.tobytes().hex() for x in changed],
                "near_edited": likeness(own, changed),
                "near_next": likeness(own, follows),
            }
        )

    def run(frames):
        held, pending, size = [], None, 0
        for frame in frames:
            for doc, text, place, borrowed in zip(frame["id"], frame["text"], frame["range"], frame["borrowed"]):
                if pending and pending[2] == place:
                    if pending[3] is False:
                        held.append((pending[0], pending[1], text))
                        size += len(text)
                pending = (doc, text, place, bool(borrowed))
                if size > 1_000_000 or len(held) >= 2000:
                    yield work(held)
                    held, size = [], 0
        if held:
            yield work(held)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInPandas(run, schema)
