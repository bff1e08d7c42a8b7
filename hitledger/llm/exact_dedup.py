"""Exact duplicates by counting quotient filters, then byte verification.

Every partition builds counting quotient filters of its 64-bit fingerprints, one for each class of them by remainder of a division. A filter is a
table of slots: the high bits of a fingerprint (quotient) say where it belongs, the low bits (remainder) are what a slot stores, with a count. Remainders
of one quotient stand together in order (a run), shifted to the right where slots are taken; three bits per slot tell which quotients occur, which
slots continue a run and which are shifted. Quotients are not stored: they follow from the positions. So nothing is lost, and filters
merge by sorted remainders, counts added up. Only rows whose fingerprint counts more than one are compared by their bytes.

Null and empty texts are equal. Of equal texts the largest id stays; a null id is
smaller than any. Of wholly repeated rows exactly one is ``kept``. An empty table gives no rows. Texts of any length are
fingerprinted where they lie; they move only where a fingerprint repeats. Other columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from hitledger.llm.common import small, stored, whole_text

#: Fingerprints of one class, about.
CLASS_ENTRIES = 1 << 14
#: Slots of a filter for each entry, at least.
SLOTS_PER_ENTRY = 4 / 3

#: Number of quotient bits; occupied, continuation and shifted bits; remainders and counts of the slots in use.
Filter = tuple[int, bytes, bytes, bytes, bytes, bytes]


def build_filter(values: np.ndarray, counts: np.ndarray) -> Filter:
    """A filter of sorted, distinct 64-bit values with their counts."""
    n = len(values)
    bits = max(1, int(np.ceil(np.log2(max(2, n * SLOTS_PER_ENTRY)))))
    low = np.uint64(64 - bits)
    quotients = (values >> low).astype(np.int64)
    steps = np.arange(n)
    slots = np.maximum.accumulate(quotients - steps) + steps  # the next free slot from the quotient's own on
    size = max(1 << bits, int(slots[-1]) + 1) if n else 1 << bits
    occupied, continued, shifted = (np.zeros(size, bool) for _ in range(3))
    occupied[quotients] = True
    continued[slots[1:]] = quotients[1:] == quotients[:-1]
    shifted[slots] = slots != quotients
    remainders = values & ((np.uint64(1) << low) - np.uint64(1))
    tables = (np.packbits(x).tobytes() for x in (occupied, continued, shifted))
    return bits, *tables, remainders.tobytes(), counts.astype(np.int64).tobytes()


def read_filter(found: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts of a filter, in order: quotients from the positions, remainders from the slots."""
    bits, *tables, remainders, counts = found
    occupied, continued, shifted = (np.unpackbits(np.frombuffer(t, np.uint8)).astype(bool) for t in tables)
    used = occupied | continued | shifted  # any bit; a slot whose quotient occurs is in use, by itself or by a shifted one
    run = np.cumsum(~continued[used]) - 1
    quotients = np.flatnonzero(occupied)[run].astype(np.uint64)
    return quotients << np.uint64(64 - bits) | np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.int64)


def merge_filters(parts: list[Filter]) -> Filter:
    """One filter of the same fingerprints: runs merged by sorted remainder, counts added."""
    values, counts = (np.concatenate(x) for x in zip(*map(read_filter, parts)))
    return build_filter(*_added(values, counts))


def _added(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return values, counts
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[first], np.add.reduceat(counts, first)


_COLUMNS = ["bits", "occupied", "continued", "shifted", "remainders", "counts"]


def _filters(classes: int):
    def run(frames):
        values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for frame in frames:
            found, n = np.unique(frame["fp"].to_numpy(np.int64).view(np.uint64), return_counts=True)
            values.append(found)
            counts.append(n.astype(np.int64))
            if len(values) > 16:
                values, counts = ([x] for x in _added(np.concatenate(values), np.concatenate(counts)))
        values, counts = _added(np.concatenate(values), np.concatenate(counts))
        # by what is left of a division, so that the quotients of a class are spread over its filter
        of = (values % np.uint64(classes)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        values, counts, of = values[order], counts[order], of[order]
        cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else []
        rows = [(int(of[a]), *build_filter(values[a:b], counts[a:b])) for a, b in zip(cuts, cuts[1:])]
        yield pd.DataFrame(rows, columns=["class", *_COLUMNS])

    return run


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    values, counts = read_filter(merge_filters(list(frame[_COLUMNS].itertuples(index=False, name=None))))
    return pd.DataFrame({"fp": values[counts > 1].view(np.int64)})


def repeated_fingerprints(rows: DataFrame) -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once. The number of classes follows that of the rows."""
    classes = max(64, -(-rows.count() // CLASS_ENTRIES))
    schema = "class long, bits int, occupied binary, continued binary, shifted binary, remainders binary, counts binary"
    filters = rows.select("fp").mapInPandas(_filters(classes), schema)
    return filters.groupBy("class").applyInPandas(_repeated, "fp long")


def mark_copies(docs: DataFrame, fingerprint=F.xxhash64) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``keep_id``, ``group_size``, ``kept``.

    ``fingerprint`` makes a long from the text column; a weak one only makes more rows be
    compared by their bytes.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), whole_text().alias("body"))
    rows = rows.withColumn("fp", fingerprint("body").cast("long"))
    repeated = small(stored(repeated_fingerprints(rows), "repeated"))
    suspects = rows.select("id", "fp", "body").join(repeated, "fp")
    classes = suspects.groupBy("fp", "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    #: texts are kept only where several share a fingerprint
    alone = F.col("n") == 1
    shared = classes.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    classes = classes.join(shared, "fp").select(
        "fp", F.when(~alone, F.col("body")).alias("witness"), "keep_id", "group_size"
    )
    classes = small(stored(classes, "classes"))
    same = (F.col("a.fp") == F.col("c.fp")) & F.coalesce(F.col("c.witness") == F.col("a.body"), F.lit(True))
    joined = rows.alias("a").join(classes.alias("c"), same, "left")
    lone = joined.filter("group_size is null or group_size = 1").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    in_turn = Window.partitionBy("a.fp", "id", "a.body").orderBy("id")
    copies = (
        rows.alias("a").join(classes.filter("group_size > 1").alias("c"), same)
        .withColumn("turn", F.row_number().over(in_turn))
        .select("row", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"))
    )
    return lone.unionByName(copies)


def exact_copies(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return mark_copies(docs.select("doc_id", "text")).select(
        "row.doc_id", "keep_id", "group_size", "kept", F.sha2(whole_text("row.text"), 256).alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each distinct text, all columns as they were."""
    return mark_copies(docs).filter("kept").select("row.*")
