"""Maximal repeats of byte strings across a corpus, and their removal.

Every window of ``LENGTH`` bytes has an anchor: the smallest of the hashed ``GRAM``-byte strings in it
(the first of equals). Equal windows have equal anchors at equal places, so only windows whose anchor occurs
twice can repeat, and each needs to be compared only with windows of the same anchor.
Anchors are one in about ``LENGTH / 2`` bytes: they are all that is shuffled for the whole corpus.

For each occurrence of a shared anchor the stretch of text that its windows cover is cut out. Equal
stretches of one anchor become one with all its occurrences. An enhanced suffix array (suffixes sorted, common prefix
of neighbours) over the different stretches is scanned with a stack; the intervals of common prefix at least
``LENGTH`` long whose suffixes have different bytes on their left are the maximal repeats, reported with
all their occurrences. Every byte of an occurrence goes.

An anchor with more than ``MOST_STRETCHES`` different stretches is not put into one array. Its windows are split by where in
the window the anchor stands: in a range of places they all share a core, so the stretches are dealt
anew by (anchor, range, core), which parts those that merely have a short passage in common. A range of one place
has the whole window as its core, so splitting ends.

Matches never cross documents; a document counts with itself, and overlapping occurrences count. Null and empty
texts have no bytes. Rows that repeat are documents of their own. A row needs an id for its spans to be
found again: rows with a null id are told apart from others by their text. An empty table gives no rows. A text is held whole in
one task, with about three bytes for each of its own in anchors and stretches; text of one byte over and over costs up to 400 a byte.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hitledger.llm.common import BROADCAST_ROWS, freed_shuffles, stored, whole_text
from hitledger.llm.hashing import in_chunks, mix

LENGTH = 400
GRAM = 24
MOST_STRETCHES = 256
#: Parts into which a range of places is split.
FAN = 8
_BASE = np.uint64(0xD6E8FEB86659FD93)


# --- anchors ------------------------------------------------------------------

def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on, by doubling."""
    out, have = mix(data.astype(np.uint64) + np.uint64(1)), 1
    done: tuple[np.ndarray, int] | None = None  # the part made up of the higher powers of two so far
    rest = width
    while rest:
        if rest & 1:
            if done is None:
                done = out, have
            else:
                n = len(data) - have - done[1] + 1
                done = mix(out[:n] * _BASE + done[0][have : have + n]), have + done[1]
        rest >>= 1
        if rest:
            n = len(out) - have
            out, have = mix(out[:n] * _BASE + out[have : have + n]), have * 2
    return done[0]


def window_anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of window starts with one anchor: their first start and the anchor's place.

    A window is ``width`` hashes; its anchor is the first of the smallest.
    """
    n = len(hashes) - width + 1
    # sliding minimum: smallest of the end of one block and the beginning of the next
    blocks = -(-len(hashes) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max)
    padded[: len(hashes)] = hashes
    square = padded.reshape(blocks, width)
    head = np.minimum.accumulate(square, axis=1).reshape(-1)
    tail = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(tail[:n], head[width - 1 : width - 1 + n])
    runs = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]).tolist()
    firsts, places = [], []
    for a, b in zip(runs, [*runs[1:], n]):
        place = a + int(hashes[a : b + width - 1].argmin())
        firsts.append(a)
        places.append(place)
        if place < b - 1:  # windows that begin beyond it have the next one with that hash
            same = a + np.flatnonzero(hashes[a : b + width - 1] == least[a])
            for before, place in zip(same.tolist(), same[1:].tolist()):
                if before < b - 1:
                    firsts.append(before + 1)
                    places.append(place)
    return np.array(firsts), np.array(places)


def anchor_runs(bodies: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """Anchors of texts: number of the text, hash, place, first and last start of the windows that have it."""
    out = []
    hashes = gram_hashes(np.frombuffer(b"".join(bodies) + bytes(GRAM), np.uint8), GRAM)
    start = 0
    for i, body in enumerate(bodies):
        if len(body) >= LENGTH:
            mine = hashes[start : start + len(body) - GRAM + 1]
            firsts, places = window_anchors(mine, LENGTH - GRAM + 1)
            lasts = np.r_[firsts[1:] - 1, len(body) - LENGTH]
            out += zip([i] * len(firsts), mine[places].view(np.int64).tolist(), places.tolist(), firsts.tolist(), lasts.tolist())
        start += len(body)
    return out


# --- enhanced suffix array ------------------------------------------------------

def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of at least ``depth`` bytes from there on: eight bytes at once, then prefix doubling."""
    padded = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + len(data)]
    have = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        steps = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if have >= depth or steps[-1] == len(data) - 1:
            return order
        rank = np.empty(len(data), np.uint64)
        rank[order] = steps + 1
        after = np.zeros(len(data), np.uint64)
        after[:-have] = rank[have:]
        key = rank << np.uint64(32) | after
        have *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, within the room of both."""
    a, b = order[:-1], order[1:]
    most = np.minimum(room[a], room[b])
    out = np.zeros(len(order), np.int64)
    shared = out[1:]
    open_ = np.arange(len(a))
    step = np.arange(16)
    padded = np.r_[data, np.zeros(16, np.uint8)]
    while len(open_):
        same = padded[(a[open_] + shared[open_])[:, None] + step] == padded[(b[open_] + shared[open_])[:, None] + step]
        whole = same.all(axis=1)
        shared[open_] += np.where(whole, 16, np.argmin(same, axis=1))
        open_ = open_[whole & (shared[open_] < most[open_])]
    np.minimum(shared, most, out=shared)
    return out


def maximal_repeats(left: np.ndarray, prefix: np.ndarray, least: int):
    """Stack scan over the common-prefix intervals: (length, low, high) in suffix order for each interval of at least
    ``least`` whose suffixes follow different bytes. ``left``: the byte before each suffix, -1 at the begin of a stretch."""
    deep = prefix >= least
    stack: list[list[int]] = []  # length, low, the byte before all suffixes so far, or -1 if they differ
    n = len(prefix)
    #: a suffix matters only if it shares enough with a neighbour
    for i in np.flatnonzero(deep | np.r_[deep[1:], False]) + 1:
        i = int(i)
        depth = int(prefix[i]) if i < n else 0
        low, carry = i - 1, int(left[i - 1])
        while stack and stack[-1][0] > depth:
            length, low, seen = stack.pop()
            carry = seen if seen == carry else -1
            if carry == -1:
                yield length, low, i - 1
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == carry else -1
            else:
                stack.append([depth, low, carry])


def repeat_groups(stretches: list[bytes], least: int = LENGTH):
    """Maximal repeats of ``least`` bytes or more among the stretches: (length, stretches, offsets) with all occurrences."""
    sizes = np.array([len(s) for s in stretches], np.int64)
    data = np.frombuffer(b"".join(s + b"\xff" for s in stretches), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    room = ends[owner] - np.arange(len(data))
    order = suffix_order(data, int(sizes.max(initial=0)) + 1)
    order = order[room[order] >= least]
    if len(order) < 2:
        return
    left = np.where(order == starts[owner[order]], -1, data[order - 1].astype(np.int64))
    for length, low, high in maximal_repeats(left, common_prefixes(data, order, room), least):
        at = order[low : high + 1]
        yield length, owner[at], at - starts[owner[at]]


def with_repeats(stretches: list[bytes], least: int = LENGTH) -> np.ndarray:
    """Places in the list of stretches that hold a window which occurs twice; the others need no suffix array."""
    sizes = np.array([len(s) for s in stretches], np.int64)
    data = np.frombuffer(b"".join(s + b"\xff" for s in stretches), np.uint8)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    room = np.cumsum(sizes + 1)[owner] - 1 - np.arange(len(data))
    if len(data) < least:
        return np.zeros(0, np.int64)
    hashes = gram_hashes(data, least)
    begins = np.flatnonzero(room[: len(hashes)] >= least)
    _, place, n = np.unique(hashes[begins], return_inverse=True, return_counts=True)
    return np.unique(owner[begins[n[place] > 1]])


# --- jobs -------------------------------------------------------------------------

#: Bytes of stretches in one suffix array, more only where one anchor has more.
PILE = 1_500_000


def _anchors(frames):
    for frame in frames:
        done = 0
        for texts in in_chunks(list(frame["text"])):
            part = frame.iloc[done : done + len(texts)]
            done += len(texts)
            rows = anchor_runs([t.encode("utf-8", "replace") for t in texts])
            out = pd.DataFrame(rows, columns=["row", "key", "place", "first", "last"])
            of = out.pop("row").to_numpy(np.int64)
            yield out.assign(id=part["id"].to_numpy()[of], seal=part["seal"].to_numpy()[of])


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _stretches(frames):
    """The text around each shared anchor that its windows cover."""
    columns = ["id", "seal", "key", "stretch", "at", "place", "body"]
    for frame in frames:
        rows, size = [], 0
        for doc, seal, body, runs in zip(frame["id"], frame["seal"], frame["body"], frame["runs"]):
            for run in runs:
                stretch = body[run["first"] : run["last"] + LENGTH]
                rows.append((doc, seal, run["key"], _hash(stretch), run["first"], run["place"] - run["first"], stretch))
                size += len(stretch)
            if size > PILE:
                yield pd.DataFrame(rows, columns=columns)
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns)


def _merge_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted rows of (start, end) without overlap or touch."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.column_stack([spans[first, 0], np.r_[reach[first[1:] - 1], reach[-1]]])


def _repeated_spans(keys: list[int], ids: list[int], bodies: list[bytes]) -> pd.DataFrame:
    spans: dict[int, list[tuple[int, int]]] = {}
    kinds = Counter(keys)
    several = np.array([i for i, key in enumerate(keys) if kinds[key] > 1], np.int64)
    held = several[with_repeats([bodies[i] for i in several])]
    for length, owners, offsets in repeat_groups([bodies[i] for i in held]):
        for owner, offset in zip(held[owners].tolist(), offsets.tolist()):
            spans.setdefault(owner, []).append((offset, offset + length))
    rows = [(keys[i], ids[i], _merge_spans(np.array(s)).reshape(-1).tolist()) for i, s in spans.items()]
    return pd.DataFrame(rows, columns=["key", "stretch", "spans"])


def _arrays(frames):
    """Suffix arrays over piles of stretches; all of one anchor are in the same pile."""
    keys, ids, bodies, size = [], [], [], 0
    for frame in frames:
        for key, stretch, body in zip(frame["key"], frame["stretch"], frame["body"]):
            if size > PILE and key != keys[-1]:
                yield _repeated_spans(keys, ids, bodies)
                keys, ids, bodies, size = [], [], [], 0
            keys.append(key)
            ids.append(stretch)
            bodies.append(body)
            size += len(body)
    if keys:
        yield _repeated_spans(keys, ids, bodies)


def _split(frames):
    """Each stretch by ranges of the anchor's place in the window, with the core that all windows of a range share as key."""
    for frame in frames:
        rows = []
        for key, stretch, body, place, low, high in zip(*(frame[c] for c in ("key", "stretch", "body", "place", "low", "high"))):
            width = -(-(high - low) // FAN)
            for a in range(low, high, width):
                b = min(a + width, high)  # places a .. b - 1
                first, last = max(0, place - b + 1), min(len(body) - LENGTH, place - a)
                if first <= last:
                    core = body[place - a : place - b + 1 + LENGTH]
                    part = body[first : last + LENGTH]
                    rows.append((key, stretch, first, _hash(b"%d,%d," % (key, a) + core), _hash(part), place - first, a, b, part))
        yield pd.DataFrame(rows, columns=["over_key", "over", "at", "key", "stretch", "place", "low", "high", "body"])


def _pieces(rows: DataFrame) -> DataFrame:
    """Different stretches per anchor, with the number of their occurrences; anchors that occur once are left out."""
    pieces = rows.groupBy("key", "stretch").agg(
        F.first("place").alias("place"), F.first("low").alias("low"), F.first("high").alias("high"),
        F.first("body").alias("body"), F.sum("n").alias("n"),
    )
    return stored(pieces, "stretches")


def repeated(pieces: DataFrame) -> DataFrame:
    """``key``, ``stretch`` and the ``spans`` of each stretch that lie in repeats: start, end, start, end, ..."""
    groups = stored(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")), "kinds")
    whole = pieces.filter("n > 1").select("key", "stretch", F.array(F.lit(0), F.octet_length("body")).alias("spans"))
    many = groups.filter(f"kinds > {MOST_STRETCHES}").select("key")
    n_many = many.count()
    # at most one key in MOST_STRETCHES rows; a join by key would move all the stretches a second time
    many = F.broadcast(many) if n_many <= BROADCAST_ROWS else many
    few = pieces.join(many, "key", "left_anti") if n_many else pieces
    piles = few.select("key", "stretch", "body").repartition("key").sortWithinPartitions("key", "stretch")
    found = whole.unionByName(piles.mapInPandas(_arrays, "key long, stretch long, spans array<int>"))
    if n_many:
        parts = pieces.join(many, "key").filter("high - low > 1").mapInPandas(
            _split, "over_key long, over long, at int, key long, stretch long, place int, low int, high int, body binary"
        )
        parts = stored(parts, "split")
        links = parts.select("over_key", "over", "at", "key", "stretch")
        inner = repeated(_pieces(parts.withColumn("n", F.lit(1).cast("long"))))
        shifted = F.transform("spans", lambda x: (x + F.col("at")).cast("int"))
        back = links.join(inner, ["key", "stretch"]).select(F.col("over_key").alias("key"), F.col("over").alias("stretch"), shifted.alias("spans"))
        found = found.unionByName(back)
    return found


def _cut(body: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """What remains of each text without its spans."""
    rows = []
    for data, found in zip(body, spans):
        merged = _merge_spans(np.array([] if found is None else found, np.int64).reshape(-1, 2))
        kept, done = hashlib.sha256(), 0
        for start, end in merged.tolist():
            kept.update(data[done:start])
            done = end
        kept.update(data[done:])
        rows.append((int((merged[:, 1] - merged[:, 0]).sum()), len(merged), kept.hexdigest()))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    with freed_shuffles(docs.sparkSession):
        return _removed(docs)


def _removed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    # any number can be an id, so that an id is null is part of the seal
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), whole_text().alias("text"))
    rows = rows.withColumn("seal", F.xxhash64("text", F.isnull("doc_id")))
    anchors = rows.filter(F.octet_length("text") >= LENGTH).mapInPandas(
        _anchors, "id long, seal long, key long, place int, first int, last int"
    )
    anchors = stored(anchors, "anchors")
    # written first, so that the join has two plain exchanges and a frequent anchor can be split
    shared = stored(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared")
    runs = anchors.join(shared, "key").groupBy("id", "seal").agg(F.collect_set(F.struct("key", "place", "first", "last")).alias("runs"))
    held = rows.join(runs, ["id", "seal"], "left")
    clean = F.col("runs").isNull()
    held = stored(
        held.select(
            "doc_id", "id", "seal", F.octet_length("text").cast("long").alias("n_bytes"), "runs",
            F.when(clean, F.sha2("text", 256)).alias("digest"), F.when(~clean, F.col("text").cast("binary")).alias("body"),
        ),
        "held",
    )
    touched = held.filter("runs is not null")
    found = touched.select("id", "seal", "body", "runs").mapInPandas(
        _stretches, "id long, seal long, key long, stretch long, at int, place int, body binary"
    )
    first = found.select(
        "key", "stretch", "place", F.lit(0).alias("low"), F.lit(LENGTH - GRAM + 1).alias("high"), "body", F.lit(1).cast("long").alias("n")
    )
    spans = stored(repeated(_pieces(first)), "spans")
    members = found.select("id", "seal", "key", "stretch", "at")
    shifted = F.transform("spans", lambda x: (x + F.col("at")).cast("int"))
    mine = members.join(spans, ["key", "stretch"]).select("id", "seal", shifted.alias("spans"))
    mine = mine.groupBy("id", "seal").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    cut = F.pandas_udf(_cut, "n_removed long, n_spans long, kept_sha256 string").asNondeterministic()
    dirty = touched.join(mine, ["id", "seal"], "left").select("doc_id", "n_bytes", cut("body", "spans").alias("cut"))
    zero = F.lit(0).cast("long")
    untouched = held.filter("runs is null").select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("digest").alias("kept_sha256")
    )
    return untouched.unionByName(dirty.select("doc_id", "n_bytes", "cut.*"))
