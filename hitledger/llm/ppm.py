"""Prediction by partial matching over bytes, trained on part of a corpus, beside a word unigram model.

The model is the trie of all contexts of up to ``ORDER`` bytes with the counts of the bytes that follow.
A byte is coded in the longest context the trie knows; a context that has not seen it spends an
escape (half a count for each distinct follower, taken off that follower) and passes to the next shorter one, in
which followers of the longer context are excluded; below order 0 all remaining bytes are alike. In a fixed trie
each follower of a context also follows its shorter one, so an exclusion is a sum per context, and
the code length of a byte is a function of its ``ORDER + 1``-gram. Texts end with a symbol of their own and
start in an empty context.

The trie is never gathered: batches of documents ask for their distinct grams; those are merged by context, the code
lengths are worked out per block of two-byte contexts, and the answers return to the batches. Only orders 0 and 1,
at most 256 x 256 counts, are known to all. Words are asked for in the same way.

Null and empty texts consist of their end. Without training documents every byte has one part in 255 and all words are
unknown. Rows that repeat an id count and are scored each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from hitledger.llm.batches import batch_of, batches_for, merged, pack, pack_sorted, unpack, unpack_sorted
from hitledger.llm.common import whole_text
from hitledger.llm.hashing import in_chunks, mix, words

ORDER = 5
END, START = 0xFE, 0xFF  # neither occurs in UTF-8
SYMBOLS = 255
#: Stands for the end of a text among word hashes.
END_WORD = np.uint64(0x5851F42D4C957F2D)
#: Stands for a null id.
NO_ID = -(2**63)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and its end: the context and the byte as one number; how many per text."""
    found = [_grams(part) for part in in_chunks(texts)] or [_grams([])]
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    bodies = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"".join(bytes([START]) * ORDER + b + bytes([END]) for b in bodies), np.uint8)
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    n = len(data) - ORDER
    keys = np.zeros(max(0, n), np.uint64)
    for i in range(ORDER + 1):
        keys = keys << np.uint64(8) | data[i : i + n]
    inside = np.ones(max(0, n), bool)
    for gap in range(ORDER):  # a gram that begins in one text and ends in the next
        ends = np.cumsum(sizes + ORDER)[:-1] - ORDER + gap
        inside[ends] = False
    return keys[inside], sizes


def pair_counts(keys: np.ndarray) -> np.ndarray:
    return np.bincount((keys & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)


def code_lengths(keys: np.ndarray, totals: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last byte. ``keys``: all asked or trained grams of some two-byte
    contexts, sorted and distinct; ``totals``: how often trained; ``pairs``: trained counts of orders 0 and 1."""
    first = pairs.reshape(256, 256)
    zero = first.sum(axis=0)
    context, byte = (keys >> np.uint64(8) & np.uint64(255)).astype(int), (keys & np.uint64(255)).astype(int)
    every = np.ones(len(keys), np.int64)
    #: per order and key: count of the byte, sum and number of followers, what a longer context excludes below it
    count = [zero[byte], first[context, byte]]
    total = [every * zero.sum(), first.sum(axis=1)[context]]
    kinds = [every * (zero > 0).sum(), (first > 0).sum(axis=1)[context]]
    below = [every * 0, ((first > 0) * zero).sum(axis=1)[context]]
    for order in range(2, ORDER + 1):
        nodes, where, place = np.unique(keys & np.uint64((1 << 8 * (order + 1)) - 1), return_index=True, return_inverse=True)
        seen = np.bincount(place, totals, len(nodes)).astype(np.int64)
        contexts, of = np.unique(nodes >> np.uint64(8), return_inverse=True)
        n = len(contexts)
        mine = of[place]
        total.append(np.bincount(of, seen, n).astype(np.int64)[mine])
        kinds.append(np.bincount(of, seen > 0, n).astype(np.int64)[mine])
        below.append(np.bincount(of, np.where(seen > 0, count[-1][where], 0), n).astype(np.int64)[mine])
        count.append(seen[place])
    out = np.zeros(len(keys))
    open_ = np.ones(len(keys), bool)
    escaped = np.zeros(len(keys), bool)  # from a known longer context
    for order in range(ORDER, -1, -1):
        parts, followers = total[order], kinds[order]
        known = parts > 0
        if order < ORDER:
            parts = parts - np.where(escaped, below[order + 1], 0)
            followers = followers - np.where(escaped, kinds[order + 1], 0)
        hit = open_ & (count[order] > 0)
        out[hit] += np.log10((count[order][hit] - 0.5) / parts[hit])
        open_ &= ~hit
        miss = open_ & known & (parts > 0)
        out[miss] += np.log10(0.5 * followers[miss] / parts[miss])
        escaped = known
    out[open_] -= np.log10(SYMBOLS - kinds[0][open_])
    return out


def _subs(keys: np.ndarray, shift: int, n: int) -> np.ndarray:
    return (mix(keys >> np.uint64(shift)) % np.uint64(n)).astype(np.int64)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return first


def _counted(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how often each occurs in ``trained`` rows. Two plain sorts are quicker than one with places."""
    every = np.sort(keys)
    every = every[_runs(every)]
    known = np.sort(keys[trained])
    starts = np.flatnonzero(_runs(known))
    counts = np.zeros(len(every), np.uint32)
    counts[np.searchsorted(every, known[starts])] = np.diff(starts, append=len(known))
    return every, counts


#: Bits for the place of a key among those with the same upper bytes; the rest of the word holds the key's other five bytes.
PLACE_BITS = 24


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Places of the keys in their order. Keys of six bytes are dealt by the first and sorted as whole numbers together
    with their place, which takes a fraction of the time of a sort of places."""
    if not len(keys) or int(keys.max()) >> 48:
        return np.argsort(keys)
    upper = (keys >> np.uint64(40)).astype(np.uint8)
    dealt = np.argsort(upper, kind="stable")
    cuts = np.r_[0, np.cumsum(np.bincount(upper, minlength=256))]
    if np.diff(cuts).max() >> PLACE_BITS:
        return np.argsort(keys)
    bits = np.uint64(PLACE_BITS)
    both = keys[dealt] << bits  # the first byte falls out
    for a, b in zip(cuts, cuts[1:]):
        both[a:b] |= np.arange(b - a, dtype=np.uint64)
        both[a:b].sort()
        both[a:b] &= np.uint64((1 << PLACE_BITS) - 1)
        both[a:b] += np.uint64(a)
    return dealt[both.astype(np.int64)]


def _placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the place of each key among them."""
    order = _ordered(keys)
    ordered = keys[order]
    first = _runs(ordered)
    places = np.empty(len(keys), np.int32)
    places[order] = np.cumsum(first, dtype=np.int32) - 1
    return ordered[first], places


def _by_part(part: np.ndarray, parts: int) -> np.ndarray:
    """Places in the order of their parts; numbers of two bytes are sorted by counting."""
    return np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")


class _Batch:
    """Distinct grams and words of a batch, in the order in which they are asked: by part, then by key.

    To ask, with their counts in training texts; to finish, with the place of every occurrence among them.
    """

    def __init__(self, frame: pd.DataFrame, parts: int, to_ask: bool):
        texts, train = list(frame["text"]), frame["train"].to_numpy(bool)
        grams_, self.gram_sizes = grams(texts)
        words_, self.word_sizes = words(texts)
        words_ = np.concatenate([words_, np.full(len(texts), END_WORD)])
        if to_ask:
            self.gram_keys, self.gram_counts = _counted(grams_, np.repeat(train, self.gram_sizes))
            self.word_keys, self.word_counts = _counted(words_, np.concatenate([np.repeat(train, self.word_sizes), train]))
        else:
            self.gram_keys, self.gram_at = _placed(grams_)
            self.word_keys, self.word_at = _placed(words_)
        self.gram_part, self.word_part = _subs(self.gram_keys, 8, parts), _subs(self.word_keys, 0, parts)
        self.gram_order = _by_part(self.gram_part, parts)
        self.word_order = _by_part(self.word_part, parts)


def _ask(parts: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        held = _Batch(frame, parts, to_ask=True)
        of_grams = np.searchsorted(held.gram_part[held.gram_order], np.arange(parts + 1))
        of_words = np.searchsorted(held.word_part[held.word_order], np.arange(parts + 1))
        rows = []
        for part in range(parts):
            g = held.gram_order[of_grams[part] : of_grams[part + 1]]
            w = held.word_order[of_words[part] : of_words[part + 1]]
            rows.append((
                part, int(frame["batch"].iloc[0]), pack_sorted(held.gram_keys[g]), pack(held.gram_counts[g]),
                pack_sorted(held.word_keys[w]), pack(held.word_counts[w]),
            ))
        return pd.DataFrame(rows, columns=["part", "batch", "grams", "gram_counts", "words", "word_counts"])

    return run


def _merged(frame: pd.DataFrame, what: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    return merged([unpack_sorted(x) for x in frame[f"{what}s"]], [unpack(x, "<u4") for x in frame[f"{what}_counts"]])


def _in_blocks(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by block of their last two context bytes, and where each block begins."""
    of = _subs(keys & np.uint64(0xFFFFFF), 8, blocks)
    order = _by_part(of, blocks)
    return order, np.searchsorted(of[order], np.arange(blocks + 1))


def _merge(blocks: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys, totals, _ = _merged(frame, "gram")
        order, cuts = _in_blocks(keys, blocks)
        rows = []
        for block, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                at = order[a:b]
                rows.append((block, int(frame["part"].iloc[0]), pack_sorted(keys[at]), pack(totals[at])))
        return pd.DataFrame(rows, columns=["block", "part", "grams", "gram_counts"])

    return run


def _code(pairs: np.ndarray):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in frame["grams"]]
        distinct, totals, places = merged(keys, [unpack(x, "<i8") for x in frame["gram_counts"]])
        lengths = code_lengths(distinct, totals, pairs).astype(np.float32)
        return pd.DataFrame({"part": frame["part"], "block": frame["block"], "lengths": [pack(lengths[p]) for p in places]})

    return run


def _answer(blocks: int):
    def run(_, asked: pd.DataFrame, coded: pd.DataFrame) -> pd.DataFrame:
        keys, _, places = _merged(asked, "gram")
        order, _ = _in_blocks(keys, blocks)
        lengths = np.zeros(len(keys), np.float32)
        if len(coded):
            lengths[order] = np.concatenate([unpack(x, "<f4") for x in coded.sort_values("block")["lengths"]])
        _, totals, word_places = _merged(asked, "word")
        return pd.DataFrame(
            {
                "batch": asked["batch"],
                "part": asked["part"],
                "lengths": [pack(lengths[p]) for p in places],
                "totals": [pack(totals[p]) for p in word_places],
                "known": int((totals > 0).sum()),
                "tokens": int(totals.sum()),
            }
        )

    return run


def _finish(parts: int):
    def run(_, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        held = _Batch(frame, parts, to_ask=False)
        answers = answers.sort_values("part")
        lengths, totals = np.zeros(len(held.gram_keys)), np.zeros(len(held.word_keys), np.int64)
        lengths[held.gram_order] = np.concatenate([unpack(x, "<f4") for x in answers["lengths"]])
        totals[held.word_order] = np.concatenate([unpack(x, "<i8") for x in answers["totals"]])
        corpus, known = int(answers["tokens"].sum()), int(answers["known"].sum())
        logs = np.log10(totals + 0.5)
        whole = np.log10(corpus + 0.5 * (known + 1))
        n = len(frame)
        of_grams, of_words = np.repeat(np.arange(n), held.gram_sizes), np.r_[np.repeat(np.arange(n), held.word_sizes), np.arange(n)]
        score = np.bincount(of_grams, lengths[held.gram_at], minlength=n)
        found = np.bincount(of_words[totals[held.word_at] > 0], minlength=n)
        tokens = held.word_sizes + 1
        base = np.bincount(of_words, logs[held.word_at], minlength=n) - tokens * whole
        return pd.DataFrame(
            {
                "id": frame["id"].to_numpy(), "held_out": ~frame["train"].to_numpy(bool), "n_tokens": tokens, "n_known": found,
                "train_tokens": corpus, "base_score": base, "score": score,
            }
        )

    return run


def _count_pairs(frames):
    total = np.zeros(1 << 16, np.int64)
    for frame in frames:
        for start in range(0, len(frame), 200):
            total += pair_counts(grams(list(frame["text"].iloc[start : start + 200]))[0])
    found = np.flatnonzero(total)
    yield pd.DataFrame({"pair": found.astype(np.int32), "n": total[found]})


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document, trained on those that are not held out: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score`` (word unigrams) and ``score`` (log10 of the text's probability)."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), whole_text().alias("text"), (~held_out).alias("train")
    )
    batches = batches_for(rows)
    parts = blocks = max(1, batches // 2)
    counted = rows.filter("train").select("text").mapInPandas(_count_pairs, "pair int, n long")
    pairs = np.zeros(1 << 16, np.int64)
    for row in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 65,536 rows at most
        pairs[row.pair] = row.n
    dealt = rows.withColumn("batch", batch_of(F.struct("id", "text"), batches)).groupBy("batch")
    asked = dealt.applyInPandas(
        _ask(parts), "part int, batch int, grams binary, gram_counts binary, words binary, word_counts binary"
    ).groupBy("part")
    merged_ = asked.applyInPandas(_merge(blocks), "block int, part int, grams binary, gram_counts binary")
    coded = merged_.groupBy("block").applyInPandas(_code(pairs), "part int, block int, lengths binary")
    answers = asked.cogroup(coded.groupBy("part")).applyInPandas(
        _answer(blocks), "batch int, part int, lengths binary, totals binary, known long, tokens long"
    )
    scored = dealt.cogroup(answers.groupBy("batch")).applyInPandas(
        _finish(parts),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.select(F.expr(f"nullif(id, cast('{NO_ID}' as bigint))").alias("doc_id"), *scored.columns[1:])
