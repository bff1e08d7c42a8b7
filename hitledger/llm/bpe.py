"""Byte-pair encoding and decoding with a published vocabulary.

A word's adjacent pairs sit at the leaves of a segment tree that keeps the smallest
``(rank, position)`` at its root. The root is the leftmost merge of lowest rank; a
merge changes three leaves, each a logarithmic update. Words are independent: the different words
of some texts that are not known yet are merged together, one step of all their trees at a time, and a
task keeps the results, up to ``CACHE_WORDS`` of them; beyond that the half that came first, in which the frequent words are, stays. Very long
words have a tree each.

Nulls are empty; an empty text has no ids. A text of any length is encoded whole. Repeated rows and ids are encoded
alike, each for itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from hitledger.llm.common import bounded_batches, per_text

CACHE_WORDS = 400_000
#: The same where ids are kept as bytes, beside other stages in the same workers, and the characters encoded at a time.
BINARY_WORDS, BINARY_CHARACTERS = 150_000, 1_000_000
#: Bytes of the longest words that are merged together, and words in one step.
TOGETHER, AT_ONCE = 64, 8192
_NONE = 1 << 62
#: White space of the vocabulary's own pattern (Unicode property, fixed value).
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


#: How the known vocabulary splits words (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for texts of ASCII and Latin letters, in which nothing needs composing: about twice as fast.
_BEYOND_LATIN = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]")
_LETTERS = "a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \t-\r0-9{_LETTERS}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTree:
    """Smallest value over positions, with point updates."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(0, len(values) - 1).bit_length()
        self.node = [_NONE] * self.size + values + [_NONE] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            left, right = self.node[2 * i], self.node[2 * i + 1]
            self.node[i] = left if left <= right else right

    def root(self) -> int:
        return self.node[1]

    def put(self, *changes: tuple[int, int]) -> None:
        """Each change is a position and its new value."""
        node = self.node
        for place, value in changes:
            i = place + self.size
            node[i] = value
            i >>= 1
            while i:
                low, right = node[2 * i], node[2 * i + 1]
                if right < low:
                    low = right
                if node[i] == low:
                    break
                node[i] = low
                i >>= 1


#: Number of ids, the ids in decimal, the decoded tokens, the ids as bytes.
Entry = tuple[int, str, str, bytes]


class Vocabulary:
    """Vocabulary, merges and special tokens of a tokenizer file with word ends. It keeps up to ``room`` words; without
    ``decimals`` the ids in decimal are left empty."""

    def __init__(self, path: str, room: int | None = None, decimals: bool = True):
        self.room, self.decimals = room, decimals
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: token for token, i in self.ids.items()}
        #: per left id the rank of each right id; per rank the new id
        none: dict[int, int] = {}
        self.ranks: list[dict[int, int]] = [none] * (max(self.ids.values()) + 1)
        self.made = [self.ids[a + b] for a, b in model["merges"]]
        for rank, (a, b) in enumerate(model["merges"]):
            if self.ranks[self.ids[a]] is none:
                self.ranks[self.ids[a]] = {}
            self.ranks[self.ids[a]][self.ids[b]] = rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.names |= {i: token for token, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.names}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.plain = pattern == WORD_PATTERN
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        self.inner = [self.ids.get(x, -1) for x in letters]
        self.last = [self.ids.get(x + self.suffix, -1) for x in letters]
        self.width = "<u2" if max(self.names) < 1 << 16 else "<u4"
        self.cache: dict[str, Entry] = {}
        self.inner_ids, self.last_ids = np.array(self.inner), np.array(self.last)
        self.base = len(self.ranks)
        pairs = sorted((a * self.base + b, rank) for a, found in enumerate(self.ranks) for b, rank in found.items())
        self.pairs, self.pair_ranks = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        self.made_ids = np.array(self.made, np.int64)
        self.gaps = min(self.inner + self.last) < 0

    def symbols(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        out = [inner[b] for b in data[:-1]]
        out.append(self.last[data[-1]])
        return out if min(out) >= 0 else [x for x in out if x >= 0]

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids after all merges, each the leftmost one of lowest rank."""
        n, ranks, made = len(symbols), self.ranks, self.made
        if n < 2:
            return symbols
        #: rank and place in one number: comparing it compares rank first, then place
        values = []
        for i in range(n - 1):
            rank = ranks[symbols[i]].get(symbols[i + 1])
            values.append(_NONE if rank is None else rank * n + i)
        tree = PairTree(values)
        node = tree.node
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := node[1]) != _NONE:
            rank, i = divmod(low, n)
            j = after[i]
            new = symbols[i] = made[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            changes = [(j, _NONE)] if j < n - 1 else []
            here = _NONE
            if k < n:
                before[k] = i
                rank = ranks[new].get(symbols[k])
                if rank is not None:
                    here = rank * n + i
            changes.append((i, here))
            if (p := before[i]) >= 0:
                rank = ranks[symbols[p]].get(new)
                changes.append((p, _NONE if rank is None else rank * n + p))
            tree.put(*changes)
        return [x for x in symbols if x >= 0]

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of each pair in one number; ``_NONE`` where the two do not merge."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, key), max(0, len(self.pairs) - 1))
        found = (self.pairs[at] == key) & (left >= 0) & (right >= 0) if len(self.pairs) else np.zeros(len(key), bool)
        return np.where(found, self.pair_ranks[at] * TOGETHER + place if len(self.pairs) else 0, _NONE)

    def merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """:meth:`merge` for words of one size class: a word per row, -1 behind its end. The trees are rows of one array;
        what is merged away becomes -1."""
        n, columns = symbols.shape
        size = columns - 1  # leaves, a power of two; the last column stands behind every word
        tree = np.full((n, 2 * size), _NONE, np.int64)
        places = np.arange(size)
        tree[:, size:] = self.leaves(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.tile(places, n)).reshape(n, size)
        half = size
        while half > 1:
            np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2], out=tree[:, half // 2 : half])
            half //= 2
        # the symbol after and before each; ``columns`` is after the last, -1 before the first
        symbols = np.column_stack([symbols, np.full(n, -1, np.int64)])
        after = np.tile(np.arange(1, columns + 2), (n, 1))
        before = np.tile(np.arange(-1, columns), (n, 1))

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            at = leaf + size
            tree[rows, at] = value
            while at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        rows = np.arange(n)
        while len(rows):
            low = tree[rows, 1]
            rows, low = rows[low != _NONE], low[low != _NONE]
            if not len(rows):
                break
            i = low % TOGETHER
            new = self.made_ids[low // TOGETHER]
            j = after[rows, i]
            k = after[rows, j]
            symbols[rows, i], symbols[rows, j] = new, -1
            after[rows, i], before[rows, k] = k, i
            inner = j < size
            if inner.any():
                put(rows[inner], j[inner], _NONE)
            put(rows, i, self.leaves(new, symbols[rows, k], i))
            p = before[rows, i]
            left = p >= 0
            if left.any():
                r, p = rows[left], p[left]
                put(r, p, self.leaves(symbols[r, p], new[left], p))
        return symbols

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """The ids of many words."""
        out: list[list[int] | None] = [None] * len(words)
        bodies = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(b) for b in bodies], np.int64)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        symbols = self.inner_ids[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last_ids[data[ends - 1]]
        starts = ends - lengths
        known = np.minimum.reduceat(symbols, starts) >= 0
        together = known & (lengths <= TOGETHER)
        classes = np.maximum(0, np.ceil(np.log2(np.maximum(lengths - 1, 1)))).astype(np.int64)
        for kind in np.unique(classes[together]).tolist():
            of = np.flatnonzero(together & (classes == kind))
            for some in np.array_split(of, -(-len(of) // AT_ONCE)):
                table = np.full((len(some), (1 << kind) + 1), -1, np.int64)
                row = np.repeat(np.arange(len(some)), lengths[some])
                column = np.arange(len(row)) - np.repeat(np.cumsum(lengths[some]) - lengths[some], lengths[some])
                table[row, column] = symbols[starts[some][row] + column]
                merged = self.merge_rows(table)
                left = merged >= 0
                ids = merged[left].tolist()
                stops = np.cumsum(left.sum(axis=1)).tolist()
                for place, a, b in zip(some.tolist(), [0, *stops], stops):
                    out[place] = ids[a:b]
        return [self.merge(self.symbols(word)) if found is None else found for word, found in zip(words, out)]

    def entry(self, ids: list[int]) -> Entry:
        decimal = " ".join([self.decimal[i] for i in ids]) if self.decimals else ""
        return len(ids), decimal, " ".join([self.names[i] for i in ids]), np.array(ids, self.width).tobytes()

    def split(self, text: str) -> list[str]:
        """Words after normalisation: composed, lower case letter by letter, white space dropped."""
        if self.plain and not _BEYOND_LATIN.search(text):
            return _LATIN_WORDS.findall(text.lower())
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(_SPACE.sub(" ", text).lower())

    def pieces(self, text: str) -> list[str | Entry]:
        """Words, and the entries of special tokens, in order."""
        if "<" not in text:
            return self.split(text)
        out: list[str | Entry] = []
        for part in self.cuts.split(text):
            if part in self.special:
                out.append(self.entry([self.special[part]]))
            elif part:
                out += self.split(part)
        return out

    def encode_texts(self, texts: list[str]) -> list[list[Entry]]:
        """For each text one entry per word or special token, in order: number of ids, the ids in decimal, the decoded
        tokens (both joined by spaces), the ids as bytes."""
        rows = [self.pieces(text) for text in texts]
        words = set().union(*rows)
        marks = {x for x in words if isinstance(x, tuple)}
        words -= marks
        entries = self.cache
        new = [word for word in words if word not in entries]
        if new:
            entries.update(zip(new, map(self.entry, self.merge_words(new))))
        if marks:
            entries = entries | {mark: mark for mark in marks}
        out = [list(map(entries.__getitem__, row)) for row in rows]
        if self.gaps:  # bytes that the vocabulary lacks give words without ids
            out = [[e for e in row if e[0]] for row in out]
        room = CACHE_WORDS if self.room is None else self.room
        if len(self.cache) > room:
            self.cache = dict(islice(self.cache.items(), room // 2))
        return out

    def encode_ids(self, text: str) -> list[int]:
        return [int(i) for x in self.encode_texts([text])[0] for i in x[1].split()]

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by a space, as a tokenizer file without a decoder gives them."""
        return " ".join(self.names[i] for i in ids if i in self.names)


def _uncollected(work):
    """The same without the collector of cyclic garbage, of which this makes none; it took a third of the time."""

    def run(texts: list[str]) -> pd.DataFrame:
        gc.disable()
        try:
            return work(texts)
        finally:
            gc.enable()

    return run


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (decimal, by spaces), ``decoded``: one row per document, no shuffle."""

    def make():
        vocabulary = Vocabulary(path)

        def work(texts: list[str]) -> pd.DataFrame:
            rows = vocabulary.encode_texts(texts)
            return pd.DataFrame(
                {
                    "n_tokens": [sum([x[0] for x in row]) for row in rows],
                    "ids": [" ".join([x[1] for x in row]) for row in rows],
                    "decoded": [" ".join([x[2] for x in row]) for row in rows],
                }
            )

        return _uncollected(work)

    return per_text(docs, make, "n_tokens long, ids string, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text."""

    def make():
        vocabulary = Vocabulary(path)

        def work(texts: list[str]) -> pd.DataFrame:
            out = []
            for row in vocabulary.encode_texts(texts):
                ids, decoded = " ".join([x[1] for x in row]), " ".join([x[2] for x in row])
                out.append((sum([x[0] for x in row]), _hash(ids), _hash(decoded)))
            return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        return _uncollected(work)

    return per_text(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_binary(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (16 bits each if the vocabulary allows, else 32) and the digest of the decoded text."""

    def make():
        vocabulary = Vocabulary(path, BINARY_WORDS, decimals=False)

        def work(texts: list[str]) -> pd.DataFrame:
            out = []
            for row in vocabulary.encode_texts(texts):
                decoded = " ".join([x[2] for x in row])
                out.append((sum([x[0] for x in row]), b"".join([x[3] for x in row]), _hash(decoded)))
            return pd.DataFrame(out, columns=["n_tokens", "ids", "decoded_sha256"])

        return _uncollected(work)

    bounded_batches(docs.sparkSession)
    return per_text(docs, make, "n_tokens long, ids binary, decoded_sha256 string", BINARY_CHARACTERS)
