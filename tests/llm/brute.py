"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    """(doc_id, n_shingles, component) of rows (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def repeats(texts, length):
    """(bytes, removed, spans, digest of the rest) of each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def unigrams(rows, is_held_out):
    """(doc_id, held out, tokens, known, trained tokens, base score)."""
    tokens = [words(t) + [None] for _, t in rows]
    held = [doc is not None and is_held_out(doc) for doc, _ in rows]
    count = collections.Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(count.values()), len(count)
    return [
        (doc, h, len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t))
        for (doc, _), t, h in zip(rows, tokens, held)
    ]


def held_out(doc, remainder, modulus):
    return zlib.crc32(str(doc).encode()) % modulus == remainder


def ppm(train, text, order, start=0xFF, end=0xFE, symbols=255):
    """log10 probability of a text, byte by byte, by escapes and exclusions."""
    tries = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in train:
        data = bytes([start]) * order + t.encode() + bytes([end])
        for i in range(order, len(data)):
            for k in range(order + 1):
                tries[k][data[i - k : i]][data[i]] += 1
    data, total = bytes([start]) * order + text.encode() + bytes([end]), 0.0
    for i in range(order, len(data)):
        out = set()
        for k in range(order, -1, -1):
            seen = tries[k].get(data[i - k : i])
            left = {s: n for s, n in (seen or {}).items() if s not in out}
            if not left:
                continue
            parts = sum(left.values())
            if data[i] in left:
                total += math.log10((left[data[i]] - 0.5) / parts)
                break
            total += math.log10(0.5 * len(left) / parts)
            out |= set(left)
        else:
            total -= math.log10(symbols - len(out))
    return total
