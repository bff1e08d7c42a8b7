"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than space and 0x09 to 0x0D, with A to Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RANDOM = np.random.default_rng(20240229)
#: A value for each byte, upper case as lower case.
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0."""
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(length, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, from sums of powers up to its ends."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


#: Characters hashed at a time, one text at least: what is held per byte is many times the byte.
CHARACTERS = 500_000


def in_chunks(texts: list[str]) -> Iterator[list[str]]:
    start, size = 0, 0
    for stop, text in enumerate(texts, 1):
        size += len(text)
        if size >= CHARACTERS or stop == len(texts):
            yield texts[start:stop]
            start, size = stop, 0


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    found = [_words(part) for part in in_chunks(texts)] or [_words([])]
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    bodies = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(bodies) + b"\n", np.uint8)
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    bounds = 1 + np.cumsum([0] + [len(b) + 1 for b in bodies])
    counts = np.diff(np.searchsorted(starts, bounds))
    return span_hashes(data, starts, ends), counts


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(out * _BASE + part)
    return out


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words is one shingle, none without words."""
    hashes, counts = words(texts)
    ends = np.cumsum(counts)
    n = max(0, len(hashes) - width + 1)
    every = _fold([hashes[i : i + n] for i in range(width)]) if n else np.zeros(0, np.uint64)
    out = []
    for count, end in zip(counts.tolist(), ends.tolist()):
        if count >= width:
            out.append(np.unique(every[end - count : end - width + 1]))
        elif count:
            out.append(_fold([hashes[i : i + 1] for i in range(end - count, end)]))
        else:
            out.append(hashes[:0])
    return out
