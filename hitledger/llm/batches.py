"""Questions of whole batches of texts to a table that is spread by key.

A job that needs a corpus count for each n-gram of each text would ship every
occurrence. Here texts are dealt into batches; a batch asks once for each distinct key it holds,
its questions go to blocks of the key space, and a block's answers go back to the batches in the order of the
questions, so that neither text nor ids travel with them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

#: Characters per batch.
BATCH_CHARACTERS = 4_000_000


def batches_for(text: DataFrame) -> int:
    """Number of batches for a frame with the column ``text``."""
    length = text.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-length // BATCH_CHARACTERS))


def batch_of(key: Column, batches: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(batches)).cast("int")


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted whole numbers, compressed: differences, their bytes by significance."""
    values = values.astype(np.uint64)
    steps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u8"), dtype=np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Numbers of any order, compressed with their bytes by significance."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, their counts added, and for each input array the places of its keys."""
    every = np.concatenate(keys)
    distinct, place = np.unique(every, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, np.concatenate(counts).astype(np.int64))
    return distinct, total, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


def ask_and_finish(
    dealt: DataFrame,
    ask: Callable[[pd.DataFrame], pd.DataFrame],
    question: str,
    answer: Callable[[DataFrame], DataFrame],
    finish: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """``ask`` per batch, ``answer`` from frame of questions to frame of answers with ``batch``, ``finish`` per batch
    with its answers. Both uses of the texts share one shuffle."""
    by_batch = dealt.groupBy("batch")
    answers = answer(by_batch.applyInPandas(ask, question))
    return by_batch.cogroup(answers.groupBy("batch")).applyInPandas(finish, schema)
