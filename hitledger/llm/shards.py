"""Sequences of token ids in training order, as shards of fixed-stride records.

Ids are UTF-8 bytes, ``END`` closes a document and ``PAD`` fills a record; neither byte
occurs in UTF-8. A document gives one or more sequences of ``width`` ids, all full but the last.

The sequences are numbered along the partitions of the input (one light pass counts
them), and a keyed Feistel permutation with cycle-walking maps number to slot: every slot from 0 to
n - 1 exactly once, without a sort or a table. Slots go to shards by range. Spark's
text writer puts one record and a line end after the other, so record k of a shard starts at byte
``k * stride`` and a reader can start anywhere. A task that is repeated writes the same
bytes.

Null and empty texts give one record with ``END`` alone. A null id is written as the
smallest long and read back as null. Repeated rows get slots of their own. An empty
table gives no shards. The input must give the same rows in the same partitions twice, as a table
does; if it does not, the job fails.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitledger.llm.common import whole_text

END, PAD = 0xFF, 0xFE
WIDTH = 256
SHARD_RECORDS = 32_768
NO_ID = -(2**63)
#: Characters that a task packs at a time.
CHUNK = 4_000_000
#: id, number within the document, ids used
_HEAD = np.dtype([("doc_id", "<i8"), ("seq", "<u4"), ("n", "<u2")])


def _round(half: np.ndarray, key: int) -> np.ndarray:
    x = half + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """Keyed permutation of 0 .. n - 1: a balanced Feistel network, walked until it lands below n."""

    ROUNDS = 6

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [zlib.crc32(f"{key}:{i}".encode()) << 32 | zlib.crc32(f"{i}:{key}".encode()) for i in range(self.ROUNDS)]

    def _pass(self, x: np.ndarray, keys: list[int], back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in keys:
            if back:
                left, right = right ^ (_round(left, key) & self.mask), left
            else:
                left, right = right, left ^ (_round(right, key) & self.mask)
        return left << self.half | right

    def _walk(self, numbers: np.ndarray, keys: list[int], back: bool) -> np.ndarray:
        out = self._pass(numbers.astype(np.uint64), keys, back)
        while len(beyond := np.flatnonzero(out >= self.n)):
            out[beyond] = self._pass(out[beyond], keys, back)
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1], True)


def _ids(frame: pd.DataFrame) -> np.ndarray:
    return frame["doc_id"].to_numpy(np.int64)


def _count(width: int):
    """Per partition: rows, sequences, and a checksum of the ids in order."""

    def run(frames):
        rows = sequences = check = 0
        for frame in frames:
            rows += len(frame)
            sequences += int((frame["size"].to_numpy() // width + 1).sum())
            check = zlib.crc32(_ids(frame).tobytes(), check)
        if rows:
            yield pd.DataFrame({"partition": [TaskContext.get().partitionId()], "rows": [rows], "sequences": [sequences], "check": [check]})

    return run


def records(ids: np.ndarray, bodies: list[bytes], width: int) -> np.ndarray:
    """One row of bytes per sequence of these documents, in order."""
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    n = -(-sizes // width)
    first = np.cumsum(n) - n
    out = np.full((int(n.sum()), _HEAD.itemsize + width), PAD, np.uint8)
    head = np.zeros(len(out), _HEAD)
    owner = np.repeat(np.arange(len(ids)), n)
    head["doc_id"], head["seq"] = ids[owner], np.arange(len(out)) - first[owner]
    head["n"] = np.minimum(width, sizes[owner] - head["seq"].astype(np.int64) * width)
    out[:, : _HEAD.itemsize] = head.view(np.uint8).reshape(len(out), -1)
    flat = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8)
    filled = np.arange(width) < head["n"][:, None]
    out[:, _HEAD.itemsize :][filled] = flat
    return out


def _pack(parts, permutation: Permutation, width: int, shard_records: int):
    """Records of a chunk by shard: slots and compressed bytes."""

    def run(frames):
        here = TaskContext.get().partitionId()
        expected, number = parts.value.get(here, (0, 0, 0, 0)), None
        number, rows, sequences, check = expected[0], 0, 0, 0
        squeeze = zstandard.ZstdCompressor(level=3)
        for frame in frames:
            ids, bodies = _ids(frame), [t.encode("utf-8", "replace") for t in frame["text"]]
            rows, check = rows + len(frame), zlib.crc32(ids.tobytes(), check)
            ends = np.cumsum([len(b) for b in bodies])
            start = 0
            while start < len(bodies):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK, "right")))
                made = records(ids[start:stop], bodies[start:stop], width)
                slots = permutation.slots(np.arange(number, number + len(made)))
                number, sequences, start = number + len(made), sequences + len(made), stop
                order = np.argsort(slots)
                slots, made = slots[order], made[order]
                cuts = np.flatnonzero(np.r_[True, np.diff(slots // shard_records) != 0, True])
                for a, b in zip(cuts, cuts[1:]):
                    yield pd.DataFrame(
                        {
                            "shard": [slots[a] // shard_records],
                            "slots": [slots[a:b].tobytes()],
                            "records": [squeeze.compress(made[a:b].tobytes())],
                        }
                    )
        if (rows, sequences, check) != tuple(expected[1:]):
            raise RuntimeError(f"partition {here} of the input is not what it was when it was counted; write the input first")

    return run


def _unpack(frames):
    open_ = zstandard.ZstdDecompressor()
    for frame in frames:
        for shard, slots, packed in zip(frame["shard"], frame["slots"], frame["records"]):
            slots = np.frombuffer(slots, np.int64)
            data = open_.decompress(packed)
            stride = len(data) // len(slots)
            yield pd.DataFrame(
                {"shard": shard, "slot": slots, "record": [data[i : i + stride] for i in range(0, len(data), stride)]}
            )


def write_shards(docs: DataFrame, path: str, key: int, width: int = WIDTH, shard_records: int = SHARD_RECORDS) -> int:
    """Writes all sequences below ``path`` in their slots; the number of sequences."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), whole_text().alias("text"))
    counted = rows.select("doc_id", F.octet_length("text").alias("size")).mapInPandas(
        _count(width), "partition int, rows long, sequences long, check long"
    )
    parts, total = {}, 0
    for part in sorted(counted.collect()):  # a row per partition
        parts[part.partition] = (total, part.rows, part.sequences, part.check)
        total += part.sequences
    held = spark.sparkContext.broadcast(parts)
    packed = rows.mapInPandas(
        _pack(held, Permutation(total, key), width, shard_records), "shard long, slots binary, records binary"
    )
    # range partitions of the slots: the n-th holds those of the n-th shard
    packed = packed.repartitionById(max(1, -(-total // shard_records)), F.col("shard").cast("int"))
    placed = packed.mapInPandas(_unpack, "shard long, slot long, record binary").sortWithinPartitions("shard", "slot")
    lines = placed.select("shard", F.col("record").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("compression", "none").option("lineSep", "\n").text(path)
    return total


def read_shards(
    spark: SparkSession, path: str, total: int, start: int = 0, width: int = WIDTH, shard_records: int = SHARD_RECORDS
) -> DataFrame:
    """``slot, shard, offset, doc_id, seq, n_tokens, tokens`` from slot ``start`` on; earlier shards are not opened."""
    schema = "shard long, slot long, offset long, doc_id long, seq long, n_tokens long, tokens binary"
    if not total:
        return spark.createDataFrame([], schema)
    stride = _HEAD.itemsize + width + 1
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= start // shard_records)

    def run(frames):
        for frame in frames:
            for shard, content in zip(frame["shard"], frame["content"]):
                held = np.frombuffer(content, np.uint8).reshape(-1, stride)
                slots = shard * shard_records + np.arange(len(held))
                for a in range(int(max(0, start - slots[0])), len(held), 4096):
                    part = np.ascontiguousarray(held[a : a + 4096, :-1])
                    head = np.ascontiguousarray(part[:, : _HEAD.itemsize]).view(_HEAD)[:, 0]
                    yield pd.DataFrame(
                        {
                            "shard": shard,
                            "slot": slots[a : a + 4096],
                            "offset": np.arange(a, a + len(part)) * stride,
                            "doc_id": pd.array(head["doc_id"].astype(np.int64), "Int64").copy(),
                            "seq": head["seq"].astype(np.int64),
                            "n_tokens": head["n"].astype(np.int64),
                            "tokens": [bytes(r[_HEAD.itemsize : _HEAD.itemsize + n]) for r, n in zip(part, head["n"].tolist())],
                        }
                    )

    found = files.select(F.col("shard").cast("long").alias("shard"), "content").mapInPandas(run, schema)
    return found.withColumn("doc_id", F.expr(f"nullif(doc_id, cast('{NO_ID}' as bigint))"))
