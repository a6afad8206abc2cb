"""Questions of blocks of rows to tasks that see all blocks' questions about a key, and their answers.

A block's number is its task's partition, shifted, plus its place there; it is the same
whenever the same input is read again.  A block sends a digest of its content with each
question, and asks at least one; a reader whose block's digest differs, or that finds no
answer, raises.  Answers come back as one file per partition.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _files
from ._shared import fresh_dir, released
from ._text import mix

#: Bits of a block's number for its place within its partition.
PLACES = 24
SCHEMA = "bucket long, block long, digest long, data binary"


def first_block() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << PLACES


def digest(*arrays: np.ndarray) -> int:
    """A signed 64-bit hash of arrays."""
    h = xxhash.xxh64()
    for a in arrays:
        h.update(np.int64(len(a)).tobytes())
        h.update(np.ascontiguousarray(a).view(np.uint8))
    return h.intdigest() - (1 << 63)


def batch(buckets: list[int], block: int, digest: int, data: list[bytes]) -> pa.RecordBatch:
    n = len(buckets)
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array([block] * n, pa.int64()), pa.array([digest] * n, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block", "digest", "data"])


def replies(t: pa.Table, data: list[bytes], rest: bytes | None = None) -> pa.Table:
    """Answers to the questions of t, in their order, and one row to no block."""
    cols = [t[c].to_pylist() for c in ("bucket", "block", "digest")]
    if rest is not None:
        cols, data = [[*c, -1] for c in cols], [*data, rest]
    return pa.table([*(pa.array(c, pa.int64()) for c in cols), pa.array(data, pa.binary())], names=["bucket", "block", "digest", "data"])


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The order that sorts hashes by bucket, and each bucket's places."""
    bucket = (mix(hashes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, [(int(bucket[x[0]]), x) for x in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(x)]


def answered(questions: DataFrame, reply: Callable[[pa.Table], pa.Table], name: str) -> tuple[DataFrame, str]:
    """Group questions by bucket and reply; returns replies to no block (block < 0) and the answers' folder."""
    spark = questions.sparkSession
    path, folder = fresh_dir(spark, f"{name}-replies"), fresh_dir(spark, name)
    with released(spark):
        questions.groupBy("bucket").applyInArrow(reply, SCHEMA).write.parquet(path)
    found = spark.read.schema(SCHEMA).parquet(path)
    deliver(found.where("block >= 0"), folder)
    return found.where("block < 0"), folder


def deliver(rows: DataFrame, folder: str) -> None:
    """Gather (bucket, block, data) into a file per partition."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "ascending"), ("bucket", "ascending")])
        parts: dict[int, tuple[int, list[bytes]]] = {}
        for b, d, x in zip(t["block"].to_pylist(), t["digest"].to_pylist(), t["data"], strict=True):
            parts.setdefault(b, (d, []))[1].append(x.as_buffer().to_pybytes())
        name = t["block"][0].as_py() >> PLACES
        _files.put(folder, str(name), pickle.dumps(parts))
        return pa.table({"partition": [name]})

    fs, at = _files.opened(folder)
    fs.create_dir(at)
    with released(rows.sparkSession):
        rows.groupBy(F.shiftright("block", PLACES).alias("partition")).applyInArrow(run, "partition long").write.format("noop").mode("overwrite").save()


class Answers:
    """A task's reader of answers: each block's, over its buckets in order."""

    def __init__(self, folder: str) -> None:
        self.folder, self.partition, self.parts = folder, -1, {}

    def of(self, block: int, digest: int) -> list[list[np.ndarray]]:
        if self.partition != block >> PLACES:
            self.partition = block >> PLACES
            self.parts = pickle.loads(_files.get(self.folder, str(self.partition)))
        if block not in self.parts:
            raise RuntimeError(f"no answers for block {block} in {self.folder}: the input was not read as before")
        known, data = self.parts[block]
        if known != digest:
            raise RuntimeError(f"block {block} is not the one that asked in {self.folder}: the input must give the same rows in the same order when it is read again")
        return [_files.unpack(x) for x in data]

    def joined(self, block: int, digest: int) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*self.of(block, digest), strict=True)]


def count_questions(block: int, digest: int, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Ask for the total count of distinct hashes, of which the block has ``counts``."""
    _, parts = by_bucket(hashes, buckets)
    parts = parts or [(0, np.zeros(0, np.int64))]
    few = np.minimum(counts, 255).astype(np.uint8)
    return batch([b for b, _ in parts], block, digest, [_files.pack(hashes[x], few[x]) for _, x in parts])


def count_replies(t: pa.Table) -> pa.Table:
    """Total counts, up to 255."""
    asked = [_files.unpack(x.as_buffer()) for x in t["data"]]
    _, at = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
    total = np.minimum(np.bincount(at, np.concatenate([n for _, n in asked])), 255).astype(np.uint8)
    back = np.split(total[at], np.cumsum([len(h) for h, _ in asked])[:-1])
    return replies(t, [_files.pack(x) for x in back])


def count_answers(answers: Answers, block: int, digest: int, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The total counts of the hashes that `count_questions` asked for, in their order."""
    out = np.zeros(len(hashes), np.int64)
    if len(hashes):
        order, _ = by_bucket(hashes, buckets)
        out[order] = answers.joined(block, digest)[0]
    return out


def buckets_for(docs: DataFrame) -> int:
    return max(64, 2 * docs.rdd.getNumPartitions())


