"""Exact top-k inner-product search with sorted lists and no random access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._files import get, opened, pack, put, unpack
from ._shared import fresh_dir, table, written

K = 20
SCALE = 64
EVERY = 20
#: Vectors of a candidate block and of a query block.
BLOCK = 16384
QUERY_BLOCK = 1024
#: Queries that share a reading of the lists.
TOGETHER = 256
#: Parts of every sorted list after whose reading the bounds are looked at.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 13 / 16, 7 / 8, 15 / 16, 1.0)
#: Reading stops when so many times k vectors can still qualify: their scores are resolved.
LEFT = 4


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components as floor(scale * x); rows without an id, or with null or non-finite parts, go."""
    ok = F.expr("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(ok).select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x).cast("double")).alias("v"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components, zeros after the end of shorter vectors."""
    v = batch.column(1)
    lens = np.diff(np.asarray(v.offsets))
    out = np.zeros((len(lens), int(lens.max(initial=0))))
    out[np.repeat(np.arange(len(lens)), lens), np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)] = np.asarray(v.flatten())
    return np.asarray(batch.column(0)), out


def stored(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """(file): blocks of up to ``rows`` vectors in a row, as files of the shared folder that the attempt which wrote them has named."""
    folder = fresh_dir(vectors.sparkSession, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        fs, at = opened(folder)
        fs.create_dir(at)

        def out() -> pa.RecordBatch:
            dims, own = max(v.shape[1] for _, v in held), uuid.uuid4().hex
            ids, vs = np.concatenate([i for i, _ in held]), np.concatenate([np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for _, v in held])
            put(folder, own, pack(np.array([dims]), ids, vs.ravel()))
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{own}"])], names=["file"])

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, min(rows, batch.num_rows - at))
                if n + part.num_rows > rows:
                    yield out()
                    held, n = [], 0
                held.append(_matrix(part))
                n += part.num_rows
        if held:
            yield out()

    return written(vectors.mapInArrow(run, "file string"), name)


def _load(file: str) -> tuple[np.ndarray, np.ndarray]:
    dims, ids, vs = unpack(get(*file.rsplit("/", 1)))
    return ids, vs.reshape(len(ids), int(dims[0]))


class Lists:
    """A block's vectors as one list per component of (value, vector), from the smallest value to the largest."""

    def __init__(self, x: np.ndarray, ids: np.ndarray) -> None:
        self.x, self.ids = x, ids
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(x, self.order, axis=0)
        self.largest = float(np.abs(x).max(initial=0))


def nra(q: np.ndarray, own: int, lists: Lists, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(vector ids, scores) of the k best vectors for q, best first, and the number of list entries read.

    A list is read from its largest value down where q's component is positive, from its smallest up
    where it is negative, all lists to one depth; components of zero need no list.  What was read of a
    vector is known; elsewhere it has at least the list's last product and at most the product read last.  A vector whose
    upper bound is below the k-th best lower bound, or below ``floor`` (the k-th best score found
    elsewhere), can't qualify and is forgotten.  Reading stops when at most `LEFT` * k are left or the lists end; then
    their scores are resolved, ties by smaller id.  Vectors with the id ``own`` take no part.  Numbers beyond
    the whole ones that floats hold exactly are Python's.
    """
    used = np.flatnonzero(q)
    most = float(np.abs(q).max(initial=0)) * lists.largest * max(1, len(q))
    kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else object
    whole = (lambda v: np.array([int(c) for c in v.ravel()], object).reshape(v.shape)) if kind is object else (lambda v: v.astype(kind))
    n, down, qs = len(lists.ids), q[used] > 0, whole(q[used])
    alive = np.flatnonzero(lists.ids != own)
    place = np.full(n, -1)
    place[alive] = np.arange(len(alive))
    known, unseen = whole(np.zeros(len(alive))), whole(np.ones((len(alive), len(used))))
    products = lambda at: qs * whole(np.where(down, lists.values[n - 1 - at][:, used], lists.values[at][:, used]))
    last = products(np.array([n - 1]))[0] if n else qs
    at = read = 0
    for depth in DEPTHS:
        to = max(min(n, int(np.ceil(n * depth))), at)
        if len(alive) <= LEFT * k or to == at:
            continue
        rows = np.arange(at, to)
        got = products(rows)
        seen = place[np.where(down, lists.order[n - 1 - rows][:, used], lists.order[rows][:, used])]
        read, at = read + seen.size, to
        here = seen >= 0
        column = np.broadcast_to(np.arange(len(used)), seen.shape)[here]
        if kind is object:
            np.add.at(known, seen[here], got[here])
        else:
            known = (known + np.bincount(seen[here], got[here], len(alive))).astype(kind)
        unseen[seen[here], column] = 0
        upper, lower = known + unseen @ got[-1], known + unseen @ last
        kth = sorted(lower.tolist())[-k] if kind is object else np.partition(lower, len(lower) - k)[len(lower) - k]
        if floor is not None:
            kth = max(kth, floor)
        stay = upper >= kth
        alive, known, unseen = alive[stay], known[stay], unseen[stay]
        place[:] = -1
        place[alive] = np.arange(len(alive))
    score = np.array([int(v) for v in whole(lists.x[alive][:, used]) @ qs], object) if len(used) else np.zeros(len(alive), object)
    best = np.lexsort((lists.ids[alive], [-v for v in score.tolist()]))[:k]
    return lists.ids[alive][best], score[best].astype(np.int64), read


def nra_many(q: np.ndarray, own: np.ndarray, lists: Lists, k: int, floor: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """What `nra` gives for each row of q, with one reading of the lists for all of them, and the number of list entries used.

    A list is read from either end to a depth, once for the queries whose component has that sign; what a depth
    newly reads is added to what each query knows of each vector, and the bounds follow from that and from what is unseen.  Queries
    leave when few enough vectors are left for them, and vectors when no query can use them.  ``floor`` is minus
    infinity where nothing is known from elsewhere.
    """
    most = float(np.abs(q).max(initial=0)) * lists.largest * max(1, q.shape[1])
    n, d = lists.x.shape
    if most >= 1 << 52 or not n or not d:
        one = [nra(x, o, lists, k, None if f == -np.inf else int(f)) for x, o, f in zip(q, own.tolist(), floor.tolist(), strict=True)]
        return [(ids, score) for ids, score, _ in one], sum(read for *_, read in one)
    kind = np.float32 if most < 1 << 23 else np.float64
    # two lists a component: from the largest down for positive q, from the smallest up for negative q
    two = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]).astype(kind)
    end = np.hstack([lists.values[0], lists.values[n - 1]]).astype(kind)
    used, column, floor = np.count_nonzero(q, axis=1), np.arange(d), floor.astype(kind)
    row, here = np.arange(len(q)), np.arange(n)
    alive, known, unseen = lists.ids != own[:, None], np.zeros((len(q), n), kind), np.ones((n, 2 * d), kind)
    left: list[np.ndarray] = [here] * len(q)
    at = read = 0
    for depth in DEPTHS:
        on = np.count_nonzero(alive, axis=1) > LEFT * k
        for i in np.flatnonzero(~on):
            left[row[i]] = here[alive[i]]
        if not on.all():
            row, alive, known, two, floor = row[on], alive[on], known[on], two[on], floor[on]
        to = max(min(n, int(np.ceil(n * depth))), at)
        if not len(row) or to == at:
            continue
        some = alive.any(axis=0)
        if np.count_nonzero(some) < len(here) / 2:
            here, alive, known = here[some], alive[:, some], known[:, some]
        new = np.zeros((n, 2 * d), kind)
        down, up = slice(n - to, n - at), slice(at, to)
        new[lists.order[down], column], new[lists.order[up], d + column] = lists.values[down], lists.values[up]
        unseen[lists.order[down], column] = unseen[lists.order[up], d + column] = 0
        read, at = read + (to - at) * int(used[row].sum()), to
        known += two @ new[here].T
        rest = unseen[here].T
        lower = np.where(alive, known + (two * end) @ rest, -np.inf)
        kth = np.maximum(np.partition(lower, len(here) - k, axis=1)[:, len(here) - k], floor)
        alive &= known + (two * np.hstack([lists.values[n - to], lists.values[to - 1]]).astype(kind)) @ rest >= kth[:, None]
    for i, r in enumerate(row):
        left[r] = here[alive[i]]
    out = []
    for x, ids in zip(q, left, strict=True):
        score = lists.x[ids] @ x
        best = np.lexsort((lists.ids[ids], -score))[:k]
        out.append((lists.ids[ids][best], score[best].astype(np.int64)))
    return out, read


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query's vector.

    Both sides are (vec_id, v) as `scaled` gives them.  Their blocks lie in the shared folder, and a task reads
    those of its query block and its share of the candidates, one at a time; each meeting gives at most k rows a query,
    and the best k of those stay.  A task carries each query's k-th best score from block to block.
    Vectors with the query's id are never among its results, ties go to smaller ids, and vectors of
    different lengths count as padded with zeros.  Rows that repeat an id are rows of
    their own as candidates, and as queries: each has its own k results.  Empty tables give no rows.
    """
    cand, ask = stored(vectors, BLOCK, "candidates"), stored(queries, QUERY_BLOCK, "queries")
    m, tasks = max(1, ask.count()), 4 * queries.sparkSession.sparkContext.defaultParallelism
    # a row for each query block and share of the candidate blocks: only the names of blocks travel
    shares = cand.groupBy(F.pmod(F.xxhash64("file"), F.lit(max(1, -(-tasks // m))))).agg(F.sort_array(F.collect_list("file")).alias("files")).select("files")
    pairs = ask.withColumn("block", F.monotonically_increasing_id()).select("block", "file").crossJoin(F.broadcast(shares)).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, asked, files in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (q_ids, queried), kept = _load(asked), {}
                for file in files:
                    ids, x = _load(file)
                    wide = max(queried.shape[1], x.shape[1])
                    q, x = (np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (queried, x))
                    lists, found = Lists(x, ids), []
                    for start in range(0, len(q), TOGETHER):
                        some = range(start, min(start + TOGETHER, len(q)))
                        floor = np.array([kept[i][k - 1] if len(kept.get(i, [])) >= k else -np.inf for i in some])
                        for i, (got, score) in zip(some, nra_many(q[start : some.stop], q_ids[start : some.stop], lists, k, floor)[0], strict=True):
                            kept[i] = sorted([*kept.get(i, []), *score.tolist()], reverse=True)[:k]
                            found.append((np.full(len(got), at), np.full(len(got), i), np.full(len(got), q_ids[i]), got, score))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], names=["block", "row", "query_id", "vec_id", "score"])

    best = Window.partitionBy("block", "row").orderBy(F.col("score").desc(), "vec_id")
    found = pairs.mapInArrow(run, "block long, row long, query_id long, vec_id long, score long")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = scaled(table(spark, sf_dir, "embeddings"))
    return top_k(v.where(f"vec_id % {EVERY} = 0"), v)


ORACLES = {
    "op1_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
}

QUERIES = {"op1_exact_top_k": op1_exact_top_k}
