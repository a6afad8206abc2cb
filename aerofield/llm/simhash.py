"""Near-duplicate groups by SimHash fingerprints, linked in a binary-trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ._components import components
from ._rows import noted, numbered
from ._shared import table, written
from ._text import tidy

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints of one subtrie that travel together.
CHUNK = 1024
#: Sorted fingerprints that a task holds at once.
HELD = 1 << 16
#: Node pairs expanded, and links held, at once.
FRONTIER = 1 << 17


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles; zero for a text without words."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(w[i:] for i in range(size)), strict=False)) if len(w) >= size else [b" ".join(w)]
    h = np.fromiter((digest(x, SEED) for x in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], name: str = "fp") -> DataFrame:
    """Columns ``keep`` of ``docs`` and each whole text's fingerprint as a signed long; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py()) for x in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fps.view(np.int64))], names=[*keep, name])

    kept = docs.select(*keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(tidy(run), StructType([*kept.schema.fields, StructField(name, LongType())]))


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links i-j."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]


def trie_links(a: np.ndarray, a_ranges: np.ndarray, b: np.ndarray, b_ranges: np.ndarray, same: np.ndarray, skip: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with a[i] and b[j] at ``budget`` differing bits or fewer, within given range pairs, in parts.

    Each range is the sorted content of one trie node below ``skip`` common leading
    bits.  Node pairs descend together, the differing bits add up and a pair over
    the budget is pruned; where both nodes hold one fingerprint, the rest of the
    bits is compared at once, as in a path-compressed trie.
    """
    errs = np.bitwise_count((a[a_ranges[:, 0]] ^ b[b_ranges[:, 0]]) >> np.uint64(64 - skip)).astype(np.int64) if skip else np.zeros(len(a_ranges), np.int64)
    stack = [(skip, np.column_stack([a_ranges, b_ranges, errs, same]))]

    def middle(x: np.ndarray, k: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the ones of bit k begin in nodes of common leading bits: their common prefix, that bit set, is searched for."""
        bit = np.uint64(63 - k)
        first = ((x[lo] >> bit) | np.uint64(1)) << bit
        while (open_ := lo < hi).any():
            at = (lo + hi) >> 1
            less = open_ & (x[np.minimum(at, len(x) - 1)] < first)
            lo, hi = np.where(less, at + 1, lo), np.where(open_ & ~less, at, hi)
        return lo

    while stack:
        k, f = stack.pop()
        if len(f) > FRONTIER:
            stack += [(k, f[: len(f) // 2]), (k, f[len(f) // 2 :])]
            continue
        f = f[f[:, 4] <= budget]
        leaf = (f[:, 1] - f[:, 0] == 1) & (f[:, 3] - f[:, 2] == 1) | (k >= 64)
        if leaf.any():
            x = f[leaf]
            near = np.bitwise_count(a[x[:, 0]] ^ b[x[:, 2]]) <= budget
            near &= ~((x[:, 5] == 1) & (x[:, 0] == x[:, 2]))
            if near.any():
                yield x[near, 0], x[near, 2]
            f = f[~leaf]
        if not len(f):
            continue
        al, ah, bl, bh, e, s = f.T
        am, bm = middle(a, k, al, ah), middle(b, k, bl, bh)
        twin = (s == 1) & (al == bl) & (ah == bh)
        parts = []
        for lo, hi, lo2, hi2, add, keep in ((al, am, bl, bm, 0, None), (am, ah, bm, bh, 0, None), (al, am, bm, bh, 1, None), (am, ah, bl, bm, 1, ~twin)):
            ok = (hi > lo) & (hi2 > lo2) & (e + add <= budget)
            if keep is not None:
                ok &= keep
            parts.append(np.column_stack([lo[ok], hi[ok], lo2[ok], hi2[ok], e[ok] + add, s[ok]]))
        stack.append((k + 1, np.concatenate(parts)))


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that connect what the ``pairs`` of fingerprints do, without cycles; few pairs are held at once."""
    u, v = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    held, n = [], 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate([x, *(h[k] for h in held)]) for k, x in enumerate((u, v)))
        nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        root = _roots(len(nodes), at[: len(i)], at[len(i) :])
        own = root != np.arange(len(nodes))
        return nodes[own], nodes[root[own]]

    for i, j in pairs:
        held.append((i, j))
        n += len(i)
        if n > FRONTIER:
            u, v = joined()
            held, n = [], 0
    return joined() if held else (u, v)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    """Fingerprints turned left by so many bits."""
    return x << np.uint64(by) | x >> np.uint64(64 - by) if by else x


def links(fps: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that connect all within ``budget`` bits.

    The 64 bits are cut into ``budget`` + 1 blocks: two fingerprints within the budget agree in one
    of them.  For each block there is a trie of the fingerprints turned so that the block leads; only pairs
    below one node at that block's depth are looked at.  So a fingerprint travels once a
    block, however many there are.  The turned fingerprints are dealt out by ranges, so that a node with
    many is no task of its own.  A task joins the nodes that it has whole; nodes of more than `CHUNK`
    fingerprints, and those at a task's ends, become sorted chunks, and chunks whose common
    leading bits differ within the budget meet.  Links found together are kept as a spanning forest.
    """
    n = min(budget, 63) + 1
    starts = [64 * i // n for i in range(n)]
    width = [b - a for a, b in zip(starts, [*starts[1:], 64], strict=True)]
    turned = F.array(*(F.struct(F.lit(i).alias("trie"), F.expr(f"(shiftleft(fp, {a}) | shiftrightunsigned(fp, {(64 - a) % 64})) ^ (-9223372036854775807L - 1L)").alias("place")) for i, a in enumerate(starts)))
    ordered = fps.select(F.explode(turned).alias("t")).select("t.trie", "t.place").repartitionByRange("trie", "place").sortWithinPartitions("trie", "place")
    top = np.uint64(1 << 63)

    def out(u=(), v=(), trie: int | None = None, chunk: np.ndarray | None = None) -> pa.RecordBatch:
        if chunk is None:
            cols = [pa.array(np.asarray(u).view(np.int64)), pa.array(np.asarray(v).view(np.int64)), *(pa.nulls(len(u), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
        else:
            alike = 64 - int(chunk[0] ^ chunk[-1]).bit_length()
            node = chunk[:1] >> np.uint64(64 - width[trie])
            cols = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([trie], pa.int32()), pa.array(node.view(np.int64)), pa.array(chunk[:1].view(np.int64)), pa.array([alike], pa.int32()), pa.array([chunk.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["u", "v", "trie", "node", "low", "alike", "fps"])

    def joined(trie: int, x: np.ndarray, ranges: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = np.ones(len(ranges), np.int64)
        u, v = forest((x[i], x[j]) for i, j in trie_links(x, ranges, x, ranges, same, width[trie], budget))
        if len(u):
            yield out(_turned(u, (64 - starts[trie]) % 64), _turned(v, (64 - starts[trie]) % 64))

    def whole(trie: int, x: np.ndarray, edge: bool, last: bool) -> Iterator[pa.RecordBatch]:
        """Nodes of one trie in order; the first is at an edge if ``edge``, the last if ``last``."""
        node = x >> np.uint64(64 - width[trie])
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1, [len(x)]])
        lo, hi = cuts[:-1], cuts[1:]
        apart = hi - lo > CHUNK
        apart[0] |= edge
        apart[-1] |= last
        for a, b in zip(lo[apart], hi[apart], strict=True):
            for at in range(a, b, CHUNK):
                yield out(trie=trie, chunk=x[at : min(at + CHUNK, b)])
        some = ~apart & (hi - lo > 1)
        if some.any():
            yield from joined(trie, x, np.column_stack([lo[some], hi[some]]))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, edge = np.zeros(0, np.uint64), 0, True
        for b in batches:
            tries, x = np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64) ^ top
            for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(tries)) + 1):
                if not len(part):
                    continue
                if tries[part[0]] != at:
                    if len(held):
                        yield from whole(at, held, edge, False)
                        held, edge = np.zeros(0, np.uint64), False
                    at = int(tries[part[0]])
                held = np.concatenate([held, x[part]])
                if len(held) > HELD:
                    # the last node may go on: it is held back, or its part here becomes chunks
                    cut = int(np.searchsorted(held, held[-1] >> np.uint64(64 - width[at]) << np.uint64(64 - width[at])))
                    if cut:
                        yield from whole(at, held[:cut], edge, False)
                        held, edge = held[cut:], False
                    if len(held) > HELD // 2:
                        yield from whole(at, held, True, True)
                        held, edge = np.zeros(0, np.uint64), True
        if len(held):
            yield from whole(at, held, edge, True)

    found = written(ordered.mapInArrow(tidy(runs), "u long, v long, trie int, node long, low long, alike int, fps binary"), "subtries")
    chunks = found.where("fps is not null")
    one, two = (chunks.select("trie", "node", F.col("low").alias(f"{k}_low"), F.col("alike").alias(f"{k}_alike")) for k in "ab")
    near = f"bit_count(shiftrightunsigned(a_low ^ b_low, 64 - least(a_alike, b_alike))) <= {budget} and (a_low ^ (-9223372036854775807L - 1L)) <= (b_low ^ (-9223372036854775807L - 1L))"
    pairs = one.join(two, ["trie", "node"]).where(near).select("trie", "a_low", "b_low")
    for k in "ab":
        pairs = pairs.join(chunks.select("trie", F.col("low").alias(f"{k}_low"), F.col("fps").alias(k)), ["trie", f"{k}_low"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for trie, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                same = x[0] == y[0]
                if same and len(x) < 2:
                    continue
                one, two = (np.array([[0, len(v)]]) for v in (x, y))
                u, v = forest((x[i], y[j]) for i, j in trie_links(x, one, y, two, np.array([int(same)]), width[trie], budget))
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(_turned(w, (64 - starts[trie]) % 64).view(np.int64)) for w in (u, v)], names=["u", "v"])

    return found.where("u is not null").select("u", "v").unionByName(pairs.select("trie", "a", "b").mapInArrow(tidy(met), "u long, v long"))


def classes(distinct: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """``distinct`` fingerprints, one row each, with ``root``: the same for all that links connect."""
    root = components(links(distinct.select("fp"), budget)).select(F.col("node").alias("fp"), "root")
    return distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_groups(docs: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): every document with the smallest doc_id its fingerprint reaches.

    Null and empty texts have fingerprint zero and link like any other; rows that
    repeat a doc_id stay; a null doc_id is never a component's id unless all its
    documents have none.  An empty table gives no rows; other columns are ignored.
    """
    fps = written(fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"]), "fingerprints")
    named = classes(written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct"), budget)
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = written(named.join(lowest, "root").select("fp", "component_id"), "components")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group, with all its columns: that of the smallest doc_id.

    Rows are told apart by their place in ``docs``, not by doc_id: of rows that share their group's
    smallest doc_id the first there stays, and a row whose doc_id repeats in another group
    stays as that group's.  A row without a doc_id stays only if its group has no doc_id.  ``docs`` must give
    the same rows in the same order when it is read again, as files do; else it raises.  An
    empty table gives no rows.
    """
    own = numbered(docs.select(F.col("doc_id").cast("long"), "text"))
    rows = written(fingerprints(own, ["row", "check", "doc_id"]), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    named = classes(written(rows.groupBy("fp").agg(first), "distinct"), budget)
    stay = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"), F.lit(True).alias("stays"))
    notes = rows.select("row", "check").join(stay, "row", "left").select("row", "check", F.col("stays").isNotNull().alias("stays"))
    return noted(docs, notes, lambda b, t: b.filter(t["stays"].combine_chunks()), docs.schema)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = near_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_near_dedup": op7_simhash_near_dedup}
ORACLES: dict[str, str] = {}
