"""Text scores from a hierarchical Pitman-Yor language model of words.

Three levels: a base over the training vocabulary and one unknown word, the restaurant of
all words above it, and below that a restaurant for every preceding word.  Context
restaurants share the restaurant of all words as their parent: each of their tables is one
customer there.  Seatings are drawn by Gibbs sampling, and the drawn seatings' predictive
probabilities are averaged.

A restaurant of strength s and discount d with T tables gets a number x drawn from Gamma(s / d + T).
Given x, its words' numbers of tables are independent: c customers sit at t tables with a weight of
S(c, t) (d x p)^t, where S are generalised Stirling numbers and p is the parent's probability
of the word.  So a context that holds a large part of all words is split over tasks by its followers without
changing the draw: all that its parts share is x and the sum of their tables.  A sweep draws all contexts
given the parent's probabilities, then the parent given the contexts' tables; within a sweep the
parent's mean probabilities stand for its measure.

Documents are read in blocks.  A block asks for its words' numbers, which name them from then on; then
it hands its distinct word pairs to the contexts' buckets.  Buckets keep their pairs and tables as files in the
shared folder, and exchange with the words' buckets, sweep by sweep, only tables by word.  At the end a
bucket answers each block's pairs with their probabilities.  Numbers, draws and sums do not depend on how the
documents are partitioned.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _exchange, _files
from ._exchange import Answers
from ._shared import fresh_dir, table, written
from ._stirling import draw_tables
from ._text import LOWER, SPACE, mix, prefix_hash, span_hash, text_chunks, words

#: Discounts and strengths of the parent restaurant and of the context restaurants.
PARENT_DISCOUNT, PARENT_STRENGTH, DISCOUNT, STRENGTH = 0.7, 1.0, 0.85, 1.0
#: Gibbs sweeps that are passed over, and that are averaged; and rounds of a whole context within one.
BURN_IN, KEPT, ROUNDS = 3, 3, 2
#: A context with more than this part of all training words is spread over tasks.
HOT = 1 / 1024
BLOCK_BYTES = 6 << 20
#: Bytes of text for which there is a bucket.
BUCKET_BYTES = 16 << 20
#: Hashes of the end of a document, and up to which others are moved.
END = np.uint64(1)
#: Numbers that name no word: words not in training, as words and as contexts, and the start of a document as a context.
UNKNOWN, NONE, START = -1, -1, -2
FOLD = 5
Reply = Callable[[pa.Table], pa.Table]
#: Messages between buckets; those to no bucket (target < 0) are sums for the driver.
MESSAGE = "source long, target long, data binary"


def draws(*key: int) -> np.random.Generator:
    """Random numbers that depend on the key alone."""
    return np.random.Generator(np.random.Philox(np.random.SeedSequence([k + 16 for k in key])))


class Base:
    """The base over known words and the unknown one, from how many words have each training count."""

    def __init__(self, counts: np.ndarray, n_words: np.ndarray) -> None:
        self.total, self.vocabulary = int((counts * n_words).sum()), int(n_words.sum())
        once = int(n_words[counts == 1].sum())
        v = self.vocabulary
        #: the unknown word's part, so that it is about as likely as a word was new in training (Good-Turing)
        self.unknown = min(0.95, max(1 / (v + 1), once / (DISCOUNT * PARENT_DISCOUNT * v))) if v else 1.0
        self.known = (1 - self.unknown) / max(1, v)


class Parent:
    """The restaurant of all words: how many customers and tables it has."""

    def __init__(self, base: Base, customers: int, tables: int) -> None:
        self.down = PARENT_STRENGTH + customers
        new = (PARENT_STRENGTH + PARENT_DISCOUNT * tables) / self.down
        self.of_known, self.of_unknown = new * base.known, new * base.unknown

    def probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Of known words with so many customers and tables here, and last of the unknown word."""
        return np.append((customers - PARENT_DISCOUNT * tables) / self.down + self.of_known, self.of_unknown)


def auxiliary(tables: np.ndarray, strength: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The numbers x of restaurants with so many tables, given which their words are independent."""
    return rng.standard_gamma(strength / discount + np.asarray(tables, float))


def predictive(c: np.ndarray, t: np.ndarray, p: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Probabilities of words with c customers at t tables, and p above, in contexts with so many of both in all."""
    return (c - DISCOUNT * t + (STRENGTH + DISCOUNT * tables) * p) / (STRENGTH + customers)


class Block:
    """Documents and their tokens: per token its word's place among the block's distinct words."""

    def __init__(self, keys: pa.Array, train: np.ndarray, lens: np.ndarray, hashes: np.ndarray) -> None:
        self.keys, self.train, self.lens = keys, train, lens
        self.digest = _exchange.digest(hashes, lens, train)
        self.words, self.token = np.unique(hashes, return_inverse=True)
        self.doc = np.repeat(np.arange(len(lens)), lens)
        self.in_train = train[self.doc]
        self.counts = np.bincount(self.token[self.in_train], minlength=len(self.words))
        self.first = np.cumsum(lens) - lens

    def numbered(self, answers: Answers, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The words' training counts and numbers."""
        order, _ = _exchange.by_bucket(self.words, buckets)
        count, number = np.zeros((2, len(self.words)), np.int64)
        got, rank = answers.joined(block, self.digest)
        count[order], number[order] = got, rank
        number = number * buckets + (mix(self.words) % np.uint64(buckets)).astype(np.int64)
        return count, np.where(count > 0, number, UNKNOWN)


class Questions:
    """A block's distinct pairs of a context and a word, dealt out to buckets and sorted there."""

    def __init__(self, block: Block, count: np.ndarray, number: np.ndarray, total: int, buckets: int) -> None:
        n = len(block.words)
        # all words not in training are one
        word = np.where(number >= 0, np.arange(n), n)[block.token]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[block.first] = n + 1
        code, of_token = np.unique(before * (n + 2) + word, return_inverse=True)
        train = np.bincount(of_token[block.in_train], minlength=len(code))
        u, w = np.concatenate([number, [NONE, START]])[code // (n + 2)], np.append(number, UNKNOWN)[code % (n + 2)]
        spread = np.concatenate([count > total * HOT, [True, True]])[code // (n + 2)]
        bucket = np.where(spread, np.where(w >= 0, w % buckets, 0), u % buckets)
        order = np.lexsort((w, u, bucket))
        #: each token's place among the questions in order
        self.of_token = np.argsort(order)[of_token]
        u, w, spread, bucket, train = u[order], w[order], spread[order], bucket[order], train[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(w)]])
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(u) != 0) | (np.diff(bucket) != 0)]))
        self.buckets, self.parts = bucket[cuts[:-1]].tolist(), []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            h = heads[np.searchsorted(heads, lo) : np.searchsorted(heads, hi)]
            self.parts.append(_files.pack(u[h], np.diff(np.append(h, hi)).astype(np.uint32), spread[h].astype(np.uint8), w[lo:hi], train[lo:hi].astype(np.uint32)))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """Number and content of the blocks of this task's (doc_id, text, held_out)."""
    held: list[tuple] = []
    size, number = 0, _exchange.first_block()

    def out() -> Block:
        keys, train, lens, hashes = zip(*held, strict=True)
        return Block(pa.concat_arrays(keys), np.concatenate(train), np.concatenate(lens), np.concatenate(hashes))

    for rows, data, offs in text_chunks(batches):
        if held and size + len(data) > BLOCK_BYTES:
            yield number, out()
            held, size, number = [], 0, number + 1
        low = LOWER[data]
        starts, ends, doc = words(low, offs, SPACE)
        h = span_hash(prefix_hash(low), starts, ends)
        h[h <= END] += np.uint64(2)
        n = np.bincount(doc, minlength=rows.num_rows)
        held.append((rows.column(0), ~np.asarray(rows.column(2).to_numpy(zero_copy_only=False), bool), n + 1, np.insert(h, np.cumsum(n), END)))
        size += len(data)
    if held:
        yield number, out()


def buckets_for(docs: DataFrame) -> int:
    """A power of two, from the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, 1 << (size // BUCKET_BYTES).bit_length())


def word_numbers(docs: DataFrame, buckets: int) -> tuple[str, Base]:
    """Answer each block's words with their training counts and ranks in their bucket, by count; the answers' folder and the base."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b in blocks(batches):
            _, parts = _exchange.by_bucket(b.words, buckets)
            yield _exchange.batch([k for k, _ in parts], number, b.digest, [_files.pack(b.words[x], b.counts[x].astype(np.uint32)) for _, x in parts])

    def reply(t: pa.Table) -> pa.Table:
        asked = [_files.unpack(x.as_buffer()) for x in t["data"]]
        ends = np.cumsum([len(h) for h, _ in asked])
        hashes, at = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True)
        count = np.bincount(at, np.concatenate([n for _, n in asked])).astype(np.int64)
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((hashes, -count))] = np.arange(len(count))
        back = zip(np.split(count[at].astype(np.uint64), ends[:-1]), np.split(rank[at].astype(np.uint64), ends[:-1]), strict=True)
        return _exchange.replies(t, [_files.pack(*x) for x in back], _files.pack(*np.unique(count[count > 0], return_counts=True)))

    rest, folder = _exchange.answered(docs.mapInArrow(ask, _exchange.SCHEMA), reply, "words")
    totals: dict[int, int] = {}
    for row in rest.select("data").toLocalIterator():
        for c, n in zip(*_files.unpack(bytes(row[0])), strict=True):
            totals[int(c)] = totals.get(int(c), 0) + int(n)
    counts = np.array(sorted(totals), np.int64)
    return folder, Base(counts, np.array([totals[c] for c in counts.tolist()], np.int64))


def _message_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    source, target, data = zip(*rows, strict=True)
    return pa.table([pa.array(source, pa.int64()), pa.array(target, pa.int64()), pa.array(data, pa.binary())], names=["source", "target", "data"])


class Pairs:
    """A bucket's distinct pairs, by context: customers and words; and the words, by their bucket and rank there."""

    def __init__(self, folder: str, bucket: int) -> None:
        self.folder, self.bucket = folder, bucket
        self.context, lens, self.spread, self.c, self.word, self.words = _files.unpack(_files.get(folder, f"pairs-{bucket}"))
        self.spread = self.spread.astype(bool)
        self.c, self.word, self.of = self.c.astype(np.int64), self.word.astype(np.int64), np.repeat(np.arange(len(lens)), lens)
        self.customers = np.bincount(self.of, self.c, len(lens)).astype(np.int64)
        self.many = np.flatnonzero(self.c > 1)

    @staticmethod
    def gather(t: pa.Table, folder: str, buckets: int) -> Pairs:
        """Put all blocks' questions to a bucket together, and keep which pairs each block asked about."""
        bucket = t["bucket"][0].as_py()
        asked = [_files.unpack(x.as_buffer()) for x in t["data"]]
        u, spread = (np.concatenate([np.repeat(q[k], q[1]) for q in asked]) for k in (0, 2))
        w, c = (np.concatenate([q[k] for q in asked]) for k in (3, 4))
        order = np.lexsort((w, u))
        new = np.concatenate([[True], (np.diff(u[order]) != 0) | (np.diff(w[order]) != 0)])
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        c = np.bincount(at, c).astype(np.uint64)
        u, w, spread = u[order][new], w[order][new], spread[order][new]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(u) != 0]))
        names = np.unique(w[w >= 0])
        sorter = np.lexsort((names // buckets, names % buckets))
        place = np.append(np.argsort(sorter), len(names))
        word = place[np.where(w >= 0, np.searchsorted(names, w), len(names))]
        _files.put(folder, f"pairs-{bucket}", _files.pack(u[heads], np.diff(np.append(heads, len(u))).astype(np.uint32), spread[heads], c, word.astype(np.uint32), names[sorter]))
        by_block = sorted(zip(t["block"].to_pylist(), t["digest"].to_pylist(), np.split(at, np.cumsum([len(q[3]) for q in asked])[:-1]), strict=True), key=lambda x: x[0])
        _files.put(folder, f"asked-{bucket}", pickle.dumps([(b, d, _files.pack(np.diff(x, prepend=0).astype(np.uint32))) for b, d, x in by_block]))
        return Pairs(folder, bucket)

    def tables(self, state: int) -> np.ndarray:
        """Each pair's tables; in the first state a table a word."""
        t = np.minimum(self.c, 1)
        if state:
            t[self.many] = _files.unpack(_files.get(self.folder, f"tables-{self.bucket}-{state}"))[0]
        return t

    def dishes(self, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The words' customers and tables in the parent, from the words' buckets' answers."""
        got = [_files.unpack(x.as_buffer()) for x in t.sort_by("source")["data"]]
        return tuple(np.concatenate([g[k] for g in got]).astype(np.int64) for k in (0, 1))

    def of_contexts(self, own: np.ndarray, shared: dict[int, float]) -> np.ndarray:
        """A value for each context: its own, or that of all parts of one that is spread."""
        out = np.array(own, float)
        for i in np.flatnonzero(self.spread):
            out[i] = shared.get(int(self.context[i]), 0.0)
        return out

    def messages(self, t: np.ndarray, buckets: int) -> pa.Table:
        """Tables by word to the words' buckets, and those of parts of spread contexts to the driver."""
        sums = np.bincount(self.word, t, len(self.words) + 1)[:-1].astype(np.uint64)
        to = self.words % buckets
        rows = [(self.bucket, int(to[x[0]]), _files.pack(np.diff(self.words[x] // buckets, prepend=0).astype(np.uint64), sums[x])) for x in np.split(np.arange(len(to)), np.flatnonzero(np.diff(to)) + 1) if len(x)]
        if not (to == self.bucket).any():  # an answer to nothing, so that the bucket has its turn
            rows.append((self.bucket, self.bucket, _files.pack(np.zeros(0, np.uint64), np.zeros(0, np.uint64))))
        tables = np.bincount(self.of, t, len(self.context)).astype(np.int64)
        rows.append((self.bucket, -1, _files.pack(self.context[self.spread], self.customers[self.spread], tables[self.spread])))
        return _message_table(rows)


def spread_sums(messages: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Customers and tables of the spread contexts, of which there are at most 1 / `HOT` and two."""
    customers: dict[int, int] = {}
    tables: dict[int, int] = {}
    for row in messages.where("target < 0").select("data").toLocalIterator():
        for u, c, t in zip(*(x.tolist() for x in _files.unpack(bytes(row[0]))), strict=True):
            customers[u], tables[u] = customers.get(u, 0) + c, tables.get(u, 0) + t
    return customers, tables


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of (doc_id, text, held_out).

    Rows with held_out false are the training texts; the input must give the same rows in the
    same order when it is read again, as files do (else it raises).  Null and empty texts have the end token
    alone; without training texts every token is the unknown word, with probability 1.
    Repeated rows are rows of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = buckets_for(docs)
    first, base = word_numbers(docs, buckets)
    total, v = base.total, base.vocabulary
    folder = fresh_dir(spark, "seatings")
    fs, at = _files.opened(folder)
    fs.create_dir(at)
    last = BURN_IN + KEPT
    rounds, burn_in = ROUNDS, BURN_IN

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(first)
        for number, b in blocks(batches):
            q = Questions(b, *b.numbered(answers, number, buckets), total, buckets)
            yield _exchange.batch(q.buckets, number, b.digest, q.parts)

    def gather(t: pa.Table) -> pa.Table:
        pairs = Pairs.gather(t, folder, buckets)
        return pairs.messages(pairs.tables(0), buckets)

    messages = written(docs.mapInArrow(ask, _exchange.SCHEMA).groupBy("bucket").applyInArrow(gather, MESSAGE), "tables")
    customers, spread = spread_sums(messages)

    def parent_tables(k: int, x0: float) -> Reply:
        def run(t: pa.Table) -> pa.Table:
            got = [(i, *_files.unpack(x.as_buffer())) for i, x in zip(t["source"].to_pylist(), t["data"], strict=True)]
            bucket, ends = t["target"][0].as_py(), np.cumsum([len(r) for _, r, _ in got])
            _, at = np.unique(np.concatenate([np.cumsum(r) for _, r, _ in got]), return_inverse=True)
            c = np.bincount(at, np.concatenate([n for _, _, n in got])).astype(np.int64)
            tables = draw_tables(c, np.full(len(c), x0 * base.known), draws(k, 1, bucket).random(len(c)), PARENT_DISCOUNT)
            rows = [(bucket, i, _files.pack(c[x].astype(np.uint64), tables[x].astype(np.uint64))) for (i, _, _), x in zip(got, np.split(at, ends[:-1]), strict=True)]
            return _message_table([*rows, (bucket, -1, _files.pack(np.array([c.sum()]), np.array([tables.sum()])))])

        return run

    def context_tables(k: int, parent: Parent, x_spread: dict[int, float]) -> Reply:
        def run(t: pa.Table) -> pa.Table:
            pairs = Pairs(folder, t["target"][0].as_py())
            served = pairs.dishes(t)
            if k > burn_in:
                _files.put(folder, f"dishes-{pairs.bucket}-{k}", _files.pack(*(x.astype(np.uint64) for x in served)))
            p, tables, rng = parent.probability(*served), pairs.tables(k), draws(k, 3, pairs.bucket)
            some = pairs.many
            for _ in range(rounds):
                x = auxiliary(np.bincount(pairs.of, tables, len(pairs.context)), STRENGTH, DISCOUNT, rng)
                x = pairs.of_contexts(x, x_spread)
                tables[some] = draw_tables(pairs.c[some], x[pairs.of[some]] * p[pairs.word[some]], rng.random(len(some)), DISCOUNT)
                some = some[~pairs.spread[pairs.of[some]]]
            _files.put(folder, f"tables-{pairs.bucket}-{k + 1}", _files.pack(tables[pairs.many].astype(np.uint64)))
            return pairs.messages(tables, buckets)

        return run

    parents: list[Parent] = []
    spread_tables, tables_above = [spread], v
    for k in range(last + 1):
        x0 = float(auxiliary(np.array([tables_above]), PARENT_STRENGTH, PARENT_DISCOUNT, draws(k, 0))[0])
        dishes = written(messages.where("target >= 0").groupBy("target").applyInArrow(parent_tables(k, x0), MESSAGE), "dishes")
        sums = [_files.unpack(bytes(r[0])) for r in dishes.where("target < 0").select("data").toLocalIterator()]
        tables_above = int(sum(t[0] for _, t in sums))
        parents.append(Parent(base, int(sum(c[0] for c, _ in sums)), tables_above))
        if k < last:
            x_spread = {u: float(auxiliary(np.array([n]), STRENGTH, DISCOUNT, draws(k, 2, u))[0]) for u, n in spread_tables[k].items()}
            messages = written(dishes.where("target >= 0").groupBy("target").applyInArrow(context_tables(k, parents[k], x_spread), MESSAGE), "tables")
            spread_tables.append(spread_sums(messages)[1])

    def answer(t: pa.Table) -> pa.Table:
        pairs = Pairs(folder, t["target"][0].as_py())
        in_all = pairs.of_contexts(pairs.customers, customers)[pairs.of]
        p = np.zeros(len(pairs.c))
        for k in range(burn_in + 1, last + 1):
            served = pairs.dishes(t) if k == last else _files.unpack(_files.get(folder, f"dishes-{pairs.bucket}-{k}"))
            tables = pairs.tables(k)
            whole = pairs.of_contexts(np.bincount(pairs.of, tables, len(pairs.context)), spread_tables[k])
            p += predictive(pairs.c, tables, parents[k].probability(*(x.astype(np.int64) for x in served))[pairs.word], in_all, whole[pairs.of])
        p = (p / (last - burn_in)).astype(np.float32)
        asked = pickle.loads(_files.get(folder, f"asked-{pairs.bucket}"))
        data = [_files.pack(p[np.cumsum(_files.unpack(x)[0].astype(np.int64))]) for _, _, x in asked]
        n = len(asked)
        return pa.table([pa.array([pairs.bucket] * n, pa.int64()), pa.array([b for b, _, _ in asked], pa.int64()), pa.array([d for _, d, _ in asked], pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block", "digest", "data"])

    scores = fresh_dir(spark, "probabilities")
    _exchange.deliver(dishes.where("target >= 0").groupBy("target").applyInArrow(answer, _exchange.SCHEMA), scores)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, seated = Answers(first), Answers(scores)
        for number, b in blocks(batches):
            count, numbers = b.numbered(counted, number, buckets)
            q = Questions(b, count, numbers, total, buckets)
            (p,) = seated.joined(number, b.digest)
            add = lambda x: np.bincount(b.doc, x, minlength=len(b.lens))
            base_score = np.log10((count[b.token] + 0.5) / (total + 0.5 * (v + 1)))
            yield pa.RecordBatch.from_arrays(
                [b.keys, pa.array(~b.train), pa.array(b.lens), pa.array(add(count[b.token] > 0).astype(np.int64)), pa.array(np.full(len(b.lens), total)), pa.array(add(base_score)), pa.array(add(np.log10(p.astype(float))[q.of_token]))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scores: DataFrame) -> DataFrame:
    """(held_out, tokens, base_perplexity, perplexity) of `score`'s result."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), per("base_score").alias("base_perplexity"), per("score").alias("perplexity"))


def op3_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLD == 1, F.lit(False))
    return score(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", held.alias("held_out")))


QUERIES = {"op3_pitman_yor_scores": op3_pitman_yor_scores}
ORACLES: dict[str, str] = {}
