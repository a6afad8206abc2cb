"""Benchmark decontamination with a generalised suffix automaton of the test items' words."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _files
from ._shared import fresh_dir, table
from ._text import LOWER, prefix_hash, span_hash, text_chunks, tidy, words

WINDOW = 13
#: Words of test items in one automaton; more items make more automata, and longer items go in overlapping parts.
MAX_WORDS = 100_000
#: Automata that a worker keeps; with more, each passes in turn over so many bytes of text.
KEPT, HELD_BYTES = 2, 8 << 20
#: Bytes that are not part of a word: all of ASCII but digits and lower-case letters.
OUTSIDE = np.zeros(256, bool)
OUTSIDE[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


class SuffixAutomaton:
    """All factors of several word sequences, with the items that hold each factor.

    ``occurrences`` streams words and reports, for each place where a window of an
    item ends, the window's length and the items that hold it.
    """

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        whole: dict[int, set[str]] = {}
        for item, seq in items:
            last = 0
            for w in seq:
                last = self._extend(last, w)
            if 0 < len(seq) < window:
                whole.setdefault(last, set()).update([] if item is None else [item])
        #: the state up the suffix links that has the factor of the window's length; and the short items that end there
        self.up_window, self.short = [0] * len(self.next), [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            up = self.link[s]
            self.up_window[s] = s if self.length[up] < window <= self.length[s] else self.up_window[up]
            self.short[s] = (*self.short[up], (self.length[s], frozenset(whole[s]))) if s in whole else self.short[up]
        self.shortest = min([window, *(self.length[s] for s in whole)])
        #: of a state with factors of the window's length: the items that hold that window
        self.at_window: dict[int, set[str]] = {}
        for item, seq in items:
            s = 0
            for n, w in enumerate(seq, 1):
                s = self.next[s][w]
                if n >= window:
                    self.at_window.setdefault(self.up_window[s], set()).update([] if item is None else [item])

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(step)
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of p's longest factor followed by w, split off if it stands for longer ones too."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        twin = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        self.link[new] = self._split(p, w) if p >= 0 else 0
        return new

    def occurrences(self, seq: list[int]) -> Iterator[tuple[int, int, set[str] | frozenset[str]]]:
        """(end, length, items) of each window that ends before word ``end`` of the stream."""
        s = n = 0
        for i, w in enumerate(seq):
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if w in self.next[s]:
                s, n = self.next[s][w], n + 1
            if n >= self.window:
                yield i + 1, self.window, self.at_window[self.up_window[s]]
            for k, found in self.short[s]:
                if k <= n:
                    yield i + 1, k, found


class Matcher:
    """An automaton with its vocabulary; finds the hit words of many documents at once."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.vocab = sorted({w for _, seq in items for w in seq})
        number = {w: i for i, w in enumerate(self.vocab)}
        seqs = [(item, [number[w] for w in seq]) for item, seq in items]
        self.automaton = SuffixAutomaton(seqs, window)
        data = np.frombuffer(b"".join(self.vocab), np.uint8)
        ends = np.cumsum([len(w) for w in self.vocab], dtype=np.int64)
        hashes = span_hash(prefix_hash(data), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if self.vocab else np.zeros(0, np.uint64)
        self.number = np.argsort(hashes)
        self.hashes = hashes[self.number]
        self.pairs = np.array(sorted({(a << 32) + b for _, seq in seqs for a, b in zip(seq, seq[1:], strict=False)}), np.int64)

    def mark(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, hit: np.ndarray, items: list[set[str]]) -> None:
        """Set ``hit`` of each word inside a window, and add the windows' items to their document's."""
        if not len(starts) or not self.vocab:
            return
        h = span_hash(prefix_hash(data), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        word = np.where(self.hashes[at] == h, self.number[at], -1)
        # a window of two words or more only holds word pairs of the items
        code = (word[:-1] << 32) + word[1:]
        at = np.minimum(np.searchsorted(self.pairs, code), max(0, len(self.pairs) - 1))
        known = (word[:-1] >= 0) & (word[1:] >= 0) & (doc[:-1] == doc[1:])
        known &= self.pairs[at] == code if len(self.pairs) else False
        cuts = np.concatenate([[0], np.flatnonzero(~known) + 1, [len(word)]])
        long = np.diff(cuts) >= self.automaton.shortest
        for lo, hi in zip(cuts[:-1][long], cuts[1:][long], strict=True):
            if word[lo] < 0:
                continue
            seq = [int(w) if self.vocab[w] == data[s:e].tobytes() else -1 for w, s, e in zip(word[lo:hi], starts[lo:hi], ends[lo:hi], strict=True)]
            for end, n, found in self.automaton.occurrences(seq):
                hit[lo + end - n : lo + end] = True
                items[doc[lo]] |= found


def word_lists(texts: list[str | None]) -> list[list[bytes]]:
    out = []
    for t in texts:
        data = LOWER[np.frombuffer((t or "").encode(), np.uint8)]
        s, e, _ = words(data, np.array([0, len(data)]), OUTSIDE)
        out.append([data[a:b].tobytes() for a, b in zip(s, e, strict=True)])
    return out


def parts_of(seq: list[bytes], window: int) -> list[list[bytes]]:
    """An item in parts of at most `MAX_WORDS` words, which overlap so that each of its windows lies in one."""
    step = max(1, MAX_WORDS - window + 1)
    return [seq[at : at + step + window - 1] for at in range(0, max(1, len(seq) - window + 1), step)] if len(seq) > MAX_WORDS else [seq]


def built(bench: DataFrame, window: int = WINDOW) -> tuple[str, list[str]]:
    """Automata of at most `MAX_WORDS` words each, built by tasks from blocks of the items' rows: their folder and names."""
    folder = fresh_dir(bench.sparkSession, "automata")
    fs, at = _files.opened(folder)
    fs.create_dir(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[str | None, list[bytes]]] = []
        n = 0

        def out() -> pa.RecordBatch:
            name = uuid.uuid4().hex
            _files.put(folder, name, zstandard.ZstdCompressor(level=1).compress(pickle.dumps(Matcher(block, window))))
            return pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for part in parts_of(word_lists([text.as_py()])[0], window):
                    if block and n + len(part) > MAX_WORDS:
                        yield out()
                        block, n = [], 0
                    block.append((item, part))
                    n += len(part)
        if block:
            yield out()

    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = bench.select(F.col("item_id").cast("string"), "text").coalesce(max(1, size // (8 * MAX_WORDS)))
    return folder, sorted(r.name for r in dealt.mapInArrow(tidy(run), "name string").collect())


_LOADED: dict[str, Matcher] = {}


def loaded(folder: str, name: str) -> Matcher:
    """An automaton of the folder; a worker keeps the `KEPT` it read last."""
    key = f"{folder}/{name}"
    if key not in _LOADED:
        while len(_LOADED) >= KEPT:
            _LOADED.pop(next(iter(_LOADED)))
        _LOADED[key] = pickle.loads(zstandard.ZstdDecompressor().decompress(_files.get(folder, name)))
    return _LOADED[key]


#: Makes a result of (rows, bytes, their offsets, word starts, ends, each word's document, its hit, the documents' items).
Finish = Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[set[str]]], pa.RecordBatch]


def scan(docs: DataFrame, bench: DataFrame, finish: Finish, schema: str, window: int = WINDOW) -> DataFrame:
    """Stream the whole texts of ``docs`` once through all automata, and ``finish`` each batch."""
    folder, names = built(bench, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name in names:
                m = loaded(folder, name)
                for _, _, _, low, starts, ends, doc, hit, items in held:
                    m.mark(low, starts, ends, doc, hit, items)
            for rows, data, offs, _, starts, ends, doc, hit, items in held:
                yield finish(rows, data, offs, starts, ends, doc, hit, items)

        for rows, data, offs in text_chunks(batches):
            low = LOWER[data]
            starts, ends, doc = words(low, offs, OUTSIDE)
            held.append((rows, data, offs, low, starts, ends, doc, np.zeros(len(starts), bool), [set() for _ in range(rows.num_rows)]))
            size += len(data)
            if len(names) <= KEPT or size >= HELD_BYTES:
                yield from out()
                held.clear()
                size = 0
        yield from out()

    return docs.mapInArrow(tidy(run), schema)


def _counts(rows: pa.RecordBatch, doc: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = rows.num_rows
    return np.bincount(doc, minlength=n), np.bincount(doc[hit], minlength=n)


def _contaminated(n_words: np.ndarray, n_hit: np.ndarray, share: int) -> np.ndarray:
    return (n_hit > 0) & (share * n_hit >= n_words)


def hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans, contaminated) of each row of ``docs``.

    A word is hit inside any occurrence of ``window`` consecutive words of an item, or of a
    whole shorter item; spans are maximal runs of hit words as byte ranges.  A
    document is contaminated if a 1/``share`` of its words or more are hit.  Null and empty texts
    have no words; items without words match nothing; items without an id hit words but are not
    listed; repeated rows and ids are kept; empty tables give no rows or no hits.
    """

    def finish(rows, data, offs, starts, ends, doc, hit, items):
        n_words, n_hit = _counts(rows, doc, hit)
        spans: list[list[dict]] = [[] for _ in range(rows.num_rows)]
        at = np.flatnonzero(hit)
        if len(at):
            cut = np.flatnonzero((np.diff(at) != 1) | np.diff(doc[at]).astype(bool)) + 1
            for run in np.split(at, cut):
                d = doc[run[0]]
                spans[d].append((int(starts[run[0]] - offs[d]), int(ends[run[-1]] - offs[d])))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(_contaminated(n_words, n_hit, share))],
            names=["doc_id", "n_words", "n_hit", "items", "spans", "contaminated"],
        )

    return scan(docs.select(F.col("doc_id").cast("long"), "text"), bench, finish, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>, contaminated boolean", window)


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, share: int = 20, cut: bool = False) -> DataFrame:
    """``docs`` without contaminated documents; with ``cut``, hit spans of the others are removed too."""

    def finish(rows, data, offs, starts, ends, doc, hit, items):
        keep = ~_contaminated(*_counts(rows, doc, hit), share)
        if cut and hit.any():
            gone = np.zeros(len(data) + 1, np.int64)
            joined = np.flatnonzero(hit[:-1] & hit[1:] & (doc[:-1] == doc[1:]))
            stop = ends.copy()
            stop[joined] = starts[joined + 1]
            np.add.at(gone, starts[hit], 1)
            np.add.at(gone, stop[hit], -1)
            stay = np.cumsum(gone[:-1]) == 0
            text = rows.column("text")
            new = [data[a:b][stay[a:b]].tobytes().decode() if x.is_valid else None for a, b, x in zip(offs[:-1], offs[1:], text, strict=True)]
            rows = rows.set_column(rows.schema.get_field_index("text"), rows.schema.field("text"), pa.array(new, text.type))
        return rows.filter(pa.array(keep))

    return scan(docs, bench, finish, docs.schema, window)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return h.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op5_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
lens AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, win.item_id FROM dw JOIN win ON dw.k = win.k AND dw.s = win.s),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN names ON d.doc_id = names.doc_id"""
}

QUERIES = {"op5_decontamination": op5_decontamination}
