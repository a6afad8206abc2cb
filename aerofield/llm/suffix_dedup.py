"""Removal of byte strings that repeat, by a distributed merge sort of suffixes.

A string of `LENGTH` bytes repeats if two suffixes share their first `LENGTH` bytes.  Not every
suffix is sorted.  Each window of `LENGTH` bytes has an anchor: the place inside it whose
`GRAM` bytes hash least (by the upper 48 bits), the first of equals.  Equal windows have equal anchors at equal
offsets, and consecutive windows mostly share theirs, so windows are grouped in segments by
anchor.  As in sorting with distributed duplicate detection, fingerprints first
tell what can't repeat: anchors that occur once, then segments, then single windows of
segments that don't repeat as a whole.  What is left are runs of windows around an anchor.

Their suffixes from the anchor on are sorted in each block of documents, exchanged as
front-coded runs (shared prefix length and the rest) and merged with loser trees that
keep the length of the prefix known to be shared and compare from there; so are the strings
before the anchors, read backwards.  A window repeats exactly if another window has the same
offset, lies in the same class of suffixes by the shared prefix lengths, and in the same
class of backward strings.  The bytes decide; fingerprints only save work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _exchange, _files
from ._exchange import Answers
from ._shared import fresh_dir, table, written
from ._text import _R_INV, _powers, mix, prefix_hash, span_hash, text_chunks

LENGTH, GRAM = 200, 100
BLOCK_BYTES = 3 << 20
#: Bits of an anchor's key that tell its place in a strip; the hash has the others.
PLACE_BITS = 16
#: Offsets fit one byte.
MOST = 255 + GRAM
#: What a message about suffixes holds, in `ask_suffixes`' order.
_ITEM = (np.uint8, np.uint8, np.uint8, np.uint16, np.uint8, np.uint32, np.uint16, np.uint8)


def anchors_of(h: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The anchor of the window at each place, in strips that a processor's cache holds."""
    down, width = _powers("down", _R_INV, len(h)), length - gram + 1
    m = len(h) - length
    out = np.empty(m, np.int64)
    most = (1 << PLACE_BITS) - width + 1
    place = np.arange(1 << PLACE_BITS, dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, m, most):
        to = min(at + most, m)
        n = to - at + width - 1
        best = mix((h[at + gram : at + gram + n] - h[at : at + n]) * down[at : at + n] + np.uint64(gram))
        # keys: the hash's upper bits, then the place, so that the least is the first of equals
        best &= ~low
        best |= place[:n]
        span = 1
        while span * 2 <= width:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        out[at:to] = np.minimum(best[: to - at], best[width - span : width - span + to - at]) & low
        out[at:to] += at
    return out


def segments(data: np.ndarray, offs: np.ndarray, h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor) of each segment; windows stay inside documents."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    anchor = anchors_of(h, length, gram)
    starts = offs[:-1][np.diff(offs) >= length]
    first = np.union1d(starts, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1)
    last = np.minimum(np.append(first[1:], len(data)) - 1, offs[np.searchsorted(offs, first, "right")] - length)
    inside = first <= last
    first, last = first[inside], last[inside]
    return first, last, anchor[first]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    number = _exchange.first_block()
    for rows, data, offs in text_chunks(batches, limit=BLOCK_BYTES):
        yield number, rows, data, offs
        number += 1


def digest(data: np.ndarray, offs: np.ndarray) -> int:
    return _exchange.digest(data, offs)


class Suspects:
    """Segments of a block whose anchors occur elsewhere, with the text around them."""

    def __init__(self, block: int, digest: int, packed: bytes, length: int) -> None:
        self.block, self.digest, self.length = block, digest, length
        self.data, self.place, self.shift, self.lo, self.hi, self.anchor = _files.unpack(packed)
        self.h = prefix_hash(self.data)
        self.grams = span_hash(self.h, self.anchor, self.anchor + GRAM)
        #: a segment's bytes, offset included: equal ones have equal windows
        self.whole = mix(span_hash(self.h, self.lo, self.hi + length) + (self.anchor - self.lo).astype(np.uint64))

    @staticmethod
    def packed(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, anchor: np.ndarray, length: int) -> bytes:
        """Keep the spans that the segments cover; shift says how far each span was moved."""
        # segments come in order, and so do their ends
        new = np.ones(len(lo), bool)
        new[1:] = lo[1:] > hi[:-1] + length
        first = np.flatnonzero(new)
        starts, ends = lo[first], hi[np.append(first[1:], len(lo)) - 1 if len(lo) else first] + length
        place = np.cumsum(ends - starts) - (ends - starts)  # after packing
        shift = starts - place
        moved = lo - shift[np.cumsum(new) - 1]
        kept = np.concatenate([data[:0], *(data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))])
        return _files.pack(kept, place, shift, moved, moved + (hi - lo), moved + (anchor - lo))

    def unmoved(self, at: np.ndarray) -> np.ndarray:
        return at + self.shift[np.searchsorted(self.place, at, "right") - 1]

    def repeated(self, wholes: Answers, buckets: int) -> np.ndarray:
        """Whether each segment repeats as a whole."""
        hashes, at, _ = _distinct(self.whole)
        return _exchange.count_answers(wholes, self.block, self.digest, hashes, buckets)[at] > 1

    def looked_at(self, wholes: Answers, mixed: Answers, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that need fingerprints of their own, their segments, and which segments repeat as a whole.

        Those are the windows of the other segments, and of repeated ones whose anchor has others too.
        """
        whole = self.repeated(wholes, buckets)
        hashes, at, _ = _distinct(self.grams)
        has_others = _exchange.count_answers(mixed, self.block, self.digest, hashes, buckets)[at] > 0
        return *self.windows(np.flatnonzero(~whole | has_others)), whole

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All windows of some segments, and each one's segment."""
        n = (self.hi - self.lo + 1)[some]
        seg = np.repeat(some, n)
        return self.lo[seg] + np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n), seg


def suspects_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[Suspects]:
    for b in batches:
        for block, digest, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            yield Suspects(block, digest, packed.as_buffer(), length)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(h, return_inverse=True, return_counts=True)


class Runs:
    """A block's runs of windows that fingerprints leave: around ``anchor``, from window lo to window hi."""

    def __init__(self, s: Suspects, wholes: Answers, mixed: Answers, singles: Answers, buckets: int) -> None:
        w, seg, whole = s.looked_at(wholes, mixed, buckets)
        hashes, at, _ = _distinct(span_hash(s.h, w, w + s.length))
        again = (_exchange.count_answers(singles, s.block, s.digest, hashes, buckets)[at] > 1) & ~whole[seg]
        w, seg = w[again], seg[again]
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1] + 1) | (seg[1:] != seg[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(w)).astype(np.int64) - 1
        self.lo = np.concatenate([s.lo[whole], w[first]])
        self.hi = np.concatenate([s.hi[whole], w[last] if len(w) else w[:0]])
        self.anchor = np.concatenate([s.anchor[whole], s.anchor[seg[first]]])
        text = s.data.tobytes()
        backwards = text[::-1]
        n = len(text)
        bucket = (mix(np.concatenate([s.grams[whole], s.grams[seg[first]]])) % np.uint64(buckets)).tolist()
        items: dict[tuple, list[int]] = {}
        for i, (lo, hi, a, b) in enumerate(zip(self.lo.tolist(), self.hi.tolist(), self.anchor.tolist(), bucket, strict=True)):
            items.setdefault((b, text[a : hi + s.length], backwards[n - a : n - lo]), []).append(i)
        #: equal runs of the block are one item: (bucket, suffix, backward string) in order, and its runs
        self.items = sorted(items)
        self.runs = [items[x] for x in self.items]


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shared prefix lengths of sorted strings with the string before, and the rests, concatenated."""
    shared, rest, before = [], [], b""
    for x in strings:
        n = shared_prefix(before, x, 0)
        shared.append(n)
        rest.append(x[n:])
        before = x
    return np.array(shared, np.uint16), np.frombuffer(b"".join(rest), np.uint8)


def front_decoded(shared: np.ndarray, lens: np.ndarray, rest: np.ndarray) -> list[bytes]:
    out, at, before, rest = [], 0, b"", rest.tobytes()
    for n, more in zip(shared.tolist(), (lens - shared).tolist(), strict=True):
        before = before[:n] + rest[at : at + more]
        at += more
        out.append(before)
    return out


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the shared prefix, of which the first ``known`` bytes are known."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (x.bit_length() + 7) // 8


def merged(runs: list[list[bytes]], shared: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs, given the shared prefix lengths within each, with a loser tree.

    Returns the order (numbers over all runs, one after the other) and each string's shared prefix
    length with the one before it.  Every loser remembers how long a prefix it shares with
    the string that beat it; a challenger that shares another length with that string is
    judged by the lengths alone, and equal lengths are compared from there on.
    """
    base = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).tolist()
    k = 1
    while k < len(runs):
        k *= 2
    head = [r[0] if r else None for r in runs] + [None] * (k - len(runs))
    known, place = [0] * k, [0] * k
    losers = [0] * k
    players = list(range(k))
    size = k
    while size > 1:  # the first matches, level by level
        size //= 2
        winners = []
        for i in range(size):
            a, b = players[2 * i], players[2 * i + 1]
            if head[b] is None:
                win, lose = a, b
            elif head[a] is None:
                win, lose = b, a
            else:
                n = shared_prefix(head[a], head[b], 0)
                win, lose = (a, b) if head[a][n:] <= head[b][n:] else (b, a)
                known[lose] = n
            losers[size + i] = lose
            winners.append(win)
        players = winners
    win = players[0]
    known[win] = 0
    order, lengths = [], []
    while head[win] is not None:
        order.append(base[win] + place[win])
        lengths.append(known[win])
        place[win] += 1
        if place[win] < len(runs[win]):
            head[win], known[win] = runs[win][place[win]], shared[win][place[win]]
        else:
            head[win] = None
        node = (k + win) >> 1
        c = win
        while node:
            o = losers[node]
            if head[o] is not None:
                if head[c] is None:
                    losers[node], c = c, o
                elif known[o] > known[c]:
                    losers[node], c = c, o
                elif known[o] == known[c]:
                    x, y, n = head[c], head[o], known[c]
                    m = shared_prefix(x, y, n)
                    if x[m : m + 1] <= y[m : m + 1]:
                        known[o] = m
                    else:
                        known[c] = m
                        losers[node], c = c, o
            node >>= 1
        win = c
    return order, lengths


def repeated_offsets(order: list[int], shared: list[int], back_order: list[int], back_shared: list[int], least: np.ndarray, most: np.ndarray, times: np.ndarray, length: int) -> np.ndarray:
    """Which offsets of each item are of windows that repeat, as a boolean matrix.

    Item i has windows that begin ``least[i]`` to ``most[i]`` bytes before its anchor, ``times[i]`` times.
    """
    n = len(order)
    order, back_order, shared, back_shared = (np.array(x, np.int64) for x in (order, back_order, shared, back_shared))
    out = np.zeros((n, int(most.max(initial=-1)) + 1), bool)
    ahead, behind = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(out.shape[1]):
        some = np.flatnonzero((least <= o) & (o <= most))
        ahead[order] = np.cumsum(shared < length - o)
        behind[back_order] = np.cumsum(back_shared < o)
        _, at = np.unique(ahead[some] * (n + 1) + behind[some], return_inverse=True)
        out[some, o] = np.bincount(at, times[some])[at] > 1
    return out


def _reply(length: int):
    def reply(t: pa.Table) -> pa.Table:
        asked = [_files.unpack(x.as_buffer()) for x in t["data"]]
        least, most, times = (np.concatenate([p[k] for p in asked]).astype(np.int64) for k in range(3))
        ends = np.cumsum([len(p[0]) for p in asked])
        ahead = [front_decoded(p[3], length - p[0].astype(np.int64), p[4]) for p in asked]
        order, shared = merged(ahead, [p[3].tolist() for p in asked])
        behind = [front_decoded(p[6], p[1].astype(np.int64)[p[5]], p[7]) for p in asked]
        back, back_shared = merged(behind, [p[6].tolist() for p in asked])
        # numbers over sorted backward runs to item numbers
        items = np.concatenate([p[5].astype(np.int64) + e - len(p[5]) for p, e in zip(asked, ends, strict=True)])
        again = repeated_offsets(order, shared, items[back].tolist(), back_shared, least, most, times, length)
        bits = np.packbits(again, axis=1) if again.shape[1] else np.zeros((len(again), 0), np.uint8)
        parts = np.split(bits, ends[:-1])
        return _exchange.replies(t, [_files.pack(np.full(len(x), x.shape[1], np.uint8), x.reshape(-1)) for x in parts])

    return reply


def repeats(docs: DataFrame, length: int = LENGTH) -> str:
    """The folder with the repeated spans of each block of the rows (doc_id, text)."""
    gram = GRAM
    if not gram <= length <= MOST:
        raise ValueError(f"length must lie between {gram} and {MOST}, not {length}")
    buckets = _exchange.buckets_for(docs)

    def found(rows: tuple) -> tuple:
        number, _, data, offs = rows
        h = prefix_hash(data)
        lo, hi, anchor = segments(data, offs, h, length, gram)
        return number, digest(data, offs), data, lo, hi, anchor, span_hash(h, anchor, anchor + gram)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, own, _, _, _, _, grams in map(found, blocks(batches)):
            hashes, _, n = _distinct(grams)
            yield _exchange.count_questions(number, own, hashes, n, buckets)

    _, anchors = _exchange.answered(docs.mapInArrow(ask_anchors, _exchange.SCHEMA), _exchange.count_replies, "anchors")

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(anchors)
        for number, own, data, lo, hi, anchor, grams in map(found, blocks(batches)):
            hashes, at, _ = _distinct(grams)
            some = _exchange.count_answers(answers, number, own, hashes, buckets)[at] > 1
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([own]), pa.array([Suspects.packed(data, lo[some], hi[some], anchor[some], length)], pa.binary())], names=["block", "digest", "data"])

    suspects = written(docs.mapInArrow(suspect, "block long, digest long, data binary"), "suspects")

    def ask_wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in suspects_of(batches, length):
            hashes, _, n = _distinct(s.whole)
            yield _exchange.count_questions(s.block, s.digest, hashes, n, buckets)

    _, wholes = _exchange.answered(suspects.mapInArrow(ask_wholes, _exchange.SCHEMA), _exchange.count_replies, "segments")

    def ask_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(wholes)
        for s in suspects_of(batches, length):
            hashes, at, _ = _distinct(s.grams)
            others = np.bincount(at, ~s.repeated(answers, buckets), minlength=len(hashes))
            yield _exchange.count_questions(s.block, s.digest, hashes, others, buckets)

    _, mixed = _exchange.answered(suspects.mapInArrow(ask_others, _exchange.SCHEMA), _exchange.count_replies, "others")

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = Answers(wholes), Answers(mixed)
        for s in suspects_of(batches, length):
            w, _, _ = s.looked_at(a, b, buckets)
            hashes, _, n = _distinct(span_hash(s.h, w, w + length))
            yield _exchange.count_questions(s.block, s.digest, hashes, n, buckets)

    _, singles = _exchange.answered(suspects.mapInArrow(ask_windows, _exchange.SCHEMA), _exchange.count_replies, "windows")

    def ask_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(wholes), Answers(mixed), Answers(singles)
        for s in suspects_of(batches, length):
            r = Runs(s, *answers, buckets)
            at = 0
            names, data = [], []
            while at < len(r.items):
                bucket, to = r.items[at][0], at
                while to < len(r.items) and r.items[to][0] == bucket:
                    to += 1
                part = r.items[at:to]
                back = sorted(range(len(part)), key=lambda i, part=part: part[i][2])
                names.append(bucket)
                data.append(_files.pack(
                    np.array([length - len(x[1]) for x in part], np.uint8), np.array([len(x[2]) for x in part], np.uint8), np.array([min(255, len(x)) for x in r.runs[at:to]], np.uint8),
                    *front_coded([x[1] for x in part]), np.array(back, np.uint32), *front_coded([part[i][2] for i in back]),
                ))
                at = to
            if not names:
                names, data = [0], [_files.pack(*(np.zeros(0, k) for k in _ITEM))]
            yield _exchange.batch(names, s.block, s.digest, data)

    _, suffixes = _exchange.answered(suspects.mapInArrow(ask_suffixes, _exchange.SCHEMA), _reply(length), "suffixes")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, sorted_ones = (Answers(wholes), Answers(mixed), Answers(singles)), Answers(suffixes)
        for s in suspects_of(batches, length):
            r = Runs(s, *answers, buckets)
            bits: list[np.ndarray] = []
            for width, flat in sorted_ones.of(s.block, s.digest):
                if len(width):
                    bits += list(flat.reshape(len(width), -1))
            starts = [np.zeros(0, np.int64)]
            for item, own in zip(bits, r.runs, strict=True):
                at = np.flatnonzero(np.unpackbits(item))
                starts.append((r.anchor[own][:, None] - at[None, :]).reshape(-1))
            starts = np.unique(s.unmoved(np.concatenate(starts)))
            # windows that overlap or touch form a span
            first = np.flatnonzero(np.concatenate([[True], np.diff(starts) > length])) if len(starts) else starts
            last = np.append(first[1:], len(starts)).astype(np.int64) - 1
            yield _exchange.batch([0], s.block, s.digest, [_files.pack(starts[first], (starts[last] if len(starts) else starts) + length)])

    folder = fresh_dir(docs.sparkSession, "spans")
    _exchange.deliver(suspects.mapInArrow(mark, _exchange.SCHEMA), folder)
    return folder


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): each row's removed byte ranges and the bytes that are left.

    Texts are UTF-8 bytes; a removed range may end inside a character.  Strings repeat across rows
    and within one, overlapping too, and never span rows.  Null and empty texts, and texts
    shorter than ``length``, lose nothing; rows that repeat a doc_id are rows of their own;
    an empty table gives no rows.  The input must give the same rows in the same
    order when it is read again, as files do.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    folder = repeats(docs, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folder)
        for number, rows, data, offs in blocks(batches):
            lo, hi = answers.of(number, digest(data, offs))[0]
            # spans of neighbouring documents may touch
            doc = np.searchsorted(offs, lo, "right") - 1
            spans: list[list[dict]] = [[] for _ in range(rows.num_rows)]
            kept = []
            for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist(), strict=True):
                while b > offs[d + 1]:
                    spans[d].append({"start": int(a - offs[d]), "end": int(offs[d + 1] - offs[d])})
                    a = int(offs[d + 1])
                    d = int(np.searchsorted(offs, a, "right")) - 1
                spans[d].append({"start": int(a - offs[d]), "end": int(b - offs[d])})
            text = data.tobytes()
            for d, s in enumerate(spans):
                at, parts = int(offs[d]), []
                for x in s:
                    parts.append(text[at : int(offs[d]) + x["start"]])
                    at = int(offs[d]) + x["end"]
                kept.append(b"".join([*parts, text[at : int(offs[d + 1])]]))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(offs)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = without_repeats(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
ORACLES: dict[str, str] = {}
