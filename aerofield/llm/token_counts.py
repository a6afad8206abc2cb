"""Token counts of a unigram vocabulary: count-only Viterbi over Aho-Corasick matches."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import log

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._pieces import distinct_chunks
from ._shared import table
from ._text import release

MARK = "▁"
#: What an unknown character costs below the lowest score, as unigram tokenizers have it.
UNKNOWN_PENALTY = 10.0
#: Distinct chunks solved side by side, and their longest length; longer ones are solved alone.
SIDE_BY_SIDE, LONGEST = 50_000, 256
BATCH_BYTES = 8 << 20


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece file with unigram scores.

    The file's scores are negated ranks; a piece of rank r gets the log probability of
    Zipf's law, so that the pieces make a unigram model.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    norm = log(sum(1 / (1 + r) for r in range(len(plain))))
    return [(sp.id_to_piece(i), -log(1 + max(0.0, -sp.get_score(i))) - norm) for i in plain]


class Counter:
    """Counts the pieces of the best segmentation of chunks that start with the word mark.

    Ties follow unigram tokenizers: ends are filled from earlier starts to later ones, and only a
    strictly better score replaces what is there, so the longest last piece wins.  A character
    with no piece of its own may be an unknown piece; unknown pieces in a row count as one.
    """

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        self.lens, self.scores = [], []
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and MARK not in piece[1:]:  # others never match inside a chunk
                self.automaton.add_word(piece, len(self.lens))
                self.lens.append(len(piece))
                self.scores.append(score)
        self.automaton.make_automaton()
        self.unknown = min([0.0, *(s for _, s in pieces)]) - UNKNOWN_PENALTY
        self.lens, self.scores = np.array(self.lens, np.int64), np.array(self.scores)

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """End (exclusive) and piece of every match, by end, the longest first."""
        if not len(self.lens):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        return flat[:, 0] + 1, flat[:, 1]

    def count(self, chunks: list[str]) -> np.ndarray:
        out = np.zeros(len(chunks), np.int64)
        lens = np.array([len(c) for c in chunks], np.int64)
        short = np.flatnonzero(lens <= LONGEST)
        for at in range(0, len(short), SIDE_BY_SIDE):
            pick = short[at : at + SIDE_BY_SIDE]
            out[pick] = self._side_by_side([chunks[i] for i in pick], lens[pick])
        for i in np.flatnonzero(lens > LONGEST):
            out[i] = self._alone(chunks[i])
        return out

    def _side_by_side(self, chunks: list[str], lens: np.ndarray) -> np.ndarray:
        """One step per position, for all chunks together."""
        end, piece = self._matches("".join(chunks))
        stop = np.cumsum(lens)
        first = stop - lens
        chunk = np.searchsorted(stop, end)
        node = end + chunk  # chunk c has the nodes first[c] + c ... stop[c] + c
        rel = (end - first[chunk]).astype(np.uint16)
        n_nodes = int(stop[-1]) + len(chunks)
        single = np.zeros(n_nodes, bool)
        single[node[self.lens[piece] == 1]] = True
        score, count, fused = np.full(n_nodes, -np.inf), np.zeros(n_nodes, np.int64), np.zeros(n_nodes, bool)
        score[first + np.arange(len(chunks))] = 0.0
        order = np.argsort(rel, kind="stable")
        at = np.searchsorted(rel[order], np.arange(int(lens.max(initial=0)) + 2))
        for p in range(1, int(lens.max(initial=0)) + 1):
            m = order[at[p] : at[p + 1]]
            if len(m):
                to, fr = node[m], node[m] - self.lens[piece[m]]
                cand = self.scores[piece[m]] + score[fr]
                heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                best = np.maximum.reduceat(cand, heads)
                hit = np.flatnonzero(cand == np.repeat(best, np.diff(np.append(heads, len(m)))))
                hit = hit[np.concatenate([[True], to[hit][1:] != to[hit][:-1]])]
                score[to[hit]], count[to[hit]] = cand[hit], count[fr[hit]] + 1
            bare = (first + np.arange(len(chunks)))[lens >= p] + p
            bare = bare[~single[bare]]
            cand = self.unknown + score[bare - 1]
            bare, cand = bare[cand > score[bare]], cand[cand > score[bare]]
            score[bare], fused[bare] = cand, True
            count[bare] = count[bare - 1] + ~fused[bare - 1]
        return count[stop + np.arange(len(chunks))]

    def _alone(self, chunk: str) -> int:
        end, piece = self._matches(chunk)
        n = len(chunk)
        score, count, fused = [float("-inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        score[0] = 0.0
        lens, scores = self.lens[piece].tolist(), self.scores[piece].tolist()
        single = set(end[self.lens[piece] == 1].tolist()) if len(piece) else set()
        at, ends = 0, end.tolist()
        for to in range(1, n + 1):
            while at < len(ends) and ends[at] == to:
                cand = scores[at] + score[to - lens[at]]
                if cand > score[to]:
                    score[to], count[to] = cand, count[to - lens[at]] + 1
                at += 1
            if to not in single and (cand := self.unknown + score[to - 1]) > score[to]:
                score[to], fused[to] = cand, True
                count[to] = count[to - 1] + (not fused[to - 1])
        return count[n]


_COUNTERS: dict[str, Counter] = {}


def counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): pieces of each whole text.

    Blanks become word marks, one is put before the text, and each mark starts a chunk of its
    own.  Each distinct chunk of a batch is solved once.  Null and empty texts have 0;
    repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, "right")))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count_texts(part.column(1), path))], names=["doc_id", "n_tokens"])
                at = to
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")


def count_texts(texts: pa.Array, path: str) -> np.ndarray:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(vocabulary(path))
    texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    # a text that starts with a blank needs no mark before it: its first, empty part is no chunk
    blank = pc.starts_with(texts, " ").to_numpy(zero_copy_only=False)
    n, numbers, chunks = distinct_chunks(texts)
    firsts = np.cumsum(n) - n
    each = _COUNTERS[path].count([MARK + c for c in chunks.to_pylist()])[numbers]
    each[firsts[(empty | blank) & (n > 0)]] = 0
    total = np.concatenate([[0], np.cumsum(each)])
    return total[firsts + n] - total[firsts]


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(table(spark, sf_dir, "documents"))


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
