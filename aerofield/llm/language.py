"""Language identification by multilingual mixtures of n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table
from ._text import CHUNK_BYTES, LOWER, text_chunks, tidy

#: Byte n-grams are counted in so many buckets, or fewer where a model would have more than `NUMBERS` numbers in all.
GRAM, BUCKETS, NUMBERS = 3, 1 << 16, 1 << 24
#: Part of each language's probability that is spread evenly over all buckets.
EVEN = 0.05
#: Rounds of expectation-maximisation at most, and the change of a text's proportions that ends its own.
ROUNDS, STILL = 25, 1e-3
#: The penalty of each language of a set past the first, in units of ln(n-grams) / 2.
PENALTY = 8.0
#: A language with less of the text is no candidate for its set.
LEAST_SHARE = 0.05
UNKNOWN = "und"
#: The pipeline keeps a text whose main language has this share.
KEEP_SHARE = 0.5
#: Counts that a learning task holds before it hands them on.
HELD = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def held_out(modulus: int, doc_id: Column | None = None) -> Column:
    """Whether crc32 of doc_id as text leaves 1; a null doc_id is never held out."""
    key = F.col("doc_id") if doc_id is None else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % modulus == 1, F.lit(False))


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams that hold a letter, in lower case, other ASCII as blanks; and their documents."""
    low = LOWER[data]
    letter = _LETTER[low]
    low = np.where(letter, low, 0x20).astype(np.uint32)
    n = len(low) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, some = np.zeros(n, np.uint32), np.zeros(n, bool)
    for i in range(GRAM):
        code = (code << np.uint32(8)) | low[i : n + i]
        some |= letter[i : n + i]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    some &= doc[:n] == doc[GRAM - 1 :]
    return ((code[some] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), doc[:n][some]


def padded(data: np.ndarray, offs: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with a blank at both ends of documents ``some``."""
    at = np.sort(np.concatenate([offs[:-1][some], offs[1:][some]]))
    return np.insert(data, at, 0x20), offs + 2 * np.concatenate([[0], np.cumsum(some)])


class Model(NamedTuple):
    """Languages in code-point order, each one's n-grams in training, and log probabilities of the buckets."""

    langs: list[str]
    sizes: np.ndarray
    logp: np.ndarray

    def chunk_bytes(self) -> int:
        """Bytes of text that are judged at once: fewer for many languages."""
        return max(1 << 16, CHUNK_BYTES * 4 // (4 + len(self.langs)))


def buckets_for(langs: int) -> int:
    """A power of two of which ``langs`` times as many are no more than `NUMBERS`, but 64 at least."""
    return max(64, min(BUCKETS, 1 << (NUMBERS // max(1, langs)).bit_length() - 1))


def learn(docs: DataFrame) -> Model:
    """A model from all of ``docs`` with a lang; without any it has no language.

    Null and empty texts add nothing but their language's name; repeated rows count each time.
    """
    found = docs.where("lang is not null").select("text", "lang")
    langs = sorted(r.lang for r in found.select("lang").distinct().collect())
    number, buckets = {x: i for i, x in enumerate(langs)}, buckets_for(len(langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for rows, data, offs in text_chunks(batches, limit=CHUNK_BYTES // 2):
            bucket, doc = grams(data, offs)
            coded = rows.column("lang").dictionary_encode()
            of = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[np.asarray(coded.indices)]
            new, n = np.unique(of[doc] * buckets + bucket % buckets, return_counts=True)
            codes, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(codes)).astype(np.int64)
            if len(codes) > HELD:
                yield out()
                codes, counts = codes[:0], counts[:0]
        yield out()

    t = found.mapInArrow(tidy(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(langs) * buckets)
    n[t["code"].to_numpy()] = t["n"].to_numpy()
    n = n.reshape(len(langs), buckets)
    sizes = n.sum(axis=1)
    p = (1 - EVEN) * n / np.maximum(sizes, 1)[:, None] + EVEN / buckets
    return Model(langs, sizes, np.log(p).astype(np.float32))


def shares(p: np.ndarray, n: np.ndarray, heads: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Each document's proportions of the columns of p, the likelihoods of its n-grams, which occur n times; each document stops by itself."""
    total = np.add.reduceat(n, heads)[:, None]
    share = np.full((len(heads), p.shape[1]), 1 / p.shape[1], np.float32)
    moving = np.ones((len(heads), 1), bool)
    for _ in range(ROUNDS):
        r = p * share[doc]
        r *= (n / r.sum(axis=1))[:, None]
        new = np.add.reduceat(r, heads) / total
        moved = np.abs(new - share).max(axis=1, keepdims=True)
        share = np.where(moving, new, share)
        moving &= moved >= STILL
        if not moving.any():
            break
    return share


def identify(bucket: np.ndarray, doc: np.ndarray, docs: int, model: Model) -> list[list[tuple[int, float]]]:
    """The languages of each document with their proportions, largest first; none without n-grams.

    Expectation-maximisation over all languages and an even distribution over all buckets, which takes
    what no language explains, gives proportions.  Sets of the largest one, two, three, ...
    languages (each with the even distribution) are fitted anew, and of these the last is chosen whose log likelihood,
    less a penalty for each language past the first, is above that of the one before.  Of languages
    with equal proportions the one of more training text comes first.
    """
    out: list[list[tuple[int, float]]] = [[] for _ in range(docs)]
    n_langs, buckets = model.logp.shape if len(model.langs) else (0, BUCKETS)
    if not len(bucket) or not n_langs:
        return out
    code, n = np.unique(doc * buckets + bucket % buckets, return_counts=True)
    bucket, doc = code % buckets, code // buckets
    here, heads, doc = np.unique(doc, return_index=True, return_inverse=True)
    n = n.astype(np.float32)
    total = np.add.reduceat(n, heads)
    p = np.column_stack([np.exp(model.logp.T[bucket]), np.full(len(bucket), 1 / buckets, np.float32)])
    every = shares(p, n, heads, doc)[:, :n_langs]
    by_size = np.argsort(-model.sizes, kind="stable")
    order = by_size[np.argsort(-every[:, by_size], axis=1, kind="stable")]
    value = np.full(len(here), -np.inf)
    open_ = np.arange(len(here))
    for k in range(1, n_langs + 1):
        if k > 1:
            open_ = open_[np.take_along_axis(every[open_], order[open_, k - 1 : k], 1)[:, 0] >= LEAST_SHARE]
        if not len(open_):
            break
        place = np.full(len(here), -1)
        place[open_] = np.arange(len(open_))
        row = np.flatnonzero(place[doc] >= 0)
        nk, dk = n[row], place[doc[row]]
        members = np.column_stack([order[open_, :k], np.full(len(open_), n_langs)])
        pk = np.take_along_axis(p[row], members[dk], 1)
        hk = np.unique(dk, return_index=True)[1]
        got = shares(pk, nk, hk, dk)
        fit = np.add.reduceat(nk * np.log((pk * got[dk]).sum(axis=1)), hk) - PENALTY * (k - 1) * np.log(total[open_]) / 2
        better = fit > value[open_]
        for i in np.flatnonzero(better).tolist():
            out[here[open_[i]]] = sorted(zip(members[i, :k].tolist(), got[i, :k].tolist(), strict=True), key=lambda x: -x[1])
        open_ = open_[better]
        value[open_] = fit[better]
    return out


def _lettered(rows: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(rows.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _judged(rows: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, model: Model) -> list[list[tuple[int, float]]]:
    lettered = _lettered(rows)
    found = identify(*grams(*padded(data, offs, lettered & (np.diff(offs) < GRAM))), rows.num_rows, model)
    return [x if known else [] for x, known in zip(found, lettered, strict=True)]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row: the main language of the chosen set and its share of the text.

    ``languages`` lists the set with each one's share; what is left to 1 is text that no language of it
    explains.  Null texts and texts without a letter are "und" with score 0 and no languages, as is everything
    when the model has none.  Lettered texts too short for an n-gram are judged with a blank at both ends.
    Ties go to the language of more training text; repeated rows stay; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, data, offs in text_chunks(batches, limit=m.chunk_bytes()):
            found = [[{"lang": m.langs[i], "share": min(max(x, 0.0), 1.0)} for i, x in s] for s in _judged(rows, data, offs, m)]
            lang, score = [s[0]["lang"] if s else UNKNOWN for s in found], [s[0]["share"] if s else 0.0 for s in found]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(found, kind)], names=["doc_id", "lang_pred", "score", "languages"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")


def drop_rejected(docs: DataFrame, model: Model, least: float = KEEP_SHARE) -> DataFrame:
    """``docs`` without texts that have no language, or whose main language has less than ``least`` of them.

    Null texts, and texts without a letter, go; a model without languages rejects only those.  Each row is
    judged by its text alone, so repeated rows stay or go together; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows, data, offs in text_chunks(batches, limit=m.chunk_bytes()):
            keep = [bool(s) and s[0][1] >= least for s in _judged(rows, data, offs, m)] if m.langs else _lettered(rows)
            yield rows.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, learn(docs.where(~held_out(3))))
    return out.select("doc_id", held_out(3).alias("held_out"), "lang_pred", "score", "languages")


QUERIES = {"op8_language_id": op8_language_id}
ORACLES: dict[str, str] = {}
