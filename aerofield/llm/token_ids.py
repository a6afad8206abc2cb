"""Token ids in binary files: a shared zstandard dictionary, documents compressed one by one."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._pieces import gather
from ._shared import fresh_dir, released, small_batches, table
from ._text import release, tidy

#: Documents that train the dictionary: those with the smallest hash of their id, and their leading ids.
SAMPLE_DOCS, SAMPLE_IDS = 1024, 1024
DICT_BYTES = 64 << 10
END_ID = 0
MAGIC = b"TOKIDS01"
#: Distinct words whose ids a worker remembers, and their bytes; beyond either it keeps those of the last texts, if they fit.
MEMORY, MEMORY_BYTES = 300_000, 16 << 20
#: Words the library encodes at once; one of more bytes than the second goes alone.
SPELL_WORDS, LONG_WORD = 1 << 14, 1 << 16
#: Texts encoded at once, in bytes, and of these the texts cut into words at once, which takes many times their size.
BATCH_BYTES, CUT_BYTES = 3 << 20, 1 << 19
#: Ids read back at once, unless one document has more.
READ_IDS = 1 << 20
#: Kinds of characters the pre-tokenizer tells apart.
LETTERS, DIGITS, SPACES, OTHERS = range(4)
BLANK, APOSTROPHE = 0x20, 0x27
#: What goes with an apostrophe, by its length; of two letters the first is shifted by 32 bits.
ENDINGS = {1: [ord(c) for c in "stmd"], 2: [ord(c[0]) << 32 | ord(c[1]) for c in ("re", "ve", "ll")]}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def kinds(words: Callable[[str], list]) -> np.ndarray:
    """The kind of every code point, by how the library's pre-tokenizer cuts a text of them.

    Unicode's versions differ in which letters and digits they know; none has any, nor white
    space, beyond plane 3.
    """
    out = np.full(0x110000, OTHERS, np.uint8)
    out[BLANK] = SPACES
    points = np.array([*range(BLANK), *range(BLANK + 1, 0xD800), *range(0xE000, 0x40000)])
    every = "".join(map(chr, points))
    for _, (lo, hi) in words(every):
        joined = [k for k, c in ((LETTERS, "a"), (DIGITS, "1"), (OTHERS, "!")) if len(words(c + every[lo] + c)) == 1]
        out[points[lo:hi]] = joined[0] if joined else SPACES
    return out


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(first, end) of neighbouring texts of at most ``limit`` bytes; a longer one goes alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


class Encoder:
    """Encodes whole texts with a byte-level BPE of the tokenizers library, each distinct word once.

    The pre-tokenizer's rule is applied to all code points of a batch at once; what kind of
    character each is, the library says.  Words it has not met yet are encoded many at a call.  As in the
    library, the strings of special tokens in a text are those tokens, unless ``special_as_text``.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = {} if special_as_text else self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"{path}: special tokens that take their surroundings in are not supported")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        #: the same model for single words: it spells their bytes and cuts nothing
        self.spelling = Tokenizer(self.tokenizer.model)
        self.spelling.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kinds = kinds(self.tokenizer.pre_tokenizer.pre_tokenize_str)
        #: words met, their ids one after the other, and each one's number of ids
        self.known = pa.array([], pa.large_string())
        self.ids, self.lens = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def keep(self, some: np.ndarray) -> None:
        """Forget all words but some."""
        self.known = self.known.take(pa.array(some))
        self.ids, self.lens = gather(self.ids, self.lens, some)

    def full(self) -> bool:
        return len(self.known) > MEMORY or self.known.nbytes > MEMORY_BYTES

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All texts' words as the pre-tokenizer cuts them, and each text's number of words.

        The rule: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
        """
        whole = texts.cast(pa.large_binary())
        _, offs, buffer = whole.buffers()
        offs = np.frombuffer(offs, np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = (np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8))[offs[0] : offs[-1]]
        offs = offs - offs[0]
        if not len(data):
            return self.known[:0], np.zeros(len(texts), np.int64)
        begins = np.zeros(len(data) + 1, bool)
        begins[offs] = True
        # code points, and which bytes begin one
        points, lead = data, slice(None)
        if data.max() > 0x7F:
            points, lead = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4"), (data & 0xC0) != 0x80
            if (begins[:-1] & ~lead).any():
                raise UnicodeError("a text is no UTF-8")
        size = len(points)
        kind = self.kinds[points]
        # a text's start; the two places after the last stand for one
        first = np.ones(size + 2, bool)
        first[:size] = begins[:-1][lead]
        start = first[: size + 1].copy()
        start[1:size] |= kind[1:] != kind[:-1]
        # the last of white space before something else is a word of its own, or leads the next if a blank
        last = np.flatnonzero((kind[:-1] == SPACES) & (kind[1:] != SPACES) & ~first[1:size])
        start[last] = True
        start[last + 1] = points[last] != BLANK
        # an apostrophe that starts a word, and the letters that go with it
        quote = np.flatnonzero(points == APOSTROPHE)
        quote = quote[start[quote] & ~first[quote + 1]]
        one, two = (points[np.minimum(quote + i, size - 1)].astype(np.int64) for i in (1, 2))
        short = np.isin(one, ENDINGS[1])
        long = ~first[quote + 2] & np.isin(one << 32 | two, ENDINGS[2])
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
        begins[:-1][lead] = start[:size]
        begins[-1] = True
        places = np.flatnonzero(begins)
        words = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
        return words, np.diff(np.searchsorted(places[:-1], offs))

    def spelled(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and each one's number of ids."""
        ids, lens = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        long = np.flatnonzero(pc.binary_length(words).to_numpy(zero_copy_only=False) > LONG_WORD)
        cuts = np.unique(np.concatenate([np.arange(0, len(words), SPELL_WORDS), long, long + 1, [len(words)]])).tolist()
        for lo, hi in pairwise(cuts):
            some = words[lo:hi].to_numpy(zero_copy_only=False).tolist()
            if hi - lo == 1:
                # without places in the text, which take most of the memory
                found = self.spelling.encode_batch_fast([some], is_pretokenized=True, add_special_tokens=False)[0].ids
                n = np.array([len(found)])
            else:
                e = self.spelling.encode(some, is_pretokenized=True, add_special_tokens=False)
                found, n = e.ids, np.bincount(np.array(e.word_ids, np.int64), minlength=len(some))
            ids.append(np.array(found, "<u4"))
            lens.append(n)
        return np.concatenate(ids), np.concatenate(lens)

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As `encode`, of texts in which no special token is looked for."""
        parts = [self.cut(texts.slice(at, to - at)) for at, to in slices(texts, CUT_BYTES)]
        # empty chunks are left out, as Arrow does
        coded = pa.chunked_array([x for x in (self.known, *(words for words, _ in parts)) if len(x)], self.known.type).dictionary_encode().chunks
        known = coded[-1].dictionary if coded else self.known
        ids, lens = self.spelled(known.slice(len(self.known)))
        self.known, self.ids, self.lens = known, np.concatenate([self.ids, ids]), np.concatenate([self.lens, lens])
        flat, sums, met = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], np.zeros(len(known), bool)
        found = iter(coded[len(coded) - sum(len(words) > 0 for words, _ in parts) :])
        for words, counts in parts:
            numbers = np.asarray(next(found).indices) if len(words) else np.zeros(0, np.int32)
            met[numbers] = True
            some, n = gather(self.ids, self.lens, numbers)
            ends = np.concatenate([[0], np.cumsum(n)])
            flat.append(some)
            sums.append(np.diff(ends[np.concatenate([[0], np.cumsum(counts)])]))
        if self.full():
            self.keep(np.flatnonzero(met))
        if self.full():
            self.keep(np.zeros(0, np.int64))
        return np.concatenate(flat), np.concatenate(sums)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, one after the other, and each text's number of ids."""
        marked = np.zeros(len(texts), bool)
        for content in self.added:
            marked |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self.plain(texts)
        # pieces, and between those of one text its special tokens
        cut = [self.specials.split(t) if m else [t] for t, m in zip(texts.to_pylist(), marked.tolist(), strict=True)]
        flat, n = self.plain(pa.array([p for c in cut for p in c[::2]], texts.type))
        pieces = np.array([len(c[::2]) for c in cut])
        ends = np.cumsum(pieces)
        followed = np.ones(len(n), bool)
        followed[ends - 1] = False
        flat = np.insert(flat, np.cumsum(n)[followed], [self.added[p] for c in cut for p in c[1::2]])
        return flat, np.add.reduceat(n + followed, ends - pieces)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def encoded(batches: Iterator[pa.RecordBatch], path: str, special_as_text: bool = False) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc ids, ids with end ids, their numbers by document) of batches of (doc_id, text)."""
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        for at, to in slices(texts, BATCH_BYTES):
            flat, n = encoder(path, special_as_text).encode(texts.slice(at, to - at))
            yield batch.column(0).slice(at, to - at), np.insert(flat, np.cumsum(n), END_ID).astype("<u4", copy=False), n + 1
            del flat, n
            release()


def packed(ids: np.ndarray) -> bytes:
    """Serialized ids: 16-bit where all fit, 32-bit else; the first byte is the width."""
    return b"\x02" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\x04" + ids.astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def trained(docs: DataFrame, path: str, special_as_text: bool = False) -> bytes:
    """A dictionary from a bounded sample: leading ids of the `SAMPLE_DOCS` documents of smallest hash."""
    sample = docs.select(F.col("doc_id").cast("long"), F.substring("text", 1, 4 * SAMPLE_IDS).alias("text")).orderBy(F.xxhash64("doc_id"), "text").limit(SAMPLE_DOCS).toArrow()
    pieces = [packed(x[:SAMPLE_IDS]) for b in sample.to_batches() for _, flat, n in encoded(iter([b]), path, special_as_text) for x in np.split(flat, np.cumsum(n)[:-1])]
    if sum(map(len, pieces)) < 8 * 1024 or len(pieces) < 16:
        return b""
    return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, pieces)) // 4), pieces).as_bytes()


# A file: each document's compressed ids; then the index: doc_id (and whether it has one), offset and
# number of ids of each; then magic, SHA-256 of the dictionary, number of documents, of ids, place of the index.
_HEAD = "<8s32sqqq"
_HEAD_BYTES = struct.calcsize(_HEAD)
INDEX = np.dtype([("doc_id", "<i8"), ("named", "?"), ("offset", "<i8"), ("ids", "<i8")])


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_files(docs: DataFrame, folder: str, path: str, order: list[Column] | None = None, special_as_text: bool = False) -> list[tuple[str, int, int]]:
    """Encode ``docs`` into files, in ascending doc_id or another ``order``; returns (name, documents, ids) of each, in order.

    Documents are dealt out by ranges of the order; those of one doc_id follow each other by a hash of
    their text, so that no id is bound to one task.  Every attempt of a task writes a file of
    its own name, and the list names the files of those that counted.
    """
    spark = docs.sparkSession
    fs, at = _open(folder)
    fs.create_dir(at)
    dictionary = trained(docs, path, special_as_text)
    with fs.open_output_stream(f"{at}/dictionary.zdict") as f:
        f.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    order = order or [F.col("doc_id").cast("long"), F.xxhash64("text")]
    places = [f"place{i}" for i in range(len(order))]
    d = docs.select(F.col("doc_id").cast("long"), "text", *(c.alias(k) for c, k in zip(order, places, strict=True)))
    ways = [F.col(k).asc_nulls_last() for k in places]
    ranged = d.repartitionByRange(max(1, d.rdd.getNumPartitions()), *ways).sortWithinPartitions(*ways).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(shared.value) if shared.value else None, write_content_size=True)
        fs, at = _open(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
        index, total, place = [], 0, 0
        with fs.open_output_stream(f"{at}/{name}") as f:
            for keys, flat, n in encoded(batches, path, special_as_text):
                rows = np.zeros(len(n), INDEX)
                rows["doc_id"], rows["named"], rows["ids"] = pc.fill_null(keys, 0).to_numpy(), pc.is_valid(keys).to_numpy(zero_copy_only=False), n
                for i, x in enumerate(np.split(flat, np.cumsum(n)[:-1])):
                    data = pack.compress(packed(x))
                    rows["offset"][i] = place
                    place += f.write(data)
                index.append(rows)
                total += int(n.sum())
            index = np.concatenate(index) if index else np.zeros(0, INDEX)
            f.write(index.tobytes())
            f.write(struct.pack(_HEAD, MAGIC, hashlib.sha256(shared.value).digest(), len(index), total, place))
        if len(index):
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(index)]), pa.array([total])], names=["name", "docs", "ids"])
        else:
            fs.delete_file(f"{at}/{name}")

    with released(spark), small_batches(spark, BATCH_BYTES):
        found = ranged.mapInArrow(tidy(run), "name string, docs long, ids long").collect()
    return sorted(tuple(r) for r in found)


class TokenFile:
    """One file: its index, and any document's ids without reading the others'."""

    def __init__(self, folder: str, name: str) -> None:
        fs, at = _open(folder)
        with fs.open_input_stream(f"{at}/dictionary.zdict") as f:
            dictionary = f.read()
        self.file = fs.open_input_file(f"{at}/{name}")
        size = self.file.size()
        self.file.seek(size - _HEAD_BYTES)
        magic, known, docs, self.ids, self.place = struct.unpack(_HEAD, self.file.read(_HEAD_BYTES))
        if magic != MAGIC or known != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was not written with this dictionary")
        self.file.seek(self.place)
        self.index = np.frombuffer(self.file.read(docs * INDEX.itemsize), INDEX)
        self.unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def document(self, i: int) -> np.ndarray:
        start = int(self.index["offset"][i])
        stop = int(self.index["offset"][i + 1]) if i + 1 < len(self.index) else self.place
        self.file.seek(start)
        return unpacked(self.unpack.decompress(self.file.read(stop - start)))


def read_files(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of token files, in order of the files."""
    starts = np.concatenate([[0], np.cumsum([n for _, _, n in files], dtype=np.int64)])
    listed = [(name, int(s)) for (name, _, _), s in zip(files, starts, strict=False)]
    manifest = spark.createDataFrame(listed, "name string, start long").repartition(max(1, len(listed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                f = TokenFile(folder, name)
                at = start + np.cumsum(f.index["ids"]) - f.index["ids"]
                lo = 0
                while lo < len(f.index):
                    hi = max(lo + 1, int(np.searchsorted(at, at[lo] + READ_IDS)))
                    rows = f.index[lo:hi]
                    each = [f.document(i).tobytes() for i in range(lo, hi)]
                    yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], mask=~rows["named"]), pa.array(at[lo:hi]), pa.array(rows["ids"]), pa.array(each, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                    lo = hi

    return manifest.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, path: str | None = None, order: list[Column] | None = None, special_as_text: bool = False) -> DataFrame:
    """Write ``docs`` to token files in the shared folder, in ascending doc_id or another ``order``, and read them back.

    (doc_id, start, n_tokens, ids): ids are little-endian unsigned 32-bit integers, the
    end id 0 last.  Null texts are empty; nulls come last in the order; repeated rows are
    documents of their own; an empty table gives no rows; other columns are ignored.  A special
    token's string in a text is that token, as in the library, unless ``special_as_text``.
    """
    folder = fresh_dir(docs.sparkSession, "tokens")
    return read_files(docs.sparkSession, folder, write_files(docs, folder, path or vocabulary_path(), order, special_as_text))


def digest(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(token_files(table(spark, sf_dir, "documents")))


QUERIES = {"op6_token_files": op6_token_files}
ORACLES: dict[str, str] = {}
