"""The items of JSON documents' lists, one by one: a document of any length is never held whole."""

from __future__ import annotations

import json
import pickle
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters read at a time, and characters of items in a row.
CHUNK = 1 << 20
_SPACE = re.compile(r"[ \t\r\n\ufeff]*")
_DECODE = json.JSONDecoder(parse_int=str, parse_float=str).raw_decode


class _Text:
    """Text that comes in parts, and how far it has been read."""

    def __init__(self, parts: Iterator[str]) -> None:
        self.parts, self.buf, self.at, self.done = parts, "", 0, False

    def more(self) -> None:
        """Read on, doubling what is held, so that a long value is tried a few times only."""
        held = [self.buf[self.at :]]
        n, enough = len(held[0]), 2 * len(held[0]) + CHUNK
        while n < enough and not self.done:
            part = next(self.parts, None)
            self.done = part is None
            held.append(part or "")
            n += len(held[-1])
        self.buf, self.at = "".join(held), 0

    def peek(self) -> str:
        """The next character that is no space, "" at the end."""
        while True:
            self.at = _SPACE.match(self.buf, self.at).end()
            if self.at < len(self.buf) or self.done:
                return self.buf[self.at : self.at + 1]
            self.more()

    def take(self, *one_of: str) -> str:
        c = self.peek()
        if c not in one_of:
            raise ValueError(f"{c!r} where {' or '.join(one_of)} should stand")
        self.at += 1
        return c

    def value(self) -> str:
        """The text of the next value, whatever it is."""
        self.peek()
        while True:
            try:
                end = _DECODE(self.buf, self.at)[1]
            except json.JSONDecodeError:
                if self.done:
                    raise
                end = len(self.buf)
            if self.done or (end < len(self.buf) and self.buf[end] not in ".eE"):  # a number may go on
                text, self.at = self.buf[self.at : end], end
                return text
            self.more()


def _list(t: _Text) -> Iterator[str]:
    t.take("[")
    if t.peek() == "]":
        t.take("]")
        return
    while True:
        yield t.value()
        if t.take(",", "]") == "]":
            return


def _object(t: _Text, names: tuple[str, ...]) -> Iterator[tuple[str, str | None]]:
    t.take("{")
    if t.peek() == "}":
        t.take("}")
        return
    while True:
        key = json.loads(t.value())
        t.take(":")
        if key in names and t.peek() == "[":
            yield key, None
            yield from ((key, item) for item in _list(t))
        else:
            t.value()
        if t.take(",", "}") == "}":
            return


def walk(parts: Iterator[str], names: tuple[str, ...]) -> Iterator[tuple[str, str | None]]:
    """(name, text) of each item of the lists ``names`` of a document, and (name, None) where a list starts.

    A document is an object, or a list of objects.  What is no JSON raises.
    """
    t = _Text(parts)
    if t.peek() != "[":
        if t.peek():
            yield from _object(t, names)
        return
    t.take("[")
    if t.peek() == "]":
        return
    while True:
        if t.peek() == "{":
            yield from _object(t, names)
        else:
            t.value()
        if t.take(",", "]") == "]":
            return


def grouped(parts: Iterator[str], names: tuple[str, ...]) -> Iterator[tuple[int, list[str]]]:
    """(ordinal of the first, items) in groups of about `CHUNK` characters, of the first of ``names`` that is a list.

    Lists of later names wait in a file until it is known that no earlier one comes.
    """
    with tempfile.TemporaryFile() as waiting:
        seen: set[str] = set()
        state = {name: [0, [], 0] for name in names}

        def groups() -> Iterator[tuple[str, int, list[str]]]:
            for name, item in walk(parts, names):
                s = state[name]
                if item is None or s[2] > CHUNK:
                    if s[1]:
                        yield name, s[0], s[1]
                    s[:] = [0 if item is None else s[0] + len(s[1]), [], 0]
                    seen.add(name)
                if item is not None:
                    s[1].append(item)
                    s[2] += len(item)
            yield from ((name, s[0], s[1]) for name, s in state.items() if s[1])

        for name, first, items in groups():
            if name == names[0]:
                yield first, items
            else:
                pickle.dump((name, first, items), waiting)
        if names[0] in seen or not seen:
            return
        chosen = next(name for name in names if name in seen)
        end = waiting.tell()
        waiting.seek(0)
        while waiting.tell() < end:
            name, first, items = pickle.load(waiting)
            if name == chosen:
                yield first, items


def split(documents: DataFrame, parts: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[str, Iterator[str]]]], names: tuple[str, ...], required: bool = False) -> DataFrame:
    """(document, ord, item): the text of each item; a document without any raises if they are ``required``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for document, text in parts(batches):
            n = 0
            try:
                for first, items in grouped(text, names):
                    n += len(items)
                    yield pa.RecordBatch.from_arrays([pa.array([document], pa.string()), pa.array([first], pa.int32()), pa.array([items], pa.list_(pa.string()))], names=["document", "first", "items"])
            except ValueError as e:
                raise ValueError(f"{document}: {e}") from e
            if required and not n:
                raise ValueError(f"{document} has no records")

    rows = documents.mapInArrow(run, "document string, first int, items array<string>")
    rows = rows.repartition(documents.sparkSession.sparkContext.defaultParallelism)
    return rows.select("document", "first", F.posexplode("items").alias("place", "item")).select("document", (F.col("first") + F.col("place")).alias("ord"), "item")


def of_files(spark: SparkSession, path: str, names: tuple[str, ...], required: bool = False) -> DataFrame:
    """(document, ord, item) of each file at ``path``, a task each.

    Spark reads the files in blocks; what separates their rows here, "},", ends no JSON document.
    """
    at = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.option("lineSep", "},").text(path).select(F.col("_metadata.file_path").alias("document"), at.alias("at"), "value")
    lines = lines.repartition("document").sortWithinPartitions("document", "at").select("document", "value")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[str]]]:
        rows = ((d, v) for b in batches for d, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        ahead = next(rows, None)
        while ahead is not None:
            document = ahead[0]

            def one(document: str = document) -> Iterator[str]:
                nonlocal ahead
                start = ""
                while ahead is not None and ahead[0] == document:
                    yield start + ahead[1]
                    start, ahead = "},", next(rows, None)

            text = one()
            yield document, text
            for _ in text:  # what follows the document's end
                pass

    return split(lines, parts, names, required)


def of_column(documents: DataFrame, column: str, key: str, names: tuple[str, ...]) -> DataFrame:
    """(document, ord, item) of the documents that a column holds; column ``key`` is their name."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[str]]]:
        for b in batches:
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is not None:
                    yield k, iter([text])

    return split(documents.select(F.col(key).cast("string").alias("document"), column), parts, names)
