"""Arrow batches to byte arrays, and words found with array operations."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is handled alone.
CHUNK_BYTES = 2 << 20

#: ASCII white space: blank and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def release() -> None:
    """Give memory that a worker no longer uses back, so that the next stage's workers have it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's ``run``, which gives memory back when all that it held is free: idle workers stay beside the next stages'."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _POWERS.clear()
        release()

    return whole


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Yield (rows, bytes, offsets) with about ``limit`` bytes of text; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
        _, offs, data = whole.buffers()
        offs = np.frombuffer(offs, np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to
    release()


def words(data: np.ndarray, offs: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes that are not ``outside``, and each run's document.

    Runs never cross documents.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~outside[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offs[1:-1]
    cut = cut[cut < len(data)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


_BYTE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """Powers of ``base``; a worker keeps those for two chunks at most."""
    if n > 2 * CHUNK_BYTES:
        return powers(base, n)
    if len(_POWERS.get(name, ())) < max(n, 1):
        _POWERS[name] = powers(base, max(n, CHUNK_BYTES + 1))
    return _POWERS[name][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums h[i] over the bytes before i, for `span_hash`."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers("up", _R, len(data)), out=h[1:])
    return h


def span_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings between starts and ends; equal strings have equal hashes."""
    return mix((h[ends] - h[starts]) * _powers("down", _R_INV, len(h))[starts] + (ends - starts).astype(np.uint64))
