"""Small binary files in the shared folder, for tasks that answer each other."""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow.fs as pafs
import zstandard


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def put(folder: str, name: str, data: bytes) -> None:
    """Write a file that appears under its name only when it is whole.

    All attempts of a task write the same bytes, so the first file under a name stays.
    """
    fs, at = opened(folder)
    own = f"{at}/.{name}-{uuid.uuid4().hex}"
    there = lambda: fs.get_file_info(f"{at}/{name}").type != pafs.FileType.NotFound
    if there():
        return
    with fs.open_output_stream(own) as f:
        f.write(data)
    try:
        fs.move(own, f"{at}/{name}")
    except OSError:
        if not there():
            raise
        fs.delete_file(own)


def get(folder: str, name: str) -> bytes:
    fs, at = opened(folder)
    with fs.open_input_stream(f"{at}/{name}") as f:
        return f.read()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes: the k-th bytes of all entries lie together."""
    raw = [(a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(raw))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(-1, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind) for kind, n, b in raw]
