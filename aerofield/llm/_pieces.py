"""Texts as sequences of blank-separated chunks, each distinct chunk handled once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def gather(values: np.ndarray, lens: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate variable-length entries of ``values`` in the order ``pick``; also their lengths."""
    n = lens[pick]
    # place of each value: a step of one, but for the jump at each entry's start
    first, ends = (np.cumsum(lens) - lens)[pick], np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    step = np.ones(total, np.int32)
    some = n > 0
    first, start, last = first[some], (ends - n)[some], (first + n)[some]
    if total:
        step[start] = first - np.concatenate([[0], last[:-1] - 1])
        np.cumsum(step, out=step)
    return values[step], n


def distinct_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(chunks of each text, each chunk's number, distinct chunks): texts split at each blank."""
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    return np.diff(np.asarray(parts.offsets)), np.asarray(coded.indices), coded.dictionary
