import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from aerofield.llm import suffix_dedup as S
from aerofield.llm._text import prefix_hash, span_hash


def brute(texts, n=S.LENGTH):
    seen = Counter()
    for t in texts:
        b = (t or "").encode()
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = [i for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((len(b), len(spans), bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def run(df):
    return {r.doc_id: (r.n_bytes, len(r.spans), bytes(r.kept)) for r in S.without_repeats(df).collect()}


def check(docs_of, texts, parts=None):
    df = docs_of(texts)
    got = run(df.repartition(parts) if parts else df)
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_matches_brute_force(docs_of, prose):
    check(docs_of, prose)


def test_edges_of_repeats(docs_of):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefg é") for _ in range(n))
    p, q = text(260), text(199)
    texts = [text(50) + p + text(50), text(9) + p[30:] + text(70), p[:215] + text(5), q, q, text(10) + q + "x", text(20) + q + "x", "a" * 450, "ab" * 200, p[3:240] + p[5:230], text(400), None, "", p.replace("a", "A", 1)]
    texts += [text(rng.randint(0, 60)) + p[rng.randint(0, 40) : rng.randint(220, 260)] + text(rng.randint(0, 60)) for _ in range(25)]
    check(docs_of, texts)


def test_neighbouring_documents_do_not_run_together(docs_of):
    rng = random.Random(6)
    p = "".join(rng.choice("abcdefgh") for _ in range(250))
    check(docs_of, [p, p, p, p[:249], "z" + p[1:]])


def test_edge_rows(spark, docs_of):
    long = "word " * 60
    got = S.without_repeats(docs_of([], [(None, long, None, None, None), (3, long, None, None, None), (3, None, None, None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in got) == [(0, 300, 0), (3, 0, 0), (3, 300, 0)]
    assert S.without_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree_merge(k):
    rng = random.Random(k)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 30))) for _ in range(k)]
    shared = [S.front_coded(r)[0].tolist() for r in runs]
    order, lengths = S.merged(runs, shared) if k else ([], [])
    flat = [x for r in runs for x in r]
    out = [flat[i] for i in order]
    assert out == sorted(flat)
    prefix = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    assert lengths == [prefix(a, b) for a, b in zip([b"", *out], out, strict=False)]


def test_front_coding_round_trip():
    import numpy as np

    runs = sorted([b"", b"a", b"ab", b"ab", b"abc", b"b"])
    shared, rest = S.front_coded(runs)
    assert S.front_decoded(shared.astype(np.int64), np.array([len(r) for r in runs]), rest) == runs


def test_segments_match_brute_force(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in (0, 700, 3, 200, 199, 201, 0, 450, 40)] + ["a" * 500, "ab" * 300, ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h = prefix_hash(data)
    at = np.arange(len(data) - S.GRAM + 1)
    key = span_hash(h, at, at + S.GRAM) >> np.uint64(S.PLACE_BITS)
    want = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        before = None
        for w in range(a, b - S.LENGTH + 1):
            anchor = w + int(np.argmin(key[w : w + S.LENGTH - S.GRAM + 1]))
            if anchor == before:
                want[-1][1] = w
            else:
                want.append([w, w, anchor])
            before = anchor
    assert [list(x) for x in zip(*(x.tolist() for x in S.segments(data, offs, h, S.LENGTH, S.GRAM)), strict=True)] == want
    whole = S.anchors_of(h, S.LENGTH, S.GRAM)
    monkeypatch.setattr(S, "PLACE_BITS", 8)  # strips of 156 windows: the same anchors, as no hashes are near
    assert np.array_equal(S.anchors_of(h, S.LENGTH, S.GRAM), whole)


def test_segments_are_found_strip_by_strip():
    """Passes over the hashes of a whole block took seven times as long (0.2 s for 3 MB)."""
    data = np.random.default_rng(3).integers(97, 123, 1 << 20).astype(np.uint8)
    h, offs = prefix_hash(data), np.array([0, len(data)])
    S.segments(data, offs, h, S.LENGTH, S.GRAM)
    tracemalloc.start()
    S.segments(data, offs, h, S.LENGTH, S.GRAM)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(data)


@pytest.mark.parametrize("spans", [[], [(5, 9, 20)], [(0, 3, 10), (4, 4, 11), (30, 31, 40), (241, 243, 250)]])
def test_suspects_keep_their_text(spans):
    from aerofield.llm import _files

    data = np.random.default_rng(3).integers(97, 123, 500).astype(np.uint8)
    lo, hi, anchor = (np.array([x[k] for x in spans], np.int64) for k in range(3))
    kept, place, shift, *moved = _files.unpack(S.Suspects.packed(data, lo, hi, anchor, 200))
    for a, b, c, x, y, z in zip(lo, hi, anchor, *moved, strict=True):
        assert kept[x : y + 200].tobytes() == data[a : b + 200].tobytes() and z - x == c - a
        assert x + shift[np.searchsorted(place, x, "right") - 1] == a
    assert len(kept) == len({i for a, b, _ in spans for i in range(a, b + 200)})
