import numpy as np
import pytest
import xxhash

from aerofield.llm import simhash


def brute(texts):
    fps = []
    for t in texts:
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()]
        sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    comp = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            comp[i] = min(comp[j] for j, b in enumerate(fps) if bin(a ^ b).count("1") <= 3)
    return fps, comp


def test_matches_brute_force(spark, docs_of, prose):
    fps, comp = brute(prose)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_groups(docs_of(prose)).collect()}
    assert got == {i: (fps[i], comp[i]) for i in range(len(prose))}


def test_trie_links_find_all_pairs():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 300, np.int64).astype(np.uint64)
    near = [x ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for x, i, j in zip(a[:100], rng.integers(0, 64, 100), rng.integers(0, 64, 100), strict=True)]
    a = np.unique(np.concatenate([a, near]).astype(np.uint64))
    r = np.array([[0, len(a)]])
    i, j = (np.concatenate(x) for x in zip(*simhash.trie_links(a, r, a, r, np.array([1]), 0, 3), strict=True))
    want = {(p, q) for p in range(len(a)) for q in range(p + 1, len(a)) if bin(int(a[p] ^ a[q])).count("1") <= 3}
    assert {tuple(sorted(x)) for x in zip(i.tolist(), j.tolist(), strict=True)} == want


def test_chain_links_through_subtries(spark, monkeypatch):
    fps = [0, 0b111, 0b111 << 60 | 0b111, 0b11 << 30 | 0b111 << 60 | 0b111, 0b1111 << 20]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from aerofield.llm._components import components

    got = {r.node: r.root for r in components(simhash.links(df)).collect()}
    assert len(got) == 4 and len(set(got.values())) == 1


@pytest.mark.parametrize(("chunk", "held", "budget"), [(3, 8, 0), (3, 8, 3), (1024, 1 << 16, 5)])
def test_links_connect_what_brute_force_does(spark, monkeypatch, chunk, held, budget):
    """Small chunks make nodes that span chunks, batches and tasks."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "HELD", held)
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    fps = {x for x in base} | {base[0] ^ 1 << int(i) ^ 1 << int(j) for i, j in rng.integers(0, 64, (80, 2))} | {x ^ sum(1 << int(i) for i in rng.integers(0, 64, rng.integers(1, 8))) for x in base}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").repartition(4)
    got = {}
    for r in simhash.classes(df, budget).collect():
        got.setdefault(r.root, set()).add(r.fp % (1 << 64))
    comp = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= budget and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    want = {}
    for f, c in comp.items():
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_edge_rows(spark, docs_of):
    got = simhash.near_groups(docs_of([], [(None, "a b c", None, None, None), (7, None, None, None, None), (7, None, None, None, None), (9, "", "x", None, 1)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got if r.doc_id) == [(False, 7, 7), (False, 7, 7), (False, 9, 7)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash.near_groups(docs_of([])).count() == 0


def test_keep_one(spark, docs_of):
    kept = simhash.keep_one(docs_of(["a b c d", "A b c d", "other words here now", None, ""]).withColumn("fp", __import__("pyspark").sql.functions.lit(1)))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]


def test_keep_one_goes_by_rows(spark):
    """A repeated doc_id never takes another text with it, and of equal rows one stays."""
    rows = [(3, "a a a"), (5, "a a a"), (5, "quite another text it is"), (7, "same words here twice"), (7, "same words here twice"), (None, "a a a"), (None, "nobody else has this one"), (None, "nobody else has this one")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in kept.collect()) == [((False, 3), "a a a"), ((False, 5), "quite another text it is"), ((False, 7), "same words here twice"), ((True, 0), "nobody else has this one")]
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
