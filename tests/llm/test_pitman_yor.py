import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerofield.llm import _stirling as S
from aerofield.llm import pitman_yor as P


def scored(docs):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return P.score(docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))).collect()


def test_base_figures_match_brute_force(spark, docs_of, prose):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(prose)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in scored(docs_of(prose))}
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_sum_to_one():
    """Over all known words and the unknown one, in the parent and in a context."""
    rng = np.random.default_rng(2)
    c = rng.integers(1, 40, 60)
    t = np.minimum(c, rng.integers(1, 6, 60))
    base = P.Base(*np.unique(c, return_counts=True))
    assert base.known * 60 + base.unknown == pytest.approx(1)
    p = P.Parent(base, c.sum(), t.sum()).probability(c, t)
    assert p.sum() == pytest.approx(1)
    own = np.append(np.where(rng.random(60) < 0.5, c, 0), 0)
    tables = np.minimum(own, np.append(t, 0))
    assert P.predictive(own, tables, p, own.sum(), tables.sum()).sum() == pytest.approx(1)


def test_table_draws_have_the_exact_distribution():
    """Few customers against all seatings one by one; many against the recurrence carried further."""
    d, rate, n = 0.6, 0.5, 20000
    u = (np.arange(n) + 0.5) / n
    weight = {1: (1 - d) * (2 - d) * d * rate, 2: 3 * (1 - d) * (d * rate) ** 2, 3: (d * rate) ** 3}
    got = S.draw_tables(np.full(n, 3), np.full(n, rate), u, d)
    for t, x in weight.items():
        assert (got == t).mean() == pytest.approx(x / sum(weight.values()), abs=1e-3)
    for d in (P.DISCOUNT, P.PARENT_DISCOUNT):
        logs = S.recurrence(d, 700)
        for c in (257, 700):
            for rate in (0.01, 3.0, 60.0, 250.0, 900.0):
                t = np.arange(1, c + 1)
                w = t * np.log(d * rate) + logs[c, 1 : c + 1]
                want = np.cumsum(np.exp(w - w.max()))
                got = S.draw_tables(np.full(n, c), np.full(n, rate), u, d)
                far = np.abs(np.bincount(got, minlength=c + 1)[1:].cumsum() / n - want / want[-1]).max()
                assert far < (1e-3 if got.max() < c**d else 0.03), (d, c, rate)


def test_huge_counts_stay_in_bounds():
    c, rate = np.array([1, 2, 10**6, 10**9, 10**12, 10**6]), np.array([1e-9, 1e-9, 1e4, 1e5, 1e-6, 2e6])
    t = S.draw_tables(c, rate, np.full(6, 0.5), P.DISCOUNT)
    assert (t >= 1).all() and (t <= c).all() and t[2] == pytest.approx(1e4, rel=0.1) and t[4] == 1


def test_edge_rows(spark, docs_of):
    got = scored(docs_of([], [(None, None, None, None, None), (None, "a b", None, None, None), (4, "a a", None, None, 0), (4, "a a", None, None, 0)]))
    assert sorted(r.n_tokens for r in got) == [1, 3, 3, 3] and {r.train_tokens for r in got} == {10}
    assert scored(docs_of([])) == []
    alone = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][0]
    (r,) = scored(docs_of([], [(alone, "only held out", None, None, None)]))
    assert (r.n_known, r.train_tokens, r.score) == (0, 0, 0.0) and r.held_out


def seated(train, sweeps, burn_in, base, rng):
    """Mean predictive probabilities by seating customer by customer, at tables of their own sizes, in both levels."""
    top, low = {}, {}
    size = lambda r: (sum(map(sum, r.values())), sum(map(len, r.values())))

    def above(w):
        c, t = size(top)
        own = top.get(w, [])
        return (sum(own) - P.PARENT_DISCOUNT * len(own) + (P.PARENT_STRENGTH + P.PARENT_DISCOUNT * t) * (base.unknown if w == "?" else base.known)) / (P.PARENT_STRENGTH + c)

    def leave(own):
        k = rng.choices(range(len(own)), own)[0]
        own[k] -= 1
        if not own[k]:
            own.pop(k)
            return True
        return False

    def sit(r, w, new, d):
        own = r.setdefault(w, [])
        k = rng.choices(range(len(own) + 1), [*(n - d for n in own), new])[0]
        if k == len(own):
            own.append(1)
            return True
        own[k] += 1
        return False

    def enter(u, w):
        r = low.setdefault(u, {})
        if sit(r, w, (P.STRENGTH + P.DISCOUNT * size(r)[1]) * above(w), P.DISCOUNT):
            sit(top, w, (P.PARENT_STRENGTH + P.PARENT_DISCOUNT * size(top)[1]) * base.known, P.PARENT_DISCOUNT)

    for u, w in train:
        enter(u, w)
    sums = {}
    for k in range(sweeps):
        for u, w in train:
            if leave(low[u][w]):
                leave(top[w])
            enter(u, w)
        if k >= burn_in:
            for u in [*low, "?"]:
                r = low.get(u, {})
                c, t = size(r)
                for w in [*top, "?"]:
                    own = r.get(w, [])
                    sums[u, w] = sums.get((u, w), 0) + (sum(own) - P.DISCOUNT * len(own) + (P.STRENGTH + P.DISCOUNT * t) * above(w)) / (P.STRENGTH + c)
    return {k: x / (sweeps - burn_in) for k, x in sums.items()}


@pytest.mark.parametrize("hot", [P.HOT, 2.0])
def test_scores_match_a_sampler_of_single_customers(spark, docs_of, monkeypatch, hot):
    """Contexts spread over buckets (all of them here) or whole."""
    monkeypatch.setattr(P, "BURN_IN", 5)
    monkeypatch.setattr(P, "KEPT", 10)
    monkeypatch.setattr(P, "HOT", hot)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in np.where(rng.random(30) < 0.3, 0, rng.zipf(1.4, 30) % 30)) for _ in range(25)]
    tokens = [[*t.split(), None] for t in texts]
    train = [t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in train for w in t)
    base = P.Base(*(np.array(x) for x in zip(*sorted(Counter(count.values()).items()), strict=True)))
    pairs = lambda t: zip(["start", *t], t, strict=False)
    p = seated([x for t in train for x in pairs(t)], 400, 50, base, random.Random(1))
    known = lambda w: w if w == "start" or count[w] else "?"
    got = {r.doc_id: r.score for r in scored(docs_of(texts))}
    off = [got[i] - sum(math.log10(p[known(a), known(b)]) for a, b in pairs(t)) for i, t in enumerate(tokens)]
    assert np.abs(off).mean() / 31 < 0.01 and abs(np.mean(off)) / 31 < 0.01


def test_scores_do_not_depend_on_partitions(spark, docs_of, prose, tmp_path):
    got = []
    for k in (1, 80):
        docs_of(prose * 3).repartition(k).write.parquet(f"{tmp_path}/{k}")
        # a text may occur in several documents, so rows are told apart by doc_id alone
        got.append(sorted(tuple(r) for r in scored(spark.read.parquet(f"{tmp_path}/{k}"))))
    assert got[0] == got[1]


def test_an_input_that_changes_is_refused(spark, docs_of, prose):
    """Texts differ each time they are read."""
    new = F.udf(lambda x: f"{uuid.uuid4()} {x}", "string").asNondeterministic()
    docs = docs_of(prose).select("doc_id", new("text").alias("text"), F.lit(False).alias("held_out"))
    with pytest.raises(Exception, match="not the one that asked|not read as before"):
        P.score(docs).collect()
