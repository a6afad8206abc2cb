import random
import re

import pytest

from aerofield.llm import decontaminate as D

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(t):
    return WORD.findall((t or "").encode().lower())


def brute(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for at in range(len(w) - k + 1) if w else []:
            wins.setdefault(tuple(w[at : at + k]), set()).add(i)
    out = []
    for t in docs:
        w = words(t)
        hit, found = [False] * len(w), set()
        for k in {len(x) for x in wins}:
            for at in range(len(w) - k + 1):
                got = wins.get(tuple(w[at : at + k]))
                if got:
                    found |= got
                    hit[at : at + k] = [True] * k
        out.append((len(w), sum(hit), sorted(str(i) for i in found if i is not None), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


@pytest.fixture
def tables(spark, docs_of):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "é2", "D"]) for _ in range(n))
    items = [(i, text(rng.randint(14, 40))) for i in range(12)] + [(20, text(5)), (21, text(7)), (22, ""), (23, None), (None, text(9)), (3, text(30)), (24, "solo")]
    docs = [text(rng.randint(0, 300)) for _ in range(40)] + [None, "", "..", "Solo!"]
    for i in range(20):
        q = items[rng.randrange(12)][1]
        docs.append("zz " * rng.randint(0, 400) + re.sub(" ", rng.choice([" ", "\n", "--"]), q.upper()) + " yy" * 9)
    return docs, items, docs_of(docs), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("most", [D.MAX_WORDS, 60])
def test_hits_match_brute_force(tables, monkeypatch, most):
    """With one automaton, and with several that run one after the other."""
    monkeypatch.setattr(D, "MAX_WORDS", most)
    docs, items, d, b = tables
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in D.hits(d, b).collect()}
    assert [got[i] for i in range(len(docs))] == brute(docs, items)


def test_spans_are_the_hit_words(tables):
    docs, items, d, b = tables
    for r in D.hits(d, b).collect():
        text = (docs[r.doc_id] or "").encode()
        assert sum(len(words(text[s.start : s.end].decode())) for s in r.spans) == r.n_hit


def test_dropping_and_cutting(tables):
    docs, items, d, b = tables
    want = brute(docs, items)
    kept = {r.doc_id: r.text for r in D.drop_contaminated(d.withColumnRenamed("source", "n_words"), b).collect()}
    assert kept == {i: docs[i] for i, x in enumerate(want) if not x[3]}
    cut = {r.doc_id: r.text for r in D.drop_contaminated(d, b, cut=True).collect()}
    assert cut.keys() == kept.keys()
    assert all(len(words(t)) == want[i][0] - want[i][1] for i, t in cut.items())


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.hits(docs_of([]), none).count() == 0
    (r,) = D.hits(docs_of(["some words"]), none).collect()
    assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (2, 0, [], False)
