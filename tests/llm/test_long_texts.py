"""Single texts of more bytes than the operators otherwise hold at once."""

import random

from pyspark.sql import functions as F

from aerofield.llm import decontaminate, language, pitman_yor, suffix_dedup
from aerofield.llm._text import CHUNK_BYTES


def prose_of(n, seed=1):
    rng = random.Random(seed)
    some = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    out, size = [], 0
    while size < n:
        out.append(rng.choice(some))
        size += len(out[-1]) + 1
    return " ".join(out)


def test_repeats(docs_of):
    passage = prose_of(400, 2)
    long = prose_of(suffix_dedup.BLOCK_BYTES + 100_000)
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs_of([long + "\n" + passage + "!", "short", "?" + passage])).collect()}
    assert [len(got[i].spans) for i in range(3)] == [1, 0, 1]
    assert bytes(got[0].kept).decode() in (long + "\n!", long + "!") and bytes(got[2].kept) == b"?"


def test_benchmark_words_at_the_end(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(20))
    long = prose_of(CHUNK_BYTES + 100_000)
    (r,) = decontaminate.hits(docs_of([long + " " + item]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (len(long.split()) + 20, 20, ["7"], False)


def test_items_longer_than_an_automaton(spark, docs_of, monkeypatch):
    words = [f"w{i % 997}x{i}" for i in range(500)]
    monkeypatch.setattr(decontaminate, "MAX_WORDS", 100)
    parts = decontaminate.parts_of([w.encode() for w in words], 13)
    windows = {tuple(p[i : i + 13]) for p in parts for i in range(len(p) - 12)}
    assert max(map(len, parts)) <= 100 and windows == {tuple(w.encode() for w in words[i : i + 13]) for i in range(488)}


def test_language(docs_of):
    a, b = prose_of(CHUNK_BYTES + 100_000), prose_of(20_000, 3).replace("a", "x").replace("b", "y")
    model = language.learn(docs_of([], [(1, a, "la", None, None), (2, b, "lb", None, None)]))
    (r,) = language.predict(docs_of([a]), model).collect()
    assert r.lang_pred == "la" and r.score > 0.9


def test_scores(spark, docs_of):
    long = prose_of(pitman_yor.BLOCK_BYTES + 100_000)
    d = docs_of([long, "few words"]).select("doc_id", "text", (F.col("doc_id") == 1).alias("held_out"))
    got = {r.doc_id: r for r in pitman_yor.score(d).collect()}
    assert got[0].n_tokens == len(long.split()) + 1 == got[0].train_tokens and got[0].score > got[0].base_score and got[1].n_known < 3
