import numpy as np
import pytest
from pyspark.sql import functions as F

from aerofield.llm import language as L

from ..conftest import SF


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.predict(docs, L.learn(docs.where(~L.held_out(3)))).join(docs.select("doc_id", "lang"), "doc_id").where(L.held_out(3))
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 40 and right / n > 0.97


def by_hand(text, model):
    """One document: the same model, one n-gram at a time."""
    langs, sizes, logp = model
    b = bytes(c + 32 if 0x41 <= c < 0x5B else c for c in (text or "").encode())
    if not any(c.isalpha() for c in text):
        return "und", 0.0, 0
    b = b if len(b) >= 3 else b" " + b + b" "
    letter = lambda c: 0x61 <= c < 0x7B or c >= 0x80
    b = bytes(c if letter(c) else 32 for c in b)
    g = [((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % 2**32) >> 16 for i in range(len(b) - 2) if any(map(letter, b[i : i + 3]))]
    p = lambda k, x: 1 / L.BUCKETS if k == len(langs) else np.exp(logp[k, x])

    def fit(members):
        members = [*members, len(langs)]
        share = {k: 1 / len(members) for k in members}
        for _ in range(L.ROUNDS):
            new = dict.fromkeys(members, 0.0)
            for x in g:
                r = {k: share[k] * p(k, x) for k in members}
                for k in members:
                    new[k] += r[k] / sum(r.values()) / len(g)
            moved = max(abs(new[k] - share[k]) for k in members)
            share = new
            if moved < L.STILL:
                break
        return share, sum(np.log(sum(share[k] * p(k, x) for k in members)) for x in g)

    every = fit(range(len(langs)))[0]
    order = sorted(range(len(langs)), key=lambda k: (-every[k], -sizes[k]))
    best = None
    for k in range(1, len(langs) + 1):
        if k > 1 and every[order[k - 1]] < L.LEAST_SHARE:
            break
        share, value = fit(order[:k])
        value -= L.PENALTY * (k - 1) * np.log(len(g)) / 2
        if best and value <= best[0]:
            break
        top = max(order[:k], key=share.get)
        best = (value, top, share[top], k)
    return langs[best[1]], best[2], best[3]


def test_matches_one_document_at_a_time(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.learn(docs)
    rows = docs.orderBy("doc_id").limit(12).collect()
    texts = [r.text[:400] for r in rows] + [rows[0].text[:300] + " " + next(r.text for r in rows if r.lang != rows[0].lang)[:300], "", None, "12 .. 3", "a", "ab"]
    by = {r.lang: r.text for r in docs.collect()}
    texts.append(" ".join(x[:600] for x in by.values()))
    got = {r.doc_id: r for r in L.predict(docs_of(texts), model).collect()}
    for i, t in enumerate(texts):
        lang, score, k = by_hand(t or "", model)
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=0.02) and len(got[i].languages) == k, t
    assert len(by) >= 4 and len(got[len(texts) - 1].languages) == len(by)


def test_scores_do_not_depend_on_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.learn(docs)
    one, many = ({r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs.repartition(k, "doc_id"), model).collect()} for k in (1, 40))
    assert one == many


def test_what_no_language_explains(spark, docs_of):
    model = L.learn(docs_of([], [(1, "aaa bbb aaa bbb " * 400, "big", None, None), (2, "ccc ddd", "small", None, None)]))
    got = {r.doc_id: r for r in L.predict(docs_of(["\u4e2d\u6587\u6587\u672c " * 30, "aaa bbb aaa"]), model).collect()}
    assert got[0].lang_pred == "big" and got[0].score < 0.2 and got[1].lang_pred == "big" and got[1].score > 0.8
    assert [r.doc_id for r in L.drop_rejected(docs_of(["\u4e2d\u6587\u6587\u672c " * 30, "aaa bbb aaa"]), model).collect()] == [1]


def test_many_languages(spark, docs_of):
    """More languages have coarser buckets; nothing is refused."""
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} " * 20, f"l{i:04}", None, None) for i in range(1500)]
    model = L.learn(docs_of([], rows))
    assert model.logp.shape == (1500, L.buckets_for(1500)) and model.logp.size <= L.NUMBERS
    got = {r.doc_id: r.lang_pred for r in L.predict(docs_of([], rows[:40]), model).collect()}
    assert sum(got[i] == f"l{i:04}" for i in range(40)) > 35


def test_rejection_keeps_clean_rows(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    d = docs_of(["", None, "123 456"], [tuple(r) for r in docs.limit(30).collect()])
    kept = L.drop_rejected(d, L.learn(docs))
    assert kept.columns == d.columns and kept.count() == 30
    assert L.drop_rejected(docs_of(["a", "1"]), L.learn(docs_of([]))).count() == 1


def test_no_languages_and_no_rows(spark, docs_of):
    model = L.learn(docs_of([], [(1, "text", None, None, None)]))
    assert model.langs == [] and [r.lang_pred for r in L.predict(docs_of(["text"]), model).collect()] == ["und"]
    assert L.predict(docs_of([]), model).count() == 0


def test_short_lettered_texts_have_a_language(spark, docs_of, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = docs_of([], [(900_000 + i, t, None, None, None) for i, t in enumerate(["A.", "a", "ab", "\u00e9", "a", "1.", "", None])])
    both = docs.select(short.columns).union(short)
    both.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in L.op8_language_id(spark, str(tmp_path)).where("doc_id >= 900000").collect()}
    got = [rows[900_000 + i] for i in range(8)]
    assert all(r.lang_pred != "und" and r.score > 0 for r in got[:5]) and got[1].lang_pred == got[4].lang_pred
    assert all(r.lang_pred == "und" and r.score == 0 for r in got[5:])
    kept = {r.text for r in L.drop_rejected(short, L.learn(docs)).collect()}
    assert "a" in kept and not kept & {"1.", "", None}


def test_padding_changes_nothing_else():
    data, offs = np.frombuffer(b"a123abx", np.uint8), np.array([0, 1, 4, 4, 6, 7])
    out, at = L.padded(data, offs, np.array([True, False, False, True, True]))
    assert out.tobytes() == b" a 123 ab  x " and at.tolist() == [0, 3, 6, 6, 10, 13]
