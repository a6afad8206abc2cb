import pytest
from pyspark.sql import functions as F

from aerofield.llm import mixing


def levels(sizes, weights=(5, 2, 1)):
    """Targets by sharing out, capping and sharing again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]
        open_ -= full
    return target


def docs(spark, sizes, each=50):
    rows, k = [], 0
    for s, n in sizes.items():
        while n > 0:
            m = min(each, n)
            rows.append((k, " ".join(["w"] * m), s))
            n, k = n - m, k + 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 4000, "c": 20000, None: 3000},
    {"a": 90000, "b": 100, "B": 100, "z": 5000},
    {f"s{i}": 200 + 170 * i for i in range(20)},
    {"only": 3000},
])
def test_targets_and_taken(spark, sizes):
    got = mixing.taken(docs(spark, sizes)).withColumnRenamed("taken", "t").collect()
    want = levels(sizes)
    src = {}
    k = 0
    for s, n in sizes.items():
        for _ in range(-(-n // 50)):
            src[k] = s
            k += 1
    total = dict.fromkeys(sizes, 0)
    for r in got:
        s = src[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.t <= 2 * r.size
        total[s] += r.t
    for s in sizes:
        assert total[s] == pytest.approx(want[s], rel=0.02, abs=60), s


def test_mix_takes_the_same_words(spark):
    d = docs(spark, {"a": 1000, "b": 4000, "c": 9000, None: 3000})
    taken = {r.doc_id: r["taken"] for r in mixing.taken(d).collect()}
    words = {}
    for r in mixing.mix(d).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {k: v for k, v in taken.items() if v}


def test_mix_follows_the_schedule(spark):
    """Rows come in the order of the slots in which they begin: any stretch holds sources as their targets."""
    d = docs(spark, {"a": 30000, "b": 30000, "c": 30000}, each=10).repartition(6)
    got = mixing.mix(d).select("source", F.spark_partition_id().alias("part"), F.size(F.split("text", " ")).alias("n")).collect()
    assert [r.part for r in got] == sorted(r.part for r in got) and len({r.part for r in got}) == 6
    target = {r.source: r.target / r.total for r in mixing.targets(d.select("source", mixing.size().alias("size"), mixing._key().alias("skey"))).collect()}
    for lo in range(0, len(got) - 1000, 1000):
        words = dict.fromkeys(target, 0)
        for r in got[lo : lo + 1000]:
            words[r.source] += r.n
        for s, share in target.items():
            assert words[s] / sum(words.values()) == pytest.approx(share, abs=0.03)


def test_rows_that_share_an_id(spark):
    rows = [(None, f"text {i} of nobody", "x") for i in range(50)] + [(3, f"text {i} of three", "x") for i in range(50)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"skey": F.lit("k"), "start": F.lit(1), "row": F.lit("r"), "slot": F.lit(2)})
    got = mixing.taken(d).collect()
    assert len(got) == 100 and sum(r["taken"] for r in got) == pytest.approx(1.5 * 400, abs=4)
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns and mixed.select(F.sum(F.size(F.split("text", " ")))).first()[0] == sum(r["taken"] for r in got)


def test_edge_rows(spark):
    rows = [(None, "a b", "x"), (1, None, None), (1, "", None), (2, " c \n d", "x"), (2, " c \n d", "x")]
    got = mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r.size for r in got) == [0, 0, 2, 2, 2]
    assert {r.target for r in got if r.source_size} == {9.0}
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_small_sources_beside_huge_ones(spark):
    """Words by the schedule alone; blocks of the huge sources have thousands of words."""
    sizes = {"huge": 250_000_000, "large": 150_000_000, "s500": 500, "s3000": 3000, "s5000": 5000, "one": 1, "million": 1_000_003}
    sized = spark.createDataFrame([(s, n, "=" + s) for s, n in sizes.items()], "source string, size long, skey string")
    plan = mixing.targets(sized)
    rows = {r.source: r for r in plan.collect()}
    got = dict.fromkeys(sizes, 0)
    for r in mixing.schedule(plan).groupBy("skey", "block").count().collect():
        p = rows[r.skey[1:]]
        got[p.source] += r["count"] * min(p.block, p.source_size - r.block * p.block)
    want = levels(sizes)
    for s in sizes:
        assert rows[s].target == pytest.approx(want[s])
        assert got[s] == pytest.approx(want[s], rel=0.02, abs=1), s


def test_small_sources_give_their_rows(spark):
    sizes = {"big": 1_500_000, "b": 7, "c": 60}
    d = docs(spark, {"big": sizes["big"]}, each=20_000).union(docs(spark, {"b": 7, "c": 60}, each=5).selectExpr("doc_id + 1000", "text", "source")).cache()
    got = mixing.taken(d).collect()
    for s in ("b", "c"):
        assert sum(r["taken"] for r in got if r.source_size == sizes[s]) == pytest.approx(2 * sizes[s], abs=1)
    words = {}
    for r in mixing.mix(d).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r["taken"] for r in got if r["taken"]}
