"""Lists of JSON documents, read and written item by item."""

import json
import random

import pytest
from pyspark.sql import functions as F

from aerofield.sources import items, readers, writers


def test_items_come_before_the_document_is_read(monkeypatch):
    monkeypatch.setattr(items, "CHUNK", 100)
    read = []

    def parts():
        yield '{"n": [1, {"links": [0]}], "links" :[ '
        for i in range(500):
            read.append(i)
            yield ("," if i else "") + json.dumps({"i": i, "s": '"},{]['})
        yield ' ], "tail": null}'

    got = []
    for first, group in items.grouped(parts(), ("links",)):
        assert first == len(got) and len(read) < len(got) + 40
        got += [json.loads(j)["i"] for j in group]
    assert got == list(range(500))


def test_any_cut_of_a_text_gives_the_same_items(monkeypatch):
    monkeypatch.setattr(items, "CHUNK", 1)
    rng = random.Random(4)
    value = [12, -1.5e-3, "a\\\"},é", None, True, {}, [], [[1, {"b": "}"}]], {"a": {"links": [3]}}, 123456789]
    for text in (json.dumps({"x": {"links": [1]}, "links": value}), json.dumps({"links": value}, indent=2, ensure_ascii=False), json.dumps([{"links": value}, 5, {}])):
        for _ in range(20):
            cuts = sorted(rng.choices(range(len(text) + 1), k=15))
            parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
            assert [json.loads(j) for _, g in items.grouped(iter(parts), ("links",)) for j in g] == value


def test_earlier_names_come_first_wherever_they_stand():
    of = lambda d: [int(j) for _, g in items.grouped(iter([json.dumps(d)]), ("a", "b")) for j in g]
    assert of({"b": [1, 2], "a": [3]}) == [3] and of({"a": None, "b": [1, 2]}) == [1, 2]
    assert of({"b": [1], "a": []}) == [] and of({"c": [1]}) == [] and of([]) == [] and of({}) == []


def test_written_documents_come_back_from_small_blocks(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("ord"), F.concat(F.lit("a},"), "id").alias("area_id"), F.when(F.col("id") % 3 > 0, "p").alias("area_property_id"))
    path = str(tmp_path / "links")
    writers.json_document(rows.orderBy(F.col("ord").desc()), path, "links", ["ord"], header={"v": "1"})
    (text,) = [f.read_text() for f in (tmp_path / "links").glob("part-*")]
    assert [r["area_id"] for r in json.loads(text)["links"]] == [f"a}},{i}" for i in range(3000)] and json.loads(text)["v"] == 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.links(spark, path).orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in got] == [(i, f"a}},{i}", "p" if i % 3 else None) for i in range(3000)]
    writers.json_document(rows.where("false"), path, "links", ["ord"])
    assert readers.links(spark, path).count() == 0 and [json.loads(f.read_text()) for f in (tmp_path / "links").glob("part-*")] == [{"links": []}]


@pytest.mark.parametrize("text", ['{"links": [{"area_id": "a"}', '{"links": [{"area_id": "a"} {}]}', '{"links": [{"area_id": tru}]}', "nothing"])
def test_what_is_no_json_raises(spark, tmp_path, text):
    (tmp_path / "links.json").write_text(text)
    with pytest.raises(Exception, match="links.json"):
        readers.links(spark, str(tmp_path / "links.json")).collect()
