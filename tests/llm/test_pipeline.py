import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as C
from aerofield.llm import language, mixing, token_ids

from ..conftest import SF
from . import test_decontaminate, test_simhash


def test_stages_against_brute_force(spark):
    """Language and mixing by their own operators (tested elsewhere), all else by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = language.learn(docs.where(~language.held_out(3)))
    kept = sorted(r.doc_id for r in language.predict(docs, model).where("lang_pred <> 'und' and score >= 0.5").collect())
    _, comp = test_simhash.brute([rows[i].text for i in kept])
    kept = [i for k, i in enumerate(kept) if comp[k] == k]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [i for i, x in zip(kept, test_decontaminate.brute([rows[i].text for i in kept], items), strict=True) if not x[3]]
    clean = spark.createDataFrame([tuple(rows[i]) for i in kept], docs.schema)
    mixed = [(r.doc_id, r.text) for r in mixing.mix(clean).collect()]
    assert [d for d, _ in mixed] != sorted(d for d, _ in mixed)
    ids = [e.ids + [0] for e in Tokenizer.from_file(token_ids.vocabulary_path()).encode_batch([t for _, t in mixed], add_special_tokens=False)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    want = [(d, int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), s, x in zip(mixed, starts, ids, strict=False)]
    assert sorted(tuple(r) for r in C.run(spark, SF).collect()) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    for _, f in C.STAGES[:-1]:
        assert f(spark, docs, SF).columns == docs.columns


def test_stages_send_small_batches_to_python(spark):
    docs = spark.createDataFrame([(i, "word " * 8000, "en", "a", 40000) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    for _, f in C.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        f(spark, docs, SF)
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 5 << 20
