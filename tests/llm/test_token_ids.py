import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tokenizers import Tokenizer

from aerofield.llm import token_ids as T
from aerofield.llm._shared import fresh_dir

ODD = ["", "a  b", "a \n b", "  x", " ", "\n", "a\n\n b  ", "hello world\n", "it's  we'll", "<|endoftext|> x", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|", "end<|endoftext|>\n ", "a\tb \tc", " lead", "tail ", "日本語 テスト", "é" * 300, "x y z"]


def library(texts):
    return [e.ids + [0] for e in Tokenizer.from_file(T.vocabulary_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoding_matches_the_library(prose):
    texts = [*(t or "" for t in prose), *ODD]
    flat, n = T.Encoder(T.vocabulary_path()).encode(pa.array(texts))
    assert [x.tolist() + [0] for x in np.split(flat, np.cumsum(n)[:-1])] == library(texts)


def test_files_round_trip(spark, docs_of, prose):
    texts = [*prose, *ODD, None]
    folder = fresh_dir(spark, "tokens")
    files = T.write_files(docs_of(texts).repartition(3), folder, T.vocabulary_path())
    got = sorted(T.read_files(spark, folder, files).collect())
    start = 0
    for r, want in zip(got, library(texts), strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == want and (r.start, r.n_tokens) == (start, len(want))
        start += len(want)
    f = T.TokenFile(folder, files[-1][0])
    assert f.document(len(f.index) - 1).tolist() == library(texts)[int(f.index["doc_id"][-1])]


def test_a_file_needs_its_dictionary(spark, docs_of, prose):
    folder = fresh_dir(spark, "tokens")
    files = T.write_files(docs_of(prose), folder, T.vocabulary_path())
    fs, at = T._open(folder)
    with fs.open_output_stream(f"{at}/dictionary.zdict") as f:
        f.write(b"another")
    with pytest.raises(ValueError, match="dictionary"):
        T.TokenFile(folder, files[0][0])


def test_edge_rows(spark, docs_of):
    rows = [(None, "b", None, None, None), (5, None, None, None, None), (5, "a", None, None, None), (2, "", None, None, None)]
    got = sorted(T.digest(T.token_files(docs_of([], rows))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [2, 5, 5, None]
    assert sorted(r.n_tokens for r in got) == [1, 1, 2, 2] and [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(4)]
    assert got[0].ids_crc32 == zlib.crc32(bytes(4))
    assert T.token_files(docs_of([])).count() == 0


def test_wide_ids():
    for x in ([], [1, 65535], [1, 65536]):
        assert T.unpacked(T.packed(np.array(x, np.uint32))).tolist() == x


def test_special_tokens_as_text():
    t = Tokenizer.from_file(T.vocabulary_path())
    t.encode_special_tokens = True
    text = "a <|endoftext|> b"
    flat, _ = T.Encoder(T.vocabulary_path(), special_as_text=True).encode(pa.array([text]))
    assert flat.tolist() == t.encode(text, add_special_tokens=False).ids != T.Encoder(T.vocabulary_path()).encode(pa.array([text]))[0].tolist()


def test_another_order(spark, docs_of):
    from pyspark.sql import functions as F

    got = sorted(T.token_files(docs_of(["c", "a", "b"]), order=[F.col("text")]).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 2, 0]


def test_words_are_cut_as_the_library_cuts_them():
    # letters and digits that newer versions of Unicode have, and the library has not, among them
    parts = [" ", "  ", "\n", " ", "　", "\x1c", "'s", "'ve", "'ll", "'", "'S", "s", "ve", "l", "7", "½", "é", "日本", "x́", "😀", "!", "࢏", "՘", "\U00010940", "\U00012550", "\U0003d000", "<|endoftext|>", "<|end"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 2, 4, 9]))) for _ in range(4000)]
    encoder = T.Encoder(T.vocabulary_path())
    for some in (texts, [t for t in texts if t.isascii()], texts[:1], [""], ["", "", "'s"]):
        flat, n = encoder.encode(pa.array(["cut off", *some]).slice(1))
        assert [x.tolist() + [0] for x in np.split(flat, np.cumsum(n)[:-1])] == library(some)


def test_a_word_is_encoded_once_while_it_is_remembered(monkeypatch):
    encoder, asked = T.Encoder(T.vocabulary_path()), []
    spelled = encoder.spelled
    monkeypatch.setattr(encoder, "spelled", lambda words: asked.extend(words.to_pylist()) or spelled(words))
    monkeypatch.setattr(T, "MEMORY", 8)
    batches = [["one two, two", "two, it's one"], ["three four, one"], ["three five"], ["one"]]
    got = []
    for texts in batches:
        flat, n = encoder.encode(pa.array(texts))
        got += [x.tolist() + [0] for x in np.split(flat, np.cumsum(n)[:-1])]
    assert got == library([t for texts in batches for t in texts])
    # the second batch is beyond the limit: its own four words stay, "one" without a blank is asked again
    assert asked == ["one", " two", ",", "two", " it", "'s", " one", "three", " four", " five", "one"]


def test_long_words_are_encoded_alone(monkeypatch, prose):
    monkeypatch.setattr(T, "SPELL_WORDS", 3)
    monkeypatch.setattr(T, "LONG_WORD", 5)
    texts = [*(t or "" for t in prose[:20]), *ODD]
    flat, n = T.Encoder(T.vocabulary_path()).encode(pa.array(texts))
    assert [x.tolist() + [0] for x in np.split(flat, np.cumsum(n)[:-1])] == library(texts)


def test_a_character_cut_in_two_by_texts_raises():
    with pytest.raises(UnicodeError):
        T.Encoder(T.vocabulary_path()).encode(pa.array([b"a\xc3", b"\xa9"]).view(pa.string()))


def test_batches_of_texts_take_bounded_memory():
    """What cutting and placing takes does not grow with the batch."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(1500)]
    e = T.Encoder(T.vocabulary_path())
    want = e.tokenizer.encode_batch(texts[:20], add_special_tokens=False)
    few = pa.array(texts)
    e.encode(few[:300])
    tracemalloc.start()
    flat, n = e.encode(few)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [flat[b - k : b].tolist() for b, k in zip(np.cumsum(n)[:20], n, strict=False)] == [x.ids for x in want]
    assert peak < 12 * few.nbytes


def test_empty_texts_between_slices(monkeypatch):
    monkeypatch.setattr(T, "CUT_BYTES", 8)
    e = T.Encoder(T.vocabulary_path())
    texts = ["", "", "a long text that is a slice of its own", "", "b", "", "", "c d", "", "another one of these long ones", ""]
    for _ in range(2):
        flat, n = e.encode(pa.array(texts))
        want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]
    flat, n = T.Encoder(T.vocabulary_path()).encode(pa.array(["", ""]))
    assert n.tolist() == [0, 0] and not len(flat)
