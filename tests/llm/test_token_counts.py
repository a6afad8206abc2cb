import pyarrow as pa
from tokenizers import Tokenizer, models, pre_tokenizers

from aerofield.llm import token_counts


def library(pieces, texts):
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts])]


ODD = ["", None, " ", "  a", "▁b", "a  b c", "日本語 テスト", "\n\n", "é" * 400, "abc" * 500 + " x", "zz🙂🙂 🙂", "tail ", " lead", "a\tb"]


def test_counts_match_the_library(prose):
    path = token_counts.vocabulary_path()
    texts = [*prose, *ODD]
    assert token_counts.count_texts(pa.array(texts), path).tolist() == library(token_counts.vocabulary(path), texts)


def test_ties_follow_the_library():
    pieces = [("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("▁a", -2.0), ("ab", -2.0), ("b", -1.0), ("▁aab", -4.0)]
    texts = ["aaaa", "aab", "abab", "xa", "axxa", "aaaaaaab" * 40, "b"]
    c = token_counts.Counter(pieces)
    got = [int(c.count(["▁" + t])[0]) for t in texts]
    assert got == library(pieces, texts)
    assert got == [c._alone("▁" + t) for t in texts]


def test_rows(spark, docs_of):
    got = {r.doc_id: r.n_tokens for r in token_counts.counts(docs_of(["a b", None, ""], [(9, "a b", None, None, None)])).collect()}
    assert got[1] == got[2] == 0 and got[0] == got[9] > 0
    assert token_counts.counts(docs_of([])).count() == 0
