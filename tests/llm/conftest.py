import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, extra=()):
        return spark.createDataFrame(rows(texts) + list(extra), SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts with exact copies, near copies, shared passages, empties, nulls and a long one."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "er", "Th", "ou", "é", "ß", "in", "x9"]) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(rng.randint(1, 200)) for _ in range(60)]
    shared = text(80)
    out = [*base, None, "", " \n\t", "one", "two words", *base[:10], text(3000)]
    for t in base[10:20]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [text(20) + "\n" + shared + "\n" + text(30) for _ in range(6)]
    return out
