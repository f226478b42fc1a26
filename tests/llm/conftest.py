import random
import string

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, tokens binary, rep long, c long"


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and very long texts, copies, near copies, repeated rows, and columns whose names operators use."""
    rng = random.Random(4)
    base = _words(rng, 60)
    texts = [None, "", " ", "one", "two words", "\n\n", base, base, base + " more", "  " + base.upper(), _words(rng, 30_000), "x" * 200_000]
    texts += [base] * 150  # a group of copies that is a third of all rows and more
    for _ in range(60):  # near copies
        w = base.split(" ")
        w[rng.randrange(60)] = _words(rng, 1)
        texts.append(" ".join(w))
    texts += [_words(rng, rng.randint(1, 200)) for _ in range(120)]
    texts += [_words(rng, 10) + " " + "".join(rng.choices(string.printable, k=80)) for _ in range(40)]
    rows = [
        (i, t, ["en", "de", None][i % 3], "src0" if i % 3 else f"src{i % 12}", None if t is None else len(t), 0.5, None, b"?", i, 1)
        for i, t in enumerate(texts)
    ]
    return rows


@pytest.fixture()
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
