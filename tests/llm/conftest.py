import random

import pytest

WORDS = "the of river stone and a house winter is bright water under to green hill long road in".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, length string, words string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) + str(rng.randrange(9)) * (rng.random() < 0.02) for _ in range(n))


def documents():
    """Nulls in every column, empty, blank and very long texts, copies, near copies and ties; the
    last columns only clash with names that the operators use."""
    base = prose(1, 200)
    near = base.split()
    near[100] = "changed"
    texts = [base, base, " ".join(near), prose(2, 30), prose(3, 2100), "", None, " \n\t ", "one two", "one two"]
    texts += [prose(4, 9000), "Größe, naïve 'tis 日本  x <|endoftext|> Σας", "word " * 40 + "\n" + "word " * 40]
    texts += [prose(50 + i, 25 + i) for i in range(20)]
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    rows[15] = (15, *rows[15][1:3], None, None, None, None, None)
    return rows + [(None, base, "en", "s", 3, None, None, None), rows[3], rows[3]]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in documents()]
