"""Blocks of word pairs against brute force, and the language model built on them."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordstrata.llm import common
from ordstrata.llm.language_model import score_texts
from ordstrata.llm.pair_blocks import END, TEXTS, Block, Vocabulary, pair_blocks, tokens, unpacked, word_hash

SCHEMA = "doc_id long, held_out boolean, text string"


def spoken(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.random() ** 3 * words)}" for _ in range(n))


@pytest.mark.parametrize("known", [0, 3, 1000])
def test_blocks_hold_every_pair_once(spark, known):
    texts = [spoken(i, 1 + i % 40) for i in range(200)] + [None, "", " \n", "w0 w0 w0 W0"]
    rows = [(None if i == 7 else i, i % 5 == 0, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    words = [w for w, _ in Counter(w for t in texts for w in tokens(t)).most_common(known)]
    index = {word_hash(w): i for i, w in enumerate(words)}
    blocks = pair_blocks(table, Vocabulary(index, np.ones(len(index), np.int64), 0.0), 4)
    stored = blocks.collect()
    numbers = {r.row: r for r in stored if r.kind == TEXTS}
    assert Counter(r.doc_id for r in numbers.values()) == Counter(None if i is None else str(i) for i, _, _ in rows)

    want, held = [Counter(), Counter()], [Counter(), Counter()]
    for doc_id, out, text in rows:
        said = [index.get(word_hash(w), word_hash(w)) for w in [END, *tokens(text)]]
        for pair, k in Counter(zip(said, said[1:])).items():
            unknown = sum(x not in range(len(index)) for x in pair)
            copies = max(1, unknown)  # pairs of two tokens without numbers are in two blocks
            want[0][pair] += 0 if out else k * copies
            held[0][pair, None if doc_id is None else str(doc_id)] += k * copies
    for r in stored:
        if r.kind != TEXTS:
            b = Block(*unpacked(r))
            at = iter(zip(b.at, b.times))
            for u, w, n, spread in zip(*b[:4]):
                want[1][int(u), int(w)] += int(n)
                for _ in range(spread):
                    row, k = next(at)
                    held[1][(int(u), int(w)), numbers[row].doc_id] += int(k)
    assert +want[0] == +want[1] and held[0] == held[1]


def test_scores_do_not_hang_on_which_tokens_travel(spark):
    rows = [(i % 300, spoken(i % 300, 60)) for i in range(330)] + [(400, "never heard w1"), (401, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = []
    for most in (0, 100_000):
        scored = score_texts(docs, n_classes=6, most_known=most, burn_in=1, samples=3).collect()
        found.append(sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), r.score) for r in scored))
    for a, b in zip(*found):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 0.02 * abs(b[4])  # draws differ


def test_tables_of_the_language_model_take_little_disk(spark, tmp_path, monkeypatch):
    made = iter(range(1000))
    monkeypatch.setattr(common, "scratch_folder", lambda _: str(tmp_path / str(next(made))))
    rows = [(i, spoken(i, 1000, 5000)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert score_texts(docs, n_classes=15, burn_in=0, samples=1).agg(F.count("*")).first()[0] == 300
    taken = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert taken < 2 * sum(len(t) for _, t in rows)
