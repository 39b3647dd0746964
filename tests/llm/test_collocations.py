"""Phrases against plain counting, and automata against dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordstrata.llm import collocations as module
from ordstrata.llm.automata import Automaton, built, composed, numbers, sequences, summed, union
from ordstrata.llm.collocations import _cut, collocations


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, least, most):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", lower(text)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, count in counts.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    part = p[i:j]
                    if len(part) < len(p) and 100 * a >= 100 * found[part]:
                        covered.add(part)
        scored = []
        for p in found.keys() - covered:
            cuts = []
            for k in range(1, len(p)):
                left, right = count[p[:k]], count[p[k:]]
                cuts.append((1000 * found[p] * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -found[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score


@pytest.mark.parametrize("range_rows, shard_words, chunk", [(10**6, 2 * 10**6, 4 * 10**6), (100, 500, 1)])
def test_odd_texts(docs, monkeypatch, range_rows, shard_words, chunk):
    for name in ("RANGE_ROWS", "RANGE_PHRASES"):
        monkeypatch.setattr(module, name, range_rows)
    monkeypatch.setattr(module, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(module, "CHUNK", chunk)
    got = Counter(map(tuple, collocations(docs, 3, 400).collect()))
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert got == Counter(expected(rows, 3, 400))
    assert len(got) > 300


def test_odd_characters(spark):
    pieces = ["a\x01 b a\x01 b", "a b\x00c a b\x00c", "日本 語 日本 語", "A B\tA  B", "x\x1cy z x\x1cy z", "é é"]
    rows = [(lang, (" ".join(pieces) + ".\r") * 4) for lang in ("en", None, "und", "", "fr/0")]
    table = spark.createDataFrame(rows, "lang string, text string")
    got = Counter(map(tuple, collocations(table, 2, 50).collect()))
    assert got == Counter(expected(rows, 2, 50))


def test_nothing_to_count(spark, empty):
    assert collocations(empty).count() == 0
    rows = [("en", None), ("en", ""), (None, " .,\n"), ("en", "one two")]
    once = collocations(spark.createDataFrame(rows, "lang string, text string"), 1)
    assert [tuple(r) for r in once.collect()] == [("en", 1, "one two", 1, 1, 1, 2, 2000)]


def test_marks_that_cannot_tell_change_nothing(docs, monkeypatch):
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    monkeypatch.setattr(module, "MARK_BITS", 4)
    monkeypatch.setattr(module, "SLICE_BITS", 3)
    assert Counter(map(tuple, collocations(docs, 3, 400).collect())) == Counter(expected(rows, 3, 400))


def random_sequences(seed, n=300, letters="abcd"):
    rng = random.Random(seed)
    return Counter(tuple(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n))


def automaton(weights):
    words, rows = numbers(list(weights), 5)
    rows, sums = summed(rows, np.array(list(weights.values()), np.int64), len(words))
    return built(words, rows, sums)


def named(words, rows, weights):
    return {tuple(words[i - 1] for i in row if i): int(w) for row, w in zip(rows, weights)}


@pytest.mark.parametrize("seed", range(5))
def test_automata(seed):
    first, second = random_sequences(seed), random_sequences(seed + 100, letters="bcde")
    one, two = (Automaton.unpacked(automaton(s).packed()) for s in (first, second))
    assert named(one.words, *sequences(one)) == first
    assert named(*union([one, two])) == first + second
    rows, weights, found = composed(one, two)
    assert named(one.words, rows, weights) == first
    assert named(one.words, rows, found) == {s: second[s] for s in first}
    # States are shared: far fewer than prefixes.
    prefixes = {s[:k] for s in first for k in range(6)}
    assert sum(map(len, one.finals)) < len(prefixes)


def test_states_are_minimal():
    weights = {("a", "x", "y"): 2, ("b", "x", "y"): 2, ("b", "x"): 1, ("c", "x", "y"): 2}
    found = automaton(weights)
    assert [len(f) for f in found.finals] == [1, 2, 2, 1, 0, 0]


def test_borders_cut_where_sequences_compare():
    weights = random_sequences(3)
    words, rows = numbers(list(weights), 5)
    rows, _ = summed(rows, np.ones(len(rows), np.int64), len(words))
    plain = [tuple(words[i - 1] for i in row if i) for row in rows]
    borders = sorted([("a",), ("a", "b", "zz"), ("aa", "b"), ("b", "b", "b", "b", "b"), ("c", "0"), ("z",), ("",)])
    assert _cut(words, rows, borders) == [sum(s < b for s in plain) for b in borders]
