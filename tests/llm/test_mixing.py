"""The mix: the flow against cuts, selection against its promises and a plain walk."""

import hashlib
import random
from collections import Counter
from fractions import Fraction
from itertools import chain, combinations

import pytest
from pyspark.sql import functions as F

from ordstrata.llm import mixing
from ordstrata.llm.mixing import cheapest_flow, mix, mix_sources, mixed, ranked_targets


def largest_flow(sizes, members, quotas):
    """By the least cut: sources on the far side of it, and patterns that reach the others."""
    names = list(quotas)
    subsets = chain.from_iterable(combinations(names, n) for n in range(len(names) + 1))
    return min(
        sum(quotas[s] for s in cut)
        + sum(n for n, own in zip(sizes, members) if not set(own) <= set(cut))
        for cut in subsets
    )


@pytest.mark.parametrize("seed", range(40))
def test_flow_repeats_as_little_as_can_be(seed):
    rng = random.Random(seed)
    names = ["a", "b", None, "d"][: rng.randrange(1, 5)]
    members = [rng.sample(names, rng.randrange(0, len(names) + 1)) for _ in range(rng.randrange(1, 7))]
    sizes = [rng.randrange(0, 30) for _ in members]
    quotas = {s: rng.randrange(0, 90) for s in names}
    given = cheapest_flow(sizes, members, quotas, 3)
    assert all(n >= 0 for flow in given for n in flow.values())
    assert all(sum(flow.get(s, 0) for flow in given) <= quotas[s] for s in names)
    used = [sum(flow.values()) for flow in given]
    # Of the first k uses of all tokens as much as any flow could carry.
    for k in (1, 2, 3):
        carried = sum(min(u, k * n) for u, n in zip(used, sizes))
        assert carried == largest_flow([k * n for n in sizes], members, quotas)


def test_targets():
    targets = ranked_targets()({"b": 10, "a": 100, None: 300, "c": 0})
    # Weights 3, 1, 2, 3; c and b stop at once, then a, and what is over goes to null.
    assert targets == {"c": 0, "b": 20, "a": 200, None: 395}
    assert ranked_targets()({}) == {}


def test_sources_near_their_targets(docs, texts):
    rows = mix_sources(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)
    by_source = {}
    for r in rows:
        by_source.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), own in by_source.items():
        assert sum(r.size for r in own) == size
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) / 2 + 1


def test_empty(empty):
    assert mix_sources(empty).count() == 0


def corpus(spark, n=400):
    rng = random.Random(5)
    tags = [["news"], ["web"], ["news", "web"], ["web", None], [None], ["books", "web"], []]
    rows = [
        (i if i % 50 else None, "w " * rng.randrange(0, 60), rng.choice(tags), "x", "y")
        for i in range(n)
    ]
    rows += [(7, "w " * 20, ["web"], "x", "y")] * 200
    return spark.createDataFrame(rows, "doc_id long, text string, tags array<string>, size string, copies string")


def wanted(sizes):
    return {"news": Fraction(6000), "web": Fraction(9000), None: Fraction(1500), "books": Fraction(100)}


@pytest.mark.parametrize("few", [1, 50_000])
def test_overlapping_sources(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW_ROWS", few)
    docs = corpus(spark)
    rows, sizes, targets = mix(docs, F.col("tags"), wanted)
    rows = rows.collect()
    got = Counter()
    for r in rows:
        assert 0 <= r.copies <= 2 and r.copies == sum(t.copies for t in r.taken_for)
        assert all(t.source in r.sources and t.copies >= 0 for t in r.taken_for)
        for t in r.taken_for:
            got[t.source] += t.copies * r.size
    # Whole documents meet a source at the cuts of each of its patterns.
    for source, target in targets.items():
        assert abs(got[source] - min(target, 2 * sizes[source])) <= 60 * 5
    # Nothing is taken twice while something that could serve is not taken at all.
    assert all(not r.copies for r in rows if not r.sources)
    again, _, _ = mix(docs.repartition(7), F.col("tags"), wanted)
    plain = [Counter((r.doc_id, r.size, r.copies) for r in t) for t in (rows, again.collect())]
    assert plain[0] == plain[1]
    expected = Counter()
    for r in rows:
        expected[r.doc_id, r.size] += r.copies
    taken = mixed(docs, F.col("tags"), wanted)
    assert taken.columns == docs.columns
    assert sum(expected.values()) == taken.count()


def test_selection_is_a_prefix_of_the_seeded_order(spark):
    rows = [(i, "w " * (1 + i % 7), "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    goal = 500
    taken = {r.doc_id for r in mix(docs, F.array("source"), lambda s: {"s": Fraction(goal)})[0].collect() if r.copies}

    def key(doc_id):
        return hashlib.md5(f"mix:{doc_id}:{1 + doc_id % 7}".encode()).hexdigest()[:15]

    total, prefix = 0, set()
    for doc_id in sorted(range(300), key=key):
        if total + 1 + doc_id % 7 > goal:
            break
        prefix.add(doc_id)
        total += 1 + doc_id % 7
    assert prefix <= taken and len(taken - prefix) <= mixing.FILLERS
    assert sum(1 + i % 7 for i in taken) == goal
    other = mix(docs, F.array("source"), lambda s: {"s": Fraction(goal)}, seed="other")[0].collect()
    assert {r.doc_id for r in other if r.copies} != taken


def test_too_many_patterns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 3)
    with pytest.raises(ValueError, match="sets of sources"):
        mix(corpus(spark), F.col("tags"), wanted)
