"""The manifest against a plain climb through whole lists of hashes."""

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from ordstrata.llm import manifest
from ordstrata.llm.manifest import leaves, verified


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(hashes):
    """The root, and for every hash what stands left and right of it on each level."""
    proofs, members = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        for i, below in enumerate(members):
            left = hashes[i - 1] if i % 2 else ""
            right = hashes[i + 1] if i % 2 == 0 and i + 1 < len(hashes) else ""
            for m in below:
                proofs[m].append((left, right))
        hashes = [digest("".join(hashes[i : i + 2])) for i in range(0, len(hashes), 2)]
        members = [sum(members[i : i + 2], []) for i in range(0, len(members), 2)]
    return hashes[0], proofs


def expected(rows):
    trees = {}
    for doc_id, source, lang, n_chars, text in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        met = leaf(doc_id, source, lang, n_chars + 1, text) if hit else own
        trees.setdefault(lang, []).append(((doc_id is not None, doc_id or 0, own), doc_id, own, met))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    ordered = [sorted(trees[name]) for name in names]
    subroots, inner = zip(*(climb([own for *_, own, _ in rows]) for rows in ordered))
    root, outer = climb(list(subroots))
    for rows, subroot, proofs, over in zip(ordered, subroots, inner, outer):
        for (_, doc_id, own, met), proof in zip(rows, proofs):
            for left, right in proof + over:
                met = digest(left + met + right)
            siblings = digest("".join(left + right for left, right in proof + over))
            yield doc_id, own, subroot, root, siblings, met, met == root


def check(docs):
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = Counter(map(tuple, verified(docs).collect()))
    assert got == Counter(expected(map(tuple, rows)))
    return got


def test_odd_rows(docs):
    got = check(docs)
    assert 0 < sum(row[-1] * n for row, n in got.items()) < sum(got.values())


def test_many_levels(spark, monkeypatch):
    """Trees of sizes around powers of two, climbed in several steps."""
    monkeypatch.setattr(manifest, "MOST_SPAN", 2)
    monkeypatch.setattr(manifest, "MOST_SENT", 0)
    sizes = {"a": 1, "b": 2, "c": 3, None: 17, "é/0": 33}
    rows = [(i, None, lang, i, "x" * i) for lang, n in sizes.items() for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_one_row_and_none(spark, docs, empty):
    assert verified(empty).count() == 0
    one = docs.filter("doc_id = 4")
    (row,) = verified(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == digest("")


def test_every_change_shows(docs):
    """Whatever row is changed, its fold differs; others keep theirs."""
    rows = verified(docs, F.col("n_chars").isNotNull()).collect()
    found = leaves(docs, F.col("n_chars").isNotNull()).filter("leaf <> given").count()
    assert sum(not row.verified for row in rows) == found > 0
