"""Operators against brute force on a small table with every odd case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from math import log10

import numpy as np
import pytest

from ordstrata.llm import pii
from ordstrata.llm.decontamination import Item, Index, contamination, leaks, search, without_leaks
from ordstrata.llm.language_id import identify
from ordstrata.llm.language_model import (
    gibbs,
    pair_counts,
    rare_tokens,
    score_texts,
    token_counts,
)
from ordstrata.llm.near_dups import chunks, near_duplicates, without_near_duplicates
from ordstrata.llm.packing import pack, plan
from ordstrata.llm.quality_classifier import classify
from ordstrata.llm.quality_rules import judge, without_rejected
from ordstrata.llm.queries import word_tokenizer
from ordstrata.llm.sharding import shard_by_bytes


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def test_shards(docs, empty, texts):
    rows = shard_by_bytes(docs, 5).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(r.size for r in rows)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(5)]
    assert max(sizes) - total / 5 <= max(r.size for r in rows)
    assert shard_by_bytes(empty).count() == 0


def test_packing(docs, empty, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    tokenizer.encode_special_tokens = True
    rows = pack(docs, word_tokenizer(), 512).collect()
    want = Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            want[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(filled) <= -(-sum(r.length for r in rows) // 512) + 2
    assert pack(empty, word_tokenizer()).count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(rng.lognormal(6, 1, 50_000).astype(int) + 1, 2048), minlength=2049)
    table = plan(counts, 2048, 700, 512)
    rows = np.arange(len(counts)) @ counts
    used = table["sequence"].max() + 1
    assert -(-rows // 2048) <= used <= 1.01 * rows / 2048 + 2


def test_quality_rules(docs, empty, texts):
    def counts(text):
        w, again = words(text), set()
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        for i in range(len(w) - 7):
            if seen[tuple(w[i : i + 8])] > 1:
                again |= set(range(i, i + 8))
        lines = [x for x in (text or "").split("\n") if words(x)]
        return (
            len(w),
            sum(map(len, w)),
            len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)),
            len(again),
        )

    rows = judge(docs).collect()
    found = Counter((r.doc_id, *r[1:6]) for r in rows)
    assert found == Counter((i, *counts(t)) for i, t in texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed) and 0 <= r.quality_probability <= 1
    kept = without_rejected(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows) > 15
    assert judge(empty).count() == 0 and without_rejected(empty).columns == docs.columns


def test_rules_reject_noise(spark):
    from conftest import prose

    def noise(seed):
        return " ".join(w.upper() + "!!" if seed % 2 else w + "***" for w in prose(seed, 80).split())

    rows = [(i, noise(i) if i % 6 == 0 or i % 7 == 0 else prose(i, 80)) for i in range(200)]
    for r in judge(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.kept == (r.doc_id % 6 != 0 and r.doc_id % 7 != 0)


def linked(texts, n, percent):
    sets = {}
    for i, t in texts:
        w = words(lower(t))
        if i is not None:
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates(spark, docs, empty, texts):
    from conftest import prose

    chain = [prose(9, 300).split()]
    for k in range(40):  # each close to the next, the ends far apart
        chain.append([*chain[-1]])
        for j in range(4):
            chain[-1][(7 * k + 71 * j) % 300] = f"w{k}"
    shared = prose(10, 100)
    more = [(1000 + i, " ".join(w)) for i, w in enumerate(chain)]
    more += [(2000 + i, f"{shared} {prose(100 + i, 30 + i)}") for i in range(60)]
    rows = [(i, t) for i, t in texts] + more
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = linked(rows, 3, 85)
    for r in near_duplicates(table).collect():
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    left = without_near_duplicates(docs, 5, 80)
    want = linked(texts, 5, 80)
    ids = [r.doc_id for r in left.collect()]
    assert left.columns == docs.columns
    assert Counter(ids) == Counter([i for i, (_, c) in want.items() if i == c] + [None])
    assert near_duplicates(empty).count() == 0 and without_near_duplicates(empty, 5, 80).count() == 0


def test_chunks_cover_the_radius():
    parts = chunks(12, 5, 1)
    for wrong in combinations(range(12), 5):
        assert any(len(set(p) & set(wrong)) <= 1 for p in parts)


ITEM = "Which river runs past the old stone house in winter? The green water under the hill."


def test_decontamination(spark, docs, empty):
    from conftest import prose

    items = [(1, ITEM), (2, "short one"), (3, None), (None, ITEM), (4, prose(77, 150))]
    items = spark.createDataFrame(items, "item_id long, text string")
    long = prose(78, 3000)
    texts = [
        (1, f"{prose(5, 90)} {ITEM.upper()} {prose(6, 90)}"),
        (2, prose(7, 500)),
        (3, "Which river runs past the old stone house in winter? " + prose(8, 60)),
        (4, f"{long} {ITEM} {long}"),
        (5, f"{prose(11, 40)} {prose(77, 150)}"),
        (6, None),
        (7, ""),
    ]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in contamination(table, items).collect()}
    assert found == {(1, 1), (4, 1), (5, 4)}
    parts = {(r.doc_id, r.item_id) for r in contamination(table, items, most_items=1).collect()}
    assert parts == found
    assert {r.doc_id for r in without_leaks(table, items).collect()} == {2, 3, 6, 7}
    assert contamination(empty, items).count() == 0
    assert without_leaks(docs, items.limit(0)).columns == docs.columns
    assert contamination(docs, items.limit(0)).count() == 0


def test_block_max_search_finds_what_scoring_all_finds():
    from conftest import prose

    index = Index([Item(i, prose(i, 20 + i % 30)) for i in range(300)])
    for seed in range(60):
        terms = sorted({t for t in index.terms(prose(seed % 40, 60).replace(",", "").replace(".", "").split()) if t >= 0})
        lists = [index.postings[t] for t in terms]
        totals = Counter()
        for p in lists:
            for entry, share in zip(p.entries, p.shares):
                totals[entry] += share
        for threshold in (0.1, 0.3, 0.6):
            want = {e for e, s in totals.items() if s >= threshold}
            assert {e for e, _ in search(lists, threshold)} == want
    assert leaks("", index, 0.5, 0.5, 0.5) == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), order, m.end()))
    return sorted(found)


def test_personal_data(spark, docs, empty, texts):
    odd = [
        "a@b.c d@e.f@g.h i@j k.l@m.n.o. @x.y -@-.-",
        "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 é1.2.3.4",
        "4111 1111 1111 1111 4111-1111-1111-1111 0 41111111111111111111",
        "+1 (743) 555-3824 +12 345 +1-2-3-4-5-6-7-8-9 ++49 30 1234567",
        "call (312) 555-0142 or 3.14159",
        "7" * 5000 + "@" * 300 + "x" * 5000 + "@a.b",
        None,
    ]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100 + k, t) for k, (_, t) in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = dict(rows)
    for r in pii.personal_data(table).collect():
        spans = base(known[r.doc_id] or "")
        text = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        counts = [sum(k == order for _, k, _ in spans) for order in range(4)]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert set(text.split(",")) <= set(r.spans.split(",")) | {""}
    found = {r.doc_id: r.spans for r in pii.personal_data(table).collect()}
    assert found[4] == "phone:5:19"
    clean = pii.redacted(table.filter("doc_id = 4")).first().text
    assert clean == "call [PHONE] or 3.14159"
    assert pii.redacted(docs).columns == docs.columns and pii.redacted(docs).count() == docs.count()
    assert pii.personal_data(empty).count() == 0


def test_language(spark, empty):
    from conftest import prose

    other = str.maketrans("aeiou", "ouaei")
    rows = [(i, prose(i, 60).translate(other) if i % 2 else prose(i, 60), "xy"[i % 2]) for i in range(200)]
    rows += [(200, None, "x"), (201, "", None), (202, "12 34 !", "y"), (203, prose(1, 9000), None), (None, "stone", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for r in identify(table).collect():
        assert r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 200:
            assert r.lang_pred == "xy"[r.doc_id % 2]
        elif r.doc_id in (200, 201, 202):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id == 203:
            assert r.lang_pred == "x"
    assert identify(empty).count() == 0


@pytest.mark.parametrize("most_known", [5, 100_000])
def test_language_model(docs, empty, texts, most_known):
    said = [(i, [*words(lower(t)), None]) for i, t in texts]
    counts = Counter(w for i, t in said if remainder(i, 7) != 2 for w in t)
    n = sum(counts.values())
    rows = score_texts(docs, n_classes=8, most_known=most_known, burn_in=1, samples=1).collect()
    want = Counter()
    for i, t in said:
        score = sum(log10((counts[w] + 1) / (n + len(counts) + 1)) for w in t)
        want[i, remainder(i, 7) == 2, len(t), sum(counts[w] > 0 for w in t), n, round(score, 6)] += 1
    assert Counter((*r[:5], round(r.base_score, 6)) for r in rows) == want
    assert all(r.score < 0 for r in rows)
    assert score_texts(empty, n_classes=8, burn_in=0, samples=1).count() == 0


def test_language_model_probabilities_add_up(docs):
    counts = token_counts(docs).cache()
    classes = {r.h: i for i, r in enumerate(counts.orderBy("h").limit(6).collect())}
    pairs = pair_counts(docs, classes)
    assert np.allclose(gibbs(pairs, 7, 1, 2, 1.0).sum(axis=1), 1)
    table, unknown = rare_tokens(counts, classes, 2, 1.0)
    rare = [r.log_p for r in table.collect() if r.h not in classes]
    assert abs(sum(10**x for x in rare) + 10**unknown - 1) < 0.05  # its tables are last sweep's


def test_language_model_learns_contexts(spark):
    text = "a b c d e f g h"  # each word tells the next
    docs = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string")
    for r in score_texts(docs, n_classes=20, burn_in=1, samples=2).limit(5).collect():
        assert r.score > r.base_score / 5


@pytest.mark.parametrize("most_known", [2, 100_000])
def test_language_model_learns_contexts_beyond_its_classes(spark, most_known):
    text = "a b c d e f g h"  # all but the end are outside the classes
    docs = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string")
    rows = score_texts(docs, n_classes=1, most_known=most_known, burn_in=1, samples=2)
    for r in rows.limit(5).collect():
        assert r.score > r.base_score / 5


def test_language_model_restaurants_add_up(spark):
    # Texts of one token: their probabilities, and what is left for others, make one in the end.
    said = ["a"] * 9 + ["b"] * 4 + ["c"] * 2 + ["d"]
    docs = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(said)], "doc_id long, text string")
    seen = {r.text for r in docs.collect() if remainder(r.doc_id, 7) != 2}
    rows = score_texts(docs, n_classes=2, burn_in=1, samples=2)
    found = {r.text: r.score for r in docs.join(rows, "doc_id").collect() if r.text in seen}
    assert 0.8 < sum(10**x for x in found.values()) <= 1.0001


def test_quality_classifier(spark, docs, empty):
    from conftest import prose

    rows = [(i, prose(i, 60) if i % 3 else prose(i, 60).replace(" ", "*** "), "en", "s", 400) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)], "doc_id long, quality int")
    for r in classify(table, labels).collect():
        assert r.kept == (r.doc_id % 3 > 0) and 0 <= r.score <= 1
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in classify(docs, nulls).collect()} == {0.5}
    assert classify(empty, labels).count() == 0
    assert classify(docs, labels.limit(0)).count() == docs.count()
