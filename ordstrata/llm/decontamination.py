"""Benchmark items found in training text: BM25 over word pairs with block-max WAND."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import shared

SEGMENT = 64  # words of an item that are one entry of the index; a passage is twice as long
LEAST_WORDS = 8
BLOCK = 16
K1, B = 1.2, 0.75
HITS = "array<struct<item_id: long, score: double, question: double, answer: double>>"
WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.!?\n]\s*(?=\S)")


class Item:
    """Words of an item, and where its answer begins: its last sentence, or its last quarter."""

    def __init__(self, item_id: int, text: str):
        text = text.lower().strip()
        self.item_id, self.words = item_id, WORD.findall(text)
        ends = [m.end() for m in SENTENCE_END.finditer(text)]
        before = len(WORD.findall(text[: ends[-1]])) if ends else 0
        if not 0 < before < len(self.words):
            before = len(self.words) - max(1, len(self.words) // 4)
        self.answer_at = before


class Index:
    """Postings of word pairs: sorted entries, their share of the entry's own BM25 score, and the
    last entry and the highest share of every block."""

    def __init__(self, items: list[Item]):
        self.items = [i for i in items if len(i.words) >= LEAST_WORDS]
        self.entries, bags = [], []
        for number, item in enumerate(self.items):
            n = -(-len(item.words) // SEGMENT)
            for part in range(n):  # the last part reaches back, so none is short
                end = min((part + 1) * SEGMENT, len(item.words))
                words = item.words[max(0, end - SEGMENT) : end]
                self.entries.append(number)
                bags.append(Counter(zip(words, words[1:])))
        in_entries = Counter(t for bag in bags for t in bag)
        mean = sum(sum(bag.values()) for bag in bags) / max(1, len(bags))
        found = defaultdict(list)
        for entry, bag in enumerate(bags):
            size = K1 * (1 - B + B * sum(bag.values()) / mean)
            weight = {
                t: math.log(1 + (len(bags) - in_entries[t] + 0.5) / (in_entries[t] + 0.5))
                * tf * (K1 + 1) / (tf + size)
                for t, tf in bag.items()
            }
            whole = sum(weight.values())
            for term, w in weight.items():
                found[term].append((entry, w / whole))
        self.vocabulary = {
            w: i + 1 for i, w in enumerate(sorted({w for t in found for w in t}))
        }
        self.width = len(self.vocabulary) + 1
        terms = sorted((self.code(*t), postings) for t, postings in found.items())
        self.codes = np.array([code for code, _ in terms], np.int64)
        self.postings = [Postings(p) for _, p in terms]
        self.highest = np.array([p.highest for p in self.postings])

    def code(self, first: str, second: str) -> int:
        return self.vocabulary[first] * self.width + self.vocabulary[second]

    def terms(self, words: list[str]) -> np.ndarray:
        """Number of the term that begins at each word but the last; -1 if it has no postings."""
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        codes = ids[:-1] * self.width + ids[1:]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)


class Postings:
    def __init__(self, postings: list[tuple[int, float]]):
        self.entries = [e for e, _ in postings]
        self.shares = [s for _, s in postings]
        starts = range(0, len(postings), BLOCK)
        self.block_highest = [max(self.shares[i : i + BLOCK]) for i in starts]
        self.block_last = [self.entries[min(i + BLOCK, len(postings)) - 1] for i in starts]
        self.highest = max(self.shares)


class Cursor:
    def __init__(self, postings: Postings):
        self.postings, self.at = postings, 0
        self.entry = postings.entries[0]

    def seek(self, entry: int) -> None:
        self.at = bisect_left(self.postings.entries, entry, self.at)
        ended = self.at == len(self.postings.entries)
        self.entry = math.inf if ended else self.postings.entries[self.at]

    def block(self, entry: int) -> int:
        return bisect_left(self.postings.block_last, entry, self.at // BLOCK)


def search(lists: list[Postings], threshold: float) -> list[tuple[int, float]]:
    """All entries whose shares add up to ``threshold``, by block-max WAND.

    Lists are ordered by their current entry. The first entry at which the lists' highest shares
    add up to the threshold is the pivot: none before it can reach it. If the highest shares of the
    blocks that hold the pivot do not add up either, everything up to the nearest end of those
    blocks is passed over; otherwise the pivot is scored.
    """
    cursors, found = [Cursor(p) for p in lists], []
    threshold -= 1e-9
    while True:
        cursors = sorted((c for c in cursors if c.entry < math.inf), key=lambda c: c.entry)
        bound, last = 0.0, -1
        for i, c in enumerate(cursors):
            bound += c.postings.highest
            if bound >= threshold:
                last = i
                break
        if last < 0:
            return found
        pivot = cursors[last].entry
        while last + 1 < len(cursors) and cursors[last + 1].entry == pivot:
            last += 1
        upto = cursors[: last + 1]
        blocks = [(c.postings, c.block(pivot)) for c in upto]
        held = [(p, b) for p, b in blocks if b < len(p.block_last)]
        if sum(p.block_highest[b] for p, b in held) >= threshold:
            if cursors[0].entry == pivot:
                score = sum(c.postings.shares[c.at] for c in upto)
                if score >= threshold:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
        else:
            target = min(p.block_last[b] for p, b in held) + 1
            if last + 1 < len(cursors):
                target = min(target, cursors[last + 1].entry)
        for c in upto:
            if c.entry < target:
                c.seek(target)


def leaks(text: str | None, index: Index, threshold: float, question: float, answer: float) -> list:
    """(item_id, score, question overlap, answer overlap) of the items found in a whole text.

    Passages of two segments begin at every segment, so a run of a segment's length lies inside one
    of them. Passages whose terms' highest shares cannot reach the threshold hold no pivot and are
    not searched.
    """
    words = WORD.findall((text or "").lower())
    if len(words) < 2 or not len(index.codes):
        return []
    terms = index.terms(words)
    hit = np.flatnonzero(terms >= 0)
    if not len(hit):
        return []
    bounds = np.concatenate([[0.0], np.cumsum(index.highest[terms[hit]])])
    starts = np.arange(0, max(1, len(words) - SEGMENT), SEGMENT)
    first = np.searchsorted(hit, starts)
    last = np.searchsorted(hit, starts + 2 * SEGMENT - 1)
    best: dict[int, tuple] = {}
    for p in np.flatnonzero(bounds[last] - bounds[first] >= threshold - 1e-9):
        held = np.unique(terms[hit[first[p] : last[p]]])
        for entry, score in search([index.postings[t] for t in held], threshold):
            number = index.entries[entry]
            item = index.items[number]
            if number in best and best[number][1] >= score:
                continue
            reach = len(item.words)
            around = words[max(0, starts[p] - reach) : starts[p] + 2 * SEGMENT + reach]
            pairs = set(zip(around, around[1:]))
            joined = [pair in pairs for pair in zip(item.words, item.words[1:])]
            covered = [a or b for a, b in zip([False, *joined], [*joined, False])]
            on_question = sum(covered[: item.answer_at]) / item.answer_at
            on_answer = sum(covered[item.answer_at :]) / (len(item.words) - item.answer_at)
            if on_question >= question and on_answer >= answer:
                best[number] = (item.item_id, float(score), on_question, on_answer)
    return sorted(best.values())


def index_parts(items: DataFrame, most_items: int, most_bytes: int) -> Iterator[Index]:
    """The index in parts of bounded size, so that each can be broadcast whatever their number."""
    size = items.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")
    ).first()
    n = max(1, math.ceil(size.n / most_items), math.ceil(size.b / most_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for number in range(n):
        rows = items.filter(part == number).filter("item_id IS NOT NULL AND text IS NOT NULL")
        yield Index([Item(r.item_id, r.text) for r in rows.select("item_id", "text").collect()])


def leak_columns(
    items: DataFrame,
    threshold: float = 0.5,
    question: float = 0.6,
    answer: float = 0.5,
    most_items: int = 5000,
    most_bytes: int = 4_000_000,
) -> list[Column]:
    """For every part of the index, the leaks of column ``text`` as an array."""
    spark = items.sparkSession
    return [
        _finder(shared(spark, index), threshold, question, answer)("text")
        for index in index_parts(items, most_items, most_bytes)
    ]


def _finder(load, threshold: float, question: float, answer: float):
    names = ("item_id", "score", "question", "answer")

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = load()
        for texts in batches:
            yield texts.map(
                lambda t: [dict(zip(names, x)) for x in leaks(t, index, threshold, question, answer)]
            )

    return F.pandas_udf(find, HITS)


def contamination(docs: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """doc_id, item_id, score, question_overlap and answer_overlap of every leak of ``items``
    (item_id, text) in ``docs`` (doc_id, text).

    Every passage of 128 words of every text queries an inverted index of the items' word pairs.
    All items are retrieved of whose own BM25 score the passage has at least ``threshold``; a hit
    counts if ``question`` of the words before the last sentence and ``answer`` of those in it lie
    in common word pairs. Items beyond one part's bound are searched part by part.

    Null and empty texts have no leaks. Items with null id or text or under eight words cannot tell
    a leak from chance and match nothing. Repeated rows, and rows without doc_id, are reported like
    others; repeated items too. Empty tables give no rows. Further columns are not read.
    """
    found = []
    for column in leak_columns(items, **limits):
        rows = docs.select("doc_id", column.alias("hits")).filter(F.size("hits") > 0)
        found.append(rows.select("doc_id", F.explode("hits").alias("hit")))
    return reduce(DataFrame.union, found).select(
        "doc_id",
        "hit.item_id",
        "hit.score",
        F.col("hit.question").alias("question_overlap"),
        F.col("hit.answer").alias("answer_overlap"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` in which :func:`contamination` finds no item, with all columns."""
    for column in leak_columns(items, **limits):
        docs = docs.filter(F.size(column) == 0)
    return docs
