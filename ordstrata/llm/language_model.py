"""Hierarchical Pitman-Yor language model with restaurants seated by Gibbs sampling."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstrata.llm.common import rows_at_once, shared, stored
from ordstrata.llm.language_id import held_out
from ordstrata.llm.pair_blocks import (
    BY_FIRST,
    BY_SECOND,
    END,
    KNOWN,
    TEXTS,
    Vocabulary,
    pack,
    pair_blocks,
    pair_keys,
    part_of,
    place,
    tokens,
    unpack,
    unpacked,
    word_hash,
)

MODULUS = 7
FLUSH = 300_000
PAIRS_IN_BLOCK = 2_000_000
BLOCKS_AT_ONCE = 4
TASKS = 16  # groups of contexts that are seated side by side
AT_ONCE = 1_000_000  # tokens that are seated at once, and sums that a task keeps
SLICE = 100_000
ONE_BY_ONE = 64  # customers of a dish that are seated singly; further ones in blocks


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often each distinct token occurs, summed in each task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def given(counts: Counter) -> pd.DataFrame:
            h = np.fromiter(map(word_hash, counts), np.int64, len(counts))
            return pd.DataFrame({"h": h, "n": np.fromiter(counts.values(), np.int64, len(h))})

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.text:
                counts.update(tokens(text))
                if len(counts) >= FLUSH:
                    yield given(counts)
                    counts = Counter()
        yield given(counts)

    counted = docs.select("text").mapInPandas(count, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, classes: dict[int, int]) -> DataFrame:
    """(u, w, n): pairs of classes of neighbouring tokens; a text begins after an end. There are at
    most the square of the classes."""
    known = Vocabulary(classes, np.zeros(len(classes), np.int64), 0.0)
    blocks = pair_blocks(docs.withColumn("held_out", F.lit(False)), known, 1)
    size = Sizes(len(classes), len(classes))
    return class_pairs(docs.sparkSession, first_sums(blocks, size).cells)


def class_pairs(spark: SparkSession, cells: np.ndarray) -> DataFrame:
    """(u, w, n) of a square of counts."""
    u, w = np.nonzero(cells)
    n = cells[u, w].astype(np.int64)
    return stored(spark.createDataFrame(pa.table({"u": u, "w": w, "n": n})))


def seat(
    customers: np.ndarray,
    parent: np.ndarray,
    discount: float,
    strength: float,
    rng: np.random.Generator,
    restaurant: np.ndarray | None = None,
    other_tables: float | np.ndarray | None = None,
) -> np.ndarray:
    """Tables of each dish after all customers of its restaurant sat down one after the other.

    The k-th customer of a dish opens a table with the weight of the parent's probability of the
    dish times (strength + discount * tables), against k - 1 - discount * its tables. Customers
    beyond the 64th come in blocks that grow with the count. ``other_tables`` fixes the number of
    tables of a restaurant too large to be in one place, for each dish if it is an array.
    """
    tables = np.ones(len(customers), np.int64)
    place = np.zeros(len(customers), np.int64) if restaurant is None else restaurant
    seated = 1
    most = int(customers.max(initial=0))
    while seated < most:
        step = 1 if seated < ONE_BY_ONE else seated // 16
        here = np.flatnonzero(customers > seated)
        t = tables[here]
        n_tables = other_tables
        if n_tables is None:
            n_tables = np.bincount(place, tables)[place[here]]
        elif isinstance(n_tables, np.ndarray):
            n_tables = n_tables[here]
        new = (strength + discount * n_tables) * parent[here]
        old = np.maximum(seated - discount * t, 1e-12)
        if step == 1:
            tables[here] = t + (rng.random(len(here)) < new / (new + old))
        else:
            more = np.minimum(customers[here] - seated, step)
            tables[here] = t + rng.binomial(more, new / (new + old))
        seated += step
    return np.minimum(tables, customers)


def discount_of(rows: DataFrame) -> float:
    """The share of single counts, as of absolute discounting."""
    once = F.count(F.when(F.col("n") == 1, 1))
    found = rows.agg(once.alias("a"), F.count(F.when(F.col("n") == 2, 1)).alias("b")).first()
    return absolute_discount(found.a, found.b)


def absolute_discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, (once + 1) / (once + 2 * twice + 2)))


def gibbs(
    pairs: DataFrame, size: int, burn_in: int, samples: int, strength: float
) -> np.ndarray:
    """Averaged probabilities of a class after another.

    One restaurant per context, all drawing dishes from one parent, whose customers are the tables
    below it and whose own base is even. A sweep seats every context anew under the parent's last
    probabilities, contexts spread over tasks, then the parent; probabilities of the sweeps after
    ``burn_in`` are averaged. All tables here are bounded by the square of the classes.
    """
    spark = pairs.sparkSession
    discount = discount_of(pairs)
    parent = np.full(size, 1 / size)
    weights = []
    for sweep in range(burn_in + samples):
        reseat = _seater(shared(spark, parent), sweep, discount, strength)
        seats = pairs.groupBy(F.col("u") % TASKS).applyInPandas(reseat, "u long, w long, n long, t long")
        found = seats.toPandas()  # at most size * size rows
        u, w, n, t = (found[c].to_numpy() for c in ("u", "w", "n", "t"))
        below = np.bincount(w, t, size).astype(np.int64)
        even = np.full(size, 1 / size)
        rng = np.random.default_rng([sweep, size])
        used = np.flatnonzero(below)
        above = np.zeros(size, np.int64)
        above[used] = seat(below[used], even[used], discount, strength, rng)
        parent = (below - discount * above + (strength + discount * above.sum()) * even) / (
            below.sum() + strength
        )
        if sweep >= burn_in:
            customers = np.bincount(u, n, size)
            tables = np.bincount(u, t, size)
            part = np.outer(strength + discount * tables, parent)
            part[u, w] += n - discount * t
            weights.append(part / (customers + strength)[:, None])
    return np.mean(weights, axis=0)


def _seater(load, sweep: int, discount: float, strength: float):
    def reseat(group: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([sweep, int(group.u.min()) % TASKS])
        group = group.sort_values(["u", "w"])
        dishes, place = group.w.to_numpy(), group.u.to_numpy() // TASKS
        parent = load()[dishes]
        group["t"] = seat(group.n.to_numpy(), parent, discount, strength, rng, place)
        return group

    return reseat


class Levels(NamedTuple):
    """Counts that tokens of the last class have, in order, and the probability within it of a token of
    each count; count 0 is that of a token never seen."""

    counts: np.ndarray
    shares: np.ndarray

    def of(self, n: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.counts, n)
        return self.shares[np.minimum(at, len(self.counts) - 1)]


def rare_levels(levels: DataFrame, samples: int, strength: float) -> Levels:
    """``levels`` (n, m): there are m tokens of count n. One restaurant over all of them, on an even base
    over their types and one more, so that tokens of equal count are alike and share the mean of
    their tables. Its seating is spread over tasks: each sweep takes the number of tables of the
    last one.
    """
    n, m = F.col("n"), F.col("m")
    found = levels.agg(
        F.sum(m).alias("types"),
        F.sum(n * m).alias("n"),
        F.sum(F.when(n == 1, m)).alias("a"),
        F.sum(F.when(n == 2, m)).alias("b"),
    ).first()
    types, n_all, once = found.types or 0, found.n or 0, found.a or 0
    base = 1 / (types + 1)
    discount = absolute_discount(once, found.b or 0)
    cuts = F.explode(F.sequence(F.lit(0), F.floor((m - 1) / SLICE).cast("int"))).alias("cut")
    many = levels.filter("n > 1").select("n", "m", cuts)
    many = many.withColumn("m", F.least(F.lit(SLICE), m - F.col("cut") * SLICE))
    many = many.repartition(TASKS, "n", "cut")

    def seating(sweep: int, draws: int, tables: float):
        def seated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                batch = batch.sort_values(["n", "cut"])
                for _, x in batch.groupby(batch.m.cumsum() // AT_ONCE):
                    rng = np.random.default_rng([sweep, int(x.n.iloc[0]), int(x.cut.iloc[0])])
                    counts, m = x.n.to_numpy(), x.m.to_numpy()
                    each = np.repeat(counts, m)
                    even = np.full(len(each), base)
                    t = sum(seat(each, even, discount, strength, rng, None, tables) for _ in range(draws))
                    yield pd.DataFrame({"n": counts, "t": np.add.reduceat(t, np.cumsum(m) - m)})

        return many.mapInPandas(seated, "n long, t long")

    tables = float(types)
    for sweep in range(2):
        tables = once + float(seating(sweep, 1, tables).agg(F.sum("t").alias("t")).first().t or 0)
    left = (strength + discount * tables) * base / (n_all + strength)
    seats = seating(2, samples, tables).groupBy("n").agg(F.sum("t").alias("t"))
    rows = levels.join(seats, "n", "left").toPandas().sort_values("n")  # a row for each count
    counts, m = rows.n.to_numpy(np.int64), rows.m.to_numpy(np.int64)
    mean = np.where(counts > 1, rows.t.fillna(0).to_numpy(float) / samples / np.maximum(m, 1), 1.0)
    kept = np.maximum(counts - discount * mean, 0) / (n_all + strength)
    return Levels(np.append(0, counts), np.append(0.0, kept) + left)


def levels_of(counts: DataFrame) -> DataFrame:
    return stored(counts.groupBy("n").agg(F.count("*").alias("m")))


def rare_tokens(
    counts: DataFrame, classes: dict[int, int], samples: int, strength: float
) -> tuple[DataFrame, float]:
    """(h, n, log_p) of all tokens, the probability being that within the class of all tokens not
    in ``classes``; and that of a token never seen."""
    rare = not_in(counts, classes)
    found = rare_levels(levels_of(rare), samples, strength)
    log_p = pa.table({"n": found.counts, "log_p": np.log10(found.shares)})
    table = rare.join(F.broadcast(counts.sparkSession.createDataFrame(log_p)), "n").select(
        "h", "n", "log_p"
    )
    whole = table.union(counts.join(rare, "h", "anti").withColumn("log_p", F.lit(0.0)))
    return stored(whole), math.log10(found.shares[0])


def not_in(counts: DataFrame, classes: dict[int, int]) -> DataFrame:
    return counts.filter(~F.col("h").isin(list(classes))) if classes else counts


class Sizes(NamedTuple):
    """Tokens with numbers, of which the first are classes of their own."""

    known: int
    classes: int

    @property
    def whole(self) -> int:
        return (self.classes + 1) ** 2 + 2 * self.known + 2


class Sums(NamedTuple):
    """Sums over pairs: by their classes, by first and by second token with a number; and how many pairs
    occur once and twice. All are bounded by the parameters."""

    cells: np.ndarray
    first: np.ndarray
    second: np.ndarray
    twice: np.ndarray


def add(total: np.ndarray, size: Sizes, u, w, by_class, by_token) -> None:
    c = size.classes + 1
    at = place(u, size.classes) * c + place(w, size.classes)
    square, k = c * c, size.known
    total[:square] += np.bincount(at, by_class, square).astype(np.int64)
    for start, codes in ((square, u), (square + k, w)):
        total[start : start + k] += np.bincount(place(codes, k), by_token, k + 1)[:k].astype(np.int64)


def slices(total: np.ndarray) -> pd.DataFrame:
    cut = [x for x in np.array_split(total, TASKS) if len(x)]
    rows = [(i, len(x), pack(x)) for i, x in enumerate(cut)]
    return pd.DataFrame(rows, columns=["slice", "width", "sums"])


SLICES = "slice int, width long, sums binary"


def collected(parts: DataFrame, size: Sizes, at_once: int = BLOCKS_AT_ONCE) -> Sums:
    """Sums of tasks, added slice by slice."""

    def added(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpack(x.sums, x.width) for x in group.itertuples())
        return pd.DataFrame([(key[0], len(total), pack(total))], columns=["slice", "width", "sums"])

    with rows_at_once(parts.sparkSession, at_once):
        rows = parts.groupBy("slice").applyInPandas(added, SLICES).collect()
    total = np.zeros(size.whole, np.int64)
    if rows:
        total = np.concatenate([unpack(r.sums, r.width) for r in sorted(rows, key=lambda r: r.slice)])
    c, k = size.classes + 1, size.known
    cells, first, second, twice = np.split(total, [c * c, c * c + k, c * c + 2 * k])
    return Sums(cells.reshape(c, c), first, second, twice)


def both(one: Sums, two: Sums) -> Sums:
    return Sums(*(a + b for a, b in zip(one, two)))


def counted_here(kind: int, u: np.ndarray, size: Sizes) -> np.ndarray:
    """Which pairs of a block count: those of two tokens without numbers are in two blocks."""
    return place(u, size.known) < size.known if kind == BY_SECOND else np.ones(len(u), bool)


def first_sums(blocks: DataFrame, size: Sizes) -> Sums:
    """Occurrences by class, and distinct pairs by token."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size.whole, np.int64)
        for batch in batches:
            for row in batch.itertuples():
                u, w, n = unpacked(row, ("u", "w", "n"))
                here = counted_here(row.kind, u, size) & (n > 0)
                u, w, n = u[here], w[here], n[here]
                add(total, size, u, w, n, n > 0)
                total[-2:] += (n == 1).sum(), (n == 2).sum()
        yield slices(total)

    return collected(pairs_in(blocks).mapInPandas(count, SLICES), size)


def pairs_in(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("kind") != TEXTS).select("kind", "part", "pairs", "u", "w", "n")


class Parents(NamedTuple):
    """What a sweep knows. ``probabilities``: of a class after another. ``shares``, ``tables``,
    ``customers``: of tokens with numbers, the probability within its class, and the restaurant it
    is the context of. ``levels``: shares of other tokens."""

    size: Sizes
    probabilities: np.ndarray
    shares: np.ndarray
    tables: np.ndarray
    customers: np.ndarray
    levels: Levels
    discount: float
    strength: float

    def parent(self, u: np.ndarray, w: np.ndarray, served: np.ndarray | None = None) -> np.ndarray:
        """``served``: customers of ``w`` in the restaurant of the last class, if it has no number."""
        at = place(w, self.size.known)
        share = np.append(self.shares, 0)[at]
        if served is not None:
            share = np.where(at < self.size.known, share, self.levels.of(served))
        c = self.size.classes
        return self.probabilities[place(u, c), place(w, c)] * share

    def of_first(self, u: np.ndarray, values: np.ndarray, others: np.ndarray) -> np.ndarray:
        at = place(u, self.size.known)
        return np.where(at < self.size.known, np.append(values, 0)[at], others)

    def seats(self, n, parent, tables, rng: np.random.Generator, samples: int) -> np.ndarray:
        """Tables of pairs, summed over ``samples`` draws. A single customer has a single table."""
        t = samples * (n > 0)
        many = np.flatnonzero(n > 1)
        n, parent, tables = n[many], parent[many], tables[many].astype(float)
        draws = (seat(n, parent, self.discount, self.strength, rng, None, tables) for _ in range(samples))
        t[many] = sum(draws)
        return t

    def score(self, u, w, n, t, parent, customers, tables) -> np.ndarray:
        """Logarithm of the probability of ``w`` in the restaurant of ``u``."""
        own = np.maximum(n - self.discount * t, 0)
        left = (self.strength + self.discount * tables) * parent
        return np.log10((own + left) / (customers + self.strength))

    def seats_known(self, row, sweep: int, samples: int) -> tuple[np.ndarray, ...]:
        u, w, n = unpacked(row, ("u", "w", "n"))
        parent, rng = self.parent(u, w), np.random.default_rng([sweep, row.part])
        return u, w, n, parent, self.seats(n, parent, self.tables[u], rng, samples)


def block_seats(blocks: DataFrame, parents: Parents, sweep: int, samples: int) -> Sums:
    """Sums of the tables of pairs with numbers, and of all pairs that occur once."""
    load, size = shared(blocks.sparkSession, parents), parents.size

    def reseat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = load(), np.zeros(size.whole, np.int64)
        for batch in batches:
            for row in batch.itertuples():
                if row.kind == KNOWN:
                    u, w, _, _, t = known.seats_known(row, sweep, samples)
                else:
                    u, w, n = unpacked(row, ("u", "w", "n"))
                    here = counted_here(row.kind, u, size) & (n == 1)
                    u, w, t = u[here], w[here], np.full(here.sum(), samples)
                add(total, size, u, w, t, t)
        yield slices(total)

    return collected(pairs_in(blocks).mapInPandas(reseat, SLICES), size)


def frequent_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs that occur more than once and have a token without a number: u, w, n; of each such token
    the part it is in (else -1), its types of neighbours or its occurrences, and the pairs in which
    it occurs once."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                u, w, n = unpacked(row, ("u", "w", "n"))
                first = row.kind == BY_FIRST
                _, token = np.unique(u if first else w, return_inverse=True)
                whole = np.bincount(token, n > 0 if first else n).astype(np.int64)
                once = np.bincount(token, n == 1).astype(np.int64)
                here = n > 1
                own = {"part": row.part, "whole": whole[token][here], "once": once[token][here]}
                other = {"part": -1, "whole": 0, "once": 0}
                sides = {1: own if first else other, 2: other if first else own}
                named = {f"{x}{i}": v for i, side in sides.items() for x, v in side.items()}
                yield pd.DataFrame({"u": u[here], "w": w[here], "n": n[here], **named})

    names = [f"{x}{i}" for i in (1, 2) for x in ("part", "whole", "once")]
    schema = "u long, w long, n long, " + ", ".join(f"{x} long" for x in names)
    sides = pairs_in(blocks).filter(F.col("kind") != KNOWN).mapInPandas(rows, schema)
    with rows_at_once(blocks.sparkSession, BLOCKS_AT_ONCE):
        return stored(sides.groupBy("u", "w").agg(*(F.max(x).alias(x) for x in ["n", *names])))


def reseated(rows: DataFrame, parents: Parents, sweep: int, samples: int) -> DataFrame:
    """``rows`` (u, w, n, tables, served) with t, the sum of their tables over ``samples`` draws."""
    load = shared(rows.sparkSession, parents)

    def reseat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = load()
        for x in batches:
            if not len(x):
                continue
            u, w, n, tables, served = (x[c].to_numpy() for c in ("u", "w", "n", "tables", "served"))
            rng = np.random.default_rng([sweep, int(u[0]) & 0xFFFFFFFF, int(w[0]) & 0xFFFFFFFF])
            tables = known.of_first(u, known.tables, tables)
            yield x.assign(t=known.seats(n, known.parent(u, w, served), tables, rng, samples))

    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns]
    return stored(rows.mapInPandas(reseat, ", ".join([*fields, "t long"])))


def row_sums(rows: DataFrame, size: Sizes) -> Sums:
    """Sums of the tables of single pairs (u, w, t)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size.whole, np.int64)
        for x in batches:
            t = x.t.to_numpy()
            add(total, size, x.u.to_numpy(), x.w.to_numpy(), t, t)
        yield slices(total)

    return collected(rows.select("u", "w", "t").mapInPandas(count, SLICES), size, 10_000)


def single_levels(blocks: DataFrame) -> DataFrame:
    """(n, m): m tokens without numbers follow n others, and each of these once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                w, n = unpacked(row, ("w", "n"))
                _, token = np.unique(w, return_inverse=True)
                total, once = np.bincount(token, n), np.bincount(token, n == 1)
                levels, m = np.unique(once[(once == total) & (once > 0)], return_counts=True)
                yield pd.DataFrame({"n": levels.astype(np.int64), "m": m})

    sides = pairs_in(blocks).filter(F.col("kind") == BY_SECOND)
    return sides.mapInPandas(count, "n long, m long")


def doubly_rare(blocks: DataFrame, size: Sizes, parts: int) -> DataFrame:
    """(part, u, w, once) of pairs of two tokens without numbers: the part of the first, and the pairs in
    which the second occurs once."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                u, w, n = unpacked(row, ("u", "w", "n"))
                _, token = np.unique(w, return_inverse=True)
                once = np.bincount(token, n == 1).astype(np.int64)[token]
                here = ~counted_here(row.kind, u, size)
                u, w, once = u[here], w[here], once[here]
                yield pd.DataFrame({"part": part_of(u, parts), "u": u, "w": w, "once": once})

    sides = pairs_in(blocks).filter(F.col("kind") == BY_SECOND)
    return sides.mapInPandas(rows, "part int, u long, w long, once long")


SCORES = "range long, width long, texts binary, score binary, base binary, known binary"
TEXTS_IN_RANGE = 13  # bits


def by_text(block_at, spread, times, *values) -> list[np.ndarray]:
    """Texts, and the sums of the values of the pairs they hold."""
    texts, number = np.unique(block_at, return_inverse=True)
    return [texts, *(np.bincount(number, times * np.repeat(x, spread), len(texts)) for x in values)]


def known_scores(blocks: DataFrame, parents: Parents, sweep: int, samples: int, last: Parents) -> DataFrame:
    """Scores of the pairs with numbers, by text: the seats of the sweep are drawn again."""
    load = shared(blocks.sparkSession, (parents, last))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        then, now = load()
        held, n = [], 0
        for batch in batches:
            for row in batch.itertuples():
                u, w, c, parent, t = then.seats_known(row, sweep, samples)
                spread, at, times = unpacked(row, ("spread", "at", "times"))
                x = now.score(u, w, c, t / samples, parent, now.customers[u], now.tables[u])
                held.append(by_text(at, spread, times, x))
                n += len(held[-1][0])
                if n >= AT_ONCE:
                    held = [summed(held)]
                    n = len(held[0][0])
                if n >= AT_ONCE:
                    yield scores(*held[0])
                    held, n = [], 0
        if held:
            yield scores(*summed(held))

    def summed(held: list) -> list[np.ndarray]:
        texts, number = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return [texts, np.bincount(number, np.concatenate([x for _, x in held]), len(texts))]

    found = blocks.filter(F.col("kind") == KNOWN).drop("row").mapInPandas(score, SCORES)
    with rows_at_once(blocks.sparkSession, BLOCKS_AT_ONCE):
        return stored(found)


def scores(texts: np.ndarray, *sums: np.ndarray) -> pd.DataFrame:
    """Sums of texts as arrays, a row for each range of texts: at most one sum for each pair of a text."""
    sums = [*(x.astype(float) for x in sums), *[np.zeros(len(texts))] * (3 - len(sums))]
    ranges, starts = np.unique(texts >> TEXTS_IN_RANGE, return_index=True)
    cut = [slice(a, b) for a, b in zip(starts, np.append(starts[1:], len(texts)))]
    rows = [
        (r, len(texts[c]), pack(texts[c]), *(pack(x[c].view(np.int64)) for x in sums))
        for r, c in zip(ranges, cut)
    ]
    return pd.DataFrame(rows, columns=["range", "width", "texts", "score", "base", "known"])


def scores_of_texts(parts: DataFrame) -> DataFrame:
    """(row, score_of, base_of, known_of): the sums of all parts."""

    def total(group: pd.DataFrame) -> pd.DataFrame:
        texts = np.concatenate([unpack(x.texts, x.width) for x in group.itertuples()])
        texts, number = np.unique(texts, return_inverse=True)
        found = {"row": texts}
        for name in ("score", "base", "known"):
            sums = [unpack(getattr(x, name), x.width).view(float) for x in group.itertuples()]
            found[f"{name}_of"] = np.bincount(number, np.concatenate(sums), len(texts))
        return pd.DataFrame(found).astype({"known_of": np.int64})

    schema = "row long, score_of double, base_of double, known_of long"
    return parts.groupBy("range").applyInPandas(total, schema)


def other_scores(
    blocks: DataFrame, replies: DataFrame, parents: Parents, samples: int, whole: float
) -> DataFrame:
    """Scores, by text, of the pairs with a token that has no number. ``replies`` (kind, part, u, w, t,
    served) gives the tables of pairs that occur more than once, and the customers of their second
    token."""
    load, size = shared(blocks.sparkSession, parents), parents.size

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return scores(np.zeros(0, np.int64))
        known, row = load(), next(left.itertuples())
        u, w, n, spread, at, times = unpacked(row)
        keys, names = pair_keys(u, w), pair_keys(right.u.to_numpy(), right.w.to_numpy())
        order = np.argsort(keys)
        place_of = order[np.searchsorted(keys[order], names)]
        t, served = np.where(n == 1, samples, 0), np.zeros(len(u), np.int64)
        given = right.t.to_numpy()
        t[place_of[given >= 0]] = given[given >= 0]
        np.maximum.at(served, place_of, right.served.to_numpy())
        first = row.kind == BY_FIRST
        _, token = np.unique(u if first else w, return_inverse=True)
        total = np.bincount(token, n)[token]
        if first:
            tables = np.bincount(token, t)[token] / samples
            x = known.score(u, w, n, t / samples, known.parent(u, w, served), total, tables)
            return scores(*by_text(at, spread, times, x))
        most = np.bincount(token, n == 1).astype(np.int64)
        np.maximum.at(most, token, served)
        code = np.where(counted_here(row.kind, u, size), u, 0)
        parent = known.parent(code, w, most[token])
        x = known.score(code, w, n, t / samples, parent, known.customers[code], known.tables[code])
        x = np.where(counted_here(row.kind, u, size), x, 0.0)
        return scores(*by_text(at, spread, times, x, np.log10(total + 1) - whole, total > 0))

    others = blocks.filter(F.col("kind").isin(BY_FIRST, BY_SECOND))
    joined = others.groupBy("kind", "part").cogroup(replies.groupBy("kind", "part"))
    return joined.applyInPandas(score, SCORES)


def score_texts(
    docs: DataFrame,
    n_classes: int = 511,
    most_known: int = 100_000,
    burn_in: int = 2,
    samples: int = 3,
    strength: float = 1.0,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs`` (doc_id, text).

    Tokens are words in ASCII lower case and one end per text. All counts cover all texts that are
    not held out. Every token is a context with a restaurant of all tokens that follow it. Its
    parent is the probability of the token's class after the context's class, times that of the
    token within its class: the ``n_classes`` most frequent tokens (the end among them) are classes
    of their own, one more holds all other tokens, whose restaurant covers all of them. Customers
    of the parents are the tables below them: restaurants are seated under parents of raw counts,
    the parents anew from their tables, then the restaurants again. ``score`` is the logarithm of
    the predictive probability of the text, ``base_score`` that of counts plus one; the perplexity
    is 10 ** (-score / n_tokens).

    The ``most_known`` most frequent tokens travel to the tasks as numbers. Pairs of them are counted,
    seated and scored where they are; pairs with other tokens lie by these, and those that occur more
    than once are rows, so vocabulary and pairs may have any number. Tokens are told apart by 64-bit
    hashes. Texts are cut into tokens twice: once for the counts of tokens, once for the pairs.

    Null and empty texts are one end. Repeated rows each get their score; rows without doc_id count
    as doc_id of empty text. Without training rows every class is equally likely. An empty table
    gives no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", held_out(MODULUS).alias("held_out"), "text")
    counts = stored(token_counts(docs.filter("not held_out")))
    totals = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    n_tokens, n_types = totals.n or 0, totals.v
    top = counts.orderBy(F.desc("n"), "h").limit(n_classes).collect()
    frequent = [word_hash(END), *(r.h for r in top if r.h != word_hash(END))][:n_classes]
    classes = {h: i for i, h in enumerate(frequent)}
    most = most_frequent(counts, most_known).union(counts.filter(F.col("h") == word_hash(END)))
    found = {r.h: r.n for r in [*top, *most.toLocalIterator()]}
    known = [*frequent, *sorted(found.keys() - classes.keys(), key=lambda h: (-found[h], h))]
    n_known = np.array([found.get(h, 0) for h in known], np.int64)
    whole = math.log10(n_tokens + n_types + 1)
    size, parts = Sizes(len(known), len(classes)), n_tokens // PAIRS_IN_BLOCK + 1
    vocabulary = Vocabulary({h: i for i, h in enumerate(known)}, n_known, whole)
    blocks = pair_blocks(docs, vocabulary, parts)

    def parents_of(cells, served, levels, tables) -> Parents:
        probabilities = gibbs(class_pairs(spark, cells), len(classes) + 1, burn_in, samples, strength)
        shares = np.where(np.arange(size.known) < size.classes, 1.0, levels.of(served))
        return Parents(size, probabilities, shares, tables, n_known, levels, discount, strength)

    pairs = first_sums(blocks, size)
    discount = absolute_discount(*map(int, pairs.twice))
    levels = rare_levels(levels_of(not_in(counts, classes)), samples, strength)
    parents = parents_of(pairs.cells, n_known, levels, pairs.first)
    many = frequent_pairs(blocks)
    rows = many.withColumns({"tables": F.col("whole1").cast("double"), "served": F.col("whole2")})
    seats = reseated(rows, parents, 0, 1).drop("tables", "served", "whole1", "whole2")
    seated = both(block_seats(blocks, parents, 0, 1), row_sums(seats, size))

    # The parents again, from the tables below them.
    by_first = seats.filter("part1 >= 0").groupBy("u").agg(F.sum("t").alias("tables"))
    by_second = seats.filter("part2 >= 0").groupBy("w")
    by_second = by_second.agg((F.sum("t") + F.max("once2")).alias("served"))
    second = seated.second[size.classes :]
    levels = (
        single_levels(blocks)
        .union(by_second.groupBy(F.col("served").alias("n")).agg(F.count("*").alias("m")))
        .union(spark.createDataFrame(pa.table({"n": second, "m": np.ones_like(second)})).filter("n > 0"))
    )
    levels = stored(levels.groupBy("n").agg(F.sum("m").alias("m")))
    levels = rare_levels(levels, samples, strength)
    parents = parents_of(seated.cells, seated.second, levels, seated.first)
    rows = seats.drop("t").join(by_first, "u", "left").join(by_second, "w", "left")
    tables = (F.coalesce("tables", F.lit(0)) + F.col("once1")).cast("double")
    rows = rows.withColumns({"tables": tables, "served": F.coalesce("served", F.lit(0))})
    seats = reseated(rows, parents, 1, samples)
    seated = both(block_seats(blocks, parents, 1, samples), row_sums(seats, size))
    last = parents._replace(tables=seated.first / samples)

    once = doubly_rare(blocks, size, parts).join(by_second, "w", "left")
    served = F.coalesce("served", "once").alias("served")
    first, second = (F.lit(x).alias("kind") for x in (BY_FIRST, BY_SECOND))
    replies = once.select(first, "part", "u", "w", F.lit(-1).cast("long").alias("t"), served)
    for kind, part in ((first, "part1"), (second, "part2")):
        there = seats.filter(F.col(part) >= 0)
        replies = replies.union(
            there.select(kind, F.col(part).cast("int").alias("part"), "u", "w", "t", "served")
        )
    found = known_scores(blocks, parents, 1, samples, last)
    found = found.union(other_scores(blocks, replies, last, samples, whole))
    return (
        blocks.filter(F.col("kind") == TEXTS)
        .join(scores_of_texts(found), "row")
        .select(
            F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.col("known_of")).alias("n_known"),
            F.lit(n_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.col("base_of")).alias("base_score"),
            F.col("score_of").alias("score"),
        )
    )


def most_frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows of the highest counts, at most ``most``: whole levels of two per cent in the count,
    whose sizes are summed from the top, so that nothing is sorted."""
    level = F.floor(F.log(F.col("n").cast("double")) * 50)
    sizes = table.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()
    left, least = most, None
    for row in sorted(sizes, reverse=True):
        left -= row.n
        if left < 0:
            break
        least = row.level
    return table.filter(F.lit(False) if least is None else level >= least)
