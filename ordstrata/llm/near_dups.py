"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import Cache, stored

COMPONENTS = 48
MISSED = 1e-5  # chance at most that a pair at the threshold is beyond the radius
ERRORS = 1
LANES = 3  # 16-bit components in a long, so that its sign bit stays free
PACKED = [f"s{i}" for i in range(COMPONENTS // LANES)]
SKETCH_BITS = 1024
SKETCH = [f"o{i}" for i in range(SKETCH_BITS // 64)]
MOST_SENT = 200_000  # ids of at most this number are sent to all tasks, more are shuffled
ODD = np.random.default_rng(7).integers(1, 2**63, COMPONENTS + 3, dtype=np.uint64) | np.uint64(1)


@cache
def radius_of(percent: int) -> int:
    """The least number of differing components that pairs of this similarity exceed with a chance
    of at most ``MISSED``: components differ independently, each with the sets' dissimilarity."""
    miss, beyond, radius = 1 - percent / 100, 0.0, COMPONENTS
    while radius > 0:
        beyond += comb(COMPONENTS, radius) * miss**radius * (1 - miss) ** (COMPONENTS - radius)
        if beyond > MISSED:
            break
        radius -= 1
    return radius


def missed(percent: int) -> float:
    """The chance that a pair of this similarity shares no key: every chunk has more errors than
    allowed."""
    miss, out = 1 - percent / 100, 1.0
    for n in map(len, chunks(COMPONENTS, radius_of(percent))):
        out *= 1 - sum(comb(n, e) * miss**e * (1 - miss) ** (n - e) for e in range(ERRORS + 1))
    return out


def chunks(n: int, radius: int, errors: int = ERRORS) -> list[range]:
    """Chunks of ``n`` components such that any two signatures that differ in at most ``radius``
    components differ in at most ``errors`` of them within some chunk: were there more than
    ``errors`` in each of m chunks, m * (errors + 1) > radius components would differ."""
    m = radius // (errors + 1) + 1
    edges = [round(i * n / m) for i in range(m + 1)]
    return [range(a, b) for a, b in zip(edges, edges[1:])]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """The set of a text: sorted distinct 64-bit hashes of its shingles of ``n`` words."""

    def __init__(self, n: int):
        self.n = n
        self.words = Cache(lambda w: xxhash.xxh64_intdigest(w, 11))

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # both on ASCII alone
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.n:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), 13)], np.uint64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        last = len(w) - self.n + 1
        joined = sum(w[i : i + last] * ODD[COMPONENTS + i % 3] * ODD[i] for i in range(self.n))
        return np.unique(mixed(joined))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the least value of each hash function over the set."""
    least = np.full(COMPONENTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        hashed = np.multiply.outer(ODD[:COMPONENTS], shingles[at : at + 4096])
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least & np.uint64(0xFFFF)).astype(np.uint16)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """1024 bits, each the parity of the number of members that fall on it. Members that two sets
    share cancel out, so the bits in which two sketches differ are no more than the members in
    which the sets differ."""
    fallen = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS)
    return np.packbits((fallen & 1).astype(np.uint8)).view(np.int64)


def signed(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, set size, a 128-bit name of the set, the packed signature and the sketch of every
    row."""
    names = ["doc_id", "n_shingles", "set_a", "set_b", *PACKED, *SKETCH]

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(n)
        shifts = np.array([16 * i for i in range(LANES)], np.int64)
        for batch in batches:
            sizes, sets = [], []
            packed = np.zeros((len(batch), len(PACKED)), np.int64)
            sketch = np.zeros((len(batch), len(SKETCH)), np.int64)
            for i, text in enumerate(batch.text):
                shingles = shingle(text)
                sizes.append(len(shingles))
                name = xxhash.xxh128_intdigest(shingles.tobytes())
                sets.append((name >> 65, name & (2**63 - 1)))
                if len(shingles):
                    parts = signature(shingles).astype(np.int64).reshape(-1, LANES)
                    packed[i] = (parts << shifts).sum(axis=1)
                    sketch[i] = odd_sketch(shingles)
            a, b = zip(*sets) if sets else ((), ())
            columns = [batch.doc_id.astype("Int64"), sizes, a, b, *packed.T, *sketch.T]
            yield pd.DataFrame(dict(zip(names, columns)))

    schema = ", ".join(f"{c} long" for c in names)
    return docs.select("doc_id", "text").mapInPandas(sign, schema)


def chunk_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, id): for every chunk and every choice of allowed errors, a hash of the components of
    the chunk that are left."""
    masks = [
        (c, [x for x in chunk if x not in missing])
        for c, chunk in enumerate(chunks(COMPONENTS, radius_of(percent)))
        for missing in combinations(chunk, ERRORS)
    ]

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = batch[PACKED].to_numpy(np.uint64)
            lanes = [(packed >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(LANES)]
            parts = np.stack(lanes, axis=2).reshape(len(batch), COMPONENTS)
            for number, (_, rest) in enumerate(masks):
                key = np.full(len(batch), number + 1, np.uint64)
                for x in rest:
                    key = mixed(key * ODD[1] + parts[:, x])
                yield pd.DataFrame({"key": key.view(np.int64), "id": batch.id})

    return sets.select("id", *PACKED).mapInPandas(keys, "key long, id long")


def distance(left: str, right: str) -> Column:
    """Components in which two packed signatures differ, 16 bits at a time."""
    low = F.lit(sum(0x7FFF << 16 * i for i in range(LANES)))
    high = F.lit(sum(0x8000 << 16 * i for i in range(LANES)))
    out = []
    for c in PACKED:
        x = F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))
        out.append(F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high)))
    return reduce(add, out)


def may_link(left: str, right: str, percent: int) -> Column:
    """Neither the sizes nor the sketches rule a link out, which no true link fails: sets that share ``percent`` of their union differ in at most (100 - percent) / (100 + percent)
    of their summed sizes."""
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    sizes = 100 * F.least(a, b) >= percent * F.greatest(a, b)
    apart = [F.bit_count(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))) for c in SKETCH]
    sketches = (100 + percent) * reduce(add, apart) <= (100 - percent) * (a + b)
    return sizes & sketches


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have ``percent`` of their union in common."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    if ids.count() <= MOST_SENT:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")

    def shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(n)
        for batch in batches:
            sets = [shingle(t).tobytes() for t in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id, "shingles": sets})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.x, batch.y):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    sets = stored(texts.mapInPandas(shingle_sets, "doc_id long, shingles binary"))
    sets = sets.dropDuplicates(["doc_id"])
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return stored(pairs.join(one, "a").join(two, "b").mapInPandas(compare, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the least id that each end of ``edges`` (a, b) reaches.

    Every round takes the least label among the neighbours and then the label of that label, until
    nothing changes; each round is a written table.
    """
    ends = stored(
        edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("id", "other")
    )
    labels = stored(
        ends.groupBy("id").agg(F.least("id", F.min("other")).alias("label"))
    )
    while True:
        near = ends.join(labels.select(F.col("id").alias("other"), "label"), "other")
        nearest = near.groupBy("id").agg(F.min("label").alias("near"))
        hooked = labels.join(nearest, "id").select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("next")
        )
        hop = labels.select(F.col("id").alias("next"), F.col("label").alias("hop"))
        moved = stored(
            hooked.join(hop, "next", "left").select(
                "id", "old", F.least("next", F.coalesce("hop", "next")).alias("label")
            )
        )
        labels = moved.select("id", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Two documents are linked if their sets of ``n``-word shingles (lower-cased ASCII; the whole
    sequence if shorter) share ``percent`` of their union; a component's id is the least doc_id in
    it, and that document is kept.

    Rows of equal sets become one class, grouped with partial minima, so copies cost no pairs. The
    MinHash signature of a class has 48 components of 16 bits. Signatures within a radius of
    differing components surely share a key (:func:`chunks`); the radius follows from ``percent``, so
    that a pair at the similarity threshold is further apart with a probability of at most 1e-5
    (:func:`radius_of`; :func:`missed` is the chance that it shares no key). Candidates are compared
    by set size and a sketch, which never refuse a link, then confirmed on the whole sets, in two
    passes:

    1. each class with the nearest first class of its keys: at most one pair per class;
    2. only within keys that still hold classes of different components: all pairs of different
       components there. Every pair that shares a key is so either confirmed,
       refused, or joined by a path already, and no link is lost.

    Large groups of near copies are joined in the first pass; what is left of a frequent key in the
    second is split by the skew join.

    A text without words has an empty set, is linked with nothing and kept. Rows without doc_id are
    linked with nothing and kept, their component is null. Rows with one doc_id count as one
    document. An empty table gives no rows. Further columns are not read.
    """
    rows = stored(signed(docs, n))
    classes = stored(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            *(F.first(c).alias(c) for c in [*PACKED, *SKETCH]),
        )
    )
    keyed = stored(chunk_keys(classes, percent))
    firsts = (
        keyed.groupBy("key")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .filter("first < last")
    )
    shared = stored(keyed.join(firsts.select("key", "first"), "key"))
    nearest = stored(_nearest(shared, classes, percent))
    links = confirmed(nearest, docs, n, percent)
    labels = components(links)

    labelled = shared.join(labels, "id", "left").select(
        "key", "id", F.coalesce("label", "id").alias("label")
    )
    open_keys = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("key")
    )
    rest = stored(labelled.join(open_keys, "key").join(classes, "id"))
    x, y = rest.alias("x"), rest.alias("y")
    within = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.label") != F.col("y.label"))
        & may_link("x", "y", percent)
    )
    pairs = x.join(y, within).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    pairs = stored(pairs.distinct().join(_as_pairs(nearest), ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        labels = components(links.union(confirmed(pairs, docs, n, percent)))

    component = (
        rows.join(classes.select("set_a", "set_b", "id"), ["set_a", "set_b"], "left")
        .join(labels, "id", "left")
        .withColumn(
            "component_id",
            F.when(
                F.col("n_shingles") > 0, F.least("doc_id", F.coalesce("label", "id"))
            ).otherwise(F.col("doc_id")),
        )
    )
    own = F.col("doc_id").isNotNull()
    return component.select(
        "doc_id",
        "n_shingles",
        F.when(own, F.col("component_id")).alias("component_id"),
        (~own | (F.col("doc_id") == F.col("component_id"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``docs`` with all columns and one document of each component; of rows that share a doc_id
    one stays, rows without doc_id all stay."""
    verdicts = stored(near_duplicates(docs, n, percent))
    dropped = stored(verdicts.filter(~F.col("kept")).select("doc_id").distinct())
    if dropped.count() <= MOST_SENT:
        dropped = F.broadcast(dropped)
    repeated = verdicts.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1")
    left = docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return left
    return left.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).union(
        left.filter("doc_id IS NULL")
    )


def _as_pairs(nearest: DataFrame) -> DataFrame:
    return nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _nearest(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Per class the pair with the closest first class of its keys that it may be linked to."""
    pairs = shared.filter("id > first").select("id", "first").distinct()
    x = classes.withColumnRenamed("id", "x_id").alias("x")
    y = classes.withColumnRenamed("id", "y_id").alias("y")
    near = (
        pairs.join(x, F.col("id") == F.col("x_id"))
        .join(y, (F.col("first") == F.col("y_id")) & may_link("x", "y", percent))
        .select("id", F.struct(distance("x", "y").alias("d"), "first").alias("found"))
    )
    nearest = near.groupBy("id").agg(F.min("found").alias("found"))
    return nearest.select(F.col("id").alias("a"), F.col("found.first").alias("b"))
