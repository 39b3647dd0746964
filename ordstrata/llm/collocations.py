"""Phrases whose words occur together more often than their parts would by chance."""

from __future__ import annotations

import pickle
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import count, pairwise
from math import ceil

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordstrata.llm.automata import (
    Automaton,
    built,
    composed,
    mixed,
    numbers,
    prefix_sums,
    summed,
    union,
)
from ordstrata.llm.common import shared, stored

LONGEST = 5
# Upper-case letters go to lower case, ends of pieces to a line end, tabs to a space.
LOWERED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t",
    b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ",
)
# Words of a shard, distinct sequences that a prefix range stands for before they are added, phrases
# of a range of counts, and bytes of a text that are split at once. All bound memory.
SHARD_WORDS, RANGE_ROWS, RANGE_PHRASES, CHUNK = 2_000_000, 1_000_000, 200_000, 4_000_000
# Ranges are cut at sampled sequences, which decide the sizes of ranges but no result. The numbers
# of ranges, sampled shards and samples and the first letters of words bound what is sent around.
MOST_RANGES, SAMPLED_SHARDS, SAMPLES, LETTERS = 100_000, 32, 2_000, 64
# Bits of the marks of frequent words or pairs, whatever their number: 16 MB.
MARK_BITS, SLICE_BITS = 27, 20
COUNTS = "lang string, phrase string, a long"
SHARDS = "lang string, n long, own long, words binary, read binary"
CELLS = "range int, lang string, automaton binary"
NO_LANGUAGE = "und"

Sequence = tuple[str, ...]


class _Numbers(dict):
    """Numbers words as they come, from 1. A line end is 0; nothing, between two blanks, is -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})
        self.next = count(1).__next__

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.next()
        return number


class _Shard:
    """Words of texts of one language; a 0 ends a piece."""

    def __init__(self):
        self.number, self.read = _Numbers(), array("i")

    def add(self, text: str) -> None:
        data = text.encode("utf-8", "surrogatepass").translate(LOWERED)
        at = 0
        while at < len(data):
            end = data.find(b" ", at + CHUNK)
            end = len(data) if end < 0 else end
            words = data[at:end].replace(b"\n", b" \n ").split(b" ")
            self.read.extend(map(self.number.__getitem__, words))
            at = end + 1
        self.read.append(0)

    def rows(self, lang: str) -> Iterator[tuple]:
        """(lang, n, own, words, read) for up to ``SHARD_WORDS`` places at a time: how many words
        there are, how many places, the sorted words, and their numbers at these places and up to
        four more, which belong to the next row."""
        read = np.array(self.read, np.int32)
        read = read[read >= 0]
        names = [w.decode("utf-8", "surrogatepass") for w in self.number if w not in (b"\n", b"")]
        for begin in range(0, len(read), SHARD_WORDS):
            part = read[begin : begin + SHARD_WORDS + LONGEST - 1]
            own = min(SHARD_WORDS, len(read) - begin)
            used = np.unique(part)
            order = sorted(used[used > 0].tolist(), key=lambda i: names[i - 1])
            new = np.zeros(len(names) + 1, np.int32)
            new[order] = np.arange(1, len(order) + 1)
            n = int(np.count_nonzero(part[:own]))
            yield lang, n, own, _packed([names[i - 1] for i in order]), _packed(new[part])


def _packed(value) -> bytes:
    if isinstance(value, np.ndarray):
        value = value.astype(np.min_scalar_type(int(value.max(initial=0))))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, 5))


def _unpacked(data: bytes):
    return pickle.loads(zstandard.decompress(data))


def shards(docs: DataFrame) -> DataFrame:
    """The texts as numbered words, a row for each language of up to some ``SHARD_WORDS`` words."""
    lang = F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")
    texts = docs.select(lang, F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, _Shard] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.lang, batch.text):
                shard = held.setdefault(lang, _Shard())
                size -= len(shard.read)
                shard.add(text)
                size += len(shard.read)
                if size >= SHARD_WORDS:
                    yield from _frames(held)
                    held, size = {}, 0
        yield from _frames(held)

    return texts.mapInPandas(run, SHARDS)


def _frames(held: dict[str, _Shard]) -> Iterator[pd.DataFrame]:
    for lang, shard in held.items():
        for row in shard.rows(lang):
            yield pd.DataFrame([row], columns=["lang", "n", "own", "words", "read"])


def _word_hash(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(f"{lang}\t{word}".encode("utf-8", "surrogatepass"))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - MARK_BITS)
    return (marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def frequent_marks(counts: DataFrame) -> Callable[[], np.ndarray]:
    """Bits, of fixed number, with one set for the hash of each word or pair of words in ``counts``.

    A word or pair without its bit is not there. One that has it may not be there either; it is
    counted for nothing then."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.lang, batch.phrase):
                found.append([_word_hash(lang, word) for word in phrase.split(" ")])
            hashes = np.array(found, np.uint64).reshape(len(found), -1)
            one = hashes[:, 0] if hashes.shape[1] < 2 else _pair_hash(hashes[:, 0], hashes[:, 1])
            place = (one >> np.uint64(64 - MARK_BITS)).astype(np.int64)
            yield pd.DataFrame({"slice": place >> SLICE_BITS, "place": place % (1 << SLICE_BITS)})

    def bits(key: tuple, places: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(1 << SLICE_BITS, np.uint8)
        found[places.place] = 1
        return pd.DataFrame([(key[0], np.packbits(found, bitorder="little").tobytes())], columns=["slice", "bits"])

    rows = counts.mapInPandas(places, "slice long, place long").distinct().groupBy("slice")
    width = 1 << (SLICE_BITS - 3)
    marks = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for row in rows.applyInPandas(bits, "slice long, bits binary").collect():  # 16 MB at most
        marks[row.slice * width : (row.slice + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return shared(counts.sparkSession, marks)


def _sequences(row, length: int, marks: list[np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, sorted distinct sequences and how often they begin at the places of a shard.

    Of ``length`` 1 they are the words, of 2 the pairs of frequent words, of 5 the sequences of three
    to five words all of whose pairs are frequent, up to the first that is not."""
    words: list[str] = _unpacked(row.words)
    read = np.concatenate([_unpacked(row.read).astype(np.int64), np.zeros(LONGEST, np.int64)])
    own, width = row.own, len(words) + 1
    if length == 1:
        n = np.bincount(read[:own], minlength=width)
        n[0] = 0
        rows = np.flatnonzero(n)
        return words, rows.astype(np.int32)[:, None], n[rows]
    hashes = np.array([0, *(_word_hash(row.lang, word) for word in words)], np.uint64)
    frequent = _marked(marks[0], hashes)
    frequent[0] = False
    # For short use: only frequent words keep a number.
    kept = np.flatnonzero(frequent)
    new = np.zeros(width, np.int64)
    new[kept] = np.arange(1, len(kept) + 1)
    words, hashes = [words[i - 1] for i in kept], np.concatenate([hashes[:1], hashes[kept]])
    read = new[read]
    width = len(words) + 1
    reach = own + LONGEST - 2
    pair = (read[:reach] > 0) & (read[1 : reach + 1] > 0)
    if length == 2:
        at = np.flatnonzero(pair[:own])
        keys, n = np.unique(read[at] * width + read[at + 1], return_counts=True)
        return words, np.stack([keys // width, keys % width], 1).astype(np.int32), n
    at = np.flatnonzero(pair)
    pair[at] = _marked(marks[1], _pair_hash(hashes[read[at]], hashes[read[at + 1]]))
    pair = np.concatenate([pair, np.zeros(LONGEST, bool)])
    at = np.flatnonzero(pair[:own] & pair[1 : own + 1])
    rows = np.zeros((len(at), LONGEST), np.int32)
    going = np.ones(len(at), bool)
    for k in range(LONGEST):
        if k:
            going &= pair[at + k - 1]
        rows[:, k] = np.where(going, read[at + k], 0)
    return words, *summed(rows, np.ones(len(rows), np.int64), len(words))


def _used(words: list[str], rows: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The words that occur in the rows, and the rows in their numbers."""
    used = np.unique(rows)
    used = used[used > 0]
    new = np.zeros(len(words) + 1, np.int32)
    new[used] = np.arange(1, len(used) + 1)
    return [words[i - 1] for i in used], new[rows]


def _prefix_ranges(table: DataFrame, length: int, marks: Callable[[], list]) -> list[Sequence]:
    """Sequences (language, words) in order at which ranges of some ``RANGE_ROWS`` sequences begin."""
    n_shards = table.count()
    fraction = min(1.0, SAMPLED_SHARDS / max(n_shards, 1))

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = marks()
        for batch in batches:
            for row in batch.itertuples():
                words, rows, _ = _sequences(row, length, bits)
                step = max(len(rows) // SAMPLES, 1)
                found = [
                    (row.lang, [words[i - 1][:LETTERS] for i in one if i], len(rows) / len(rows[::step]))
                    for one in rows[::step]
                ]
                yield pd.DataFrame(found, columns=["lang", "words", "weight"])

    sample = table if fraction == 1 else table.sample(fraction, 0)
    rows = sample.mapInPandas(drawn, "lang string, words array<string>, weight double").collect()
    return _cut_evenly([((r.lang, *r.words), r.weight / fraction) for r in rows], RANGE_ROWS)


def _cut_evenly(weighed: list[tuple[Sequence, float]], target: int) -> list[Sequence]:
    total = sum(weight for _, weight in weighed)
    n_ranges = min(ceil(total / target), MOST_RANGES)
    borders, upto = [], 0.0
    for place, weight in sorted(weighed):
        upto += weight
        if upto > (len(borders) + 1) * total / max(n_ranges, 1) and len(borders) + 1 < n_ranges:
            borders.append(place)
    return sorted(set(borders))


def _cut(words: list[str], rows: np.ndarray, borders: list[Sequence]) -> list[int]:
    """How many of the sorted rows lie before each border."""
    found = []
    number = {w: i for i, w in enumerate(words, 1)}
    for border in borders:
        low, high = 0, len(rows)
        for column, word in enumerate(border):
            exact = word in number
            at = number[word] if exact else bisect_right(words, word) + 1
            values = rows[low:high, column]
            high = low + int(np.searchsorted(values, at, "right" if exact else "left"))
            low += int(np.searchsorted(values, at))
            if not exact or low == high:
                break
        found.append(low)
    return found


def count_phrases(
    table: DataFrame, shortest: int, longest: int, least: int, marks: list[Callable[[], np.ndarray]]
) -> DataFrame:
    """(lang, phrase, a) of all phrases of ``shortest`` to ``longest`` words that occur ``least``
    times or more in the shards.

    Each shard's sequences, sorted, become an automaton for each prefix range. The automata of a
    range are united. Phrases that begin the first or the last sequence of a range may go on in its
    neighbour; their counts in all ranges are added."""
    spark = table.sparkSession

    def bits() -> list[np.ndarray]:
        return [mark() for mark in marks]

    borders = _prefix_ranges(table, longest, bits)
    borders_of = shared(spark, borders)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        borders, own_bits = borders_of(), bits()
        for batch in batches:
            for row in batch.itertuples():
                words, rows, weights = _sequences(row, longest, own_bits)
                first = bisect_right(borders, (row.lang,))
                last = bisect_right(borders, (row.lang + "\0",))
                cuts = _cut(words, rows, [border[1:] for border in borders[first:last]])
                found = []
                for i, (begin, end) in enumerate(pairwise([0, *cuts, len(rows)])):
                    if begin < end:
                        automaton = built(*_used(words, rows[begin:end]), weights[begin:end])
                        found.append((first + i, row.lang, automaton.packed()))
                yield pd.DataFrame(found, columns=["range", "lang", "automaton"])

    def united(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        found = []
        for lang, own in cells.groupby("lang", sort=False):
            words, rows, weights = union([Automaton.unpacked(a) for a in own.automaton])
            for length, starts, sums in prefix_sums(rows, weights):
                if length < shortest:
                    continue
                picked = sums >= least
                for edge in (rows[0], rows[-1]):
                    picked |= (rows[starts, :length] == edge[:length]).all(axis=1)
                for at, n in zip(starts[picked], sums[picked]):
                    found.append((lang, " ".join(words[i - 1] for i in rows[at, :length]), int(n)))
        return pd.DataFrame(found, columns=["lang", "phrase", "a"])

    parts = table.mapInPandas(cells, CELLS).groupBy("range").applyInPandas(united, COUNTS)
    added = parts.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return stored(added.filter(F.col("a") >= least))


def phrase_counts(table: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a) of all phrases of one to five words that occur ``least`` times or more.

    A phrase that often has no rarer part. So words are counted first, then pairs of frequent words,
    then longer sequences of frequent pairs; what is frequent is sent to the tasks as marks of fixed
    size, which let through what they cannot tell."""
    words = count_phrases(table, 1, 1, least, [])
    marks = [frequent_marks(words)]
    pairs = count_phrases(table, 2, 2, least, marks)
    marks.append(frequent_marks(pairs))
    return words.union(pairs).union(count_phrases(table, 3, LONGEST, least, marks))


def ranged(counts: DataFrame) -> tuple[DataFrame, list[Sequence]]:
    """``counts`` with the ``range`` in which a phrase falls, and the borders of the ranges."""
    n = counts.count()
    fraction = min(1.0, SAMPLED_SHARDS * SAMPLES / max(n, 1))
    sample = counts if fraction == 1 else counts.sample(fraction, 0)
    drawn = [
        ((r.lang, *(w[:LETTERS] for w in r.phrase.split(" "))), 1 / fraction)
        for r in sample.select("lang", "phrase").collect()
    ]
    borders = _cut_evenly(drawn, RANGE_PHRASES)
    borders_of = shared(counts.sparkSession, borders)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        borders = borders_of()
        for batch in batches:
            batch["range"] = [
                bisect_right(borders, (lang, *phrase.split(" ")))
                for lang, phrase in zip(batch.lang, batch.phrase)
            ]
            yield batch.astype({"range": "int32"})

    return stored(counts.mapInPandas(place, f"{COUNTS}, range int")), borders


def _grams(counts: pd.DataFrame) -> dict[Sequence, int]:
    """Counts by (language, words), in order."""
    return dict(
        sorted(((lang, *p.split(" ")), a) for lang, p, a in zip(counts.lang, counts.phrase, counts.a))
    )


def _parts(grams: dict[Sequence, int], borders: list[Sequence]) -> dict[int, dict[Sequence, int]]:
    """The parts of all phrases by the range they fall in, each with the highest count of a phrase
    that is one word longer, or 0."""
    asked: dict[Sequence, int] = {}
    for gram, a in grams.items():
        lang, words = gram[0], gram[1:]
        for k in range(1, len(words)):
            for part in ((lang, *words[:k]), (lang, *words[k:])):
                weight = a if len(part) == len(words) else 0
                asked[part] = max(asked.get(part, 0), weight)
    places: dict[int, dict[Sequence, int]] = {}
    for part in sorted(asked):
        places.setdefault(bisect_right(borders, part), {})[part] = asked[part]
    return places


def _automaton(weights: dict[Sequence, int]) -> Automaton:
    words, rows = numbers(list(weights), LONGEST + 1)
    rows, sums = summed(rows, np.array(list(weights.values()), np.int64), len(words))
    return built(words, rows, sums)


def cut_counts(counts: DataFrame, borders: list[Sequence]) -> DataFrame:
    """(lang, phrase, a, cuts) of all phrases of two words or more that no longer phrase covers;
    ``cuts`` holds the counts (l, r) of both parts for each cut.

    Each range makes an automaton of the parts that it asks a range for. The range composes it with
    the automaton of its counts and answers, and marks what a phrase one word longer covers (any
    longer one that does so covers those between as well). A part that many phrases share is asked
    for once by each range."""
    borders_of = shared(counts.sparkSession, borders)

    def ask(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        asked = _parts(_grams(counts), borders_of())
        found = [
            (target, key[0], _automaton({p: w + 1 for p, w in parts.items()}).packed())
            for target, parts in asked.items()
        ]
        return pd.DataFrame(found, columns=["target", "source", "asked"])

    def answer(key: tuple, asked: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        grams = _grams(counts)
        automaton = _automaton(grams)
        found, covered = [], {}
        for source, data in zip(asked.source, asked.asked):
            query = Automaton.unpacked(data)
            rows, weights, sums = composed(query, automaton)
            found.append((source, key[0], sums.astype(np.int64).tobytes(), None))
            for row in rows[weights - 1 >= sums]:
                gram = tuple(query.words[i - 1] for i in row if i)
                covered[gram[0], " ".join(gram[1:])] = None
        if covered:
            found.append((key[0], -1, None, [f"{lang}\t{phrase}" for lang, phrase in covered]))
        return pd.DataFrame(found, columns=["source", "target", "sums", "covered"])

    def gather(key: tuple, answers: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        grams = _grams(counts)
        sums = {t: np.frombuffer(s, np.int64) for t, s in zip(answers.target, answers.sums) if t >= 0}
        covered = {c for cs in answers.covered if cs is not None for c in cs}
        known: dict[Sequence, int] = {}
        for target, parts in _parts(grams, borders_of()).items():
            known.update(zip(parts, sums[target].tolist()))
        found = []
        for gram, a in grams.items():
            lang, words = gram[0], gram[1:]
            phrase = " ".join(words)
            if len(words) > 1 and f"{lang}\t{phrase}" not in covered:
                cuts = [
                    {"l": known[lang, *words[:k]], "r": known[lang, *words[k:]]}
                    for k in range(1, len(words))
                ]
                found.append((lang, phrase, a, cuts))
        return pd.DataFrame(found, columns=["lang", "phrase", "a", "cuts"])

    by_range = counts.groupBy("range")
    asked = by_range.applyInPandas(ask, "target int, source int, asked binary")
    answers = (
        asked.groupBy("target")
        .cogroup(by_range)
        .applyInPandas(answer, "source int, target int, sums binary, covered array<string>")
    )
    return (
        answers.groupBy("source")
        .cogroup(by_range)
        .applyInPandas(gather, "lang string, phrase string, a long, cuts array<struct<l long, r long>>")
    )


def collocations(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best ``most`` phrases of each language of
    ``docs`` (lang, text).

    A phrase of two to five words that occurs ``a`` times, ``least`` or more, has at each cut the
    score floor(1000 a n / (l r)), where l and r count its parts and n all words of the language; the
    lowest score counts, ties go to the first cut. Phrases that a longer one always contains are
    left out. Ties of rank go to the higher ``a``, then to the phrase's bytes.

    A null text counts as empty, a null language as ``und``. Repeated rows count each time; doc_id
    is not read. Texts are read whole, and words may be of any length. An empty table, or one
    without a phrase that often, gives no rows. Further columns are not read.
    """
    table = stored(shards(docs))
    n_words = table.groupBy("lang").agg(F.sum("n").alias("n"))
    counts, borders = ranged(phrase_counts(table, least))
    phrases = cut_counts(counts, borders).join(stored(n_words), "lang")

    def wide(name: str) -> str:
        return f"cast({name} as decimal(19,0))"

    score = f"1000 * {wide('a')} * {wide('n')} div ({wide('c.l')} * {wide('c.r')})"
    scored = phrases.withColumn(
        "least", F.expr(f"array_min(transform(cuts, (c, k) -> struct({score} as score, k, c.l, c.r)))")
    ).select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
