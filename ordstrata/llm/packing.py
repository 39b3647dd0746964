"""Packing tokenized documents into sequences by linear grouping and best fit."""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordstrata.llm.common import shared, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = f"{PIECES}, sequence_id long, offset long"
SALTS = 64


# Words of these characters alone need no normal form beyond lower case.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: where the vocabulary's own pattern splits such a word.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# The vocabulary writes each byte as one printable character: itself where it is one.
SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
HIDDEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def pack_ids(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Recent(dict):
    """Values of ``make`` by key. Keys lie in two generations: when the young one has grown to
    ``limit`` bytes or so it becomes the old one, and what was in the old one and not asked for
    again is forgotten. So memory is bounded, and frequent keys stay."""

    ENTRY = 200

    def __init__(self, make, limit: int = 100_000_000):
        super().__init__()
        self.make, self.limit = make, limit
        self.size, self.old = 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.size += len(key) + len(value) + self.ENTRY
        if self.size > self.limit:
            self.old, self.size = dict(self), 0
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Little-endian 32-bit ids of a word. The tokenizer drops white space, so the ids of a text
    are those of its words in turn; each distinct word, and each part of one, is encoded once. Plain
    words go straight to the byte-pair model, others through the whole tokenizer."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.words = Recent(self.of_word)

    def of_part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(HIDDEN)
        return pack_ids([t.id for t in self.model.tokenize(shown)])

    def of_word(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():  # of a to z: its own only part
            return self.of_part(text)
        if not PLAIN.fullmatch(text):
            return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = [part.encode() for part in PARTS.findall(text.lower())]
        if len(parts) == 1 and parts[0] == word:
            return self.of_part(text)
        return b"".join([self.words[part] for part in parts])

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.words.__getitem__, (text or "").encode().split()))


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int) -> DataFrame:
    """Token ids of every text plus ``end_id``, cut only where a document exceeds ``capacity``."""

    # Each Python worker keeps its copy of a broadcast value, and so the words it knows, for the next
    # tasks.
    kept = docs.sparkSession.sparkContext.broadcast({})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = kept.value.get(tokenizer_file)
        if ids_of is None:
            ids_of = kept.value[tokenizer_file] = WordIds(tokenizer_file)
        end = pack_ids([end_id])
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                ids = ids_of(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(encode, PIECES)


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 0,
    small: int = 700,
    n_groups: int = 512,
) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its sequence and its place there.

    Lengths are whole numbers up to ``capacity``, so all choices are made on the count of pieces of
    each length (at most ``capacity`` numbers, see :func:`plan`); pieces are then numbered within
    their length and looked up in the plan. Nothing of a single document reaches the driver.

    Null and empty texts are one piece holding ``end_id``. Repeated rows and rows without doc_id
    are packed like others. An empty table gives no rows. Further columns are not read.
    """
    pieces = stored(token_pieces(docs, tokenizer_file, capacity, end_id))
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(SALTS)).cast("int")
    pieces = pieces.withColumn("salt", salt)
    counted = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = np.zeros((capacity + 1, SALTS), np.int64)  # of fixed size, whatever the corpus
    for row in counted.toLocalIterator():
        counts[row.length, row.salt] = row.n
    before = (np.cumsum(counts, axis=1) - counts).astype(np.int64)
    table = plan(counts.sum(axis=1), capacity, small, n_groups)
    planned = shared(docs.sparkSession, (before, table))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, table = planned()
        for batch in batches:
            length = batch.length.to_numpy()
            rank = batch.nth.to_numpy() - 1 + before[length, batch.salt.to_numpy()]
            # Intervals are sorted by (length, first rank).
            row = np.searchsorted(table["key"], length * table["wide"] + rank, "right") - 1
            batch["sequence_id"] = table["sequence"][row] + rank - table["rank"][row]
            batch["offset"] = table["offset"][row]
            yield batch.drop(columns=["salt", "nth"]).astype({"doc_id": "Int64"})

    numbered = pieces.withColumn(
        "nth",
        F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")),
    )
    return numbered.mapInPandas(place, PLACES)


def plan(counts: np.ndarray, capacity: int, small: int, n_groups: int) -> dict:
    """Which sequence takes which pieces, by length and number within the length.

    1. Linear grouping: lengths above ``small``, sorted, are cut into ``n_groups`` groups of equal
       cardinality and rounded up to the largest of their group.
    2. Configurations of the few rounded sizes: the largest size left, filled up by a subset-sum
       table over the sizes left, repeated as often as the counts allow.
    3. Actual lengths, longest first, take the places of their group.
    4. Small lengths, longest first, go where the least room is left that holds them.

    A run is a number of sequences with the same lengths: the result grows with ``capacity``, not
    with the corpus.
    """
    runs = _substitute(counts, _group(counts, small, n_groups), capacity)
    runs = _best_fit(counts, runs, capacity, small)
    taken = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for n, lengths in runs:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    if not (taken == counts).all():
        raise AssertionError("the plan does not hold every piece")
    found = np.array(sorted(rows), np.int64).reshape(-1, 4)
    wide = int(counts.max(initial=0)) + 1
    names = ("length", "rank", "sequence", "offset")
    table = {name: found[:, i].copy() for i, name in enumerate(names)}
    return {**table, "key": table["length"] * wide + table["rank"], "wide": wide}


def _group(counts: np.ndarray, small: int, n_groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded size, [[length, pieces], ...] longest first) of each group, largest first."""
    left = [[length, int(counts[length])] for length in range(len(counts) - 1, small, -1)]
    left = [x for x in left if x[1]]
    per_group = -(-sum(n for _, n in left) // n_groups)
    groups: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length, n in left:
        while n:
            if not room:
                room = per_group
                if not groups or groups[-1][0] != length:
                    groups.append((length, []))
            part = min(n, room)
            groups[-1][1].append([length, part])
            n, room = n - part, room - part
    return groups


def _fullest(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """Sizes whose sum is the largest within ``room``, by a bit per reachable sum."""
    whole = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for size in sizes:
        for _ in range(min(left[size], room // size)):
            steps.append((size, reached))
            reached |= (reached << size) & whole
            if reached >> room:
                break
    total, chosen = reached.bit_length() - 1, []
    for size, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(size)
            total -= size
    return chosen


def _substitute(
    counts: np.ndarray, groups: list[tuple[int, list[list[int]]]], capacity: int
) -> list[tuple[int, list[int]]]:
    queues = {size: queue[::-1] for size, queue in groups}
    left = {size: sum(n for _, n in queue) for size, queue in groups}
    runs = []
    while left:
        largest = max(left)
        left[largest] -= 1
        config = [largest, *_fullest(sorted(left, reverse=True), left, capacity - largest)]
        left[largest] += 1
        times = min(left[s] // config.count(s) for s in set(config))
        slots = [_take(queues[size], times) for size in config]
        for size in config:
            left[size] -= times
        left = {s: n for s, n in left.items() if n}
        while times:  # sequences whose places hold the same lengths
            n = min(slot[-1][1] for slot in slots)
            runs.append((n, [slot[-1][0] for slot in slots]))
            for slot in slots:
                slot[-1][1] -= n
                if not slot[-1][1]:
                    slot.pop()
            times -= n
    return runs


def _take(queue: list[list[int]], n: int) -> list[list[int]]:
    """The next ``n`` pieces of a queue whose front is its end; given in the same order."""
    out = []
    while n:
        length, have = queue[-1]
        part = min(n, have)
        out.append([length, part])
        queue[-1][1] -= part
        if not queue[-1][1]:
            queue.pop()
        n -= part
    return out[::-1]


def _best_fit(
    counts: np.ndarray, runs: list[tuple[int, list[int]]], capacity: int, small: int
) -> list[tuple[int, list[int]]]:
    room: list[list[tuple[int, list[int]]]] = [[] for _ in range(capacity + 1)]
    for n, lengths in runs:
        room[capacity - sum(lengths)].append((n, lengths))
    for length in range(min(small, capacity), 0, -1):
        left = int(counts[length])
        for free in range(length, capacity + 1):
            fit = free // length
            while left and room[free]:
                n, lengths = room[free].pop()
                full = min(n, left // fit)
                rest = left - full * fit if full < n else 0
                if full:
                    room[free - fit * length].append((full, lengths + [length] * fit))
                if rest:
                    room[free - rest * length].append((1, lengths + [length] * rest))
                if n - full - bool(rest):
                    room[free].append((n - full - bool(rest), lengths))
                left -= full * fit + rest
            if not left:
                break
        if left:
            fit = capacity // length
            full, rest = divmod(left, fit)
            if full:
                room[capacity - fit * length].append((full, [length] * fit))
            if rest:
                room[capacity - rest * length].append((1, [length] * rest))
    return [run for runs in room for run in runs]
