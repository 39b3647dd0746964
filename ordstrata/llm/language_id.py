"""Language of a text by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstrata.llm.common import shared

LETTERS = 61  # symbols: 0 between words, then letters, then all other letters
OTHER = LETTERS + 1
SYMBOLS = 64
PIECE = 256  # symbols of a text that are parsed on their own
FAILS = 28  # bits from here count the phrases that end at a step
CHARS_AT_ONCE = 2_000_000


def held_out(modulus: int) -> Column:
    """Whether the checksum of doc_id, written as text, leaves 2 when divided."""
    written = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.crc32(written) % modulus == 2


class Alphabet:
    """Symbols of code points: letters of the sample, case folded; all else divides words."""

    def __init__(self, texts: list[str]):
        letters = Counter(c for t in texts for c in t.lower() if c.isalpha())
        self.table = np.zeros(0x110000, np.uint8)
        for code in range(0x110000):
            if chr(code).isalpha():
                self.table[code] = OTHER
        for number, (c, _) in enumerate(sorted(letters.most_common(LETTERS))):
            self.table[ord(c)] = number + 1
            if len(c.upper()) == 1:
                self.table[ord(c.upper())] = number + 1

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts one after the other, runs between words as one, and where each
        text begins and the last ends."""
        # A line feed before each text keeps them apart.
        codes = np.frombuffer("\n".join(["", *texts]).encode("utf-32-le"), np.uint32)
        found = self.table[codes]
        keep = found != 0
        keep[1:] |= found[:-1] != 0
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(sizes)])]
        return found[keep], ends


def automaton(symbols: np.ndarray) -> np.ndarray:
    """The suffix automaton of a sequence as one flat table: entry state * SYMBOLS + symbol is the
    next state * SYMBOLS. Where the longest match ends, the entry is the state that the symbol
    leads to from the start, with the number of phrases ended in the bits from FAILS."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols.tolist():
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = follow[at][symbol]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(follow)
                follow.append(dict(follow[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and follow[at].get(symbol) == to:
                    follow[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    start = np.full(SYMBOLS, 2 << FAILS, np.int32)  # an unknown symbol is a phrase of its own
    for symbol, to in follow[0].items():
        start[symbol] = to * SYMBOLS | 1 << FAILS
    table = np.tile(start, len(follow))
    for state, out in enumerate(follow):
        for symbol, to in out.items():
            table[state * SYMBOLS + symbol] = to * SYMBOLS
    table[:SYMBOLS][start == 2 << FAILS] = 1 << FAILS
    return table


class Languages:
    def __init__(self, samples: dict[str, list[str]], most_chars: int):
        self.names = sorted(samples)
        self.alphabet = Alphabet([t for texts in samples.values() for t in texts])
        self.tables, sizes = [], []
        for name in self.names:
            symbols, _ = self.alphabet.symbols(samples[name])
            symbols = symbols[:most_chars]
            self.tables.append(automaton(symbols))
            sizes.append(len(symbols))
        # A phrase names a place in the sample: its cost is the logarithm of the sample's length.
        self.cost = np.log2(np.array(sizes) + 2.0)

    def phrases(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) for each language: pieces of all texts step together."""
        sizes = np.diff(ends)
        n_pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(sizes)), n_pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        begin = ends[owner] + nth * PIECE
        reach = np.minimum(PIECE, ends[owner + 1] - begin)
        order = np.argsort(-reach, kind="stable")
        begin, reach, owner = begin[order], reach[order], owner[order]
        active = len(reach) - np.searchsorted(reach[::-1], np.arange(PIECE), "right")
        out = np.zeros((len(sizes), len(self.names)), np.int64)
        states = np.zeros((len(self.names), len(begin)), np.int32)
        counts = np.ones((len(self.names), len(begin)), np.int32)
        for step in range(int(reach.max(initial=0))):
            n = active[step]
            symbol = symbols[begin[:n] + step].astype(np.int32)
            for table, state, count in zip(self.tables, states, counts):
                to = table[state[:n] + symbol]
                count[:n] += to >> FAILS
                state[:n] = to & ((1 << FAILS) - 1)
        for i, count in enumerate(counts):
            out[:, i] = np.bincount(owner, count, len(sizes))
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        symbols, ends = self.alphabet.symbols(texts)
        lettered = np.zeros(len(texts), bool)
        starts = ends[:-1][np.diff(ends) > 0]
        lettered[np.diff(ends) > 0] = (
            np.maximum.reduceat(symbols, starts) > 0 if len(starts) else False
        )
        if not self.names:
            return [("und", 0.0)] * len(texts)
        bits = self.phrases(symbols, ends) * self.cost
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        second = ordered[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        margin = 1 - ordered[:, 0] / np.maximum(second, 1e-9)
        return [
            (self.names[b], float(m)) if ok else ("und", 0.0)
            for b, m, ok in zip(best, margin, lettered)
        ]


def learn(docs: DataFrame, sample: int = 60, most_chars: int = 40_000) -> Languages:
    """Automata of at most ``most_chars`` symbols of at most ``sample`` texts per language, those
    of least hash; fewer symbols where there are more than five languages. Only rows that are not
    held out, with text and language."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").filter(~held_out(4))
    hashed = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    ranked = hashed.select("lang", "h").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    )
    last = ranked.filter(F.col("nth") <= sample).groupBy("lang").agg(F.max("h").alias("last"))
    chosen = hashed.join(F.broadcast(last), "lang").filter(F.col("h") <= F.col("last"))
    samples: dict[str, list[str]] = {}
    for row in chosen.dropDuplicates(["lang", "h"]).orderBy("lang", "h").toLocalIterator():
        texts = samples.setdefault(row.lang, [])
        if sum(map(len, texts)) < 2 * most_chars:
            texts.append(row.text)
    return Languages(samples, min(most_chars, 5 * most_chars // max(1, len(samples))))


def identify(docs: DataFrame, languages: Languages | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    For each language a suffix automaton of a bounded labelled sample finds the longest match from
    each position; a text is cut into such phrases, and the language that needs the fewest,
    weighed by the logarithm of its sample, wins (ties: the first name). Whole texts are parsed, in
    pieces of 256 symbols that advance together; a piece's last phrase ends with it. The score is
    one less the winner's share of the runner-up's bits.

    Null texts and texts without a letter are ``und`` with score 0; so are all if nothing is
    labelled. Repeated rows and rows without doc_id are predicted like others. An empty table
    gives no rows. Further columns are not read.
    """
    load = shared(docs.sparkSession, languages or learn(docs))

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = load()
        for texts in batches:
            out, group, size = [], [], 0
            for text in texts:
                text = text or ""
                if size and size + len(text) > CHARS_AT_ONCE:
                    out += known.predict(group)
                    group, size = [], 0
                group.append(text)
                size += len(text)
            out += known.predict(group)
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    found = F.pandas_udf(predict, "lang_pred string, score double")("text")
    return docs.select("doc_id", held_out(4).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", "found.*"
    )
