"""Pairs of neighbouring tokens as sorted arrays: a row for each share of the pairs, with the texts that
hold them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import Cache, shared, stored
from ordstrata.llm.near_dups import mixed

END = b" "  # no word holds a blank
PAIRS_AT_ONCE = 1_000_000
KEPT_WORDS = 400_000
KNOWN, BY_FIRST, BY_SECOND, TEXTS = range(4)
ARRAYS = ("u", "w", "n", "spread", "at", "times")
BLOCKS = (
    "kind int, part int, row long, doc_id string, held_out boolean, n_tokens long, n_known long,"
    " base double, pairs long, texts long, " + ", ".join(f"{x} binary" for x in ARRAYS)
)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 3) - 2**63


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]  # both on ASCII alone


def pair_keys(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of codes."""
    first = mixed(u.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mixed(first + w.astype(np.int64).view(np.uint64)).view(np.int64)


def part_of(code: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(code.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def place(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes below ``size`` as they are, all others as ``size``."""
    return np.where((codes >= 0) & (codes < size), codes, size)


class Vocabulary(NamedTuple):
    """Numbers of the most frequent tokens by hash, and their counts in training. The code of a token
    is its number, or else its hash. ``whole``: logarithm of the divisor of the base score."""

    index: dict[int, int]
    n: np.ndarray
    whole: float


class Block(NamedTuple):
    """Distinct pairs of codes in order, their occurrences in training, how many texts hold each; these
    texts, pair after pair, and how often each holds the pair."""

    u: np.ndarray
    w: np.ndarray
    n: np.ndarray
    spread: np.ndarray
    at: np.ndarray
    times: np.ndarray


def pack(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, size * 8, "zstd"), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)


def packed(block: Block) -> dict:
    sizes = {"pairs": len(block.u), "texts": len(block.at)}
    return sizes | {x: pack(a) for x, a in block._asdict().items()}


def unpacked(row, names: tuple[str, ...] = ARRAYS) -> list[np.ndarray]:
    sizes = {x: row.texts if x in ("at", "times") else row.pairs for x in names}
    return [unpack(getattr(row, x), sizes[x]) for x in names]


def pairs_of(codes: np.ndarray, end: int, lengths: np.ndarray, trained: np.ndarray, first: int) -> Block:
    """The pairs of texts that lie one after the other; a text begins after an end."""
    names, local = np.unique(codes, return_inverse=True)
    before = np.concatenate([[np.searchsorted(names, end)], local[:-1]])
    key = before * len(names) + local
    order = np.argsort(key, kind="stable")
    key, row = key[order], np.repeat(np.arange(len(lengths)), lengths)[order]
    new_pair = np.append(True, key[1:] != key[:-1])
    held = np.flatnonzero(new_pair | np.append(True, row[1:] != row[:-1]))
    times, row, key = np.diff(np.append(held, len(key))), row[held], key[held]
    starts = np.flatnonzero(new_pair[held])
    spread = np.diff(np.append(starts, len(held)))
    n = np.add.reduceat(times * trained[row], starts)
    key = key[starts]
    return Block(names[key // len(names)], names[key % len(names)], n, spread, row + first, times)


def picked(block: Block, groups: np.ndarray) -> Iterator[tuple[int, Block]]:
    """The block cut by the group of each pair; pairs of group -1 are left out."""
    there = np.flatnonzero(groups >= 0)
    found = groups[there].astype(np.min_scalar_type(groups.max(initial=0)))  # few bits sort faster
    of_text = np.repeat(groups, block.spread)
    texts = np.flatnonzero(of_text >= 0)
    of_text = of_text[texts].astype(found.dtype)
    pairs, held = np.argsort(found, kind="stable"), np.argsort(of_text, kind="stable")
    of_pairs, of_held = (np.cumsum(np.bincount(x)) for x in (found, of_text))
    block = Block(*(x[there[pairs]] for x in block[:4]), *(x[texts[held]] for x in block[4:]))
    for group in np.unique(found):
        a, c = (x[group - 1] if group else 0 for x in (of_pairs, of_held))
        b, d = of_pairs[group], of_held[group]
        yield int(group), Block(*(x[a:b] for x in block[:4]), *(x[c:d] for x in block[4:]))


def merged(blocks: list[Block]) -> Block:
    u, w, n, spread, at, times = (np.concatenate(x) for x in zip(*blocks))
    small = min(u.min(), w.min()) >= 0 and max(u.max(), w.max()) < 2**31
    order = np.argsort((u << 32) + w, kind="stable") if small else np.lexsort((w, u))
    new = np.append(True, (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1]))
    starts = np.flatnonzero(new)
    number = np.empty(len(u), np.int64)
    number[order] = np.cumsum(new) - 1
    texts = np.argsort(np.repeat(number, spread), kind="stable")
    sums = (np.add.reduceat(x[order], starts) for x in (n, spread))
    return Block(u[order][starts], w[order][starts], *sums, at[texts], times[texts])


def pair_blocks(docs: DataFrame, vocabulary: Vocabulary, parts: int) -> DataFrame:
    """Blocks of all pairs of tokens of ``docs`` (doc_id, held_out, text), a text after an end, and a row
    for each text. No pair is left out.

    Pairs of two known tokens are spread over ``parts`` blocks by pair (kind ``KNOWN``). Pairs with
    another first token are spread by that token (``BY_FIRST``), those with another second token by
    that (``BY_SECOND``), so pairs of two such tokens are in both. Texts are numbered within their
    task; a task that is repeated must find its rows in the same order.
    """
    load, size = shared(docs.sparkSession, vocabulary), len(vocabulary.index)

    def cut(codes, lengths, trained, first, end) -> Iterator[dict]:
        block = pairs_of(codes, end, lengths, trained, first)
        u, w = (place(x, size) < size for x in block[:2])
        pair, one, two = (part_of(x, parts) for x in (pair_keys(*block[:2]), *block[:2]))
        for kind, groups in (
            (KNOWN, np.where(u & w, pair, -1)),
            (BY_FIRST, np.where(u, -1, one)),
            (BY_SECOND, np.where(w, -1, two)),
        ):
            for part, piece in picked(block, groups):
                yield {"kind": kind, "part": part} | packed(piece)

    def texts_of(codes, lengths, doc_ids, trained, first, known) -> pd.DataFrame:
        starts = np.cumsum(lengths) - lengths
        there = place(codes, size)
        n = np.append(known.n, 0)[there]
        base = np.where(there < size, np.log10(n + 1) - known.whole, 0.0)
        return pd.DataFrame(
            {
                "kind": TEXTS,
                "part": first >> 32,
                "row": first + np.arange(len(lengths)),
                "doc_id": doc_ids,
                "held_out": trained == 0,
                "n_tokens": lengths,
                "n_known": np.add.reduceat((n > 0).astype(np.int64), starts),
                "base": np.add.reduceat(base, starts),
            }
        )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = load()
        index, end = known.index, word_hash(END)
        end = index.get(end, end)
        codes = Cache(lambda word: index.get(h := word_hash(word), h), KEPT_WORDS)
        row = TaskContext.get().partitionId() << 32
        held, doc_ids, trained, n = [], [], [], 0

        def given() -> Iterator[pd.DataFrame]:
            lengths, all_codes = np.array([len(x) for x in held]), np.concatenate(held)
            seen = np.array(trained, np.int64)
            yield filled(texts_of(all_codes, lengths, doc_ids, seen, row, known))
            yield filled(pd.DataFrame(list(cut(all_codes, lengths, seen, row, end))))

        for batch in batches:
            for doc_id, out, text in zip(batch.doc_id, batch.held_out, batch.text):
                said = tokens(text)
                held.append(np.fromiter(map(codes.__getitem__, said), np.int64, len(said)))
                doc_ids.append(doc_id)
                trained.append(not out)
                n += len(said)
                if n >= PAIRS_AT_ONCE:
                    yield from given()
                    row += len(held)
                    held, doc_ids, trained, n = [], [], [], 0
        if held:
            yield from given()

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] == TEXTS:
            return group
        whole = merged([Block(*unpacked(row)) for row in group.itertuples()])
        return filled(pd.DataFrame([{"kind": key[0], "part": key[1]} | packed(whole)]))

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
    return stored(rows.mapInPandas(count, BLOCKS).groupBy("kind", "part").applyInPandas(merge, BLOCKS))


def filled(rows: pd.DataFrame) -> pd.DataFrame:
    """``rows`` with the columns of a block they lack."""
    empty = {"doc_id": None, "held_out": False, "base": 0.0} | dict.fromkeys(ARRAYS, b"")
    names = [column.split()[0] for column in BLOCKS.split(", ")]
    return rows.assign(**{x: empty.get(x, 0) for x in names if x not in rows})[names]
