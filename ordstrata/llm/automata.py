"""Weighted acyclic automata over sequences of words, as numpy arrays.

A sequence is a row of word numbers, padded with 0; numbers follow the order of the words, so sorted
rows are sorted sequences. States of one depth with the same ends, the same arcs and the same states
below are one state.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import zstandard

BITS = 21


@dataclass
class Automaton:
    """States by depth: ``finals`` is the weight of a sequence that ends there (0: none does),
    ``arcs`` where its arcs begin in ``labels`` and ``targets``."""

    words: list[str]
    finals: list[np.ndarray]
    arcs: list[np.ndarray]
    labels: list[np.ndarray]
    targets: list[np.ndarray]

    def packed(self) -> bytes:
        small = [
            [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
            for arrays in (self.finals, [np.diff(a) for a in self.arcs], self.labels, self.targets)
        ]
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((self.words, *small), 5))

    @staticmethod
    def unpacked(data: bytes) -> Automaton:
        words, finals, arcs, labels, targets = pickle.loads(zstandard.decompress(data))
        wide = [[a.astype(np.int64) for a in arrays] for arrays in (finals, labels, targets)]
        offsets = [np.concatenate([[0], np.cumsum(a, dtype=np.int64)]) for a in arcs]
        return Automaton(words, wide[0], offsets, wide[1], wide[2])


def numbers(sequences: list[tuple[str, ...]], length: int) -> tuple[list[str], np.ndarray]:
    """The sorted words of the sequences, and a row of numbers for each."""
    words = sorted({w for sequence in sequences for w in sequence})
    number = {w: i for i, w in enumerate(words, 1)}
    rows = np.zeros((len(sequences), length), np.int32)
    for i, sequence in enumerate(sequences):
        rows[i, : len(sequence)] = [number[w] for w in sequence]
    return words, rows


def summed(rows: np.ndarray, weights: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows and the sums of their weights."""
    if not len(rows):
        return rows, weights
    keys = []
    if n_words < 1 << BITS:
        for first in range(0, rows.shape[1], 3):
            key = np.zeros(len(rows), np.int64)
            for column in range(first, min(first + 3, rows.shape[1])):
                key = (key << BITS) | rows[:, column]
            keys.append(key)
    else:
        keys = list(rows.T)
    order = np.lexsort(keys[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = False
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    return rows[order[starts]], np.add.reduceat(weights[order], starts)


def _first_difference(rows: np.ndarray) -> np.ndarray:
    """The first column in which a row differs from the one before it."""
    found = np.zeros(len(rows), np.int8)
    found[1:] = (rows[1:] != rows[:-1]).argmax(axis=1)
    return found


def prefix_sums(rows: np.ndarray, weights: np.ndarray):
    """For each length the prefixes of sorted distinct rows: the rows where they first occur and the
    sums of weights of all rows that begin with them."""
    difference = _first_difference(rows)
    upto = np.concatenate([[0], np.cumsum(weights)])
    for length in range(1, rows.shape[1] + 1):
        starts = np.flatnonzero(difference < length)
        ends = np.concatenate([starts[1:], [len(rows)]])
        has = rows[starts, length - 1] != 0
        yield length, starts[has], (upto[ends] - upto[starts])[has]


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits of each number, well mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signature(final, label, target, first, after, seed: int) -> np.ndarray:
    """A hash of a state: its final weight and the set of its arcs."""
    arcs = mixed(
        label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
        + mixed(target.astype(np.uint64) + np.uint64(seed + 1))
    )
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arcs, dtype=np.uint64)])
    return mixed(final.astype(np.uint64) + np.uint64(seed)) + upto[after] - upto[first]


def _same(first_hash: np.ndarray, second_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One member of each class of equal states, and every state's class: by 64 bits of hash where
    the other 64 agree, else by all 128."""
    _, member, of = np.unique(first_hash, return_index=True, return_inverse=True)
    if (second_hash[member][of] == second_hash).all():
        return member, of
    _, member, of = np.unique(
        np.stack([first_hash, second_hash], 1), axis=0, return_index=True, return_inverse=True
    )
    return member, of.ravel()


def _ranges(first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The numbers first[0] … after[0] - 1, first[1] … and so on."""
    n = after - first
    before = np.concatenate([[0], np.cumsum(n)])
    return np.arange(before[-1]) + np.repeat(first - before[:-1], n)


def built(words: list[str], rows: np.ndarray, weights: np.ndarray) -> Automaton:
    """The minimal automaton of sorted distinct rows with weights above 0.

    Sequences come sorted, so the prefixes of one length begin at known rows; states are merged from
    the deepest up, each depth at once."""
    length = rows.shape[1]
    difference = _first_difference(rows)
    nodes = [np.zeros(1, np.int64)]
    nodes += [np.flatnonzero((difference < d) & (rows[:, d - 1] != 0)) for d in range(1, length + 1)]
    finals, arcs, labels, targets = [], [], [], []
    state = below = np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        for depth in range(length, -1, -1):
            own = nodes[depth]
            if depth == length:
                final = weights[own]
                first = after = np.zeros(len(own), np.int64)
                label = np.zeros(0, np.int64)
            else:
                final = np.where(rows[own, depth] == 0, weights[own], 0)
                first = np.searchsorted(below, own)
                after = np.concatenate([first[1:], [len(below)]])
                label = rows[below, depth].astype(np.int64)
            member, of = _same(
                *(_signature(final, label, state, first, after, seed) for seed in (0, 77))
            )
            picked = _ranges(first[member], after[member])
            finals.append(final[member])
            arcs.append(np.concatenate([[0], np.cumsum(after[member] - first[member])]))
            labels.append(label[picked])
            targets.append(state[picked])
            state, below = of, own
    return Automaton(words, finals[::-1], arcs[::-1], labels[::-1], targets[::-1])


def sequences(automaton: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """All rows that the automaton accepts with their weights, in no order."""
    length = len(automaton.finals) - 1
    state = np.zeros(1, np.int64)
    path = np.zeros((1, length), np.int32)
    rows, weights = [], []
    for depth in range(length + 1):
        final = automaton.finals[depth][state]
        rows.append(path[final > 0])
        weights.append(final[final > 0])
        if depth < length:
            first, after = automaton.arcs[depth][state], automaton.arcs[depth][state + 1]
            arc = _ranges(first, after)
            path = np.repeat(path, after - first, axis=0)
            path[:, depth] = automaton.labels[depth][arc]
            state = automaton.targets[depth][arc]
    return np.concatenate(rows), np.concatenate(weights)


def union(automata: list[Automaton]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, sorted rows and summed weights of all sequences of the automata."""
    words = sorted(set().union(*(a.words for a in automata)))
    number = {w: i for i, w in enumerate(words, 1)}
    rows, weights = [], []
    for automaton in automata:
        own, weight = sequences(automaton)
        new = np.array([0, *(number[w] for w in automaton.words)], np.int32)
        rows.append(new[own])
        weights.append(weight)
    return words, *summed(np.concatenate(rows), np.concatenate(weights), len(words))


def composed(asked: Automaton, counts: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequences of ``asked`` in order, with their weights there and in ``counts`` (0 where that
    does not accept them): both automata read them together, all sequences a word at a time."""
    number = {w: i for i, w in enumerate(counts.words, 1)}
    rows, weights = summed(*sequences(asked), len(asked.words))
    read = np.array([0, *(number.get(w, -1) for w in asked.words)], np.int64)[rows]
    found = np.zeros(len(rows), np.int64)
    live = np.arange(len(rows))
    state = np.zeros(len(rows), np.int64)
    width = len(counts.words) + 1
    for depth in range(rows.shape[1] + 1):
        ends = np.ones(len(live), bool) if depth == rows.shape[1] else read[live, depth] == 0
        found[live[ends]] = counts.finals[depth][state[ends]]
        live, state = live[~ends], state[~ends]
        if not len(live):
            break
        of = np.repeat(np.arange(len(counts.arcs[depth]) - 1), np.diff(counts.arcs[depth]))
        arcs = of * width + counts.labels[depth]
        wanted = state * width + read[live, depth]
        at = np.minimum(np.searchsorted(arcs, wanted), max(len(arcs) - 1, 0))
        known = (arcs[at] == wanted) & (read[live, depth] > 0) if len(arcs) else np.zeros(len(live), bool)
        live, state = live[known], counts.targets[depth][at[known]]
    return rows, weights, found
