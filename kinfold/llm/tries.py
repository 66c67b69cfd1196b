"""Double-array tries over sequences of integers, built and walked with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols of the trie: a word's number is spelled in digits of this base, the highest first.
DIGITS = 256
#: A node with more children gets a block of cells of its own, which later nodes fill up.
WIDE = 32


@dataclass
class Trie:
    """Phrases of 2 to ``words`` keys. From state ``s`` digit ``d`` leads to cell ``base[s] + d`` if ``check`` there is ``s``.

    ``vocabulary`` holds the keys that occur, in order; a word's digits spell its place there. ``accept`` names the
    phrase that ends in a cell, or -1.
    """

    words: int
    width: int
    vocabulary: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    phrases: int

    @property
    def root(self) -> int:
        return len(self.base) - 1

    def count(self, keys: np.ndarray, starts: np.ndarray, times: np.ndarray | None = None) -> np.ndarray:
        """Occurrences of each phrase at the places ``starts`` of ``keys``, each ``times`` (1); key 0 belongs to no phrase.

        The states of all places advance together, digit by digit; those without a transition fall out.
        """
        counts = np.zeros(self.phrases, np.int64)
        times = np.ones(len(starts), np.int64) if times is None else times
        states = np.full(len(starts), self.root, np.int64)
        for word in range(self.words):
            inside = starts + word < len(keys)
            starts, states, times = starts[inside], states[inside], times[inside]
            found = keys[starts + word]
            place = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
            known = self.vocabulary[place] == found
            starts, states, place, times = starts[known], states[known], place[known], times[known]
            for digit in reversed(range(self.width)):
                cells = self.base[states] + (place // DIGITS**digit) % DIGITS
                goes = self.check[cells] == states
                starts, states, place, times = starts[goes], cells[goes], place[goes], times[goes]
            if word:
                ends = self.accept[states]
                np.add.at(counts, ends[ends >= 0], times[ends >= 0])
        return counts


def _nodes(digits: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parent and digit of each node but the root (number 0), and the node in which each phrase ends."""
    parents, symbols, at, total = [], [], np.zeros(len(digits), np.int64), 1
    for level in range(digits.shape[1]):
        alive = np.flatnonzero(lengths > level)
        edges, of = np.unique(at[alive] * DIGITS + digits[alive, level], return_inverse=True)
        parents.append(edges // DIGITS)
        symbols.append(edges % DIGITS)
        at[alive] = total + of
        total += len(edges)
    return np.concatenate(parents), np.concatenate(symbols), at


def _placed(parents: np.ndarray, symbols: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
    """The base of each node, such that no two children share a cell, and the number of cells.

    Parents come by falling number of children. The widest get a block each; the others try random places, all of
    about the same width at a time, until each has one where nobody is. Cells are added as trying gets slow.
    """
    order = np.argsort(parents, kind="stable")
    owner, first, width = np.unique(parents[order], return_index=True, return_counts=True)
    symbols = symbols[order]
    base = np.zeros(nodes, np.int64)
    blocks = np.flatnonzero(width > WIDE)
    base[owner[blocks]] = np.arange(len(blocks)) * DIGITS
    cells = max(4 * DIGITS, len(blocks) * DIGITS + 2 * int(width[width <= WIDE].sum()))
    taken = np.zeros(cells, bool)
    wide = np.repeat(width > WIDE, width)
    taken[np.repeat(base[owner], width)[wide] + symbols[wide]] = True
    rng = np.random.default_rng(0)
    most = WIDE
    while most:
        waiting = np.flatnonzero((width <= most) & (width > most // 2))
        while len(waiting):
            sizes = width[waiting]
            ends = np.cumsum(sizes)
            inner = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(first[waiting], sizes)
            tried = rng.integers(0, cells - DIGITS, len(waiting))
            wanted = np.repeat(tried, sizes) + symbols[inner]
            # The last to ask for a cell in this round has it; a parent stays where all its cells are its own.
            asked = np.full(cells, -1, np.int32)
            by = np.repeat(np.arange(len(waiting), dtype=np.int32), sizes)
            asked[wanted] = by
            stays = np.logical_and.reduceat((asked[wanted] == by) & ~taken[wanted], ends - sizes)
            base[owner[waiting[stays]]] = tried[stays]
            taken[wanted[np.repeat(stays, sizes)]] = True
            if stays.mean() < 0.1:
                taken = np.concatenate([taken, np.zeros(cells // 4 + DIGITS, bool)])
                cells = len(taken)
            waiting = waiting[~stays]
        most //= 2
    return base, cells


def build(phrases: np.ndarray) -> Trie:
    """The trie of ``phrases``, a row of keys each, padded with zeros at the end. Row numbers name the phrases."""
    vocabulary = np.unique(phrases)
    vocabulary = vocabulary[vocabulary != 0]
    width = 1
    while DIGITS**width < len(vocabulary):
        width += 1
    places = np.searchsorted(vocabulary, phrases)
    powers = DIGITS ** np.arange(width)[::-1]
    digits = (places[:, :, None] // powers % DIGITS).reshape(len(phrases), -1)
    parents, symbols, ends = _nodes(digits, (phrases != 0).sum(1) * width)
    nodes = len(parents) + 1
    base, cells = _placed(parents, symbols, nodes)
    # The state of a node is its cell; the root has one behind all others.
    state = np.concatenate([[cells], base[parents] + symbols])
    bases, check, accept = np.zeros(cells + 1, np.int32), np.full(cells + 1, -1, np.int32), np.full(cells + 1, -1, np.int32)
    bases[state] = base
    check[state[1:]] = state[parents]
    accept[state[ends]] = np.arange(len(phrases))
    return Trie(phrases.shape[1], width, vocabulary, bases, check, accept, len(phrases))
