"""Shingle sets of texts and their PartEnum signatures, as numpy helpers that run inside tasks.

Two sets with sizes a and b link when ``num * |union| <= 100 * |intersection|``. That is the same as a symmetric
difference of at most ``k(a, b) = (100 - num) * (a + b) // (100 + num)`` elements, which PartEnum (Arasu, Ganti and
Kaushik, VLDB 2006) turns into equality of signatures:

* sizes are cut into bands so that linked sets lie in the same band or in neighbouring ones; level j joins the
  bands j - 1 and j, and a set of band i takes part in the levels i and i + 1;
* at a level, the domain of shingles is dealt into ``groups`` groups of three parts. Of the at most k differing
  elements at most k // 2 groups hold two or more, so at least one group holds at most one, and in that group one
  of the three subsets of two parts is free of differences. Each subset of each group is one signature.

A signature whose parts hold no element says little and would gather unrelated sets. Levels therefore have some spare
groups, more than even the smallest sets of the level are likely to have with such signatures; a set with no more of
them than spare groups leaves them out without losing a pair, since one more group still agrees. A set with more of them
(mostly a small one) leaves them out too, and adds its first ``n - ceil(percent n / 100) + 1`` shingles in the order of
their hashes: two linked sets that both do so share one of these, as every prefix filter has it.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import xxhash

PARTS = 3
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> _S30)) * _B
    x = (x ^ (x >> _S27)) * _C
    return x ^ (x >> _S31)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, an empty one has none.

    A-Z are lower-cased and words end at ASCII white space, which is what ``bytes`` does.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(hashes))
    at = len(hashes) - size + 1
    out = np.full(at, size, np.uint64)
    for i in range(size):
        out = mix(out * _A + hashes[i : i + at])
    return np.unique(out)


def difference_bound(a: int, b: int, percent: int) -> int:
    """The most elements in which linked sets of these sizes can differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def bands(largest: int, percent: int) -> list[int]:
    """First size of each band, up to one band beyond ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    starts.append(starts[-1] * 100 // percent + 1)
    return starts


_starts: dict[int, list[int]] = {}


@lru_cache(maxsize=None)
def _layout(smallest: int, k: int) -> tuple[int, int]:
    """(groups, spare groups) of a level whose smallest sets have ``smallest`` elements.

    With g groups, about ``3 g exp(-2/3 smallest / g)`` signatures of such a set hold nothing. The fewest spare groups
    are taken that exceed this by three deviations, or none if that would take half of the groups again.
    """
    needed = k // 2 + 1
    for spare in range(2, needed // 2 + 2):
        groups = needed + spare
        empty = PARTS * groups * math.exp(-2 / 3 * smallest / groups)
        if empty + 3 * math.sqrt(empty) <= spare:
            return groups, spare
    return needed, 0


def levels_of(size: int, percent: int) -> list[tuple[int, int, int]]:
    """(level, most differing elements of a linked pair at it, size of its smallest sets): own band and the next.

    Level j is for pairs of the bands j - 1 and j, and for pairs within band j - 1, whose bound is no larger.
    """
    starts = _starts.get(percent)
    if starts is None or starts[-2] <= size:
        starts = _starts[percent] = bands(max(size, 1 << 20), percent)
    band = int(np.searchsorted(starts, size, side="right")) - 1
    return [(j, difference_bound(starts[j] - 1, starts[j + 1] - 1, percent), starts[max(j - 1, 0)]) for j in (band, band + 1)]


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """64-bit PartEnum signatures of a non-empty set at both of its levels."""
    out = []
    if len(elements) == 0:
        return np.empty(0, np.uint64)
    spread, crowded = mix(elements + _A), False
    for level, k, smallest in levels_of(len(elements), percent):
        seed = np.uint64((level * int(_B) + int(_C)) & 0xFFFFFFFFFFFFFFFF)
        if k == 0:
            out.append(mix(np.sum(spread, dtype=np.uint64, keepdims=True) + seed))
            continue
        groups, spare = _layout(smallest, k)
        part = ((elements >> np.uint64(32)) * np.uint64(groups * PARTS) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(groups * PARTS, np.uint64)
        np.add.at(sums, part, spread)
        counts = np.bincount(part, minlength=groups * PARTS).reshape(groups, PARTS)
        sums = mix(sums + np.arange(groups * PARTS, dtype=np.uint64) * _A + seed).reshape(groups, PARTS)
        found = np.stack([mix(sums[:, 0] * _A + sums[:, 1]), mix(sums[:, 0] * _B + sums[:, 2]), mix(sums[:, 1] * _C + sums[:, 2])], axis=1)
        held = np.stack([counts[:, 0] + counts[:, 1], counts[:, 0] + counts[:, 2], counts[:, 1] + counts[:, 2]], axis=1) > 0
        out.append(found[held])
        crowded |= int((~held.all(axis=1)).sum()) > spare
    if crowded:
        n = len(elements)
        out.append(mix(elements[: n + percent * n // -100 + 1] ^ _C))
    return np.concatenate(out)
