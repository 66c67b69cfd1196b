"""Encoding texts word by word, with a memory of the words seen."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Words whose ids a worker remembers; beyond it, words that do not come again are forgotten.
REMEMBERED = 400_000

#: The white space of one byte that Python knows, and which bytes after which make the rest of it in UTF-8.
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE_BLANKS = sorted(c.encode() for c in map(chr, range(128, 0x3001)) if c.isspace())


def word_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where words of the UTF-8 bytes ``data`` start: at texts, which begin at ``starts``, and at single blanks in them.

    A single blank is one between two characters that are not white space. No match of a pattern reaches over the place
    in front of it, since a blank either leads a match or is part of a run of blanks.
    """
    if not len(data):
        return np.empty(0, np.int64)
    blank = _BLANK[data]
    # Of wide white space both ends count: its first byte stops a blank before it, its last one a blank behind it.
    after, before = blank, blank
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        after, before = blank.copy(), blank.copy()
        for spelled in _WIDE_BLANKS:
            at = lead[(data[lead] == spelled[0]) & (lead + len(spelled) <= len(data))]
            for i, byte in enumerate(spelled[1:], 1):
                at = at[data[at + i] == byte]
            after[at], before[at + len(spelled) - 1] = True, True
    cut = data == 0x20
    cut[1:] &= ~before[:-1]
    cut[:-1] &= ~after[1:]
    cut[-1] = False
    # What the next text begins with does not tell whether a text's last blank is a single one.
    cut[starts[1:] - 1] = False
    cut[starts] = True
    return np.flatnonzero(cut)


class WordMemory:
    """Ids of texts from the ids of their words (stretches between single blanks), each worked out once.

    ``solve`` maps words to ids, given as the bytes of 32-bit integers. It must treat what a single blank leads apart
    from what stands in front of it. Words are numbered before they are looked up, so that one costs a look-up only once
    in a call.
    """

    def __init__(self, solve: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED):
        self.solve, self.remembered = solve, remembered
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, distinct: list[str]) -> list[bytes]:
        if len(self.words) > self.remembered:
            self.older, self.words = self.words, {}
        words, older = self.words, self.older
        found = list(map(words.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing and older:
            for i in missing:
                if (ids := older.get(distinct[i])) is not None:
                    found[i] = words[distinct[i]] = ids
            missing = [i for i in missing if found[i] is None]
        if missing:
            new = [distinct[i] for i in missing]
            for i, word, ids in zip(missing, new, self.solve(new)):
                found[i] = words[word] = ids
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null or empty one has none."""
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        ends = np.cumsum([0, *map(len, raw)])
        joined = b"".join(raw)
        data, full = np.frombuffer(joined, np.uint8), np.diff(ends) > 0
        starts = word_starts(data, ends[:-1][full])
        offsets = np.append(starts, len(data))
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)).dictionary_encode()
        found = self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, number = np.frombuffer(b"".join(found), np.int32), words.indices.to_numpy()
        # The ids of a word lie together: places there, and where they come in the texts, differ by one number a word.
        count = sizes[number]
        to = np.cumsum(count)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[number] - (to - count), count) + np.arange(to[-1] if len(to) else 0)]
        cuts = np.append(0, to)[np.searchsorted(starts, ends)].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]
