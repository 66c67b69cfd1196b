"""The memory of words: where texts are cut, and how often a word is looked up."""

import re
from array import array

import numpy as np

from kinfold.llm.words import WordMemory, word_starts
from tests.llm.rows import awkward

ODD = ["a\u3000 b", "\u3000a b\u00a0", "a  b", "a \u2003b", "\u0085 x", "x \u2028 y z", "é b", "王 伟 x", "a\x1c b\x1f c", " ", "  ", "", "b", None, " a", "a ", "a \n b c", "a\u200b b", "à â", "\ufeff a b", "tail ", " head"]


def cut(text):
    return re.split(r"(?<=\S)(?= \S)", text) if text else []


def test_cut_at_single_blanks_like_a_pattern():
    texts = [t for t in ODD + [r[1] for r in awkward()] if t]
    starts = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data = "".join(texts).encode()
    found = [*word_starts(np.frombuffer(data, np.uint8), starts[:-1]).tolist(), len(data)]
    assert [data[a:b].decode() for a, b in zip(found, found[1:])] == [w for t in texts for w in cut(t)]
    assert word_starts(np.empty(0, np.uint8), np.empty(0, np.int64)).tolist() == []


def test_a_word_is_looked_up_once_a_call():
    looked, solved = [], []

    def solve(words):
        solved.extend(words)
        return [array("i", map(ord, w)).tobytes() for w in words]

    memory = WordMemory(solve, remembered=3)
    texts = [t and " ".join([t] * 50) for t in ODD]
    for _ in range(3):
        assert [ids.tolist() for ids in memory.encode(texts)] == [[ord(c) for c in t or ""] for t in texts]
    assert len(solved) == len(set(solved)) == len({w for t in texts for w in cut(t)})

    class Counted(dict):
        def get(self, word):
            looked.append(word)
            return super().get(word)

        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    memory.words, memory.older, memory.remembered = Counted(memory.older | memory.words), {}, 1 << 20
    memory.encode(texts)
    assert sorted(looked) == sorted({w for t in texts for w in cut(t)})
    assert [x.tolist() for x in memory.encode([None, ""])] == [[], []] and memory.encode([]) == []
