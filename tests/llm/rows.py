"""Awkward rows that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _hash string, _row long, `hash` int, lang_pred string, text_hash string, _part int, kept string"

WORDS = "the of and to in that is was for with this from they have been which their there would about other into more some time very when them only new".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) * (rng.random() < 0.2) for _ in range(words))


def awkward() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        (1, base),
        (2, base.replace(" ", "  ")),
        (3, base + " end"),
        (4, None),
        (5, ""),
        (6, " \t\n\x0b\f\r "),
        (None, prose(2, 60)),
        (None, prose(2, 60)),
        (None, None),
        (7, prose(3, 60)),
        (7, prose(3, 60)),
        (8, prose(4, 30) + "\n" + prose(5, 30)),
        (9, "a"),
        (10, "a b c"),
        (11, "ÀÉ ñ ß 王伟 😀   x İ"),
        (12, prose(6, 30_000)),
        (13, "x" * 200_000),
        (14, prose(6, 30_000) + " tail"),
        (15, "\n\n\n"),
        (16, "12345 !!! ..."),
    ]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 3 == 0 else "src", None, "clash", 1, 2, "xx", "h", 3, "k") for n, (i, t) in enumerate(texts)]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
