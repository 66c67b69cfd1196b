"""Cleaning names and addresses, all in JVM column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.scripts import spell_out

# Title patterns to delete, in order.
TITLES = (
    r"\bdr\.\s*",
    r"\bdrs\.\s*",
    r"\bir\.\s*",
    r"\bh\.\s*",
    r"\bhj\.\s*",
    r"\balm\.\s*",
    r"\bbin\b",
    r"\bbinti\b",
    r"\bs\.kom\b",
    r"\bs\.e\b",
    r"\bm\.kom\b",
    r"\bprof\.\s*",
    r"\bpdt\.\s*",
)

# Abbreviations to expand, in order.
ABBREVIATIONS = (
    (r"\bjl\b", "jalan"),
    (r"\bjln\b", "jalan"),
    (r"\bds\b", "desa"),
    (r"\bkec\b", "kecamatan"),
    (r"\bkel\b", "kelurahan"),
    (r"\bkab\b", "kabupaten"),
    (r"\bprop\b", "provinsi"),
    (r"\bno\.\s*", "nomor "),
)

# Letters that Unicode does not decompose to ASCII.
UNDECOMPOSED = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L",
    "ħ": "h", "Ħ": "H", "ı": "i", "ĸ": "k", "ŋ": "ng", "Ŋ": "NG", "ŧ": "t", "Ŧ": "T",
}

# Latin-1 to Latin Extended-B, Latin Extended Additional, general punctuation forms, ligatures, fullwidth ASCII.
_RANGES = ((0xA0, 0x24F), (0x1E00, 0x1EFF), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))
OTHER_LETTER = r"[\p{L}&&[^\x00-\x7F]]"
_COMBINING = "".join(map(chr, range(0x300, 0x370)))


@lru_cache(maxsize=1)
def _ascii_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(single letters, their ASCII letter, letters that need several), by rule from Unicode decomposition."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for low, high in _RANGES:
        for code in range(low, high + 1):
            char = chr(code)
            if unicodedata.category(char) == "Cn":
                continue
            plain = UNDECOMPOSED.get(char)
            if plain is None:
                parts = unicodedata.normalize("NFKD", char).replace("⁄", "/")
                plain = "".join(p for p in parts if ord(p) < 128)
            if len(plain) == 1:
                single[char] = plain
            elif plain:
                several[char] = plain
    return "".join(single), "".join(single.values()), tuple(several.items())


def _any_of(patterns: Iterable[str]) -> str:
    """One pattern for several that all start at a word boundary; the boundary is tested once per place."""
    return r"\b(?:" + "|".join(p.removeprefix(r"\b") for p in patterns) + ")"


def _once(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use(text)`` with ``text`` computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(text), use), F.lit(0))


def _where(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """``change`` applied where the text holds the pattern: most texts then pass with a single scan."""
    return _once(text, lambda t: F.when(t.rlike(pattern), change(t)).otherwise(t))


def _unless_ascii(text: Column, change: Callable[[Column], Column]) -> Column:
    return _once(text, lambda t: F.when(F.octet_length(t) == F.char_length(t), t).otherwise(change(t)))


def _spell(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


def transliterate(text: Column) -> Column:
    """Letters to ASCII, of Latin and, one by one, of other scripts. Combining marks go, other characters stay."""
    letters, plain, several = _ascii_tables()
    common = [pair for pair in several if pair[0] in UNDECOMPOSED]
    rare = [pair for pair in several if pair not in common]
    # translate() deletes the trailing letters that have no counterpart: the combining marks.
    out = _unless_ascii(text, lambda t: F.translate(t, letters + _COMBINING, plain))
    out = _unless_ascii(_unless_ascii(out, lambda t: _spell(t, common)), lambda t: _spell(t, rare))
    return _unless_ascii(out, lambda t: F.when(t.rlike(OTHER_LETTER), spell_out(t)).otherwise(t))


def _untitled(text: Column) -> Column:
    """Without titles, in as few passes as keep the result of one pass per pattern.

    Words with a final dot and whole words cannot form one another, but deleting them can form one of the dotted
    degrees, and these in turn run before the last two.
    """
    groups = (TITLES[:8], TITLES[8:11], TITLES[11:])
    return reduce(lambda acc, group: F.regexp_replace(acc, _any_of(group), ""), groups, text)


def _spelled_out(text: Column) -> Column:
    return reduce(lambda acc, pair: F.regexp_replace(acc, *pair), ABBREVIATIONS, text)


def clean_text(text: Column) -> Column:
    """Lowercase ASCII words without titles and with abbreviations spelled out.

    Null and '' give null; text made only of blanks or titles gives ''.
    """
    out = _where(transliterate(F.lower(text)), _any_of(TITLES), _untitled)
    out = _where(out, _any_of(p for p, _ in ABBREVIATIONS), _spelled_out)
    # Anything but letters and digits, blanks included, ends up as one space.
    out = F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))
    return F.when(text != "", out)

