"""Letters of other scripts in ASCII, so that no name loses all its letters."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cyrillic letters.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia", "є": "ie",
    "і": "i", "ґ": "g", "ђ": "dj", "ѕ": "dz", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz",
}

# Greek letters.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}

# Hebrew letters.
HEBREW = {
    "א": "a", "ב": "b", "ג": "g", "ד": "d", "ה": "h", "ו": "v", "ז": "z", "ח": "kh", "ט": "t", "י": "y", "ך": "k",
    "כ": "k", "ל": "l", "ם": "m", "מ": "m", "ן": "n", "נ": "n", "ס": "s", "ע": "a", "ף": "p", "פ": "p", "ץ": "ts",
    "צ": "ts", "ק": "q", "ר": "r", "ש": "sh", "ת": "t",
}

# Arabic letters, with those that Persian adds.
ARABIC = {
    "ا": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z",
    "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "a", "غ": "gh", "ف": "f", "ق": "q", "ك": "k",
    "ل": "l", "م": "m", "ن": "n", "ه": "h", "و": "w", "ي": "y", "ء": "a", "ة": "h", "ى": "a", "پ": "p", "چ": "ch",
    "ژ": "zh", "گ": "g", "ک": "k", "ی": "y",
}

_FIRST, _LAST = 0x370, 0x6FF
_KANA = 0x3041
_SYLLABLE = 0xAC00


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str, str, str, str]:
    """Comma-separated values by code point: the alphabets, kana, and first, middle and last sounds of Hangul."""
    known = CYRILLIC | GREEK | HEBREW | ARABIC
    letters = []
    for code in range(_FIRST, _LAST + 1):
        char = chr(code)
        plain = known.get(char.lower(), known.get(unicodedata.normalize("NFD", char.lower())[0]))
        if plain is None and unicodedata.category(char)[0] == "L":
            plain = f"u{code:x}"
        letters.append("-" if plain is None else plain.capitalize() if char.isupper() else plain)

    def name(code: int) -> str:
        return unicodedata.name(chr(code), "").lower()

    kana = [name(code).rsplit(" ", 1)[-1] or "-" for code in range(_KANA, _KANA + 86)]
    sound = [name(_SYLLABLE + 588 * 11 + 28 * i).rsplit(" ", 1)[-1] for i in range(21)]
    first = [name(_SYLLABLE + 588 * i).rsplit(" ", 1)[-1].removesuffix("a") for i in range(19)]
    last = [name(_SYLLABLE + 588 * 11 + i).rsplit(" ", 1)[-1].removeprefix("a") for i in range(28)]
    return tuple(map(",".join, (letters, kana, first, sound, last)))


def _at(values: str, place: Column) -> Column:
    # Folded to one literal array when the query is planned.
    return F.get(F.split(F.lit(values), ","), place.cast("int"))


def _spelled(char: Column) -> Column:
    letters, kana, first, sound, last = _tables()
    code = F.ascii(char)
    syllable = code - _SYLLABLE
    hangul = F.concat(_at(first, F.floor(syllable / 588)), _at(sound, F.floor(syllable % 588 / 28)), _at(last, syllable % 28))
    found = _at(letters, code - _FIRST)
    other = F.when(char.rlike(r"\p{M}"), "").when(char.rlike(r"\p{L}"), F.concat(F.lit(" u"), F.lower(F.hex(code)), F.lit(" "))).otherwise(char)
    return (
        F.when(code < 128, char)
        .when(code.between(_FIRST, _LAST), F.when(found == "-", other).otherwise(found))
        .when(code.between(_KANA, _KANA + 85), _at(kana, code - _KANA))
        .when(code.between(_KANA + 96, _KANA + 96 + 85), _at(kana, code - _KANA - 96))
        .when(code.between(_SYLLABLE, 0xD7A3), hangul)
        .otherwise(other)
    )


def spell_out(text: Column) -> Column:
    """Each letter of another script in ASCII letters; one that no table knows, as ideographs, by its code point.

    Combining marks go, other characters stay. Characters are taken one by one, for texts that have such letters.
    """
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), _spelled), "")
