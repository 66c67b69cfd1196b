"""String and date similarity."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cells of one padded letter matrix: bounds a task's memory whatever the text lengths.
_CELLS = 1 << 21
# Texts up to this length are compared letter against letter over whole batches, longer ones text against letter.
_SHORT = 96


def _finish(a, b, used, hit, len_a, len_b) -> np.ndarray:
    """Score from the match flags (Winkler 1990: prefix weight 0.1, at most 4 letters)."""
    matched = hit.sum(axis=1)
    # Both masks mark the same number of letters per row, so the flattened letters line up.
    rows = np.repeat(np.arange(len(a)), matched)
    moved = np.bincount(rows[a[used] != b[hit]], minlength=len(a)) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (matched / len_a + matched / len_b + (matched - moved) / matched) / 3.0
    score[matched == 0] = 0.0
    head = min(4, a.shape[1], b.shape[1])
    prefix = np.cumprod(a[:, :head] == b[:, :head], axis=1).sum(axis=1)
    return np.where(score > 0.7, score + prefix * 0.1 * (1.0 - score), score)


def _reach(len_a: np.ndarray, len_b: np.ndarray) -> np.ndarray:
    return np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)


def _short(a, b, len_a, len_b) -> np.ndarray:
    """Score of narrow letter matrices: each step handles one pair of places for the whole batch at once."""
    reach = _reach(len_a, len_b).astype(np.int16)
    at_a, at_b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    used = np.zeros(at_a.shape, dtype=bool)
    hit = np.zeros(at_b.shape, dtype=bool)
    widest = int(reach.max())
    near = [reach >= d for d in range(widest + 1)]
    for j in range(int(len_b.max())):
        open_b = np.ones(len(a), dtype=bool)
        for i in range(max(0, j - widest), min(at_a.shape[0], j + widest + 1)):
            new = at_a[i] == at_b[j]
            new &= near[abs(i - j)]
            new &= open_b
            new &= ~used[i]
            used[i] |= new
            open_b ^= new
        hit[j] = ~open_b
    return _finish(a, b, np.ascontiguousarray(used.T), np.ascontiguousarray(hit.T), len_a, len_b)


def _unbounded(a, b, len_a, len_b) -> np.ndarray:
    """Score of letter matrices of any width."""
    rows = np.arange(len(a))
    reach = _reach(len_a, len_b)
    used = np.zeros(a.shape, dtype=bool)
    hit = np.zeros(b.shape, dtype=bool)
    widest = int(reach.max())
    place = np.arange(a.shape[1])
    for j in range(b.shape[1]):
        low, high = max(0, j - widest), min(a.shape[1], j + widest + 1)
        if low >= high:
            break
        free = (a[:, low:high] == b[:, j : j + 1]) & ~used[:, low:high]
        free &= np.abs(place[low:high] - j) <= reach[:, None]
        first = free.argmax(axis=1)
        found = free[rows, first]
        used[rows[found], first[found] + low] = True
        hit[found, j] = True
    return _finish(a, b, used, hit, len_a, len_b)


def _letters(texts: pa.Array, width: int, filler: int) -> np.ndarray:
    """ASCII texts as a matrix of letters, straight from the Arrow buffers."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    matrix = np.full((len(texts), width), filler, dtype=np.uint8)
    # Letters lie row after row in the buffer, which is the order in which a mask is filled.
    matrix[np.arange(width) < np.diff(offsets)[:, None]] = data[offsets[0] : offsets[-1]]
    return matrix


def _code_points(texts: pa.Array, filler: int) -> np.ndarray:
    words = texts.to_numpy(zero_copy_only=False).astype(np.str_)
    matrix = words.view(np.uint32).reshape(len(words), -1).copy()
    matrix[matrix == 0] = filler
    return matrix


def jaro_winkler_arrow(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Jaro-Winkler of aligned string arrays; a null side gives nan, an empty one 0."""
    left, right = left.cast(pa.string()), right.cast(pa.string())
    equal = pc.equal(left, right)
    out = np.where(pc.fill_null(equal, False).to_numpy(zero_copy_only=False), 1.0, 0.0)
    out[equal.is_null().to_numpy(zero_copy_only=False)] = np.nan
    len_l, len_r = (pc.fill_null(pc.utf8_length(x), 0).to_numpy(zero_copy_only=False) for x in (left, right))
    empty = (len_l == 0) | (len_r == 0)
    out[(out == 1.0) & empty] = 0.0
    todo = np.nonzero((out == 0.0) & ~empty)[0]
    size = np.maximum(len_l, len_r)[todo]
    order = np.argsort(size, kind="stable")
    todo, size = todo[order], size[order]
    plain = pc.and_(pc.string_is_ascii(left), pc.string_is_ascii(right)).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(todo):
        # Sizes ascend: take as many rows as fit at the width of the last one.
        fit = np.arange(1, len(todo) - start + 1) * size[start:] <= _CELLS
        pick = todo[start : start + max(1, int(fit.sum()))]
        start += len(pick)
        x, y = left.take(pa.array(pick)), right.take(pa.array(pick))
        lengths = len_l[pick], len_r[pick]
        widest = int(np.maximum(*lengths).max())
        if plain[pick].all():
            a, b = _letters(x, widest, 0), _letters(y, widest, 255)
        else:
            a, b = _code_points(x, 0xFFFFFFFF), _code_points(y, 0xFFFFFFFE)
        out[pick] = (_short if widest <= _SHORT else _unbounded)(a, b, *lengths)
    return out


@F.arrow_udf(T.DoubleType())
def _jaro_winkler(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(jaro_winkler_arrow(left, right), from_pandas=True)


def jaro_winkler(left: Column, right: Column) -> Column:
    """Jaro-Winkler similarity, null when a side is null. Spark has none, so Arrow batches go to Python."""
    return _jaro_winkler(left, right)


def best_jaro_winkler(left: Column, right: Column) -> Column:
    """Upper bound of :func:`jaro_winkler` from the lengths alone."""
    shorter = F.least(F.char_length(left), F.char_length(right))
    longer = F.greatest(F.char_length(left), F.char_length(right))
    jaro = (F.lit(2.0) + shorter / longer) / 3.0
    # A hair above, so that rounding never turns the bound into a false dismissal.
    return F.when(shorter > 0, jaro + 0.4 * (1.0 - jaro) + 1e-9).otherwise(F.lit(0.0))


def within_one_edit(left: Column, right: Column) -> Column:
    """Damerau-Levenshtein distance of at most 1, for texts of any length."""
    distance = F.levenshtein(left, right, 2)
    # A swap of neighbours costs two plain edits: behind the common start, two letters are exchanged.
    places = F.sequence(F.lit(1), F.char_length(left))
    start = F.array_position(F.transform(places, lambda i: F.substring(left, i, 1) != F.substring(right, i, 1)), True).cast("int")
    swapped = F.concat(F.substring(left, F.lit(1), start - 1), F.substring(left, start + 1, 1), F.substring(left, start, F.lit(1)), F.substring(left, start + 2, F.char_length(left))) == right
    alike = (distance == 2) & (F.char_length(left) == F.char_length(right)) & (F.char_length(left) > 1)
    return F.when(distance.between(0, 1), True).when(alike, (start > 0) & swapped).otherwise(False)


# One month and two years, in seconds.
MONTH_SECONDS = 2629800
TWO_YEARS_SECONDS = 63115200


def seconds_apart(left: Column, right: Column) -> Column:
    return F.abs(F.datediff(left, right)).cast("long") * 86400
