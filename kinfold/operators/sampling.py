"""Seeded samples and random pairs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 52
_PAIRS_PER_TASK, _ROWS_PER_TASK = 100_000, 1_000_000


def seeded_number(ident: Column, seed: int) -> Column:
    """A number below 2**52 from id and seed; the same on every engine and in every run."""
    return F.conv(F.substring(F.md5(F.concat(ident.cast("string"), F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("long")


def sample_n(df: DataFrame, ident: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), drawn by seeded order of the id."""
    drawn = df.withColumn("_order", seeded_number(F.col(ident), seed))
    return first_n(drawn, "_order", n).drop("_order")


# Ranges that a round of :func:`first_n` counts, ids looked at to place them, and ids that are looked at one by one.
_RANGES, _PROBE, _ALONE = 64, 4096, 50_000


def _within(low, high, ident: str) -> Column:
    """Above ``low`` and up to ``high``, where there is such a bound."""
    inside = F.col(ident).isNotNull()
    if low is not None:
        inside = inside & (F.col(ident) > low)
    return inside if high is None else inside & (F.col(ident) <= high)


def _cut(df: DataFrame, ident: str, n: int, rows: int) -> tuple[object, int]:
    """The id of the ``n``-th of ``rows`` rows by id (nulls aside), and how many rows of that id are among the first.

    The ids are cut into ranges at a few probed ones, counted per range, and added up; only the range that the n-th
    lies in is looked at further. Counts are combined in each task, so a round sends the driver a few dozen numbers.
    """
    low = high = None
    for seed in range(1, 64):
        part = df.select(ident).filter(_within(low, high, ident))
        if rows <= _ALONE:
            ids = sorted(r[0] for r in part.collect())
            return ids[n - 1], n - sum(1 for i in ids if i < ids[n - 1])
        share = int(_RANGE * min(1.0, _PROBE / rows))
        probed = sorted(r[0] for r in part.filter(seeded_number(F.col(ident), 100 + seed) < share).distinct().limit(2 * _PROBE).collect())
        # A bound equal to the upper end would leave an empty range behind it.
        bounds = sorted(set(probed[:: max(1, len(probed) // _RANGES)]) - {high})
        if not bounds:
            ends = part.agg(F.min(ident), F.max(ident)).first()
            if ends[0] == ends[1]:
                return ends[0], n
            bounds = [ends[0]]
        place = reduce(lambda out, b: out + F.when(F.col(ident) > b, 1).otherwise(0), bounds, F.lit(0))
        counts = {r["place"]: r["n"] for r in part.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()}
        edges = [low, *bounds, high]
        for number in range(len(bounds) + 1):
            here = counts.get(number, 0)
            if n <= here:
                low, high, rows = edges[number], edges[number + 1], here
                break
            n -= here
    raise RuntimeError("the ranges did not shrink")


def first_n(df: DataFrame, ident: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ids; nulls come first, and of the rows of the last id any.

    A distributed cut instead of an ordered limit: counting alone finds the last id (see :func:`_cut`), and the rows
    are then filtered where they lie, however many they are.
    """
    total, known = df.agg(F.count(F.lit(1)), F.count(ident)).first()
    if n >= total:
        return df
    if n <= total - known:
        return df.filter(F.col(ident).isNull()).limit(n)
    if n <= 0:
        return df.limit(0)
    wanted = n - (total - known)
    cut, of_last = _cut(df, ident, wanted, known)
    last = df.filter(F.col(ident) == cut)
    below = df.filter(F.col(ident).isNull() | (F.col(ident) < cut))
    if last.limit(of_last + 1).count() == of_last:
        return df.filter(F.col(ident).isNull() | (F.col(ident) <= cut))
    return below.union(last.limit(of_last))


def pair_slots(rows: int, max_pairs: int) -> tuple[int, int]:
    """Slots, and how many of them are paired, so that pairs within those number about ``max_pairs``.

    One slot when all pairs are no more than that. Of more than ``max_pairs`` rows only some meet: slots then hold two
    rows on average, which make two pairs, and so many slots are drawn that their rows number ``max_pairs`` as well.
    """
    if rows * (rows - 1) // 2 <= max_pairs:
        return 1, 1
    if rows <= max_pairs:
        slots = math.ceil(rows * rows / (2 * max_pairs))
        return slots, slots
    return rows // 2, max(1, max_pairs // 2)


def random_pairs(df: DataFrame, ident: str, carry: list[str], max_pairs: int, seed: int = 0, rows: int | None = None) -> DataFrame:
    """About ``max_pairs`` pairs of random rows (all pairs when there are fewer), sides ``x_l`` and ``x_r``.

    Rows that fall into the same random slot are paired: an equi join on an even key, whose slots hold at most
    about sqrt(2 * max_pairs) rows. The slots are drawn before anything moves, so at most about ``max_pairs`` rows are
    shuffled, once for both sides, however large the table. Few slots are cut further, to use the whole cluster.
    """
    rows = df.count() if rows is None else rows
    slots, drawn = pair_slots(rows, max_pairs)
    number = seeded_number(F.col(ident), seed)
    placed = df.select(ident, *carry, (number % slots).alias("slot"))
    if drawn < slots:
        placed = placed.filter(F.col("slot") < drawn)
    tiles = 6 if slots < 64 else 1
    # A fixed number of tasks: the input looks too small to adaptive execution for the pairs it turns into.
    pairs, moved = min(max_pairs, rows * (rows - 1) // 2), min(rows, max_pairs)
    tasks = max(1, pairs // _PAIRS_PER_TASK, moved // _ROWS_PER_TASK, min(slots * tiles, df.sparkSession.sparkContext.defaultParallelism))
    low, high = F.col(f"l.{ident}"), F.col(f"r.{ident}")
    if tiles == 1:
        both = placed.repartition(tasks, "slot")
        # As one conditional the order concerns both sides together, so that they stay alike and share their shuffle.
        met = both.alias("l").join(both.alias("r"), (F.col("l.slot") == F.col("r.slot")) & F.when(low < high, True).otherwise(False))
    else:
        placed = placed.withColumn("own", F.pmod(F.xxhash64(ident), F.lit(tiles)).cast("int"))
        left = placed.withColumns({"a": F.col("own"), "b": F.explode(F.sequence("own", F.lit(tiles - 1)))})
        right = placed.withColumns({"b": F.col("own"), "a": F.explode(F.sequence(F.lit(0), "own"))})
        left, right = left.repartition(tasks, "slot", "a", "b").alias("l"), right.repartition(tasks, "slot", "a", "b").alias("r")
        same = (F.col("l.slot") == F.col("r.slot")) & (F.col("l.a") == F.col("r.a")) & (F.col("l.b") == F.col("r.b"))
        met = left.join(right, same & ((F.col("l.a") < F.col("l.b")) | (low < high)))
    sides = []
    for c in [ident, *carry]:
        x, y = F.col(f"l.{c}"), F.col(f"r.{c}")
        sides += [F.when(low > high, y).otherwise(x).alias(f"{c}_l"), F.when(low > high, x).otherwise(y).alias(f"{c}_r")]
    return met.select(*sides)
