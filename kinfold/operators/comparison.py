"""Comparison vectors of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import (
    MONTH_SECONDS,
    TWO_YEARS_SECONDS,
    best_jaro_winkler,
    jaro_winkler,
    seconds_apart,
    within_one_edit,
)
from kinfold.settings import DATE, EXACT, TEXT, Comparison, LinkSettings


def _sides(c: Comparison) -> tuple[Column, Column]:
    return F.col(f"{c.column}_l"), F.col(f"{c.column}_r")


def _missing(c: Comparison) -> Column:
    left, right = _sides(c)
    return left.isNull() | right.isNull()


def exact_level(c: Comparison) -> Column:
    left, right = _sides(c)
    return F.when(_missing(c), -1).when(left == right, 1).otherwise(0)


def date_level(c: Comparison) -> Column:
    left, right = _sides(c)
    apart = seconds_apart(left, right)
    return (
        F.when(_missing(c), -1)
        .when(left == right, 4)
        .when(within_one_edit(left.cast("string"), right.cast("string")), 3)
        .when(apart <= MONTH_SECONDS, 2)
        .when(apart <= TWO_YEARS_SECONDS, 1)
        .otherwise(0)
    )


def reachable(c: Comparison, level: int) -> Column:
    """Could the lengths of the two texts still give the similarity of this fuzzy ``level``?"""
    return best_jaro_winkler(*_sides(c)) >= sorted(c.thresholds)[level - 1]


def similarity_input(c: Comparison) -> tuple[Column, Column]:
    """The two texts where the similarity decides the level, else null (which costs Python nothing)."""
    left, right = _sides(c)
    open_case = (left != right) & reachable(c, 1)
    return F.when(open_case, left), F.when(open_case, right)


def text_level(c: Comparison, similarity: Column) -> Column:
    left, right = _sides(c)
    level = F.when(_missing(c), -1).when(left == right, c.top)
    for number in range(c.top - 1, 0, -1):
        level = level.when(similarity >= sorted(c.thresholds)[number - 1], number)
    return level.otherwise(0)


def with_cheap_gammas(pairs: DataFrame, settings: LinkSettings) -> DataFrame:
    """Levels that need no similarity: ``gamma_<column>`` of the exact and date comparisons."""
    cheap = {EXACT: exact_level, DATE: date_level}
    return pairs.withColumns({f"gamma_{c.column}": cheap[c.kind](c) for c in settings.comparisons if c.kind in cheap})


def with_text_gammas(pairs: DataFrame, settings: LinkSettings) -> DataFrame:
    """``gamma_<column>`` of the text comparisons; their similarities share one pass through Python."""
    texts = [c for c in settings.comparisons if c.kind == TEXT]
    scored = pairs.withColumns({f"similarity_{c.column}": jaro_winkler(*similarity_input(c)) for c in texts})
    levels = {f"gamma_{c.column}": text_level(c, F.col(f"similarity_{c.column}")) for c in texts}
    return scored.withColumns(levels).drop(*[f"similarity_{c.column}" for c in texts])


def with_gammas(pairs: DataFrame, settings: LinkSettings) -> DataFrame:
    """All comparison levels of pairs that carry ``x_l`` and ``x_r`` of every compared column."""
    return with_text_gammas(with_cheap_gammas(pairs, settings), settings)


def gamma_columns(settings: LinkSettings) -> list[str]:
    return [f"gamma_{c}" for c in settings.columns]


def gamma_pattern_counts(pairs: DataFrame, settings: LinkSettings, weight: Column | None = None) -> DataFrame:
    """How often each comparison vector occurs; at most the product of the level counts, whatever the data."""
    total = F.sum(F.lit(1) if weight is None else weight).cast("long")
    return with_gammas(pairs, settings).groupBy(*gamma_columns(settings)).agg(total.alias("pairs"))
