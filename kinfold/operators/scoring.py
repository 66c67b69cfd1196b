"""Match weights and probabilities of candidate pairs (Fellegi and Sunter 1969)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.comparison import reachable, with_cheap_gammas, with_text_gammas
from kinfold.operators.model import LinkModel
from kinfold.settings import TEXT, Comparison


def weight_of(probability: float) -> float:
    """The match weight at which a probability is reached."""
    if probability <= 0:
        return -math.inf
    if probability >= 1:
        return math.inf
    return math.log2(probability / (1 - probability))


def _tf_weight(model: LinkModel, c: Comparison) -> Column:
    """Exact agreement on a rare value counts more: log2(u / tf). Both sides hold the same value, so one tf does."""
    u = model.u[c.column][c.top]
    return F.coalesce(F.log2(F.lit(u) / F.col(f"tf_{c.column}_l")), F.lit(0.0))


def level_weight(model: LinkModel, c: Comparison) -> Column:
    """Weight of a pair's level, looked up by its number so that the level is computed once."""
    gamma = F.col(f"gamma_{c.column}")
    weights = F.array(*[F.lit(model.weight(c.column, level)) for level in range(-1, c.top + 1)])
    weight = F.element_at(weights, gamma + 2)
    if c.term_frequency:
        weight = weight + F.when(gamma == c.top, _tf_weight(model, c)).otherwise(F.lit(0.0))
    return weight


def _best_weight(model: LinkModel, c: Comparison) -> Column:
    """Most a text comparison can add, before any similarity is computed."""
    left, right = F.col(f"{c.column}_l"), F.col(f"{c.column}_r")
    exact = F.lit(model.weight(c.column, c.top))
    if c.term_frequency:
        exact = exact + _tf_weight(model, c)
    # Lengths that rule out a similarity rule out every higher one too.
    best = model.weight(c.column, 0)
    fuzzy = F.lit(best)
    for level in range(1, c.top):
        best = max(best, model.weight(c.column, level))
        fuzzy = F.when(reachable(c, level), best).otherwise(fuzzy)
    return F.when(left.isNull() | right.isNull(), 0.0).when(left == right, exact).otherwise(fuzzy)


def _total(model: LinkModel, parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(model.prior_weight))


def score_pairs(
    pairs: DataFrame,
    model: LinkModel,
    min_weight: float | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``match_weight`` and ``match_probability``.

    ``pairs`` carries both sides of the compared columns and ``tf_<column>_l`` of the adjusted ones. With
    ``min_weight``, pairs below it go; those that cannot reach it whatever their text similarities are dropped
    before they are sent to Python. ``keep`` names the columns to return besides the two; None keeps all of them.
    """
    settings = model.settings
    if min_weight is not None and min_weight == math.inf:
        min_weight = None
    scored = with_cheap_gammas(pairs, settings)
    if min_weight is not None and min_weight != -math.inf:
        best = [_best_weight(model, c) if c.kind == TEXT else level_weight(model, c) for c in settings.comparisons]
        # The metric also keeps the bound where it is: pushed down, its long expression costs seconds of planning.
        scored = scored.withColumn("_best", _total(model, best)).observe("candidate_pairs", F.count(F.lit(1)).alias("pairs"))
        # A hair below, so that the order of additions never decides.
        scored = scored.filter(F.col("_best") >= min_weight - 1e-6).drop("_best")
    scored = with_text_gammas(scored, settings)
    weight = _total(model, [level_weight(model, c) for c in settings.comparisons])
    scored = scored.withColumn("match_weight", weight)
    scored = scored.withColumn("match_probability", F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.0), -F.col("match_weight"))))
    if min_weight is not None:
        scored = scored.observe("compared_pairs", F.count(F.lit(1)).alias("pairs")).filter(F.col("match_weight") >= min_weight)
    return scored if keep is None else scored.select(*keep, "match_weight", "match_probability")


def matches(pairs: DataFrame, model: LinkModel, threshold: float = 0.9, match_weight_threshold: float = -4.0, keep=None) -> DataFrame:
    """Pairs with a match probability of at least ``threshold``, after the coarser weight filter."""
    coarse = max(match_weight_threshold, weight_of(threshold) - 1e-6) if threshold > 0 else match_weight_threshold
    return score_pairs(pairs, model, coarse, keep).filter(F.col("match_probability") >= threshold)


def weight_columns(model: LinkModel) -> list[Column]:
    """``weight_<column>``: what each comparison of a scored pair adds (log2 Bayes factor with its term frequency)."""
    return [level_weight(model, c).alias(f"weight_{c.column}") for c in model.settings.comparisons]
