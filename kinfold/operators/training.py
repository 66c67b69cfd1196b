"""Learning the model without labels."""

from __future__ import annotations

from dataclasses import dataclass, replace
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.blocking import rule_block_pairs
from kinfold.operators.comparison import gamma_columns, gamma_pattern_counts, with_gammas
from kinfold.operators.frequency import tf_columns, tf_tables, with_tf
from kinfold.operators.model import LinkModel
from kinfold.operators.profiles import collapse
from kinfold.operators.sampling import random_pairs
from kinfold.session import forget, materialize
from kinfold.settings import Comparison, LinkSettings

MAX_ROUNDS = 25
SETTLED = 1e-4
_TINY = 1e-12


class TrainingIncomplete(RuntimeError):
    """Some levels could not be learned from any session."""


def default_m(c: Comparison) -> tuple[float, ...]:
    """Starting values: 0.95 on exact agreement, the rest shared evenly."""
    return (0.05 / c.top,) * c.top + (0.95,)


def estimate_u(df: DataFrame, settings: LinkSettings, max_pairs: int = 5_000_000, seed: int = 0) -> DataFrame:
    """``comparison, level, pairs, u``: share of each level among random pairs with both values present."""
    pairs = random_pairs(df, settings.id_column, settings.columns, max_pairs, seed)
    return level_shares(gamma_pattern_counts(pairs, settings), settings)


def smoothed_u(shares: DataFrame, settings: LinkSettings) -> dict[str, tuple[float, ...]]:
    """u of every level: one that no random pair showed counts as half a pair, not as impossible."""
    pairs = {c.column: [0.0] * (c.top + 1) for c in settings.comparisons}
    for row in shares.collect():  # a few dozen rows
        pairs[row.comparison][row.level] = float(row.pairs)
    floored = {c: [max(n, 0.5) for n in counts] for c, counts in pairs.items()}
    return {c: tuple(n / sum(counts) for n in counts) for c, counts in floored.items()}


def level_shares(patterns: DataFrame, settings: LinkSettings) -> DataFrame:
    """Per comparison the share of each level; ``patterns`` is small whatever the data."""
    columns = gamma_columns(settings)
    long = patterns.unpivot(["pairs"], columns, "comparison", "level").filter("level >= 0")
    counts = long.groupBy(F.regexp_replace("comparison", "^gamma_", "").alias("comparison"), F.col("level").cast("int")).agg(F.sum("pairs").alias("pairs"))
    totals = counts.groupBy("comparison").agg(F.sum("pairs").alias("total"))
    return counts.join(totals, "comparison").select("comparison", "level", "pairs", (F.col("pairs") / F.col("total")).alias("u"))


def estimate_prior(df: DataFrame, rule: tuple[str, ...] = ("national_id",), recall: float = 0.7) -> DataFrame:
    """``records, pairs, prior``: chance that two random records match, from the pairs that agree on ``rule``.

    Pairs are counted from group sizes, never formed.
    """
    n = F.col("n").cast("double")
    known = df.select([F.col(c) for c in rule]).dropna("any")
    pairs = known.groupBy(*rule).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).alias("pairs"))
    records = df.select(F.count(F.lit(1)).alias("records")).scalar().cast("double")
    everything = records * (records - 1) / 2
    prior = F.least(F.lit(1.0), F.col("pairs") / F.lit(recall) / everything)
    return pairs.select(records.cast("long").alias("records"), F.col("pairs").cast("long").alias("pairs"), F.coalesce(prior, F.lit(0.0)).alias("prior"))


def active_comparisons(settings: LinkSettings, rule: tuple[str, ...]) -> tuple[Comparison, ...]:
    """Comparisons a session over ``rule`` can learn: those that do not use its columns."""
    return tuple(c for c in settings.comparisons if c.column not in rule)


def session_vectors(profiles: DataFrame, model: LinkModel, rule: tuple[str, ...], use_tf: bool = True) -> DataFrame:
    """Comparison vectors of the rule's pairs: ``gamma_*``, the term-frequency factor ``tf_factor``, ``pairs``."""
    settings = model.settings
    pairs = with_gammas(rule_block_pairs(profiles, settings, rule, [f"tf_{c}" for c in tf_columns(settings)]), settings)
    factor = F.lit(1.0)
    active = active_comparisons(settings, rule)
    if use_tf:
        for c in active:
            if c.term_frequency:
                ratio = F.lit(max(model.u[c.column][c.top], _TINY)) / F.col(f"tf_{c.column}_l")
                factor = factor * F.when(F.col(f"gamma_{c.column}") == c.top, ratio).otherwise(F.lit(1.0))
    keys = [F.col(f"gamma_{c.column}") for c in active]
    return pairs.groupBy(*keys, factor.alias("tf_factor")).agg(F.sum("pairs").alias("pairs"))


def match_chance(model: LinkModel, active: tuple[Comparison, ...], prior: float) -> Column:
    """Probability that a vector's pairs match, under the current parameters."""
    odds = F.lit(prior / max(1 - prior, _TINY)) * F.col("tf_factor")
    for c in active:
        gamma = F.col(f"gamma_{c.column}")
        ratio = F.when(gamma == -1, F.lit(1.0))
        for level in range(c.top + 1):
            ratio = ratio.when(gamma == level, F.lit(max(model.m[c.column][level], _TINY) / max(model.u[c.column][level], _TINY)))
        odds = odds * ratio
    return odds / (F.lit(1.0) + odds)


def em_step(vectors: DataFrame, model: LinkModel, active: tuple[Comparison, ...], prior: float) -> DataFrame:
    """One round of expectation and maximisation: ``comparison, level, m`` and the new prior, in one aggregation."""
    weighed = vectors.withColumn("expected", F.col("pairs") * match_chance(model, active, prior))
    sums = [F.sum("pairs").alias("pairs"), F.sum("expected").alias("expected")]
    for c in active:
        gamma = F.col(f"gamma_{c.column}")
        sums += [F.coalesce(F.sum(F.when(gamma == level, F.col("expected"))), F.lit(0.0)).alias(f"{c.column}:{level}") for level in range(c.top + 1)]
    total = weighed.agg(*sums)
    rows = []
    for c in active:
        levels = [F.col(f"`{c.column}:{level}`") for level in range(c.top + 1)]
        seen = sum(levels[1:], levels[0])
        rows += [F.struct(F.lit(c.column).alias("comparison"), F.lit(i).alias("level"), F.try_divide(x, seen).alias("m")) for i, x in enumerate(levels)]
    new_prior = (F.col("expected") / F.col("pairs")).alias("prior")
    return total.select(new_prior, F.inline(F.array(*rows))).select("comparison", "level", "m", "prior")


@dataclass(frozen=True)
class Session:
    """What one rule taught: m per comparison and level (None where a level never occurred) and its own prior."""

    rule: tuple[str, ...]
    m: dict[str, tuple[float | None, ...]]
    prior: float
    rounds: int
    settled: bool


def _start(model: LinkModel, rule: tuple[str, ...]) -> float:
    """Prior among the rule's pairs: the overall one raised by what agreement on the rule is worth."""
    weight = model.prior_weight + sum(model.weight(c, model.settings.comparison(c).top) for c in rule)
    return 1 / (1 + 2 ** -max(min(weight, 500), -500))


def em_session(profiles: DataFrame, model: LinkModel, rule: tuple[str, ...], use_tf: bool = True, max_rounds: int = MAX_ROUNDS) -> Session | None:
    """Learn m from the pairs of one rule with u fixed; None when the rule finds no pairs.

    The pairs are reduced once to distinct comparison vectors, a written table that each round reads again; a round
    is one aggregation that returns a few dozen numbers. ``settled`` tells whether the last round still moved.
    """
    active = active_comparisons(model.settings, rule)
    vectors = materialize(session_vectors(profiles, model, rule, use_tf))
    levels = [F.collect_set(F.col(f"gamma_{c.column}")).alias(c.column) for c in active]  # at most one entry per level
    seen = vectors.agg(F.count(F.lit(1)).alias("_vectors"), *levels).first()
    if not seen["_vectors"]:
        forget(vectors)
        return None
    prior, rounds, settled = _start(model, rule), 0, False
    while rounds < max_rounds and not settled:
        rounds += 1
        m = {k: list(v) for k, v in model.m.items()}
        rows = em_step(vectors, model, active, prior).collect()
        for r in rows:
            if r.m is not None:
                m[r.comparison][r.level] = max(r.m, _TINY)
        change = max([abs(rows[0].prior - prior)] + [abs(m[c.column][i] - model.m[c.column][i]) for c in active for i in range(c.top + 1)])
        model, prior = replace(model, m={k: tuple(v) for k, v in m.items()}), rows[0].prior
        settled = change < SETTLED
    forget(vectors)
    taught = {c.column: tuple(v if i in seen[c.column] else None for i, v in enumerate(model.m[c.column])) for c in active}
    return Session(rule, taught, prior, rounds, settled)


def combine(model: LinkModel, sessions: list[Session]) -> LinkModel:
    """The median over sessions per level, brought to a sum of 1; a level no session saw keeps its starting value."""
    m = {}
    for c in model.settings.comparisons:
        values = [[s.m[c.column][i] for s in sessions if c.column in s.m and s.m[c.column][i] is not None] for i in range(c.top + 1)]
        if any(values):
            medians = [median(v) if v else model.m[c.column][i] for i, v in enumerate(values)]
            m[c.column] = tuple(x / sum(medians) for x in medians)
        else:
            m[c.column] = model.m[c.column]
    return replace(model, m=m)


@dataclass(frozen=True)
class Training:
    """A model and how it came about: ``untaught`` (comparison, level) pairs kept their starting values."""

    model: LinkModel
    sessions: tuple[Session, ...]
    untaught: tuple[tuple[str, int], ...]

    @property
    def settled(self) -> bool:
        return all(s.settled for s in self.sessions)


def train(
    staging: DataFrame,
    settings: LinkSettings,
    u_max_pairs: int = 5_000_000,
    deterministic_recall: float = 0.7,
    seed: int = 0,
    use_tf: bool = True,
    prior_rule: tuple[str, ...] = ("national_id",),
    allow_partial: bool = False,
    max_rounds: int = MAX_ROUNDS,
) -> Training:
    """Train on the whole table: u from random pairs, the prior from a deterministic rule, m by one EM session per rule.

    A sample of rows would hold only the square of its share of the matching pairs, so nothing is sampled but the
    random pairs, whose number is bounded. A comparison of which no session saw agreement or disagreement cannot be
    told apart and raises, unless ``allow_partial``; other levels that never occurred are listed.
    """
    rows = staging.select(settings.id_column, *settings.columns)
    if rows.isEmpty():
        raise TrainingIncomplete("there are no staged records to train on")
    prior = estimate_prior(rows, prior_rule, deterministic_recall).first().prior
    if not 0 < prior < 1 and not allow_partial:
        raise TrainingIncomplete(f"no two records agree on {prior_rule}: the share of matching pairs is unknown")
    u = smoothed_u(estimate_u(rows, settings, u_max_pairs, seed), settings)
    model = LinkModel(settings, prior, {c.column: default_m(c) for c in settings.comparisons}, u)
    profiles = materialize(collapse(rows, settings))
    framed = materialize(with_tf(profiles, tf_tables(profiles, settings, F.col("copies")), settings.id_column))
    start, sessions = model, []
    for rule in settings.rules:
        session = em_session(framed, model, rule, use_tf, max_rounds)
        if session is not None:
            sessions.append(session)
            model = combine(start, sessions)
    forget(profiles, framed)
    seen = {(c, i) for s in sessions for c, values in s.m.items() for i, v in enumerate(values) if v is not None}
    untaught = tuple((c.column, i) for c in settings.comparisons for i in range(c.top + 1) if (c.column, i) not in seen)
    ends = [x for x in untaught if x[1] in (0, settings.comparison(x[0]).top)]
    if ends and not allow_partial:
        raise TrainingIncomplete(f"no rule found pairs to learn these levels from: {ends}")
    return Training(model, tuple(sessions), untaught)


def fit(staging: DataFrame, settings: LinkSettings, **options) -> LinkModel:
    """The model of :func:`train`; raises if a session had not settled when its rounds were over."""
    found = train(staging, settings, **options)
    if not found.settled and not options.get("allow_partial"):
        raise TrainingIncomplete(f"not settled: {[s.rule for s in found.sessions if not s.settled]}")
    return found.model
