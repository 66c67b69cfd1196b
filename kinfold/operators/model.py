"""Learned parameters: match prior, and m and u per comparison level."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from kinfold.settings import Comparison, LinkSettings

_FLOOR = 1e-12
_SCHEMA = "comparison string, level int, label string, m double, u double, tf boolean, prior double"


@dataclass(frozen=True)
class LinkModel:
    """``m[column][level]`` and ``u[column][level]``; level 0 is disagreement, the last one is exact."""

    settings: LinkSettings
    prior: float
    m: dict[str, tuple[float, ...]]
    u: dict[str, tuple[float, ...]]

    def weight(self, column: str, level: int) -> float:
        """log2 Bayes factor of a level; null (-1) is neutral."""
        if level < 0:
            return 0.0
        return math.log2(max(self.m[column][level], _FLOOR) / max(self.u[column][level], _FLOOR))

    @property
    def prior_weight(self) -> float:
        p = min(max(self.prior, _FLOOR), 1 - _FLOOR)
        return math.log2(p / (1 - p))

    def rows(self) -> list[tuple]:
        return [
            (c.column, level, label, self.m[c.column][level], self.u[c.column][level], c.term_frequency, self.prior)
            for c in self.settings.comparisons
            for level, label in enumerate(c.labels)
        ]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r) for r in self.rows()], _SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """A few dozen rows of JSON, and the settings the parameters belong to."""
        self.to_frame(spark).coalesce(1).write.mode("overwrite").json(f"{path}/parameters")
        kept = spark.createDataFrame([(describe(self.settings),)], "settings string")
        kept.coalesce(1).write.mode("overwrite").text(f"{path}/settings")


def describe(settings: LinkSettings) -> str:
    """Rules, comparisons, thresholds and labels as JSON."""
    return json.dumps(asdict(settings), sort_keys=True)


def stored_settings(spark: SparkSession, path: str) -> LinkSettings:
    """The settings a model was trained under: rules and comparisons as they were."""
    found = json.loads(spark.read.text(f"{path}/settings").first()[0])
    rules = tuple(map(tuple, found["rules"]))
    comparisons = tuple(Comparison(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in found["comparisons"])
    return LinkSettings(found["id_column"], rules, comparisons)


def load_model(spark: SparkSession, path: str, settings: LinkSettings | None = None) -> LinkModel:
    """Read saved parameters with their settings; with ``settings`` given, both must be the same."""
    stored = stored_settings(spark, path)
    if settings is not None and describe(settings) != describe(stored):
        raise ValueError("the saved model was trained under other settings")
    rows = spark.read.schema(_SCHEMA).json(f"{path}/parameters").collect()
    found = {(r.comparison, r.level): r for r in rows}
    expected = {(c.column, level) for c in stored.comparisons for level in range(c.top + 1)}
    if set(found) != expected:
        raise ValueError("the saved parameters do not fit their settings")
    m = {c.column: tuple(found[c.column, i].m for i in range(c.top + 1)) for c in stored.comparisons}
    u = {c.column: tuple(found[c.column, i].u for i in range(c.top + 1)) for c in stored.comparisons}
    return LinkModel(stored, rows[0].prior, m, u)
