"""Does a source query keep its contract?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from kinfold.schema import SOURCE, SOURCE_NAMES

PLACEHOLDERS = (":last_id", ":limit")


@dataclass(frozen=True)
class SourceCheck:
    missing_placeholders: tuple[str, ...]
    missing_columns: tuple[str, ...]
    found_columns: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.missing_placeholders and not self.missing_columns


def missing_columns(found: list[str], required: list[str] | None = None) -> tuple[str, ...]:
    """Required columns that are absent, under their own or their source name, in any case."""
    required = SOURCE.names if required is None else required
    native = {name: source for source, name in SOURCE_NAMES.items()}
    have = {c.lower() for c in found}
    return tuple(c for c in required if c.lower() not in have and native.get(c, c).lower() not in have)


def validate_source(spark: SparkSession, query: str) -> SourceCheck:
    """Check placeholders and result columns of a source query; it is analysed, not run."""
    absent = tuple(p for p in PLACEHOLDERS if p not in query)
    args = {p[1:]: value for p, value in zip(PLACEHOLDERS, ("", 0)) if p not in absent}
    found = spark.sql(query, args=args).schema.names
    return SourceCheck(absent, missing_columns(found), tuple(found))
