"""Term frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.skew import attach
from kinfold.settings import LinkSettings


def tf_table(df: DataFrame, column: str, weight: Column | None = None) -> DataFrame:
    """``value, n, tf``: share of each value among the non-null ones; ``weight`` = records a row stands for."""
    rows = F.sum(F.lit(1) if weight is None else weight).cast("long")
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(rows.alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("tf", F.col("n") / total)


def tf_columns(settings: LinkSettings) -> list[str]:
    return [c.column for c in settings.comparisons if c.term_frequency]


def tf_tables(df: DataFrame, settings: LinkSettings, weight: Column | None = None) -> dict[str, DataFrame]:
    return {column: tf_table(df, column, weight) for column in tf_columns(settings)}


def value_counts(df: DataFrame, settings: LinkSettings, sign: int = 1) -> DataFrame:
    """``column, value, n``: how often each value of the adjusted columns occurs; negative where rows are taken back.

    Counts of several batches add up, so that no batch counts the rows of another again.
    """
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in tf_columns(settings)]))
    return df.select(values).filter("value IS NOT NULL").groupBy("column", "value").agg((F.count(F.lit(1)) * sign).alias("n"))


def merged_counts(counts: DataFrame) -> DataFrame:
    """The sums of ``counts(column, value, n)``; values that are all taken back are gone."""
    return counts.groupBy("column", "value").agg(F.sum("n").alias("n")).filter("n > 0")


def tf_of_counts(merged: DataFrame, settings: LinkSettings, wanted: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of :func:`tf_tables` from merged counts; with ``wanted(column, value)`` only its values."""
    totals = merged.groupBy(F.col("column").alias("of")).agg(F.sum("n").alias("total"))
    rows = merged if wanted is None else merged.join(wanted, ["column", "value"], "left_semi")
    # One total per column: a handful of rows.
    rows = rows.join(F.broadcast(totals), rows["column"] == totals["of"]).select("column", "value", "n", (F.col("n") / F.col("total")).alias("tf"))
    return {c: rows.filter(F.col("column") == c).drop("column") for c in tf_columns(settings)}


def with_tf(df: DataFrame, tables: dict[str, DataFrame], ident: str) -> DataFrame:
    """Add ``tf_<column>`` for each frequency table; frequent and missing values do not pile up in one task."""
    for column, table in tables.items():
        lookup = table.select(F.col("value").alias(column), "n", F.col("tf").alias(f"tf_{column}"))
        df = attach(df, lookup, column, "n", F.col(ident))
    return df
