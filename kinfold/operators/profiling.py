"""Data profile: missing values, exact duplicates, lengths, frequent values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.operators.sampling import sample_n
from kinfold.session import materialize


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, missing`` for each column, in one pass."""
    columns = columns or df.columns
    wide = df.select([F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "missing")


def duplicate_groups(df: DataFrame, keys: list[str], keep_nulls: bool = False) -> DataFrame:
    """``keys, n`` of the values that more than one row shares. Rows with a null key count unless left out."""
    rows = df if keep_nulls else df.dropna("any", subset=keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def exact_duplicates(df: DataFrame, keys: list[str], keep_nulls: bool = False) -> DataFrame:
    """One row: how many groups share a key, and how many rows are in them."""
    return duplicate_groups(df, keys, keep_nulls).agg(
        F.count(F.lit(1)).alias("dup_groups"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("dup_rows")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, n``; null is a value too."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(k)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, n`` over equal bins from minimum to maximum; the last bin is closed. Nulls are left out.

    Values are counted first and the counts written, so that range and bins come from distinct values.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts_histogram(materialize(counted), bins)


def counts_histogram(counted: DataFrame, bins: int = 30) -> DataFrame:
    """The same from stored counts, ``value, n`` with a double each."""
    low, high = counted.agg(F.min("value")).scalar(), counted.agg(F.max("value")).scalar()
    ranged = counted.withColumns({"lowest": low, "width": (high - low) / bins})
    # One value only: a single bin of width 1 around it holds everything, as numpy does it.
    flat = F.col("width") == 0
    lowest = F.when(flat, F.col("lowest") - 0.5).otherwise(F.col("lowest"))
    width = F.when(flat, F.lit(1.0 / bins)).otherwise(F.col("width"))
    number = F.least(F.floor((F.col("value") - lowest) / width), F.lit(bins - 1)).cast("int")
    placed = ranged.select("n", number.alias("bin"), lowest.alias("lowest"), width.alias("width"))
    return placed.groupBy("bin").agg(
        (F.min("lowest") + F.col("bin") * F.min("width")).alias("low"),
        (F.min("lowest") + (F.col("bin") + 1) * F.min("width")).alias("high"),
        F.sum("n").cast("long").alias("n"),
    )


def length_histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    return histogram(df.select(F.char_length(column).alias("length")), "length", bins)


def _joined(columns: list[str]) -> Column:
    """One text per list of values; nulls and '' differ, and no two lists run together."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.char_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in map(F.col, columns)])


def _long_counts(df: DataFrame, key: str, pair: list[str], lengths: list[str], frequent: list[str]) -> DataFrame:
    """``kind, column, value, n`` of everything a profile counts, each row of ``df`` adding one to several of them.

    Counts are combined in each task before the one shuffle, so what moves are distinct values, not rows.
    """

    def entry(kind: str, column: str | None, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"), value.cast("string").alias("value"))

    nothing = F.lit(None)
    entries = [entry("rows", None, nothing)]
    entries += [F.when(F.col(c).isNull(), entry("missing", c, nothing)) for c in df.columns]
    entries += [F.when(F.col(key).isNotNull(), entry("same", key, F.col(key))), entry("same", "+".join(pair), _joined(pair))]
    entries += [F.when(F.col(c).isNotNull(), entry("length", c, F.char_length(c))) for c in lengths]
    entries += [entry("frequent", c, F.col(c)) for c in frequent]
    long = df.select(F.inline(F.array_compact(F.array(*entries))))
    return long.groupBy("kind", "column", "value").agg(F.count(F.lit(1)).alias("n"))


def report(df: DataFrame, key: str, name: str, birth_date: str, lengths: list[str], frequent: list[str]) -> DataFrame:
    """The profile in long form: ``metric, column, item, value``; ready to be written as JSON or Parquet.

    The source is read once and shuffled once, as counts of values; every figure follows from these.
    """
    pair = [name, birth_date]
    counted = materialize(_long_counts(df, key, pair, lengths, frequent))

    def of(kind: str, column: str) -> DataFrame:
        return counted.filter((F.col("kind") == kind) & (F.col("column") == column))

    def rows(source: DataFrame, metric, column, item, value) -> DataFrame:
        return source.select(
            F.lit(metric).alias("metric") if isinstance(metric, str) else metric.alias("metric"),
            column.alias("column"),
            item.cast("string").alias("item"),
            value.cast("long").alias("value"),
        )

    nothing = F.lit(None)
    number = F.coalesce(F.sum(F.when(F.col("kind") == "rows", F.col("n"))), F.lit(0))
    missing = [F.coalesce(F.sum(F.when((F.col("kind") == "missing") & (F.col("column") == c), F.col("n"))), F.lit(0)).alias(c) for c in df.columns]
    wide = counted.filter(F.col("kind").isin("rows", "missing")).agg(number.alias("_rows"), *missing)
    counts = wide.unpivot([], ["_rows", *df.columns], "column", "n")
    total = F.col("column") == "_rows"
    parts = [rows(counts, F.when(total, "rows").otherwise("missing"), F.when(~total, F.col("column")), nothing, F.col("n"))]
    for column in (key, "+".join(pair)):
        found = of("same", column).filter("n > 1").agg(F.count(F.lit(1)).alias("dup_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows"))
        parts.append(rows(found.unpivot([], ["dup_groups", "dup_rows"], "metric", "value"), F.col("metric"), F.lit(column), nothing, F.col("value")))
    for c in lengths:
        binned = counts_histogram(of("length", c).select(F.col("value").cast("double").alias("value"), "n"))
        parts.append(rows(binned, "length", F.lit(c), F.round("low", 3), F.col("n")))
    for c in frequent:
        best = of("frequent", c).orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(5)
        parts.append(rows(best, "frequent", F.lit(c), F.col("value"), F.col("n")))
    return reduce(DataFrame.unionByName, parts)


# What the profile of the source and of the staged table reads.
SOURCE_PROFILE = ("record_id", "full_name", "national_id", "birth_date", "gender", "address", "site_id", "residivis")
STAGING_PROFILE = (
    "record_id", "full_name", "clean_name", "national_id", "birth_date", "gender",
    "address", "clean_address", "site_id", "clean_father", "clean_mother",
)


def analyze(df: DataFrame, source: str = "raw", sample_size: int | None = None, seed: int = 0) -> DataFrame:
    """Profile the raw source (``source='raw'``) or the staged table (``'staged'``), whole or from an exact-size sample."""
    if source not in ("raw", "staged"):
        raise ValueError("source must be 'raw' or 'staged'")
    wanted = SOURCE_PROFILE if source == "raw" else STAGING_PROFILE
    rows = df.select(*[c for c in wanted if c in df.columns])
    if sample_size is not None:
        rows = sample_n(rows, "record_id", sample_size, seed)
    return report(rows, "national_id", "full_name", "birth_date", ["full_name", "address"], ["full_name", "site_id"])
