"""Lookup joins whose key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup row counts as hot from this many matching rows on; there can be at most (all rows / HOT_ROWS) such rows.
HOT_ROWS = 1_000_000
# Hot lookup rows that are broadcast; should a huge table have more, all rows are joined by a shuffle.
MOST_HOT = 200_000


def attach(df: DataFrame, lookup: DataFrame, key: str, matching: str, spread: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join ``lookup`` (unique ``key``; ``matching`` = rows of ``df`` with that key) without a hot task.

    Hot lookup rows are few by construction and are broadcast. Rows they serve, and rows without a key, then get
    a key of their own from ``spread``, which matches nothing and scatters them over the shuffle of the rest.
    """
    added = [c for c in lookup.columns if c not in (key, matching)]
    hot = lookup.filter(F.col(matching) >= hot_rows).select(F.col(key), F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in added])
    if hot.count() > MOST_HOT:
        return df.join(lookup.select(key, *added), key, "left").select(*df.columns, *added)
    cold = lookup.filter(F.col(matching) < hot_rows).select(F.col(key).alias("_cold_key"), F.lit(False).alias("_spread"), *added)
    served = df.join(F.broadcast(hot), key, "left")
    alone = F.col("_hot").isNotNull() | F.col(key).isNull()
    served = served.withColumns({"_join_key": F.when(alone, spread.cast("string")).otherwise(F.col(key)), "_alone": alone})
    joined = served.join(cold, (F.col("_join_key") == F.col("_cold_key")) & (F.col("_alone") == F.col("_spread")), "left")
    return joined.select(*df.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in added])
