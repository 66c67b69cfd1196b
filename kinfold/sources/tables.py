"""Keyed tables: upsert, latest row per key, what is waiting to be linked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the stated ``order``, which should leave no ties.

    Spark keeps only the best row per key of each task before the shuffle, so a key with many rows is harmless.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of ``delta`` put in, replacing those with the same key (unique in ``delta``)."""
    return base.join(delta.select(key), key, "left_anti").unionByName(delta)


def mark_processed(staging: DataFrame, batch: DataFrame, at: Column) -> DataFrame:
    """Set ``processed_at`` on the rows whose id is in ``batch``."""
    done = batch.select("record_id").distinct().withColumn("_done", F.lit(True))
    joined = staging.join(done, "record_id", "left")
    return joined.withColumn("processed_at", F.when(F.col("_done"), at).otherwise(F.col("processed_at"))).select(*staging.columns)


def unprocessed_ids(staging: DataFrame, links: DataFrame) -> DataFrame:
    """Ids of the staged records not linked since they were last extracted.

    Follows from the links, so no batch has to rewrite staging; a record that is extracted again is pending
    again. Only ids and times are joined.
    """
    done = links.select("record_id", F.col("processed_at").alias("_linked_at"))
    late = F.col("_linked_at").isNull() | (F.col("_linked_at") < F.col("extracted_at"))
    waiting = staging.filter(F.col("processed_at").isNull()).select("record_id", "extracted_at")
    return waiting.join(done, "record_id", "left").filter(late).select("record_id")
