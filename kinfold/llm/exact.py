"""Exact duplicates by sorting contents: equal texts become neighbours and are compared in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import SPACE, hot_keys, partitions, salt

#: Bytes of the normalised text that lead the sort key; splitters stay this small however long texts are.
HEAD = 32


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: bool = False, share: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``, and with ``carry`` the whole
    row as struct ``row``.

    Splitters that Spark samples deal the rows into ranges of (first bytes, hash) of the normalised text. Inside a
    range an external sort puts equal texts next to each other, and the window compares neighbouring texts in full.
    The row with the most code points in the original text stays, of these the one with the smallest id.

    A text that would fill more than ``share`` of a task is dealt over all tasks by a hash of the id. The few such
    texts (2 * tasks / share at most) are combined once more over all their parts, before any shuffle.

    Null and empty texts are equal to each other and to blank ones. A null id ranks behind all others. Of fully
    equal rows one is kept. An empty table gives no rows; other columns, whatever their names, play no part.
    """
    tasks = partitions(docs.sparkSession)
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.char_length(F.coalesce(text, F.lit(""))).alias("_length"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []),
        normalised(text).alias("_norm"),
    ).withColumn("_hash", F.xxhash64("_norm"))
    hot = hot_keys(rows.select("_hash", F.octet_length("_norm").alias("_size")), "_hash", F.col("_size"), tasks, share)
    keyed = rows.withColumns({"_head": F.substring("_norm", 1, HEAD), "_part": salt(F.col("_hash"), hot, F.xxhash64("doc_id", "_length"), tasks)})
    # A constant among the keys would hide from the planner that the ranges already hold the groups together.
    keys = ["_head", "_hash", *(["_part"] if hot else [])]
    if carry:
        # The text itself travels once, inside the row; its normal form is made again where it is sorted.
        keyed = keyed.drop("_norm")
    dealt = keyed.repartitionByRange(*keys)
    if carry:
        dealt = dealt.withColumn("_norm", normalised(F.col("_row").getField(text_column)))
    equal = Window.partitionBy(*keys, "_norm")
    ranked = equal.orderBy(F.desc("_length"), F.asc_nulls_last("doc_id"))
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = dealt.select(
        "doc_id",
        *(["_row"] if carry else []),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        (F.row_number().over(ranked) == 1).alias("kept"),
        F.first("_length").over(whole).alias("_most"),
        F.sha2("_norm", 256).alias("text_sha256"),
    )
    if hot:
        best = F.struct((-F.col("_length")).alias("l"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"))
        over_all = rows.filter(F.col("_hash").isin(hot)).groupBy("_norm").agg(F.min(best).alias("_best"), F.count(F.lit(1)).alias("_all"))
        over_all = over_all.select(F.sha2("_norm", 256).alias("text_sha256"), "_best", "_all")
        wins = F.col("keep_id").eqNullSafe(F.col("_best.i")) & (F.col("_most") == -F.col("_best.l"))
        marked = marked.join(F.broadcast(over_all), "text_sha256", "left").withColumns(
            {
                "kept": F.col("kept") & (F.col("_best").isNull() | wins),
                "keep_id": F.when(F.col("_best").isNotNull(), F.col("_best.i")).otherwise(F.col("keep_id")),
                "group_size": F.coalesce("_all", "group_size"),
            }
        )
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256", *([F.col("_row").alias("row")] if carry else []))
