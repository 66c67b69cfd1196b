"""Collapsing records that agree on every compared column.

Copies are interchangeable: each scores the same against any third record, and any two of them score the same.
One row per distinct profile therefore carries all the information of the pairs among its copies, so a group of
copies, however large, costs one row in the joins below instead of a quadratic number of pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.settings import LinkSettings


def profile_key(settings: LinkSettings) -> Column:
    """128-bit digest of the compared columns; nulls and '' differ, and no two value lists run together."""
    parts = [
        F.coalesce(F.concat(F.char_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-"))
        for c in map(F.col, settings.columns)
    ]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def collapse(df: DataFrame, settings: LinkSettings) -> DataFrame:
    """One row per profile: ``profile``, the compared columns, smallest id and number of ``copies``.

    Partial aggregation runs before the shuffle, so a hot profile leaves each task as a single row.
    """
    ident = F.col(settings.id_column)
    return (
        df.groupBy(profile_key(settings).alias("profile"))
        .agg(
            *[F.min(c).alias(c) for c in settings.columns],
            F.min(ident).alias(settings.id_column),
            F.count(F.lit(1)).alias("copies"),
        )
    )
