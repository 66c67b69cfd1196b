"""Injecting labelled duplicates and measuring how well they are found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.identity import compose_record_key, swap_letters
from kinfold.operators.sampling import seeded_number

_RANGE = 1 << 52


def _chosen(ident: Column, share: float, seed: int) -> Column:
    return seeded_number(ident, seed) < int(share * _RANGE)


def inject_duplicates(df: DataFrame, rate: float = 0.05, seed: int = 0, new_id: Column | None = None, new_site: Column | None = None) -> DataFrame:
    """``df`` plus copies of a ``rate`` of its rows; all rows get ``true_entity``, the id of the original.

    Half of the copies have two neighbouring letters of the name swapped, half (independently) another address.
    A copy gets a key of its own; by default the original's with a mark. Every choice follows from id and seed, so
    the job is one narrow pass and repeats exactly.
    """
    ident = F.col("record_id")
    length = F.char_length("full_name")
    place = seeded_number(ident, seed + 3) % F.greatest(length - 1, F.lit(1)) + 1
    name = F.when(_chosen(ident, 0.5, seed + 1), swap_letters(F.col("full_name"), place)).otherwise(F.col("full_name"))
    house = (seeded_number(ident, seed + 4) % 900 + 1).cast("string")
    address = F.when(_chosen(ident, 0.5, seed + 2), F.concat(F.lit("Jl. Baru No. "), house)).otherwise(F.col("address"))
    labelled = df.withColumn("true_entity", ident)
    changes = {"full_name": name, "address": address, "record_id": F.concat(ident, F.lit("-D")) if new_id is None else new_id}
    if new_site is not None:
        changes["site_id"] = new_site
    copies = labelled.filter(_chosen(ident, rate, seed)).withColumns(changes)
    return labelled.unionByName(copies)


def numbered_record_key(ident: Column, index: Column, seed: int = 0) -> Column:
    """A key from a running index, at one of 50 sites drawn from the id."""
    return compose_record_key(seeded_number(ident, seed) % 50 + 1, index)


def pair_quality(clusters: DataFrame, truth: DataFrame, entity: str = "cif_number", label: str = "true_entity") -> DataFrame:
    """Pair precision and recall of a grouping, from group sizes alone: no pair is formed.

    Both frames carry ``record_id``; the pairs are those within one found entity and within one true entity.
    """
    joined = clusters.select("record_id", entity).join(truth.select("record_id", label), "record_id")
    cells = joined.groupBy(entity, label).agg(F.count(F.lit(1)).alias("n"))

    def pairs(groups: DataFrame, name: str) -> Column:
        n = F.col("n").cast("double")
        return groups.agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).cast("long").alias(name))

    found = pairs(cells.groupBy(entity).agg(F.sum("n").alias("n")), "found_pairs")
    true = pairs(cells.groupBy(label).agg(F.sum("n").alias("n")), "true_pairs")
    both = pairs(cells, "common_pairs")
    out = both.select("common_pairs", found.scalar().alias("found_pairs"), true.scalar().alias("true_pairs"))
    return out.withColumns(
        {
            "precision": F.try_divide("common_pairs", "found_pairs"),
            "recall": F.try_divide("common_pairs", "true_pairs"),
        }
    )
