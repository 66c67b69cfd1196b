"""Entity numbers (CIF): reuse, mint, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.identity import mint_cif, stable_cluster_id
from kinfold.operators.components import connected_components
from kinfold.operators.skew import attach

# Graph node kinds. Entity numbers sort before records, so a component that holds one is named by its smallest.
_CIF, _NODE = "c:", "n:"


def cif_cluster_id(cif: Column) -> Column:
    """Numeric id that follows from the entity number alone: equal numbers have equal ids."""
    return stable_cluster_id(F.regexp_replace(cif, "^CIF-", ""))


def entity_graph(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``node, component`` over record edges (``src, dst``) and links from records to their known numbers.

    With the numbers themselves as nodes, everything that shares a number stays together, and components that
    meet in a number close over it: merges are transitive.
    """
    records = edges.select(F.concat(F.lit(_NODE), "src").alias("src"), F.concat(F.lit(_NODE), "dst").alias("dst"))
    numbers = known.filter(F.coalesce("cif_number", F.lit("")) != "").select(
        F.concat(F.lit(_NODE), "node").alias("src"), F.concat(F.lit(_CIF), "cif_number").alias("dst")
    )
    return connected_components(records.union(numbers))


def _number(component: Column) -> Column:
    name = F.substring(component, F.lit(3), F.char_length(component))
    return F.when(component.startswith(_CIF), name).otherwise(mint_cif(name))


def entity_numbers(graph: DataFrame) -> DataFrame:
    """``node, cif_number`` for each record in the graph: its smallest known number, else one from its smallest id."""
    return graph.filter(F.col("node").startswith(_NODE)).select(
        F.substring("node", F.lit(3), F.char_length("node")).alias("node"), _number(F.col("component")).alias("cif_number")
    )


def merges(graph: DataFrame) -> DataFrame:
    """``old_cif, new_cif`` where a component bridges several known numbers."""
    return graph.filter(F.col("node").startswith(_CIF) & (F.col("node") != F.col("component"))).select(
        F.substring("node", F.lit(3), F.char_length("node")).alias("old_cif"), _number(F.col("component")).alias("new_cif")
    )


def resolve(batch: DataFrame, edges: DataFrame, clusters: DataFrame, ident: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """Assignments of the batch members and the merges of known numbers.

    ``batch`` holds the ids to assign, ``edges(new_id, candidate_id)`` the matches, ``clusters`` the numbers known
    so far. Candidates that are not in the batch take part in the grouping but get no row.
    """
    links = edges.select(F.col("new_id").alias("src"), F.col("candidate_id").alias("dst"))
    ids = batch.select(F.col(ident).alias("node")).distinct()
    nodes = ids.union(links.select("src")).union(links.select("dst")).distinct()
    known = nodes.join(clusters.select(F.col(ident).alias("node"), "cif_number"), "node")
    graph = entity_graph(links, known)
    numbers = ids.join(entity_numbers(graph), "node", "left")
    cif = F.coalesce("cif_number", mint_cif(F.col("node")))
    assigned = numbers.select(F.col("node").alias(ident), cif.alias("cif_number"))
    return assigned.select(ident, cif_cluster_id(F.col("cif_number")).alias("cluster_id"), "cif_number"), merges(graph)


def grown_forest(forest: DataFrame, merged: DataFrame) -> DataFrame:
    """``number, root`` of the numbers that ``merged(old_cif, new_cif)`` hooks somewhere else.

    ``forest(number, root)`` holds the numbers that were merged before, each right below its root. A merged root goes
    below the new one, and so does everything that stood below it: the trees stay stars, and only trees that the merge
    touches change. Records are not looked at, however many hold a number.
    """
    hooked = merged.select(F.col("old_cif").alias("number"), F.col("new_cif").alias("root"))
    below = forest.join(merged, F.col("root") == F.col("old_cif")).select("number", F.col("new_cif").alias("root"))
    return hooked.union(below)


def current_numbers(links: DataFrame, forest: DataFrame) -> DataFrame:
    """``links`` (``record_id, cluster_id, cif_number, ...``) with the root of each number in its place.

    A number that a large share of the records holds does not gather them in one task.
    """
    held = links.groupBy("cif_number").agg(F.count(F.lit(1)).alias("records"))
    moved = forest.join(held, F.col("number") == F.col("cif_number")).select("cif_number", "records", "root")
    return _renumbered(attach(links, moved, "cif_number", "records", F.col("record_id")), "root").select(*links.columns)


def _renumbered(rows: DataFrame, to: str) -> DataFrame:
    moved = F.col(to).isNotNull()
    return rows.withColumns(
        {
            "cluster_id": F.when(moved, cif_cluster_id(F.col(to))).otherwise(F.col("cluster_id")),
            "cif_number": F.coalesce(to, "cif_number"),
        }
    )


def apply_merges(clusters: DataFrame, merged: DataFrame) -> DataFrame:
    """All rows of ``clusters`` after the merges."""
    return current_numbers(clusters, merged.select(F.col("old_cif").alias("number"), F.col("new_cif").alias("root")))
