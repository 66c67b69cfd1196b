"""Linking records to entities: all at once, or batch by batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.identity import mint_cif
from kinfold.operators.blocking import BROADCAST_NEW, guard_max_pairs, keyed_new_vs_all, profile_pairs, with_block_keys
from kinfold.operators.entities import cif_cluster_id, current_numbers, entity_graph, entity_numbers, grown_forest, merges
from kinfold.operators.frequency import merged_counts, tf_columns, tf_of_counts, tf_tables, value_counts, with_tf
from kinfold.operators.model import LinkModel
from kinfold.operators.profiles import collapse, profile_key
from kinfold.operators.sampling import first_n
from kinfold.operators.scoring import matches
from kinfold.operators.skew import attach
from kinfold.session import forget, materialize
from kinfold.sources.batches import BatchTables
from kinfold.sources.tables import unprocessed_ids

_ID = "record_id"


def linked_profiles(records: DataFrame, model: LinkModel) -> DataFrame:
    """Distinct profiles of ``records`` with the term frequencies of their values."""
    profiles = materialize(collapse(records, model.settings))
    return with_tf(profiles, tf_tables(profiles, model.settings, F.col("copies")), _ID)


def match_edges(profiles: DataFrame, model: LinkModel, threshold: float, match_weight_threshold: float, max_pairs: int | None = None) -> DataFrame:
    """Matching profiles by their smallest ids, ``id_l, id_r, pairs, match_probability``.

    A profile whose copies match one another is an edge to itself.
    """
    carry = [f"tf_{c}" for c in tf_columns(model.settings)]
    pairs = profile_pairs(profiles, model.settings, carry, max_pairs=max_pairs)
    keep = [F.col(f"{_ID}_l").alias("id_l"), F.col(f"{_ID}_r").alias("id_r"), "pairs"]
    return matches(pairs, model, threshold, match_weight_threshold, keep)


def link_all(
    records: DataFrame,
    model: LinkModel,
    threshold: float = 0.9,
    match_weight_threshold: float = -4.0,
    max_pairs: int | None = None,
) -> DataFrame:
    """Entity numbers for all of ``records`` in one go: ``record_id, cluster_id, cif_number``.

    Works on distinct profiles, so copies cost nothing; records go through one lookup join at the end, and those
    that match nothing keep a number of their own without entering the graph.
    """
    profiles = materialize(linked_profiles(records, model))
    edges = match_edges(profiles, model, threshold, match_weight_threshold, max_pairs)
    no_numbers = records.sparkSession.createDataFrame([], "node string, cif_number string")
    graph = entity_graph(edges.select(F.col("id_l").alias("src"), F.col("id_r").alias("dst")), no_numbers)
    numbers = entity_numbers(graph)
    linked = profiles.select("profile", "copies", F.col(_ID).alias("node")).join(numbers, "node").drop("node")
    keyed = records.select(_ID, profile_key(model.settings).alias("profile"))
    cif = F.coalesce("cif_number", mint_cif(F.col(_ID)))
    numbered = attach(keyed, linked, "profile", "copies", F.col(_ID)).select(_ID, cif.alias("cif_number"))
    return numbered.select(_ID, cif_cluster_id(F.col("cif_number")).alias("cluster_id"), "cif_number")


@dataclass(frozen=True)
class BatchLinks:
    """What one batch changes, and its figures."""

    links: DataFrame
    merges: DataFrame
    records: int
    edges: int
    record_pairs: int
    matched_records: int
    written: tuple[DataFrame, ...] = ()


def holders(tables: BatchTables, profiles: DataFrame) -> DataFrame:
    """``profile, record_id``: the records that have one of these profiles now.

    Reads ids and profiles only. A record that was extracted again counts with its last profile.
    """
    wanted = profiles.select("profile").distinct()
    once = tables.rows("keys").join(wanted, "profile", "left_semi")
    return tables.read("keys", once).join(wanted, "profile", "left_semi").select("profile", "record_id")


def touched(tables: BatchTables, fresh_keys: DataFrame, small: bool) -> DataFrame:
    """``rule, block`` of the batch with each profile in them: ``profile``, its columns, smallest id and ``copies``.

    The index gives the profiles; of these alone, ids, numbers of copies and columns are looked up.
    """
    columns = tables.settings.columns
    blocks = fresh_keys.select("rule", "block").distinct()
    near = materialize(tables.blocks().join(F.broadcast(blocks) if small else blocks, ["rule", "block"], "left_semi").distinct())
    sizes = holders(tables, near).groupBy("profile").agg(F.min(_ID).alias(_ID), F.count(F.lit(1)).alias("copies"))
    # A profile can have been written by several batches, always with the same columns.
    values = tables.rows("profiles").join(near.select("profile").distinct(), "profile", "left_semi")
    values = values.groupBy("profile").agg(*[F.min(c).alias(c) for c in columns])
    found = materialize(near.join(sizes.join(values, "profile"), "profile"))
    forget(near)
    return found


def current_clusters(tables: BatchTables, among: DataFrame | None = None) -> DataFrame:
    """The entity number of every linked record, or of those that ``among`` lists, after all merges."""
    return current_numbers(tables.read("links", among), tables.read("forest"))


def link_batch(
    tables: BatchTables,
    batch: DataFrame,
    model: LinkModel,
    threshold: float = 0.9,
    match_weight_threshold: float = -4.0,
    max_pairs: int | None = None,
    broadcast_rows: int = BROADCAST_NEW,
) -> BatchLinks:
    """Match staged records against all staged records and settle their entity numbers.

    Nothing of the size of all data is hashed or shuffled: blocks come from the index, frequencies from the counts of
    the batches, known numbers from the links of records around the batch. ``max_pairs``, if given, bounds the record
    pairs that the blocks of the batch make, and is checked before any pair is formed.
    """
    settings = model.settings
    members = materialize(batch.select(_ID, *settings.columns, profile_key(settings).alias("profile")))
    rows = members.count()
    small = rows <= broadcast_rows
    fresh = members.groupBy("profile").agg(*[F.min(c).alias(c) for c in settings.columns], F.min(_ID).alias(_ID), F.count(F.lit(1)).alias("copies"))
    counts = merged_counts(tables.rows("counts"))
    frequencies = tf_of_counts(counts, settings, value_counts(members, settings) if small else None)
    fresh = materialize(with_tf(fresh, frequencies, _ID))
    fresh_keys = with_block_keys(fresh, settings.rules)
    near = touched(tables, fresh_keys, small)
    if max_pairs is not None:
        sides = [side.groupBy("rule", "block").agg(F.sum("copies").alias(n)) for side, n in ((fresh_keys, "a"), (near, "b"))]
        made = sides[0].join(sides[1], ["rule", "block"]).agg(F.sum(F.col("a").cast("decimal(38,0)") * (F.col("b") - 1))).first()[0]
        guard_max_pairs(int(made or 0), max_pairs)

    left = [_ID, *settings.columns, "profile", "copies", *[f"tf_{c}" for c in frequencies]]
    right = [_ID, *settings.columns, "profile", "copies"]
    paired = (F.col("l.profile") != F.col("r.profile")) | (F.col("r.copies") > 1)
    pairs = keyed_new_vs_all(fresh_keys, near, settings, left, right, paired, rows if small else None)
    # A copy in the batch pairs with every other copy, so the profile itself counts one less.
    others = F.col("copies_r") - F.when(F.col("profile_l") == F.col("profile_r"), 1).otherwise(0)
    pairs = pairs.withColumn("pairs", F.col("copies_l") * others)
    keep = ["profile_l", "profile_r", F.col(f"{_ID}_r").alias("node_r"), "copies_l", "pairs", "match_probability"]
    edges = materialize(matches(pairs, model, threshold, match_weight_threshold).select(*keep))

    per_profile = edges.groupBy("profile_l").agg(F.count(F.lit(1)).alias("edges"), F.sum("pairs").alias("pairs"), F.first("copies_l").alias("members"))
    figures = per_profile.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("edges", "pairs", "members")]).first()

    # Every profile of the batch with a match takes part under the smallest id among all its copies.
    matched = edges.select(F.col("profile_r").alias("profile"), F.col("node_r").alias("node")).distinct()
    own = near.select("profile", F.col(_ID).alias("node")).join(edges.select(F.col("profile_l").alias("profile")).distinct(), "profile", "left_semi")
    nodes = materialize(matched.union(own).distinct())
    linked = edges.join(nodes.select(F.col("profile").alias("profile_l"), F.col("node").alias("src")), "profile_l").select("src", F.col("node_r").alias("dst"))
    around = materialize(holders(tables, nodes).join(nodes, "profile"))
    known = current_clusters(tables, around.select(_ID).union(members.select(_ID)))
    known = materialize(known.select(_ID, "cif_number"))
    graph = materialize(entity_graph(linked, around.join(known, _ID).select("node", "cif_number").distinct()))

    numbers = nodes.join(entity_numbers(graph), "node").groupBy("profile").agg(F.min("cif_number").alias("linked_cif"))
    sizes = members.groupBy("profile").agg(F.count(F.lit(1)).alias("copies"))
    before = known.select(_ID, F.col("cif_number").alias("own_cif"))
    # A profile that a large share of the batch has does not gather it in one task.
    settled = attach(members.select(_ID, "profile"), numbers.join(sizes, "profile"), "profile", "copies", F.col(_ID)).join(before, _ID, "left")
    own_cif = F.when(F.col("own_cif") != "", F.col("own_cif"))
    cif = F.coalesce("linked_cif", own_cif, mint_cif(F.col(_ID)))
    assigned = settled.select(_ID, cif_cluster_id(cif).alias("cluster_id"), cif.alias("cif_number"))
    # A record that stands alone now may still hold a number that this batch merges: the forest says so.
    return BatchLinks(assigned, merges(graph), rows, figures.edges, figures.pairs, figures.members, (members, fresh, near, edges, nodes, around, known, graph))


@dataclass(frozen=True)
class BatchReport:
    batch_id: str
    records: int
    edges: int
    record_pairs: int
    matched_records: int
    merged_numbers: int


def commit_batch(tables: BatchTables, name: str, found: BatchLinks, at: Column | None = None) -> BatchReport:
    """Add the numbers of the batch's records, and hook the numbers it merged, as one batch."""
    at = F.current_timestamp() if at is None else at
    merged = materialize(found.merges)
    tables.write(name, links=found.links.withColumn("processed_at", at), forest=grown_forest(tables.read("forest"), merged))
    report = BatchReport(name, found.records, found.edges, found.record_pairs, found.matched_records, merged.count())
    forget(merged, *found.written)
    return report


def pending_rows(tables: BatchTables) -> DataFrame:
    """``record_id`` and compared columns of what is staged and not linked since, in id order; written once."""
    waiting = materialize(unprocessed_ids(tables.read("staging"), tables.read("links")))
    rows = tables.read("staging", waiting).select(_ID, *tables.settings.columns)
    written = materialize(rows.repartitionByRange(_ID).sortWithinPartitions(_ID))
    forget(waiting)
    return written


def run(
    tables: BatchTables,
    model: LinkModel,
    threshold: float = 0.9,
    batch_size: int = 50_000,
    limit: int | None = None,
    max_pairs_per_batch: int | None = None,
    match_weight_threshold: float = -4.0,
) -> list[BatchReport]:
    """Link everything that is staged and not linked yet, in batches of ``batch_size`` up to ``limit`` records.

    What is pending is written once, in id order; each batch takes the next ids of it. Records count as linked as of
    the moment their rows were read, so one that is extracted again while the run goes on is pending again.
    """
    read_at = F.lit(tables.spark.range(1).select(F.current_timestamp()).first()[0])
    pending = rest = pending_rows(tables)
    reports: list[BatchReport] = []
    done = 0
    while limit is None or done < limit:
        size = batch_size if limit is None else min(batch_size, limit - done)
        batch = materialize(first_n(rest, _ID, size))
        last = batch.agg(F.max(_ID)).first()[0]
        if last is None:
            forget(batch)
            break
        links = link_batch(tables, batch, model, threshold, match_weight_threshold, max_pairs_per_batch)
        reports.append(commit_batch(tables, f"run-{uuid.uuid4().hex}", links, read_at))
        forget(batch)
        done += links.records
        rest = pending.filter(F.col(_ID) > last)
    forget(pending)
    return reports


def entity_count(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.countDistinct("cif_number").alias("entities"))


def mapping(staging: DataFrame, clusters: DataFrame) -> DataFrame:
    """``record_id, cif_number`` of every staged record; null where it is not linked yet."""
    return staging.select(_ID).join(clusters.select(_ID, "cif_number"), _ID, "left")
