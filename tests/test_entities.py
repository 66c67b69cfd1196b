import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import entities
from kinfold.operators.components import connected_components


def label(edges):
    """Smallest node of each component, by brute force."""
    least = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def found(spark, edges):
    df = spark.createDataFrame(edges, "src string, dst string")
    rows = connected_components(df).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("seed,nodes,links", [(1, 60, 40), (2, 200, 160), (3, 40, 200)])
def test_components_of_random_graphs(spark, seed, nodes, links):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(nodes):03d}", f"n{rng.randrange(nodes):03d}") for _ in range(links)]
    assert found(spark, edges) == label(edges)
    rng.shuffle(edges)
    assert found(spark, [(b, a) for a, b in edges]) == label(edges)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"{i:03d}", f"{i + 1:03d}") for i in range(120)]
    star = [("hub", f"s{i:03d}") for i in range(300)]
    assert found(spark, chain + star) == label(chain + star)


def test_components_of_nothing(spark):
    assert found(spark, []) == {}
    assert found(spark, [("a", "a")]) == {"a": "a"}


def test_order_graph_against_brute_force(spark, folder):
    from kinfold.plans.catalog import order_components

    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey").collect()
    least = label([(f"o{r.l_orderkey}", f"p{r.l_partkey}") for r in lines])
    sizes = {}
    for root in least.values():
        sizes[root] = sizes.get(root, 0) + 1
    assert {r.component: r.nodes for r in order_components(spark, folder).collect()} == sizes


# name: known numbers, edges, batch, expected numbers of the batch, merges
CASES = {
    "singleton": ({}, [], "a", {"a": "CIF-a"}, set()),
    "new pair": ({}, [("a", "b"), ("b", "a")], "ab", {"a": "CIF-a", "b": "CIF-a"}, set()),
    "join known": ({"x": "CIF-x"}, [("b", "x")], "b", {"b": "CIF-x"}, set()),
    "smaller unprocessed": ({}, [("b", "a")], "b", {"b": "CIF-a"}, set()),
    "bridge": ({"x": "CIF-x", "y": "CIF-y"}, [("b", "x"), ("b", "y")], "b", {"b": "CIF-x"}, {("CIF-y", "CIF-x")}),
    "chained bridge": (
        {"x": "CIF-x", "y1": "CIF-y", "y2": "CIF-y", "z": "CIF-z"},
        [("b", "x"), ("b", "y1"), ("c", "y2"), ("c", "z")],
        "bc",
        {"b": "CIF-x", "c": "CIF-x"},
        {("CIF-y", "CIF-x"), ("CIF-z", "CIF-x")},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_resolve(spark, name):
    known, edges, batch, numbers, merged = CASES[name]
    clusters = spark.createDataFrame([(k, 0, v) for k, v in known.items()], "record_id string, cluster_id long, cif_number string")
    assigned, merges = entities.resolve(
        spark.createDataFrame([(b,) for b in batch], "record_id string"), spark.createDataFrame(edges, "new_id string, candidate_id string"), clusters
    )
    assert {r.record_id: r.cif_number for r in assigned.collect()} == numbers
    assert {tuple(r) for r in merges.collect()} == merged
    after = {r.record_id: r.cif_number for r in entities.apply_merges(clusters, merges).collect()}
    replaced = dict(merged)
    assert after == {k: replaced.get(v, v) for k, v in known.items()}


def test_forest_stays_flat_and_a_hot_number_is_spread(spark, monkeypatch):
    """Three rounds of merges: every number ever given leads straight to its root, however many records hold it."""
    from kinfold.operators import skew

    monkeypatch.setattr(skew.attach, "__defaults__", (50,))
    links = spark.createDataFrame([(f"r{i:04d}", 1, "c" if i < 900 else f"x{i % 7}") for i in range(1000)] + [("null", 2, None), ("empty", 3, "")], "record_id string, cluster_id long, cif_number string")
    forest = spark.createDataFrame([], "number string, root string")
    for merged in ([("c", "b"), ("x1", "x0")], [("b", "a"), ("x0", "a")], [("x3", "x2")]):
        delta = entities.grown_forest(forest, spark.createDataFrame(merged, "old_cif string, new_cif string"))
        forest = spark.createDataFrame((forest.join(delta, "number", "left_anti").union(delta)).collect(), "number string, root string")
    assert {tuple(r) for r in forest.collect()} == {("c", "a"), ("b", "a"), ("x0", "a"), ("x1", "a"), ("x3", "x2")}
    now = {r.record_id: r.cif_number for r in entities.current_numbers(links, forest).collect()}
    roots = {"c": "a", "x0": "a", "x1": "a", "x3": "x2"}
    assert now == {r.record_id: roots.get(r.cif_number, r.cif_number) for r in links.collect()}


def test_equal_numbers_have_equal_cluster_ids(spark):
    rows = spark.createDataFrame([("CIF-0012",), ("CIF-0012",), ("CIF-x",)], "cif string")
    ids = [r[0] for r in rows.select(entities.cif_cluster_id(F.col("cif"))).collect()]
    assert ids[0] == ids[1] == 12 and ids[2] != 12


def test_edges_are_read_once(spark):
    """Edges may be costly, as scored pairs are; loops and links come from one reading of them."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    edges = [("a", "b"), ("b", "c"), ("d", "d"), ("e", "f"), ("b", "a"), (None, "g"), ("a", "a")]
    df = spark.createDataFrame(edges, "src string, dst string").mapInArrow(seen, "src string, dst string")
    rows = sorted(map(tuple, connected_components(df).collect()))
    assert rows == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e"), ("f", "e")]
    assert read.value == len(edges)
