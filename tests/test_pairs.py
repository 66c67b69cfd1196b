import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking, comparison, frequency, profiles, sampling, scoring, skew
from kinfold.plans.catalog import FROZEN
from kinfold.settings import DEFAULT_SETTINGS, Comparison, LinkSettings

SMALL = LinkSettings("id", (("a",), ("b", "c")), (Comparison("a"), Comparison("b"), Comparison("c")))


def table(spark, n=400, seed=1, hot=None):
    rng = random.Random(seed)

    def value(choices):
        return None if rng.random() < 0.1 else str(rng.randrange(choices))

    rows = [(f"{i:04d}", hot if hot and i % 3 == 0 else value(60), value(9), value(9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, a string, b string, c string").repartition(4)


def first_rule(x, y):
    if x[1] is not None and x[1] == y[1]:
        return 1
    if None not in (x[2], x[3]) and x[2:] == y[2:]:
        return 2
    return 0


def expected(rows):
    found = {(x[0], y[0]): first_rule(x, y) for x, y in itertools.combinations(rows, 2)}
    return {k: v for k, v in found.items() if v}


def collected(pairs):
    rows = pairs.collect()
    found = {(r.id_l, r.id_r): r.rule for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("tile_rows", [4096, 7])
def test_self_pairs_with_a_hot_block(spark, tile_rows):
    rows, df = table(spark, hot="77")
    pairs = blocking.self_pairs(df, SMALL, tile_rows=tile_rows)
    assert collected(pairs) == expected(rows)
    by_id = {r[0]: r for r in rows}
    for r in pairs.filter("rule = 1").limit(50).collect():
        assert (r.a_l, r.b_l, r.c_l) == by_id[r.id_l][1:] and (r.a_r, r.b_r, r.c_r) == by_id[r.id_r][1:]


def test_tiles_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(blocking, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(blocking, "PAIRS_PER_TASK", 500)
    rows, df = table(spark, hot="77")
    assert collected(blocking.self_pairs(df, SMALL, tile_rows=7)) == expected(rows)


@pytest.mark.parametrize("known,tile_rows", [(True, 4096), (False, 4096), (False, 5)])
def test_new_vs_all(spark, known, tile_rows):
    rows, df = table(spark, n=300, hot="77")
    new = df.filter("id >= '0200'")
    pairs = blocking.new_vs_all(new, df, SMALL, new_rows=100 if known else None, tile_rows=tile_rows)
    both = {}
    for (x, y), rule in expected(rows).items():
        for a, b in ((x, y), (y, x)):
            if a >= "0200":
                both[a, b] = rule
    assert collected(pairs) == both


def test_estimate_and_guard(spark):
    rows, df = table(spark)
    found = {r.rule: r for r in blocking.estimate_pairs(df, SMALL.rules).collect()}
    ones = sum(1 for x, y in itertools.combinations(rows, 2) if x[1] is not None and x[1] == y[1])
    assert found[1].pairs == ones
    stats = blocking.block_stats(df, SMALL.rules)
    assert stats.pairs == sum(r.pairs for r in found.values()) and stats.largest == max(r.largest_block for r in found.values())
    with pytest.raises(blocking.PairLimitExceeded):
        blocking.self_pairs(df, SMALL, max_pairs=stats.pairs - 1)
    blocking.guard_max_pairs(5, 5)


def test_profile_pairs_stand_for_all_record_pairs(spark):
    rows, _ = table(spark, n=120)
    rows = [(f"{i}-{r[0]}", *r[1:]) for i in range(4) for r in rows]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string")
    collapsed = profiles.collapse(df, SMALL)
    assert collapsed.count() == len({r[1:] for r in rows})
    total = blocking.profile_pairs(collapsed, SMALL, []).agg(F.sum("pairs")).first()[0]
    assert total == len(expected(rows))


def test_profile_key_tells_values_apart(spark):
    rows = [("1", "a", "b", None), ("2", "ab", "", None), ("3", "a", "b", ""), ("4", None, "b", None), ("5", "a", "b", None)]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string")
    assert sorted(r.copies for r in profiles.collapse(df, SMALL).collect()) == [1, 1, 1, 2]


def test_attach_serves_hot_cold_and_missing_keys(spark):
    rows = [(str(i), "hot" if i % 2 else (None if i % 4 else f"k{i % 3}")) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, key string")
    lookup = spark.createDataFrame([("hot", 150, 1.0), ("k0", 25, 2.0), ("k1", 25, 3.0)], "key string, n long, value double")
    found = {r.id: r.value for r in skew.attach(df, lookup, "key", "n", F.col("id"), hot_rows=100).collect()}
    values = {"hot": 1.0, "k0": 2.0, "k1": 3.0}
    assert found == {i: values.get(k) for i, k in rows}


def test_tf_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert {r.value: (r.n, round(r.tf, 6)) for r in frequency.tf_table(df, "x").collect()} == {"a": (2, 0.666667), "b": (1, 0.333333)}


def test_bound_never_drops_a_match(spark, folder):
    from kinfold.plans import catalog

    people = catalog._with_tf(catalog._compared(spark, folder))
    carry = [*DEFAULT_SETTINGS.columns, *[f"tf_{c}" for c in frequency.tf_columns(DEFAULT_SETTINGS)]]
    pairs = blocking.self_pairs(people, DEFAULT_SETTINGS, carry)
    keep = ["record_id_l", "record_id_r"]
    whole = scoring.score_pairs(pairs, FROZEN, keep=keep).collect()
    for least in (-20.0, 0.0, 5.0, 20.0):
        found = {tuple(r)[:2] for r in scoring.score_pairs(pairs, FROZEN, least, keep).collect()}
        assert found == {tuple(r)[:2] for r in whole if r.match_weight >= least}


def test_null_level_is_neutral(spark):
    row = spark.createDataFrame([("x", None)], "a_l string, a_r string").select(comparison.exact_level(Comparison("a")).alias("g")).first()
    assert row.g == -1 and FROZEN.weight("gender", -1) == 0.0


def test_samples(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    sample = sampling.sample_n(df, "id", 300, seed=4)
    ids = {r.id for r in sample.collect()}
    assert len(ids) == 300 and ids == {r.id for r in sampling.sample_n(df.repartition(3), "id", 300, seed=4).collect()}
    first = sorted(r.id for r in sampling.first_n(df, "id", 700).collect())
    assert first == sorted(str(i) for i in range(20000))[:700]


def test_a_large_limit_is_cut_where_the_rows_lie(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_ALONE", 50)
    df = spark.range(6000, numPartitions=5).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("v"))
    half = sampling.first_n(df, "id", 3000)
    assert sorted(r.id for r in half.collect()) == sorted(str(i) for i in range(6000))[:3000]
    plan = half._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan and "Sort" not in plan


def test_limits_with_nulls_ties_and_one_id(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_ALONE", 5)
    ids = [None] * 4 + ["b"] * 300 + [f"a{i:02d}" for i in range(40)] + ["c", "d"]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int").repartition(3)
    want = sorted(ids, key=lambda i: (i is not None, i or ""))
    for n in (0, 3, 4, 5, 44, 45, 200, 344, 345, 346, 900):
        got = [r.id for r in sampling.first_n(df, "id", n).collect()]
        assert sorted(got, key=lambda i: (i is not None, i or "")) == want[:n], n


def test_pairs_of_a_large_table_move_no_more_rows_than_pairs(spark):
    df = spark.range(40_000).select(F.col("id").cast("string").alias("id"))
    assert sampling.pair_slots(40_000, 1000) == (20_000, 500) and sampling.pair_slots(900, 1000) == (405, 405)
    pairs = sampling.random_pairs(df, "id", [], 1000)
    rows = [tuple(r) for r in pairs.collect()]
    assert 700 < len(rows) < 1300 and len(set(rows)) == len(rows) and all(a < b for a, b in rows)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 1


def test_random_pairs_are_all_pairs_when_few(spark):
    df = spark.range(90).select(F.col("id").cast("string").alias("id"))
    pairs = [tuple(r) for r in sampling.random_pairs(df, "id", [], 10_000).collect()]
    assert sorted(pairs) == sorted(itertools.combinations(sorted(str(i) for i in range(90)), 2))
    some = sampling.random_pairs(df, "id", [], 800).count()
    assert 400 < some < 1600
