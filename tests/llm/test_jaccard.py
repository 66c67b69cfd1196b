import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import jaccard
from kinfold.llm.jaccard import jaccard_components
from kinfold.llm.signatures import difference_bound, levels_of, shingle_set, signatures
from tests.llm.rows import awkward, frame, prose


def shingles(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def expected(rows, words, percent):
    sets = [shingles(r[1], words) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=repr)


def changed(text, count, rng):
    words = text.split()
    for i in rng.sample(range(len(words)), min(count, len(words))):
        words[i] = f"w{rng.randint(0, 10**6)}"
    return " ".join(words)


def many():
    """Near copies around the threshold, copies, a passage that many share, chains, short texts."""
    rng, rows = random.Random(11), []
    passage = prose(99, 60)
    for g in range(12):
        base = prose(g + 200, rng.choice([6, 20, 60, 150, 400]))
        for _ in range(6):
            n = len(base.split())
            rows.append(changed(base, rng.randint(0, max(1, n // 22)), rng))
    chain = prose(77, 200)
    for _ in range(12):
        chain = changed(chain, 3, rng)
        rows.append(chain)
    rows += [passage + " " + prose(i + 500, rng.randint(5, 60)) for i in range(30)]
    rows += [passage] * 5 + ["a b", "A  B", "a", "a b c d", "a b c d e"]
    return awkward() + [(i + 1000, t, *awkward()[0][2:]) for i, t in enumerate(rows)]


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_against_brute_force(spark, words, percent):
    found = jaccard_components(frame(spark, many()), words=words, percent=percent).drop("text_hash", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == expected(many(), words, percent)


def test_hot_signatures_and_stars_are_split(spark, monkeypatch):
    """With tiny limits, copies, frequent signatures and large stars take their own ways to the same result."""
    monkeypatch.setattr(jaccard, "STAR_ROWS", 2)
    monkeypatch.setattr(jaccard, "LARGE_CLASS", 2)
    monkeypatch.setattr(jaccard, "OFTEN", 2)
    found = jaccard_components(frame(spark, many()), words=4, percent=85, share=1e-9).drop("text_hash", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == expected(many(), 4, 85)


def test_one_document_of_each_component_is_kept(spark):
    """Also where linked texts have one id, or none."""
    rng, base = random.Random(3), prose(5, 120)
    ids = [4, 4, 4, None, None, 9, 2, 2]
    rows = [(i, changed(base, 1, rng), *awkward()[0][2:]) for i in ids] + [(None, prose(50 + i, 80), *awkward()[0][2:]) for i in range(3)] + [(7, " ", *awkward()[0][2:]), (7, None, *awkward()[0][2:])]
    found = jaccard_components(frame(spark, rows)).collect()
    assert [r.doc_id for r in found if r.kept and r.component_id == 2] == [2]
    assert sum(r.kept for r in found) == 1 + 3 + 2 and len(found) == len(rows)


def test_rest_pairs_follow_the_rows(spark):
    """Near copies that hardly ever link form no pairs to speak of, however many they are."""
    made = []
    for n in (300, 600, 1200):
        rng, base = random.Random(1), prose(8, 40)
        rows = spark.createDataFrame([(i, changed(base, 2, rng)) for i in range(n)], "doc_id long, text string").repartition(4)
        source = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        classes = jaccard.materialize(jaccard.shingle_classes(source, 4))
        keepers = jaccard.materialize(jaccard._keepers(classes))
        stars = jaccard.materialize(jaccard._stars(source, classes, 4, 85, 0.3))
        compared = jaccard.materialize(jaccard._compared(source, keepers, stars, 4, 85))
        links = compared.filter("linked").select(F.col("low").alias("src"), F.col("class").alias("dst"))
        made.append(jaccard._rest_pairs(compared, jaccard.connected_components(links), 85).count())
    assert made[2] <= max(300, 5 * made[0])


def test_sketches_never_differ_in_more_bits_than_the_sets():
    rng = np.random.default_rng(5)
    for n in (1, 5, 50, 700, 5000):
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        b = np.unique(np.r_[a[n // 3 :], rng.integers(0, 2**64, n // 4, np.uint64)])
        apart = len(np.setxor1d(a, b))
        assert sum(bin(int(x)).count("1") for x in (jaccard._sketch(a) ^ jaccard._sketch(b)).view(np.uint64)) <= apart
    assert len(jaccard._sketch(a)) == jaccard.SKETCH


def test_empty_table(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    assert jaccard_components(frame(spark, [r for r in awkward() if not (r[1] or "").strip()])).count() == 5


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_signature(percent):
    """Pairs exactly at the bound, of every small size and some large ones."""
    rng = np.random.default_rng(7)
    for size in [*range(1, 80), 150, 400, 1000]:
        for larger in {size, size * 100 // percent}:
            k = difference_bound(size, larger, percent)
            # larger - size elements are added; the rest of the difference is a replacement on both sides.
            swap = (k - (larger - size)) // 2
            if swap < 0:
                continue
            a = np.unique(rng.integers(0, 2**64, size, np.uint64))
            b = np.unique(np.r_[a[swap:], rng.integers(0, 2**64, swap + larger - size, np.uint64)])
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert set(signatures(a, percent).tolist()) & set(signatures(b, percent).tolist()), (size, larger)


def test_helpers():
    assert len(shingle_set("A  b\tC d", 4)) == 1 and (shingle_set("A  b\tC d", 4) == shingle_set("a B c\nD", 4)).all()
    assert len(shingle_set(None, 4)) == len(shingle_set(" \n", 4)) == 0
    assert [j for j, _, _ in levels_of(10, 85)] == [levels_of(10, 85)[0][0], levels_of(10, 85)[0][0] + 1]


def test_sets_cross_the_shuffle_with_their_differences_at_once(spark, monkeypatch):
    """A row per set and part of its star, not one per difference; the pairs are those that the rule names."""
    rng = np.random.default_rng(2)
    sets = []
    for name in range(160):
        apart = int(rng.integers(8, 40))
        delta = rng.permutation(60)[: int(rng.integers(0, min(apart, 25)))] - 30
        sketch = np.array([rng.integers(0, 8), *[0] * (jaccard.SKETCH - 2), -1 if rng.random() < 0.1 else 0], np.int64)
        sets.append((int(rng.integers(0, 4)), name * (-1) ** name, True, int(rng.integers(90, 130)), apart, delta.tolist(), sketch.tolist()))
    compared = spark.createDataFrame(sets, "low long, class long, linked boolean, n long, apart long, delta array<int>, sketch array<bigint>").repartition(3)
    root = {s[1]: int(rng.integers(0, 5)) for s in sets[:100]}
    roots = spark.createDataFrame(list(root.items()), "node long, component long")
    want, bound = set(), (100 - 85) / (100 + 85)
    for la, a, _, na, da, xa, sa in sets:
        for lb, b, _, nb, db, xb, sb in sets:
            if la != lb or a >= b or root.get(a, a) == root.get(b, b) or na * 100 < nb * 85 or nb * 100 < na * 85:
                continue
            if sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(sa, sb)) > bound * (na + nb):
                continue
            if any(x == y and da + db - 2 * min(da - i, db - j) <= bound * (na + nb) for i, x in enumerate(xa) for j, y in enumerate(xb)):
                want.add((a, b))
    assert len(want) > 100
    repartition = type(compared).repartition
    for most in (1_000, 3):
        sent = []
        with monkeypatch.context() as m:
            m.setattr(jaccard, "REST_ROWS", most, raising=False)
            m.setattr(jaccard, "PAIRS_HELD", most, raising=False)
            m.setattr(type(compared), "repartition", lambda self, *a: (sent.append(self.count()), repartition(self, *a))[1])
            got = [tuple(r) for r in jaccard._rest_pairs(compared, roots, 85).collect()]
        assert len(got) == len(want) and set(got) == want
        assert len(sent) == 1 and sent[0] <= len(sets) * (1 if most > 3 else 25)
