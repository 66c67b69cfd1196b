from kinfold.llm import decontaminate as d
from kinfold.llm.decontaminate import find_leaks
from tests.llm.rows import awkward, frame, prose

ITEM = "Tom buys 12 apples and 3 pears at the market near Paris. How many fruits does Tom carry after he walked 5 km?"
BENCH = "item_id long, text string, hash int"


def leaks(spark, texts, items, **kw):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, hash int, item_id string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], BENCH)
    return sorted((r["doc_id"], r["item_id"], r["kind"]) for r in find_leaks(docs, bench, **kw).collect())


def test_exact_changed_and_inconsistent(spark):
    around = prose(1, 50)
    changed = ITEM.replace("12", "40").replace("3 ", "9 ").replace("Paris", "London").replace("does Tom", "does Eve").replace("km", "miles")
    # Tom stands for Eve and for Bob: the slots contradict each other.
    item = "Then Tom gave 7 coins to the old man who met Tom near the bridge and Tom left the village"
    torn = item.replace("Then Tom", "Then Eve").replace("met Tom", "met Bob")
    even = item.replace("Tom", "Eve").replace("7", "nine")
    texts = [f"{around} {ITEM} {around}", f"{around}\n{changed}", around, f"{around}. {torn}", f"{around}. {even}", ITEM.lower().replace("tom", "Tom").replace("paris", "Paris"), item.replace(" ", "\n").replace("coins", "coins,")]
    found = leaks(spark, texts, [ITEM, item])
    assert found == [(0, 0, "exact"), (1, 0, "changed"), (4, 1, "changed"), (5, 0, "exact"), (6, 1, "exact")]


def test_partial_passages(spark):
    item = " ".join(f"word{chr(97 + i)}" for i in range(26))
    words = item.split()
    texts = [" ".join(words[:13]), " ".join(words[:12]), " ".join(words[5:20]), " ".join(words[:7] + ["x"] + words[8:15])]
    assert leaks(spark, texts, [item]) == [(0, 0, "exact"), (2, 0, "exact")]
    # A short item has to occur in full, a very short one is none.
    assert leaks(spark, ["say one small step for a man today", "small step for a man"], ["One small step for a man", "a b"]) == [(0, 0, "exact")]


def test_a_row_of_numbers_is_found_verbatim_only(spark):
    """Placeholders alone are no evidence, but equal values are."""
    table, other = (" ".join(str(i) for i in range(n, n + 40)) for n in (0, 500))
    assert [(r[0], r[1], r[-1]) for r in leaks(spark, [table, table, other], [table])] == [(0, 0, "exact"), (1, 0, "exact")]


def test_awkward_rows(spark):
    long_ = awkward()[15][1]
    bench = spark.createDataFrame([(1, " ".join(long_.split()[100:140]), 0), (1, " ".join(long_.split()[100:140]), 0), (None, None, None), (3, "", 1), (None, awkward()[6][1], 1)], BENCH)
    found = find_leaks(frame(spark), bench).select("doc_id", "item_id").distinct().collect()
    # A null id is an id; repeated rows count once.
    assert sorted(map(tuple, found), key=repr) == [(12, 1), (14, 1), (None, None)]
    plan = find_leaks(frame(spark), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_large_benchmark_gives_the_same(spark, monkeypatch):
    texts = [ITEM, prose(3, 80)]
    want = leaks(spark, texts, [ITEM])
    monkeypatch.setattr(d, "MOST_BROADCAST", 0)
    assert leaks(spark, texts, [ITEM]) == want


def test_empty_tables(spark):
    bench = spark.createDataFrame([], BENCH)
    assert find_leaks(frame(spark), bench).count() == 0
    assert find_leaks(frame(spark, []), spark.createDataFrame([(1, ITEM, 1)], BENCH)).count() == 0


def test_only_texts_with_a_phrase_of_the_benchmark_get_windows(spark, monkeypatch):
    items = [ITEM, "If John has 5 apples, Mary has 3 and Bob has 2, then 7 or 8 go to Ann", "7 14 3 99 12 8 41 6 5 22", "Name three primes", "Berlin", "one small step", "\x01A. B.C 1,000 İstanbul ΑΣ'Α straße in the U.S. of 2.5 km", "see New York and Rome and 12 and 13 m of it"]
    other = [i.replace("12", "40").replace("Tom", "Eve").replace("Paris", "Oslo").replace("Rome", "Bath") for i in items]
    texts = [f"{before}{i}{after}" for i in items + other for before, after in (("", ""), ("- ", "\n"), (f"{prose(2, 20)}. ", " then"))]
    texts += [i.lower() for i in items] + [i.upper() for i in items] + [None, "", " . ", prose(1, 60), prose(4, 60)]
    made, plain = [], d.windows

    def windows(frame, keys, *a, **kw):
        made.append(frame.count()) if "doc_id" in keys else None
        return plain(frame, keys, *a, **kw)

    monkeypatch.setattr(d, "windows", windows)
    found = leaks(spark, texts, items)
    monkeypatch.setattr(d, "MOST_PHRASES", 0)
    assert leaks(spark, texts, items) == found
    held = {doc for doc, _, _ in found}
    assert len(held) > len(texts) / 2
    assert len(held) <= made[0] <= len(texts) - 5 and made[1] == len(texts)
