"""Phrases beside a literal count, and their SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from kinfold.llm import collocations as c
from kinfold.llm.common import open_store
from kinfold.llm.oracles import ORACLES
from kinfold.llm.tries import build
from tests.llm.rows import awkward, frame

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=10, keep=2000, share=50):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWERED)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count:
                continue
            if any(100 * n >= share * a for q, n in f.items() if n >= min_count and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def check(spark, df, rows, **options):
    found = sorted(tuple(r) for r in c.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert found == brute(rows, options.get("min_count", 10), options.get("keep", 2000), options.get("share", 50))
    return found


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "city", "é", "É", "王", "a-b", "\x00", "\x1f", " ", "x"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "? ", "   "]
    return [("".join(rng.choice(words) + rng.choice(marks[:3] * 3 + marks) for _ in range(rng.randint(0, 80))), rng.choice(["en", "de", None, "und", ""])) for _ in range(docs)]


def test_beside_a_literal_count(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert check(spark, df, rows, min_count=3)
    check(spark, df, rows, min_count=2, keep=7, share=90)


def test_several_tries_and_passes(spark, monkeypatch):
    rows = corpus(2, 200)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(c, "WORDS_HELD", 5)
    monkeypatch.setattr(c, "KEYS_AT_ONCE", 50)
    assert check(spark, df, rows, min_count=4, phrases=20, most_bytes=30_000)


def test_full_filters_lose_nothing(spark, monkeypatch):
    rows = corpus(3, 100)
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(c.Filter, "passes", lambda self, hashes: np.ones(len(hashes), bool))
    assert check(spark, df, rows, min_count=5)


def test_awkward_rows(spark):
    rows = awkward()
    assert check(spark, frame(spark, rows), [(r[1], r[2]) for r in rows], min_count=3)
    assert c.collocations(frame(spark, [])).count() == 0
    assert c.collocations(frame(spark, [r for r in rows if not (r[1] or "").strip()])).count() == 0


def test_repeats_and_a_long_text(spark):
    rows = [("to be or not to be " * 20_000, "en"), ("to be or not", None)] * 10
    check(spark, spark.createDataFrame(rows, "text string, lang string"), rows)


def test_large_counts_stay_exact(spark):
    found = pa.table({"k1": [1], "k2": [2], "k3": [0], "n": [10**13 - 1]})
    single = pa.table({"key": [1, 2], "group": ["en", "en"], "n": [10**13 + 7, 10**13 + 9]})
    got = c._scored(spark.createDataFrame(found.to_pandas()), spark.createDataFrame(single.to_pandas())).first()
    assert got.score == 1_000_000 * (10**13 - 1) ** 2 // ((10**13 + 7) * (10**13 + 9))


def test_sql_agrees(spark):
    rows = corpus(4, 150)
    con = duckdb.connect()
    documents = pa.table({"text": [r[0] for r in rows], "lang": [r[1] for r in rows]})
    con.register("documents", documents)
    want = sorted(map(tuple, con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ORACLES['op11_collocations']})").fetchall()))
    assert want == brute(rows) != []


def test_trie_counts():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 400, 30_000)
    keys[rng.random(30_000) < 0.1] = 0
    grams = Counter()
    for k in (2, 3):
        grams.update(tuple(map(int, keys[i : i + k])) + (0,) * (3 - k) for i in range(len(keys) - k + 1) if (keys[i : i + k] != 0).all())
    phrases = np.array([p for p in grams if sum(p) % 3], np.int64)
    trie = build(phrases)
    assert trie.width == 2 and trie.count(keys, np.arange(len(keys))).tolist() == [grams[tuple(p)] for p in phrases.tolist()]


def test_rows_of_bucket_counts_do_not_follow_the_buckets(spark, monkeypatch):
    keys = np.random.default_rng(5).integers(1, 1 << 62, 60)
    keys = np.concatenate([np.tile(keys, 3), [0], np.random.default_rng(6).integers(1, 1 << 62, 4_000)])
    corpus = spark.createDataFrame([(bytearray(keys.tobytes()),)], "keys binary").coalesce(1)
    written, plain = [], c.materialize

    def seen(df):
        written.append(df.count())
        return plain(df)

    monkeypatch.setattr(c, "materialize", seen)
    monkeypatch.setattr(c, "SPANS", 4, raising=False)
    sent, repartition = [], type(corpus).repartition
    monkeypatch.setattr(type(corpus), "repartition", lambda self, *a: (sent.append(self.count()), repartition(self, *a))[1])
    for bits in (18, 23):
        often = c._frequent(corpus, [], bits, 3)
        starts = c._candidates(keys, [], 2)
        bucket, n = np.unique(c._bucket(c._hash(keys[starts], keys[starts + 1]), bits), return_counts=True)
        want = np.zeros(1 << bits, bool)
        want[bucket[n >= 3]] = True
        assert (np.unpackbits(often.flags.value, bitorder="little") == want).all() and want.any()
    assert sent == [4, 4] and written == [8, 256]


def test_rows_of_keys_are_short_and_end_with_a_piece(spark):
    rng = random.Random(8)
    text = "".join(rng.choice(["so", "it", "is", "now"]) + rng.choice([" "] * 9 + [". "]) for _ in range(150_000))
    docs = spark.createDataFrame([("en", text), ("en", "so it is"), ("de", "")], "group string, text string").coalesce(1)
    often = c.Filter(spark.createDataFrame([(i, bytearray(b"\xff" * (c.BLOCK // 8))) for i in range(8)], "block int, bitmap binary"), 18)
    rows = [np.frombuffer(r.keys, np.int64) for r in c._encoded(docs, often).collect()]
    assert len(rows) > 5 and max(map(len, rows)) < c.KEYS_AT_ONCE + 1_000
    assert all(r[-1] == 0 for r in rows)
    words = [w for w in c.words_of([text, "so it is"])]
    ends = [a == b == c._END for a, b in zip(words, words[1:])] + [False]
    assert sum(map(len, rows)) == len(words) - sum(ends)


def test_pages_of_long_rows_are_small(spark):
    def seen():
        return spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")

    before = seen()
    with c.arrow_rows(spark, 16):
        assert seen() == "16"
    assert seen() == before
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(bytearray(rng.bytes(1 << 17)),) for _ in range(200)], "keys binary").coalesce(1)
    files = c.materialize(rows, **c.LONG_ROWS).inputFiles()
    store, at = open_store(files[0])
    found = pq.ParquetFile(at, filesystem=store).metadata
    assert found.num_row_groups > 1 and max(found.row_group(i).total_byte_size for i in range(found.num_row_groups)) < 20 << 20


def test_listed_phrases_are_sent_without_what_they_share(spark, monkeypatch):
    """Tasks that hold the same phrases send few bytes for each; all of these come back, each once."""
    rng = np.random.default_rng(9)
    keys = rng.integers(1, 1 << 62, 300)
    keys[::3] *= -1
    rows = [np.r_[rng.choice(keys, 3_000) * (rng.random(3_000) > 0.05), 0] for _ in range(12)]
    want = {tuple(r[i : i + k].tolist()) + (0,) * (3 - k) for r in rows for k in (2, 3) for i in range(len(r) - k + 1) if (r[i : i + k] != 0).all()}
    words = spark.createDataFrame([(int(k), 20 + i) for i, k in enumerate(keys)], "key long, n long")
    all_pass = [c.Filter(spark.createDataFrame([(i, bytearray(b"\xff" * (c.BLOCK // 8))) for i in range(8)], "block int, bitmap binary"), 18)] * 2
    for most, held in ((1 << 20, 1 << 20), (100, 500), (0, 1 << 20)):
        monkeypatch.setattr(c, "LISTED_HELD", held)
        numbers = c.Numbers(words, 10, most)
        assert len(numbers.sent.value[0]) == min(most, 300) + 1
        corpus = spark.createDataFrame([tuple(map(bytearray, numbers.pack(r))) for r in rows], "words binary, numbers binary").repartition(4)
        sent, repartition = [], type(corpus).repartition
        with monkeypatch.context() as m:
            m.setattr(type(corpus), "repartition", lambda self, *a: (sent.append(self), repartition(self, *a))[1])
            got = c._listed(corpus, all_pass, 3, numbers, 8)
        found = [(r.k1, r.k2, r.k3) for r in got.collect()]
        assert len(found) == len(want) and set(found) == want
        assert all(r.place == c._place(np.array([r.k1]), np.array([r.k2]))[0] for r in got.limit(50).collect())
        if held > 500:
            bytes_ = sent[0].selectExpr("sum(length(marks) + length(words) + length(numbers))").first()[0]
            assert bytes_ < len(rows) * 6_000 * (10 if most else 30)


def test_rows_of_numbers_give_the_keys_back(spark):
    text = " ".join(f"w{i % 700}." if i % 9 == 0 else f"w{i % 700}" for i in range(100_000))
    docs = spark.createDataFrame([("en", text), ("de", "w1 w2. w3"), ("en", None)], "group string, text string").coalesce(1)
    words = c.word_counts(docs)
    often = c.Filter(spark.createDataFrame([(i, bytearray(b"\xff" * (c.BLOCK // 8))) for i in range(8)], "block int, bitmap binary"), 18)
    plain = np.concatenate([np.frombuffer(r.keys, np.int64) for r in c._encoded(docs, often).collect()])
    for most in (1 << 20, 200, 0):
        numbers = c.Numbers(words, 10, most)
        packed = c._encoded(docs, often, numbers).toArrow()
        back = np.concatenate(list(map(numbers.unpack, packed.column(0), packed.column(1))))
        assert (back == plain).all() and sum(packed.column(i).nbytes for i in range(2)) < 6 * len(plain)


def test_more_tries_take_no_more_passes(spark, monkeypatch):
    """The corpus is gone over once for all phrases, however many tries count them and however little is held."""
    rows = corpus(10, 200)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    written, plain, built, build_ = [], c.materialize, spark.sparkContext.accumulator(0), c.build

    def counted(phrases):
        built.add(1)
        return build_(phrases)

    monkeypatch.setattr(c, "materialize", lambda df, **options: (written.append(df.columns), plain(df, **options))[1])
    monkeypatch.setattr(c, "build", counted)
    found = []
    for limits in ({}, {"phrases": 5, "most_bytes": 1}):
        before, had = len(written), built.value
        found.append((check(spark, df, rows, min_count=3, **limits), len(written) - before, built.value - had))
    assert found[0][:2] == found[1][:2] and found[1][2] > 10 * found[0][2] > 0


def test_counts_come_back_and_phrases_count_where_longer_ones_go_on(spark):
    rng = np.random.default_rng(4)
    for most in (1, 255, 256, 70_000, 1 << 40):
        n = np.r_[rng.integers(1, most, 50, endpoint=True), most]
        assert (c._unplaned(np.frombuffer(c._planes(n), np.uint8), len(n)) == n).all()
    keys = rng.integers(1, 40, 20_000) * (rng.random(20_000) > 0.1)
    grams = Counter()
    for k in (2, 3):
        grams.update(tuple(keys[i : i + k].tolist()) + (0,) * (3 - k) for i in range(len(keys) - k + 1) if (keys[i : i + k] != 0).all())
    numbers = c.Numbers(spark.createDataFrame([(k, 50) for k in range(1, 30)], "key long, n long"), 10, 100)
    packed = [tuple(map(bytearray, numbers.pack(part))) for part in np.split(np.r_[keys, 0], [i + 1 for i in np.flatnonzero(keys == 0)[::200].tolist()])]
    all_pass = [c.Filter(spark.createDataFrame([(i, bytearray(b"\xff" * (c.BLOCK // 8))) for i in range(8)], "block int, bitmap binary"), 18)] * 2
    for phrases, most_bytes in ((1 << 16, 1 << 20), (30, 1)):
        listed = c._listed(spark.createDataFrame(packed, "words binary, numbers binary").repartition(3), all_pass, 3, numbers, 4, phrases, most_bytes)
        assert {(r.k1, r.k2, r.k3): r.n for r in listed.collect()} == grams
