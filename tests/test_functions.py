import datetime as dt
import random
import unicodedata

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.functions import identity, text
from kinfold.functions.similarity import jaro_winkler, jaro_winkler_arrow, within_one_edit
from kinfold.plans import oracles

# In and out, worked by hand.
CLEANED = [
    (None, None),
    ("", None),
    ("   ", ""),
    ("H. ", ""),
    ("Dr. H. Budi Santoso, S.Kom", "budi santoso"),
    ("Ahmad bin Ali", "ahmad ali"),
    ("dr budi", "dr budi"),
    ("Jl. Merdeka No. 5, Kec. Baru", "jalan merdeka nomor 5 kecamatan baru"),
    ("José Ñuñez", "jose nunez"),
    ("José Straße Ærø", "jose strasse aero"),
    ("s.dr.kom", ""),
    ("s.prof.kom x", "s kom x"),
    ("Binti binti Siti", "siti"),
]


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i long, t string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("t"))).collect()]


def test_clean_text_literals(spark):
    assert column(spark, [i for i, _ in CLEANED], text.clean_text) == [o for _, o in CLEANED]


def test_clean_text_is_what_sql_gives(spark):
    """Against the chain of single replacements in DuckDB, on texts full of titles and abbreviations."""
    rng = random.Random(5)
    parts = ["dr.", "drs.", "ir.", "h.", "hj.", "alm.", "bin", "binti", "s.kom", "s.e", "m.kom", "prof.", "pdt.", "s.", "kom", "m.", "e", "jl", "jln"]
    parts += ["ds", "kec", "kel", "kab", "prop", "no.", "no", " ", "  ", ".", ",", "-", "_", "a", "x9", "\t"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(4000)]
    frame = pd.DataFrame({"i": range(len(values)), "t": values})
    expected = duckdb.sql(f"SELECT {oracles.clean('t')} AS c FROM frame ORDER BY i").df()["c"].tolist()
    assert len(frame) == len(expected) and column(spark, values, text.clean_text) == expected


# In and out, worked by hand from the letter tables.
SPELLED = [
    ("Иванов Пётр", "Ivanov Petr"),
    ("Щукин-Юрьев", "Shchukin-Iurev"),
    ("Γιώργος", "Giorgos"),
    ("محمد", "mhmd"),
    ("שלום", "shlvm"),
    ("김민준", "gimminjun"),
    ("さくら サクラ", "sakura sakura"),
    ("Straße 5, é", "Strasse 5, e"),
    ("王伟", " u738b  u4f1f "),
]


def test_no_letter_vanishes(spark):
    assert column(spark, [i for i, _ in SPELLED], text.transliterate) == [o for _, o in SPELLED]
    cleaned = column(spark, ["Иванов Пётр", "محمد", "王伟", "Γιώργος", "ไทย", "😀"], text.clean_text)
    assert cleaned[:4] == ["ivanov petr", "mhmd", "u738b u4f1f", "giorgos"] and cleaned[4] and cleaned[5] == ""


def test_transliteration_follows_decomposition(spark):
    letters = [chr(c) for c in range(0xC0, 0x250)]
    found = column(spark, letters, text.transliterate)
    for letter, plain in zip(letters, found):
        expected = "".join(c for c in unicodedata.normalize("NFKD", letter) if ord(c) < 128)
        if letter not in text.UNDECOMPOSED and expected:
            assert plain == expected, letter


def words(rng, letters, longest):
    return "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))


@pytest.mark.parametrize("letters,longest", [("abcd e", 6), ("abcdefgh ", 25), ("abc", 140)])
def test_jaro_winkler_agrees_with_duckdb(letters, longest):
    rng = random.Random(longest)
    left = [words(rng, letters, longest) for _ in range(3000)]
    right = []
    for w in left:
        changed = list(w)
        for _ in range(rng.randint(0, 3)):
            if len(changed) > 1:
                i = rng.randrange(len(changed) - 1)
                changed[i], changed[i + 1] = changed[i + 1], changed[i]
                if rng.random() < 0.4:
                    del changed[i]
        right.append("".join(changed) if rng.random() < 0.7 else words(rng, letters, longest))
    frame = pd.DataFrame({"l": left, "r": right})
    expected = duckdb.sql("SELECT jaro_winkler_similarity(l, r) AS s FROM frame").df()["s"].to_numpy()
    assert np.abs(jaro_winkler_arrow(pa.array(left), pa.array(right)) - expected).max() < 1e-12


def test_jaro_winkler_nulls_unicode_and_slices(spark):
    left, right = pa.array(["x", None, "dwayne", "ñandú", ""]), pa.array(["x", "a", "duane", "ñandu", ""])
    found = jaro_winkler_arrow(left, right)
    assert found[0] == 1 and np.isnan(found[1]) and found[4] == 0
    assert found[2] == pytest.approx(0.84) and found[3] == pytest.approx(0.92)
    assert jaro_winkler_arrow(left.slice(2, 2), right.slice(2, 2)).tolist() == found[2:4].tolist()
    frame = spark.createDataFrame([("martha", "marhta"), (None, "x")], "l string, r string")
    values = [r[0] for r in frame.select(jaro_winkler(F.col("l"), F.col("r"))).collect()]
    assert values[0] == pytest.approx(0.9611, abs=1e-4) and values[1] is None


def test_one_edit_agrees_with_duckdb(spark):
    rng = random.Random(2)
    start = dt.date(1960, 1, 1)
    pairs = []
    for _ in range(3000):
        day = start + dt.timedelta(rng.randrange(20000))
        digits = list(day.isoformat())
        i = rng.choice([0, 1, 2, 3, 5, 6, 8, 9])
        if rng.random() < 0.5:
            digits[i] = str(rng.randrange(10))
        j = rng.choice([0, 1, 2, 5, 8])
        if rng.random() < 0.5:
            digits[j], digits[j + 1] = digits[j + 1], digits[j]
        pairs.append((day.isoformat(), "".join(digits)))
    words = ["".join(rng.choice("abc") for _ in range(30)) for _ in range(300)]
    for w in words:
        i = rng.randrange(29)
        pairs.append((w, w[:i] + w[i + 1] + w[i] + w[i + 2 :]))
        pairs.append((w, w[:i] + "x" + w[i:]))
        pairs.append((w, w[:i] + "xy" + w[i + 2 :]))
    frame = pd.DataFrame(pairs, columns=["l", "r"])
    expected = duckdb.sql("SELECT damerau_levenshtein(l, r) <= 1 AS s FROM frame").df()["s"].tolist()
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, l string, r string").orderBy("i")
    assert [r[0] for r in rows.select(within_one_edit(F.col("l"), F.col("r"))).collect()] == expected


def test_stable_cluster_id(spark):
    values = ["001201001010001", "CIF-a", "99999999999999999999", "9223372036854775807"]
    assert column(spark, values, identity.stable_cluster_id) == [1201001010001, 28700953319360246, 384881222108542374, 9223372036854775807]


def test_national_id_and_record_key(spark):
    day, gender = F.lit("1999-12-31").cast("date"), F.lit("P")
    number = identity.compose_national_id(F.lit(11), F.lit(2), F.lit(33), day, gender, F.lit(7))
    row = spark.range(1).select(
        number.alias("n"),
        identity.national_id_agrees(number, day, gender).alias("ok"),
        identity.national_id_agrees(number, day, F.lit("L")).alias("other"),
        identity.national_id_gender(number).alias("g"),
        identity.compose_record_key(F.lit(5), F.lit(5001)).alias("k"),
    ).first()
    assert tuple(row) == ("1102337112990007", True, False, "P", "005201001020002")


def test_swap_letters(spark):
    def swap(at):
        return lambda t: identity.swap_letters(t, F.lit(at))

    assert column(spark, ["budi", "abc", None], swap(1)) == ["ubdi", "abc", None]
    assert column(spark, ["budi"], swap(3)) == ["buid"]
