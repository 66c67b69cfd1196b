from pyspark.sql import functions as F

from kinfold.llm import language
from kinfold.llm.language import identify, train
from tests.llm.rows import awkward, frame


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    found = identify(docs.filter(held), train(docs.filter(~held)), carry=["doc_id", "lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.99 * len(found) and all(0 <= r["score"] <= 1 for r in found)


def test_bounded_training(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs, train(docs, training_rows=30), carry=["lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)


def test_awkward_rows(spark):
    docs = frame(spark)
    found = identify(docs, train(docs), carry=docs.columns[:3]).collect()
    assert len(found) == len(awkward())
    for r in found:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == "en" and r["score"] == 1.0


def test_nothing_learned_and_empty_table(spark):
    docs = frame(spark)
    model = train(docs.filter("lang = 'none'"))
    assert {r["lang_pred"] for r in identify(docs, model).collect()} == {"und"}
    assert identify(frame(spark, []), train(docs)).count() == 0


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    texts = ["Abc déf 王 " * 500, "x", None, "ghi " * 900]
    model = train(spark.createDataFrame([(t, "l" + str(i)) for i, t in enumerate(texts)], "text string, lang string"))
    whole = language.score(texts, model)
    monkeypatch.setattr(language, "SPAN", 100)
    cut = language.score(texts, model)
    assert whole[0] == cut[0] and abs(whole[1] - cut[1]).max() < 1e-9
