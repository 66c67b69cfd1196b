import numpy as np

import corpus_pipeline
from kinfold.llm.language import train


def test_texts_of_no_learned_language_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    strange = ["Это русский текст о погоде и о людях в городе", "今天天气很好我们去公园散步", "مرحبا بالعالم هذا نص", "xqzj kwvbq zzxqj qqkjx wxzvq jkqxz"]
    rows = [(-1 - i, t, None) for i, t in enumerate([*strange, "the and of", "of"])]
    # With several learned languages, and with one, whose posterior is always 1.
    for learned in (docs, docs.filter("lang = 'en'")):
        left = corpus_pipeline.language(spark, learned.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")), folder)
        ids = {r["doc_id"] for r in left.collect()}
        assert {i for i in ids if i < 0} == {-5, -6}
        assert len(ids) - 2 >= 0.99 * learned.count()


def test_every_labelled_row_teaches(spark, folder):
    """More labelled rows than were once read: counts, shares and limits follow all of them."""
    rare = "zqx wqvk jjxq vvkz qqwx " * 20
    rows = [(i, f"the weather is fine today number {i}", "en") for i in range(25_000)] + [(-i, rare, "xx") for i in (1, 2)] + [(-3, rare, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs)
    counted = train(docs, training_rows=30)
    assert model.languages == counted.languages == ["en", "xx"]
    # The least probability of an n-gram falls with the number of all that were counted.
    again = train(docs.union(docs))
    assert abs(model.log_prior - again.log_prior).max() < 1e-12
    grams = lambda m: 1 / np.exp(m.log_probability.astype(float)).min(axis=0)
    assert grams(again)[0] / grams(model)[0] > 1.9 and grams(model)[0] / grams(counted)[0] > 100
    assert corpus_pipeline.language(spark, docs, folder).count() == len(rows)
