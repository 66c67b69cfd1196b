import corpus_pipeline
from kinfold.llm.queries import QUERIES
from kinfold.session import materialize
from tests.llm.rows import awkward, frame, prose
from tests.llm.test_jaccard import changed, shingles


def test_stages_on_awkward_rows(spark, folder):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder))
        assert docs.columns == frame(spark).columns, name
    left = sorted((r["doc_id"] for r in docs.collect()), key=repr)
    # No letters: 4, 5, 6, the null text, 15, 16. Shorter or repeated copies: 1, 7 and the null id. Near copies: 3, 14.
    assert left == [10, 11, 12, 13, 2, 7, 8, 9, None]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(left)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []), folder).count() == 0


def test_planted_cases(spark, folder):
    """Copies, near copies and leaks go, clean documents stay."""
    import random

    rng = random.Random(4)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = [prose(i + 900, 150) for i in range(6)]
    texts = clean + [clean[0].replace(" ", "\n"), changed(clean[1], 3, rng), f"{prose(1, 40)} {item} {prose(2, 40)}"]
    tail = awkward()[0][3:]
    docs = frame(spark, [(i, t, "en", *tail) for i, t in enumerate(texts)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder))
    assert sorted(r["doc_id"] for r in docs.collect()) == list(range(6))
    a, b = shingles(texts[1], 5), shingles(texts[7], 5)
    assert len(a & b) >= 0.8 * len(a | b)


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
    assert 100 < found.count() <= spark.read.parquet(f"{folder}/documents.parquet").count()
    assert len(QUERIES) == 13 and len(corpus_pipeline.STAGES) == 5


def test_language_leaves_no_texts_behind(spark, folder):
    """Of what it judged, only the names of the rows that go are kept until its result is written."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(docs.first()["doc_id"], "123", None), (None, "...", "en"), (None, None, None), (-1, "the and of", "en")], "doc_id long, text string, lang string")
    made = corpus_pipeline.language(spark, docs.select("doc_id", "text", "lang").union(odd), folder)
    assert spark.read.parquet(made._written_to).columns == ["doc_id", "text_hash"]
    assert made.count() == docs.count() + 1 and made.columns == ["doc_id", "text", "lang"]
