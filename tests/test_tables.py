import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold import schema
from kinfold.operators import checks, profiling
from kinfold.plans import staging
from kinfold.sources import readers, tables
from kinfold.sources.batches import BatchTables


def test_conform_and_names(spark):
    df = spark.createDataFrame([("1", "Budi", 5)], "nomor_induk string, NAMA_LENGKAP string, extra int")
    ours = schema.conform(schema.from_source_names(df), schema.SOURCE)
    assert ours.schema == schema.SOURCE
    row = ours.first()
    assert (row.record_id, row.full_name, row.site_id) == ("1", "Budi", None)
    assert schema.empty(spark, schema.MERGES).count() == 0


def test_upsert_and_latest(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    delta = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(map(tuple, tables.upsert(base, delta, "k").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    both = base.union(delta)
    assert sorted(map(tuple, tables.latest_per_key(both, ["k"], [F.desc("v")]).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def rows_of(kept):
    return {r.record_id: r.cif_number for r in kept.read("links").collect()}


def test_batches_count_once_and_the_latest_row_wins(spark, tmp_path, monkeypatch):
    kept = BatchTables(spark, str(tmp_path), buckets=4)
    assert kept.read("links").schema == schema.CLUSTERS and rows_of(kept) == {} and kept.last() == 0

    def delta(*rows):
        return spark.createDataFrame(rows, "record_id string, cif_number string")

    assert kept.write("one", links=delta(("a", "1"), ("b", "1")))
    assert kept.write("two", links=delta(("b", "2"), ("c", "2")))
    assert not kept.write("two", links=delta(("b", "9")))
    assert rows_of(kept) == {"a": "1", "b": "2", "c": "2"} and kept.finished("two") and not kept.finished("three")
    assert {r.record_id for r in kept.read("links", delta(("a", ""), ("z", ""))).collect()} == {"a"}
    # A run that dies before its mark: its rows do not count, and the next batch, another one, takes its place.
    monkeypatch.setattr(BatchTables, "_mark", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.write("three", links=delta(("a", "3")), forest=spark.createDataFrame([("1", "0")], "number string, root string"))
    monkeypatch.undo()
    kept = BatchTables(spark, str(tmp_path), buckets=4)
    assert rows_of(kept) == {"a": "1", "b": "2", "c": "2"} and kept.read("forest").isEmpty()
    assert kept.write("four", links=delta(("c", "4")))
    assert rows_of(kept) == {"a": "1", "b": "2", "c": "4"} and kept.read("forest").isEmpty() and kept.last() == 3
    assert kept.write("three", links=delta(("a", "3")).limit(0))
    assert rows_of(kept) == {"a": "1", "b": "2", "c": "4"} and kept.finished("three")


def test_index_keeps_what_several_batches_add(spark, tmp_path):
    kept = BatchTables(spark, str(tmp_path / "it's"), buckets=4)
    rows = spark.createDataFrame([(1, 7, "p"), (2, 7, "p"), (1, 8, "q")], "rule int, block long, profile string")
    assert kept.blocks().isEmpty()
    kept.add_blocks(rows)
    kept.add_blocks(rows.limit(2))
    again = BatchTables(spark, str(tmp_path / "it's"), buckets=4)
    assert again.blocks().count() == 5 and again.blocks().distinct().count() == 3


def test_extract_increment_positions(spark):
    rows = [(f"{i:02d}", "x", s) for i, s in enumerate(["001", "002", "003", "001", None])]
    df = spark.createDataFrame(rows, "NOMOR_INDUK string, NAMA_LENGKAP string, ID_UPT string")

    def ids(**how):
        return [r.record_id for r in staging.extract_increment(df, **how).orderBy("record_id").collect()]

    assert ids() == ["00", "01", "02", "03", "04"]
    assert ids(last_id="01", limit=2) == ["02", "03"]
    assert ids(sites=" 001 ,003") == ["00", "02", "03"]
    first = staging.extract_increment(df, sites="001", limit=1)
    state = staging.position_row(first, "001")
    assert staging.filter_position(state, "001") == "00" and staging.filter_position(state, "002") is None
    assert staging.position_row(staging.extract_increment(df, last_id="99"), None).count() == 0


def test_staging_keeps_one_row_per_id(spark):
    rows = [("1", "Dr. Budi", "001"), ("1", "Dr. Budi", "002"), ("2", None, None)]
    found = staging.to_staging(staging.extract_increment(spark.createDataFrame(rows, "record_id string, full_name string, site_id string")))
    assert found.schema.simpleString() == schema.STAGING.simpleString()
    assert {r.record_id: (r.site_id, r.clean_name, r.processed_at) for r in found.collect()} == {"1": ("002", "budi", None), "2": (None, None, None)}


def test_mark_processed(spark):
    staged = staging.to_staging(spark.createDataFrame([("1",), ("2",)], "record_id string").transform(lambda d: schema.conform(d, schema.SOURCE)))
    at = F.lit("2024-05-01").cast("timestamp")
    marked = tables.mark_processed(staged, spark.createDataFrame([("2",), ("2",)], "record_id string"), at)
    assert {r.record_id: r.processed_at for r in marked.collect()} == {"1": None, "2": dt.datetime(2024, 5, 1)}


def test_readers(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("record_id"))
    for kind in ("parquet", "json", "orc"):
        readers.append(df, str(tmp_path / kind), kind)
        readers.append(df, str(tmp_path / kind), kind)
        assert readers.read_source(spark, readers.SourceSpec(kind, str(tmp_path / kind))).count() == 20
    assert readers.key_ranges("K", ("b", "d'")) == ["K < 'b' OR K IS NULL", "K >= 'b' AND K < 'd'''", "K >= 'd'''"]


def test_database_url_from_environment(monkeypatch):
    monkeypatch.delenv("DATABASE_URL", raising=False)
    assert readers.jdbc_url("jdbc:a") == "jdbc:a"
    monkeypatch.setenv("DATABASE_URL", "jdbc:b")
    assert readers.jdbc_url("jdbc:a") == "jdbc:b"


def test_source_contract(spark):
    spark.createDataFrame([("1", "x")], "record_id string, NAMA_LENGKAP string").createOrReplaceTempView("thin")
    good = "SELECT * FROM thin WHERE record_id > :last_id LIMIT :limit"
    found = checks.validate_source(spark, good)
    assert found.missing_placeholders == () and not found.ok
    assert found.missing_columns == ("national_id", "birth_date", "gender", "address", "site_id", "father_name", "mother_name")
    assert checks.validate_source(spark, "SELECT * FROM thin").missing_placeholders == (":last_id", ":limit")
    assert readers.read_query(spark, good, "0", 1).count() == 1 and readers.read_query(spark, good, "1").count() == 0


def test_profile_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), ("k1",), ("k1",), ("k1",), ("k2",)], "k string")
    assert tuple(profiling.exact_duplicates(df, ["k"]).first()) == (1, 3)
    assert tuple(profiling.exact_duplicates(df, ["k"], keep_nulls=True).first()) == (2, 5)
    assert tuple(profiling.exact_duplicates(df.limit(0), ["k"]).first()) == (0, 0)
    assert [tuple(r) for r in profiling.top_values(df, "k", 2).collect()] == [("k1", 3), (None, 2)]


@pytest.mark.parametrize("values", [[3, 9, 4, 4, 60, 17, 33], [5, 5, 5]])
def test_histogram_agrees_with_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    found = {r.bin: r.n for r in profiling.histogram(df, "v").collect()}
    counts, _ = np.histogram(values, bins=30)
    assert found == {i: n for i, n in enumerate(counts.tolist()) if n}


def test_profile_shuffles_once(spark):
    """Every count comes from one aggregation of the rows; a table without rows has zeros."""
    rows = [("1", "A", None, "x"), ("2", "A", None, None), (None, "B", dt.date(2000, 1, 1), "y")]
    df = spark.createDataFrame(rows, "national_id string, full_name string, birth_date date, site_id string")
    counts = profiling._long_counts(df, "national_id", ["full_name", "birth_date"], ["full_name"], ["site_id"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    found = {(r.metric, r.column, r.item): r.value for r in profiling.report(df, "national_id", "full_name", "birth_date", ["full_name"], ["site_id"]).collect()}
    assert found["rows", None, None] == 3 and found["missing", "birth_date", None] == 2 and found["missing", "full_name", None] == 0
    assert found["dup_groups", "full_name+birth_date", None] == 1 and found["dup_rows", "full_name+birth_date", None] == 2
    assert found["dup_rows", "national_id", None] == 0 and found["frequent", "site_id", None] == 1
    none = {r.value for r in profiling.report(df.limit(0), "national_id", "full_name", "birth_date", ["full_name"], ["site_id"]).collect()}
    assert none == {0}


def test_analyze_sample(spark, folder):
    from kinfold.sources.persons import persons

    people = persons(spark, folder)
    found = profiling.analyze(people, sample_size=40, seed=1).filter("metric = 'rows'").first()
    assert found.value == 40
    clean = staging.to_staging(staging.extract_increment(people))
    assert profiling.analyze(clean, "staged").filter("metric = 'missing' AND column = 'clean_name'").count() == 1
    with pytest.raises(ValueError):
        profiling.analyze(people, "other")
