import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking, duplicates, frequency, scoring
from kinfold.operators.blocking import PairLimitExceeded
from kinfold.plans import catalog, linkage, staging
from kinfold.plans.catalog import FROZEN
from kinfold.session import materialize
from kinfold.settings import DEFAULT_SETTINGS
from kinfold.sources.persons import persons
from kinfold.sources.batches import BatchTables
from kinfold.sources.tables import unprocessed_ids
from kinfold.streaming import incremental
from tests.test_entities import label


@pytest.fixture(scope="module")
def people(spark, folder):
    """Staged persons, a third of them copies of one person, and a crowd that shares a profile but no id."""
    base = catalog._cleaned(spark, folder)
    one = base.filter("record_id LIKE '%0000031'")
    copies = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(59)))).withColumn("record_id", F.format_string("999%015d", "i")).drop("i")
    nobody = copies.limit(5).withColumns(
        {"record_id": F.concat(F.lit("8"), "record_id"), "national_id": F.lit(None).cast("string"), "birth_date": F.lit(None).cast("date"), "gender": F.lit(None).cast("string")}
    )
    return materialize(base.unionByName(copies).unionByName(nobody).drop("true_entity"))


@pytest.fixture(scope="module")
def expected(people):
    """Entities from all record pairs, grouped by brute force."""
    rows = frequency.with_tf(people, frequency.tf_tables(people, DEFAULT_SETTINGS), "record_id")
    carry = [*DEFAULT_SETTINGS.columns, *[f"tf_{c}" for c in frequency.tf_columns(DEFAULT_SETTINGS)]]
    pairs = scoring.matches(blocking.self_pairs(rows, DEFAULT_SETTINGS, carry), FROZEN, keep=["record_id_l", "record_id_r"]).collect()
    least = label([(r.record_id_l, r.record_id_r) for r in pairs])
    ids = [r.record_id for r in people.select("record_id").collect()]
    return {i: least.get(i, i) for i in ids}, len(pairs)


def canonical(clusters):
    rows = clusters.select("record_id", "cif_number").collect()
    least = {}
    for r in rows:
        least[r.cif_number] = min(least.get(r.cif_number, r.record_id), r.record_id)
    return {r.record_id: least[r.cif_number] for r in rows}


def test_link_all_with_many_copies(people, expected):
    found = linkage.link_all(people, FROZEN)
    assert {r.record_id: r.cif_number for r in found.collect()} == {k: f"CIF-{v}" for k, v in expected[0].items()}


def staged(spark, people, tmp_path):
    tables = BatchTables(spark, str(tmp_path), buckets=4)
    staging.stage_batch(tables, "load", people.withColumn("extracted_at", F.lit("2024-01-01").cast("timestamp")))
    return tables


@pytest.mark.parametrize("batch_size", [110, 1000])
def test_batches_give_the_same_entities(spark, people, expected, tmp_path, batch_size):
    tables = staged(spark, people, tmp_path)
    reports = linkage.run(tables, FROZEN, batch_size=batch_size)
    clusters = linkage.current_clusters(tables)
    assert canonical(clusters) == expected[0]
    assert sum(r.records for r in reports) == len(expected[0])
    if batch_size == 1000:
        assert len(reports) == 1 and reports[0].record_pairs == 2 * expected[1]
        assert reports[0].matched_records == sum(1 for k, v in expected[0].items() if list(expected[0].values()).count(v) > 1)
    ids = {(r.cif_number, r.cluster_id) for r in clusters.collect()}
    assert len(ids) == len({c for c, _ in ids})
    assert linkage.run(tables, FROZEN) == []


def test_limit_and_guard(spark, people, tmp_path):
    tables = staged(spark, people, tmp_path)
    with pytest.raises(PairLimitExceeded):
        linkage.run(tables, FROZEN, max_pairs_per_batch=3)
    assert tables.read("links").isEmpty()
    reports = linkage.run(tables, FROZEN, batch_size=40, limit=60)
    assert [r.records for r in reports] == [40, 20]
    clusters = linkage.current_clusters(tables)
    assert clusters.count() == 60
    assert linkage.mapping(tables.read("keys"), clusters).filter("cif_number IS NULL").count() == people.count() - 60


def test_extracting_again_links_again(spark, people, tmp_path):
    tables = staged(spark, people.limit(30), tmp_path)
    linkage.run(tables, FROZEN)
    again = tables.read("staging").limit(4).withColumn("extracted_at", F.lit("2100-01-01").cast("timestamp"))
    staging.stage_batch(tables, "again", again)
    assert tables.read("staging").count() == 30
    assert unprocessed_ids(tables.read("staging"), tables.read("links")).count() == 4


def test_a_changed_record_counts_with_its_last_profile(spark, people, tmp_path):
    """Records that turn into copies of others take their places, and leave those of old, in every table."""
    tables = staged(spark, people, tmp_path)
    linkage.run(tables, FROZEN, batch_size=500)
    rows = tables.read("staging").filter("record_id LIKE '999%'").orderBy("record_id").limit(7)
    model = tables.read("staging").filter("national_id IS NOT NULL AND record_id NOT LIKE '999%'").orderBy("record_id").limit(1)
    copied = rows.select("record_id", "site_id").crossJoin(model.drop("record_id", "site_id")).withColumn("extracted_at", F.lit("2100-01-01").cast("timestamp"))
    copied = materialize(copied)
    assert staging.stage_batch(tables, "changed", copied)
    now = tables.read("staging").drop("extracted_at", "processed_at")
    counted = frequency.tf_of_counts(frequency.merged_counts(tables.rows("counts")), DEFAULT_SETTINGS)
    for column, table in frequency.tf_tables(now, DEFAULT_SETTINGS).items():
        assert sorted(map(tuple, counted[column].collect())) == sorted(map(tuple, table.collect()))
    held = linkage.holders(tables, tables.read("keys", model)).collect()
    assert {r.record_id for r in held} == {r.record_id for r in copied.collect()} | {model.first().record_id}
    linkage.run(tables, FROZEN)
    clusters = {r.record_id: r.cif_number for r in linkage.current_clusters(tables).collect()}
    # Numbers are kept for good: the seven bring theirs along, so both entities are one from here on.
    assert len({clusters[r.record_id] for r in held}) == 1
    assert sum(r.merged_numbers for r in linkage.run(tables, FROZEN)) == 0


def test_second_batch_reads_columns_of_touched_profiles_only(spark, people, tmp_path):
    tables = staged(spark, people, tmp_path)
    linkage.run(tables, FROZEN, batch_size=100, limit=100)
    batch = linkage.pending_rows(tables).limit(20)
    keys = blocking.with_block_keys(materialize(batch), DEFAULT_SETTINGS.rules)
    for small in (True, False):
        near = tables.blocks().join(F.broadcast(keys) if small else keys.hint("merge"), ["rule", "block"], "left_semi")
        plan = near._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "/blocks" in line)
        # The index is joined where it lies, and holds neither names nor addresses.
        assert "clean_name" not in scan and (small or "Bucketed: true" in scan)
    for plan in (linkage.holders(tables, tables.read("keys", batch)), linkage.current_clusters(tables, batch)):
        assert "clean_name" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stream_in_micro_batches_survives_replay(spark, folder, tmp_path):
    source = str(tmp_path / "in")
    rows = staging.extract_increment(persons(spark, folder))
    rows.filter("record_id < '012'").coalesce(1).write.parquet(source)
    rows.filter("record_id >= '012'").coalesce(1).write.mode("append").parquet(source)
    tables = BatchTables(spark, str(tmp_path / "store"), buckets=4)
    reports = []
    handler = incremental.stage_and_link(tables, FROZEN, report=reports.append)
    stream = incremental.source_stream(spark, source, files_per_batch=1)
    incremental.start(stream, handler, str(tmp_path / "cp")).awaitTermination()
    before = canonical(linkage.current_clusters(tables))
    assert len(before) == 150 and len(reports) == 2
    # The second micro-batch sees what the first one added to the index, in another session.
    assert reports[1].matched_records > 0
    # The same micro-batch once more, as after a lost driver: nothing changes.
    handler(rows.filter("record_id >= '012'"), 1)
    assert canonical(linkage.current_clusters(tables)) == before and len(reports) == 2


def test_a_run_that_dies_is_repeated(spark, people, expected, tmp_path, monkeypatch):
    """A writer that dies before its mark leaves nothing that counts, and the next run goes on."""
    tables = staged(spark, people, tmp_path)
    linkage.run(tables, FROZEN, batch_size=100, limit=100)
    before = canonical(linkage.current_clusters(tables))
    put = BatchTables._put

    def dying(self, table, number, df):
        if table == "marks":
            raise KeyboardInterrupt
        put(self, table, number, df)

    monkeypatch.setattr(BatchTables, "_put", dying)
    with pytest.raises(KeyboardInterrupt):
        linkage.run(tables, FROZEN, batch_size=60, limit=60)
    monkeypatch.undo()
    again = BatchTables(spark, str(tmp_path), buckets=4)
    assert canonical(linkage.current_clusters(again)) == before
    linkage.run(again, FROZEN, batch_size=500)
    assert canonical(linkage.current_clusters(again)) == expected[0]


def test_quality_of_injected_duplicates(spark, folder):
    people = persons(spark, folder).drop("true_entity")
    both = materialize(staging.with_clean_columns(duplicates.inject_duplicates(people, rate=0.3, seed=2)))
    assert both.filter("record_id <> true_entity").count() > 20
    found = duplicates.pair_quality(linkage.link_all(both, FROZEN), both).first()
    assert found.recall > 0.9 and found.true_pairs == both.filter("record_id <> true_entity").count()


def test_names_in_other_scripts_stay_apart(spark, folder):
    """Six persons with six Cyrillic names, parents and numbers and one birth date are six entities."""
    names = ["Иванов Пётр", "Сидоров Олег", "Жуков Лев", "Щукин Яков", "Цой Виктор", "Ёлкин Юрий"]
    rows = [(f"00120240101000900{i}", n, f"77{i:014d}", "1980-05-05", "L", None, "001", names[i - 1], names[i - 2]) for i, n in enumerate(names)]
    six = spark.createDataFrame(rows, "record_id string, full_name string, national_id string, birth_date string, gender string, address string, site_id string, father_name string, mother_name string")
    six = six.withColumn("birth_date", F.col("birth_date").cast("date"))
    people = staging.with_clean_columns(persons(spark, folder).drop("true_entity").unionByName(six))
    found = linkage.link_all(materialize(people), FROZEN).filter("record_id LIKE '00120240101000900%'")
    assert found.count() == found.select("cif_number").distinct().count() == 6


def test_hot_block_on_the_other_side(spark):
    """A block with few new and many known records is cut on both sides, and every pair comes once."""
    rows = [(f"{i:05d}", "1", None) for i in range(300)] + [("x", "2", None)]
    everything = spark.createDataFrame(rows, "record_id string, national_id string, birth_date date").withColumns({c: F.lit(None).cast("string") for c in DEFAULT_SETTINGS.columns if c not in ("national_id", "birth_date")})
    new = everything.filter("record_id < '00003'")
    for tile in (7, 10_000):
        found = blocking.new_vs_all(new, everything, DEFAULT_SETTINGS, carry=[], tile_rows=tile)
        assert found.count() == found.distinct().count() == 3 * 299
