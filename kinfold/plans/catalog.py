"""The registered queries: each takes a session and the folder of the tables, and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold import schema
from kinfold.functions import identity, similarity, text
from kinfold.operators import (
    blocking,
    checks,
    comparison,
    components,
    duplicates,
    entities,
    frequency,
    profiles,
    profiling,
    sampling,
    scoring,
    training,
)
from kinfold.operators.model import LinkModel, load_model
from kinfold.operators.skew import attach
from kinfold.plans import linkage, staging
from kinfold.session import checkpoint_root, materialize
from kinfold.settings import DEFAULT_SETTINGS
from kinfold.sources import readers, tables
from kinfold.sources.batches import BatchTables
from kinfold.sources.persons import cases, mapped_ids, persons
from kinfold.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

# A fixed model, so that scores can be checked against SQL.
FROZEN = LinkModel(
    DEFAULT_SETTINGS,
    prior=0.00002,
    m={
        "national_id": (0.05, 0.95),
        "birth_date": (0.02, 0.02, 0.03, 0.03, 0.90),
        "gender": (0.02, 0.98),
        "clean_name": (0.05, 0.05, 0.05, 0.10, 0.75),
        "clean_address": (0.50, 0.10, 0.10, 0.10, 0.20),
        "clean_father": (0.05, 0.05, 0.05, 0.05, 0.80),
        "clean_mother": (0.05, 0.05, 0.05, 0.05, 0.80),
    },
    u={
        "national_id": (0.9999, 0.0001),
        "birth_date": (0.90, 0.08, 0.01, 0.005, 0.005),
        "gender": (0.5, 0.5),
        "clean_name": (0.97, 0.02, 0.006, 0.002, 0.002),
        "clean_address": (0.80, 0.10, 0.05, 0.03, 0.02),
        "clean_father": (0.97, 0.015, 0.008, 0.004, 0.003),
        "clean_mother": (0.97, 0.015, 0.008, 0.004, 0.003),
    },
)

RULES = DEFAULT_SETTINGS.rules
SAMPLE_ROWS = 100_000
U_PAIRS = 5_000_000
MATCH_WEIGHT = 25.0
SITES = "001, 002"
# Where the second and third file of a stream begin.
ARRIVALS = ("008", "016")
# Record ids lead with the site: the sites from this one on register later than the others.
NEW_FROM = "015"

# Placeholders for names, and a site whose records are not linked.
NOT_NAME, NOT_ID = "UNKNOWN", "024"

# A source query of the caller's own, with both placeholders: unmapped persons under the site of each of their cases.
CUSTOM_QUERY = f"""
SELECT record_id, full_name, national_id, birth_date, gender, address, held.site_id, father_name, mother_name, held.case_id
FROM persons
JOIN (SELECT record_id, case_id, site_id FROM cases WHERE case_id IS NOT NULL AND site_id IS NOT NULL) held USING (record_id)
WHERE NOT EXISTS (SELECT 1 FROM cif_mapping WHERE cif_mapping.record_id = persons.record_id)
  AND length(full_name) > 0 AND NOT startswith(full_name, '{NOT_NAME}') AND NOT startswith(record_id, '{NOT_ID}')
  AND record_id > :last_id
LIMIT :limit
"""
# The same without a place for the limit, without the national id and with the name under another name.
BROKEN_QUERY = "SELECT record_id, full_name AS nama, birth_date, gender, address, site_id, father_name, mother_name FROM persons WHERE record_id > :last_id"


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return staging.with_clean_columns(persons(spark, folder))


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """The staged columns that linkage reads, as a stored table like any staging table."""
    return materialize(_cleaned(spark, folder).select("record_id", *DEFAULT_SETTINGS.columns))


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"


# --- cleaning


def normalize_names(spark, folder):
    people = persons(spark, folder)
    clean = {f"clean_{c}": text.clean_text(F.col(c)) for c in ("full_name", "father_name", "mother_name")}
    return people.select("record_id", *[v.alias(k) for k, v in clean.items()])


def normalize_addresses(spark, folder):
    return persons(spark, folder).select("record_id", text.clean_text(F.col("address")).alias("clean_address"))


def normalize_documents(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select("doc_id", text.transliterate(F.col("text")).alias("plain"))


def clean_documents(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select("doc_id", text.clean_text(F.col("text")).alias("clean"))


# --- extraction and staging


def extract_keyset(spark, folder):
    return staging.extract_increment(persons(spark, folder), last_id="010")


def extract_limited(spark, folder):
    return staging.extract_increment(persons(spark, folder), last_id="010", limit=500)


def extract_half(spark, folder):
    """A limit of half the table: as large as the table, so it must not gather anywhere."""
    people = persons(spark, folder)
    return staging.extract_increment(people, limit=people.count() // 2)


def extract_site_filter(spark, folder):
    return staging.extract_increment(persons(spark, folder), sites=SITES)


def extract_custom_sql(spark, folder):
    people = persons(spark, folder)
    people.createOrReplaceTempView("persons")
    mapped_ids(people).createOrReplaceTempView("cif_mapping")
    cases(spark, folder).createOrReplaceTempView("cases")
    return readers.read_query(spark, CUSTOM_QUERY)


def source_contract(spark, folder):
    """One row per placeholder and required column of a good and of a broken query: is it there?"""
    people = persons(spark, folder)
    people.createOrReplaceTempView("persons")
    mapped_ids(people).createOrReplaceTempView("cif_mapping")
    cases(spark, folder).createOrReplaceTempView("cases")
    rows = []
    for name, query in (("good", CUSTOM_QUERY), ("broken", BROKEN_QUERY)):
        found = checks.validate_source(spark, query)
        rows += [(name, "placeholder", p, p not in found.missing_placeholders) for p in checks.PLACEHOLDERS]
        rows += [(name, "column", c, c not in found.missing_columns) for c in schema.SOURCE.names]
    met = spark.createDataFrame(rows, "query string, kind string, item string, present boolean")
    # The rows that hold a value, per required column, beside what the queries return.
    values = people.select([F.count(c).alias(c) for c in schema.SOURCE.names]).unpivot([], schema.SOURCE.names, "item", "values")
    return met.join(values, "item", "left").fillna(0, ["values"])


def extract_resumed(spark, folder):
    """Runs with two site filters, one of them in two goes; positions and staged rows as they stand afterwards."""
    kept = BatchTables(spark, _folder(spark))
    people = persons(spark, folder)
    for run, (sites, limit) in enumerate([(SITES, 5), ("003", None), ("002,001", None), (SITES, None)]):
        staging.extract_job(kept, people, f"run-{run}", sites, limit)
    staged = kept.read("staging").select(F.lit("row").alias("kind"), F.col("record_id").alias("name"), F.col("site_id").alias("value"))
    return staged.union(kept.read("positions").select(F.lit("position"), "sites", "position"))


def unmapped_anti_join(spark, folder):
    people = persons(spark, folder)
    return people.join(mapped_ids(people), "record_id", "left_anti").select("record_id", "full_name", "site_id")


def _eligible(spark, folder):
    people = persons(spark, folder)
    return staging.eligible(people, mapped_ids(people), cases(spark, folder), NOT_NAME, NOT_ID)


def case_inner_fanout_latest(spark, folder):
    return staging.one_row_per_person(_eligible(spark, folder)).select("record_id", "full_name", "site_id", "case_id")


def staging_rows(spark, folder):
    return staging.to_staging(staging.extract_increment(persons(spark, folder))).drop("extracted_at", "processed_at")


def staging_upsert(spark, folder):
    shown = ["record_id", "full_name", "clean_name", "site_id"]
    base = staging.to_staging(staging.extract_increment(persons(spark, folder))).select(*shown)
    moved = staging.one_row_per_person(_eligible(spark, folder)).withColumn("full_name", F.concat("full_name", F.lit(" bin "), "case_id"))
    delta = staging.to_staging(moved).select(*shown)
    return tables.upsert(base, delta, "record_id")


def high_water_mark(spark, folder):
    by_site = persons(spark, folder).groupBy("site_id").agg(F.max("record_id").alias("position"))
    overall = staging.high_water_mark(persons(spark, folder)).select(F.lit("all").alias("site_id"), "position")
    return by_site.union(overall)


def events_high_water_mark(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.groupBy("event_type").agg(F.max("event_id").alias("position"), F.count(F.lit(1)).alias("n"))


def mark_processed(spark, folder):
    staged = staging.to_staging(staging.extract_increment(persons(spark, folder)))
    linked = cases(spark, folder)
    at = F.lit("2024-01-02 00:00:00").cast("timestamp")
    marked = tables.mark_processed(staged, linked, at)
    return marked.groupBy("site_id").agg(
        F.count_if(F.col("processed_at").isNotNull()).alias("processed"), F.count_if(F.col("processed_at").isNull()).alias("pending")
    )


# --- profile


def null_profile(spark, folder):
    return profiling.null_counts(persons(spark, folder).drop("true_entity"))


def dup_groups_key(spark, folder):
    return profiling.exact_duplicates(persons(spark, folder), ["national_id"])


def dup_groups_name_dob(spark, folder):
    return profiling.exact_duplicates(_cleaned(spark, folder), ["clean_name", "birth_date"], keep_nulls=True)


def length_histogram(spark, folder):
    people = persons(spark, folder)
    parts = [profiling.length_histogram(people, c).select(F.lit(c).alias("column"), "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n") for c in ("full_name", "address")]
    return parts[0].union(parts[1])


def document_length_histogram(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return profiling.length_histogram(documents, "text").withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def top_values(spark, folder):
    people = persons(spark, folder)
    parts = [profiling.top_values(people, c).select(F.lit(c).alias("column"), "value", "n") for c in ("full_name", "site_id")]
    return parts[0].union(parts[1])


def value_counts(spark, folder):
    return profiling.value_counts(persons(spark, folder), "national_id")


def profile_report(spark, folder):
    return profiling.analyze(persons(spark, folder).drop("true_entity"))


def profile_staged(spark, folder):
    return profiling.analyze(staging.to_staging(staging.extract_increment(persons(spark, folder))), "staged")


def sample_rows(spark, folder):
    return sampling.sample_n(persons(spark, folder), "record_id", SAMPLE_ROWS // 100, seed=3).select("record_id", "full_name")


# --- candidate pairs


def tf_table(spark, folder):
    people = _cleaned(spark, folder)
    parts = [frequency.tf_table(people, c).select(F.lit(c).alias("column"), "value", "n", F.round("tf", 9).alias("tf")) for c in frequency.tf_columns(DEFAULT_SETTINGS)]
    return parts[0].union(parts[1]).union(parts[2])


def _rule(number: int) -> Query:
    return lambda spark, folder: blocking.rule_pairs(_compared(spark, folder), DEFAULT_SETTINGS, number)


def pairs_all_rules(spark, folder):
    return blocking.self_pairs(_compared(spark, folder), DEFAULT_SETTINGS, carry=[])


def pair_estimate(spark, folder):
    found = blocking.estimate_pairs(_compared(spark, folder), RULES)
    return found.select("rule", "blocks", "largest_block", F.col("pairs").cast("long").alias("pairs"))


def new_vs_all_pairs(spark, folder):
    everything = _compared(spark, folder)
    new = everything.filter(F.col("record_id") >= NEW_FROM)
    return blocking.new_vs_all(new, everything, DEFAULT_SETTINGS, carry=[]).select(
        F.col("record_id_l").alias("new_id"), F.col("record_id_r").alias("candidate_id"), "rule"
    )


# --- comparison and scores


def _pairs(spark, folder):
    return blocking.self_pairs(_compared(spark, folder), DEFAULT_SETTINGS)


def jaro_winkler_pairs(spark, folder):
    pairs = _pairs(spark, folder)
    texts = ("clean_name", "clean_address", "clean_father", "clean_mother")
    found = {c: similarity.jaro_winkler(F.col(f"{c}_l"), F.col(f"{c}_r")) for c in texts}
    return pairs.select("record_id_l", "record_id_r", *[F.round(v, 6).alias(f"similarity_{c}") for c, v in found.items()])


def dob_levels(spark, folder):
    only = blocking.self_pairs(_compared(spark, folder), DEFAULT_SETTINGS, carry=["birth_date"])
    level = comparison.date_level(DEFAULT_SETTINGS.comparison("birth_date"))
    return only.select("record_id_l", "record_id_r", level.alias("level"))


def order_date_levels(spark, folder):
    """Date levels between consecutive order dates of a customer: many near misses."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("birth_date_r"))
    before = F.lag("birth_date_r").over(Window.partitionBy("o_custkey").orderBy("birth_date_r", "o_orderkey"))
    both = orders.withColumn("birth_date_l", before)
    return both.select("o_orderkey", comparison.date_level(DEFAULT_SETTINGS.comparison("birth_date")).alias("level"))


def gamma_pattern_counts(spark, folder):
    return comparison.gamma_pattern_counts(_pairs(spark, folder), DEFAULT_SETTINGS)


def _with_tf(people: DataFrame) -> DataFrame:
    return frequency.with_tf(people, frequency.tf_tables(people, DEFAULT_SETTINGS), "record_id")


def _scored(spark, folder):
    # Block sizes and pairs both read them.
    people = materialize(_with_tf(_compared(spark, folder)))
    carry = [*DEFAULT_SETTINGS.columns, *[f"tf_{c}" for c in frequency.tf_columns(DEFAULT_SETTINGS)]]
    return blocking.self_pairs(people, DEFAULT_SETTINGS, carry)


def scored_pairs_frozen(spark, folder):
    scored = scoring.score_pairs(_scored(spark, folder), FROZEN, keep=["record_id_l", "record_id_r"])
    return scored.withColumns({c: F.round(c, 6) for c in ("match_weight", "match_probability")})


def pairs_over_threshold(spark, folder):
    found = scoring.matches(_scored(spark, folder), FROZEN, keep=["record_id_l", "record_id_r"])
    return found.select("record_id_l", "record_id_r", F.round("match_probability", 6).alias("match_probability"))


def pairs_over_weight(spark, folder):
    """The coarse weight filter decides: it asks for more than the probability does."""
    found = scoring.matches(_scored(spark, folder), FROZEN, 0.9, MATCH_WEIGHT, keep=["record_id_l", "record_id_r"])
    return found.select("record_id_l", "record_id_r", F.round("match_weight", 6).alias("match_weight"))


def scored_pairs_debug(spark, folder):
    """Scored pairs with levels and with what each comparison adds."""
    scored = scoring.score_pairs(_scored(spark, folder), FROZEN)
    scored = scored.select("*", *scoring.weight_columns(FROZEN))
    rounded = [F.round(c, 6).alias(c) for c in ("match_weight", *[f"weight_{c}" for c in DEFAULT_SETTINGS.columns])]
    return scored.select("record_id_l", "record_id_r", *comparison.gamma_columns(DEFAULT_SETTINGS), *rounded)


# --- training


def u_from_random_pairs(spark, folder):
    found = training.estimate_u(_compared(spark, folder), DEFAULT_SETTINGS, U_PAIRS, seed=5)
    return found.withColumn("u", F.round("u", 9))


def prior_estimate(spark, folder):
    return training.estimate_prior(_compared(spark, folder)).withColumn("prior", F.round("prior", 12))


def _em_profiles(spark, folder):
    rows = profiles.collapse(_compared(spark, folder), DEFAULT_SETTINGS)
    return materialize(frequency.with_tf(rows, frequency.tf_tables(rows, DEFAULT_SETTINGS, F.col("copies")), "record_id"))


def em_one_iteration(spark, folder):
    """One round of each rule's session from the frozen model."""
    rows = _em_profiles(spark, folder)
    steps = []
    for number, rule in enumerate(RULES, 1):
        vectors = training.session_vectors(rows, FROZEN, rule)
        step = training.em_step(vectors, FROZEN, training.active_comparisons(DEFAULT_SETTINGS, rule), 0.5)
        steps.append(step.select(F.lit(number).alias("rule"), "comparison", "level", F.round("m", 6).alias("m"), F.round("prior", 6).alias("prior")))
    return reduce(DataFrame.union, steps)


def em_trained(spark, folder):
    """The model of all sessions, saved and loaded again, and whether they settled within their rounds."""
    found = training.train(_compared(spark, folder), DEFAULT_SETTINGS, allow_partial=True)
    path = _folder(spark)
    found.model.save(spark, path)
    rows = load_model(spark, path, DEFAULT_SETTINGS).to_frame(spark)
    rounded = {"m": F.round("m", 6), "u": F.round("u", 9), "prior": F.round("prior", 12)}
    return rows.withColumns(rounded).withColumn("settled", F.lit(found.settled))


# --- entities


def _edges(spark, folder):
    found = scoring.matches(_scored(spark, folder), FROZEN, keep=[F.col("record_id_l").alias("src"), F.col("record_id_r").alias("dst")])
    return materialize(found.select("src", "dst"))


def connected_components(spark, folder):
    return components.connected_components(_edges(spark, folder))


def order_components(spark, folder):
    """Components of the graph of orders and the parts they hold: few, large, with hot nodes."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    edges = lines.select(F.concat(F.lit("o"), F.col("l_orderkey")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey")).alias("dst"))
    found = components.connected_components(edges)
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))


def stable_cluster_id(spark, folder):
    people = persons(spark, folder).select("record_id", "national_id")
    return people.select(
        "record_id", identity.stable_cluster_id(F.col("record_id")).alias("numeric_id"), identity.stable_cluster_id(identity.mint_cif(F.col("record_id"))).alias("hashed_id")
    )


def resolve_entities(spark, folder):
    return linkage.link_all(_compared(spark, folder), FROZEN)


def _resolved(spark: SparkSession, folder: str, people: DataFrame, numbers: DataFrame) -> DataFrame:
    """New records, those of the later sites, against records that already have numbers."""
    known = numbers.filter(F.col("record_id") < NEW_FROM)
    batch = people.filter(F.col("record_id") >= NEW_FROM).select("record_id")
    edges = _edges(spark, folder)
    both = edges.select(F.col("src").alias("new_id"), F.col("dst").alias("candidate_id"))
    both = both.union(edges.select(F.col("dst").alias("new_id"), F.col("src").alias("candidate_id"))).join(batch.select(F.col("record_id").alias("new_id")), "new_id", "left_semi")
    assigned, _ = entities.resolve(batch, both, known)
    return assigned


def resolve_batch(spark, folder):
    people = _compared(spark, folder)
    return _resolved(spark, folder, people, _first_numbers(people))


def resolve_batch_gaps(spark, folder):
    """The same where some known records have no number, or an empty one: they name nothing."""
    people = _compared(spark, folder)
    last = F.right("record_id", F.lit(1))
    number = F.when(last == "3", None).when(last == "7", "").otherwise(F.col("cif_number"))
    return _resolved(spark, folder, people, _first_numbers(people).withColumn("cif_number", number))


def _first_numbers(people: DataFrame) -> DataFrame:
    """Numbers as a first pass over the national id alone would give them."""
    least = people.filter("national_id IS NOT NULL").groupBy("national_id").agg(F.min("record_id").alias("least"), F.count(F.lit(1)).alias("records"))
    joined = attach(people.select("record_id", "national_id"), least, "national_id", "records", F.col("record_id"))
    cif = identity.mint_cif(F.coalesce("least", "record_id"))
    return joined.select("record_id", entities.cif_cluster_id(cif).alias("cluster_id"), cif.alias("cif_number"))


def _bridges(spark, folder):
    people = _compared(spark, folder)
    clusters = materialize(_first_numbers(people))
    edges = blocking.rule_pairs(people, DEFAULT_SETTINGS, 3).select(F.col("record_id_l").alias("new_id"), F.col("record_id_r").alias("candidate_id"))
    _, merged = entities.resolve(people.select("record_id"), edges, clusters)
    return clusters, merged


def bridge_merges(spark, folder):
    return _bridges(spark, folder)[1]


def apply_merges(spark, folder):
    return entities.apply_merges(*_bridges(spark, folder))


# --- incremental


def _canonical(clusters: DataFrame) -> DataFrame:
    """Entities named by their smallest record, so that groupings compare whatever their numbers are."""
    least = clusters.groupBy("cif_number").agg(F.min("record_id").alias("entity"))
    return clusters.join(least, "cif_number").select("record_id", "entity")


def _batches(spark: SparkSession, folder: str, parts: int):
    """All persons staged at once and linked in as many batches, in id order."""
    kept = BatchTables(spark, _folder(spark))
    staging.stage_batch(kept, "load", staging.to_staging(staging.extract_increment(persons(spark, folder))))
    size = -(-kept.read("keys").count() // parts)
    return kept, linkage.run(kept, FROZEN, batch_size=size)


def incremental_two_batches(spark, folder):
    kept, _ = _batches(spark, folder, 2)
    return _canonical(linkage.current_clusters(kept))


def incremental_three_batches(spark, folder):
    """The forest after three batches: numbers merged by later batches stand below one root."""
    kept, _ = _batches(spark, folder, 3)
    return _canonical(linkage.current_clusters(kept))


def run_statistics(spark, folder):
    """The figures of three batches, and how many entities there are in the end."""
    kept, reports = _batches(spark, folder, 3)
    rows = [(i, r.records, r.record_pairs, r.matched_records, r.merged_numbers) for i, r in enumerate(reports, 1)]
    figures = spark.createDataFrame(rows, "batch int, records long, record_pairs long, matched_records long, merged_numbers long")
    return figures.withColumn("entities", linkage.entity_count(linkage.current_clusters(kept)).scalar())


def tf_merged(spark, folder):
    """Frequencies from the counts of three batches, the third of which replaces rows of the first."""
    kept = BatchTables(spark, _folder(spark))
    staged = staging.to_staging(staging.extract_increment(persons(spark, folder)))
    first, second = staged.filter(F.col("record_id") < NEW_FROM), staged.filter(F.col("record_id") >= NEW_FROM)
    staging.stage_batch(kept, "first", first.withColumns({"clean_name": F.reverse("clean_name"), "clean_father": F.col("clean_mother"), "clean_mother": F.lit(None)}))
    staging.stage_batch(kept, "second", second)
    staging.stage_batch(kept, "third", first)
    found = frequency.tf_of_counts(frequency.merged_counts(kept.rows("counts")), DEFAULT_SETTINGS)
    parts = [t.select(F.lit(c).alias("column"), "value", "n", F.round("tf", 9).alias("tf")) for c, t in found.items()]
    return reduce(DataFrame.union, parts)


def _arrivals(spark: SparkSession, folder: str) -> tuple[str, list[DataFrame]]:
    """A folder with three files of source rows, as they arrive."""
    source = _folder(spark)
    rows = staging.extract_increment(persons(spark, folder))
    bounds = (None, *ARRIVALS, None)
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        part = rows if low is None else rows.filter(F.col("record_id") >= low)
        parts.append(part if high is None else part.filter(F.col("record_id") < high))
        parts[-1].coalesce(1).write.mode("append").parquet(source)
    return source, parts


def stream_stage_and_link(spark, folder):
    """Three micro-batches, the second once more as after a lost driver: sizes of entities, micro-batches that counted."""
    (source, parts), root = _arrivals(spark, folder), _folder(spark)
    kept = BatchTables(spark, root)
    handler = incremental.stage_and_link(kept, FROZEN)
    incremental.start(incremental.source_stream(spark, source, files_per_batch=1), handler, f"{root}/checkpoint").awaitTermination()
    handler(parts[1], 1)
    sizes = linkage.current_clusters(kept).groupBy("cif_number").agg(F.count(F.lit(1)).alias("n"))
    batches = kept.marks().filter(~F.col("name").endswith("-staged")).agg(F.count(F.lit(1))).scalar()
    return sizes.groupBy("n").agg(F.count(F.lit(1)).alias("entities")).withColumn("batches", batches)


# --- identity numbers and evaluation


def nik_compose_decode(spark, folder):
    k = F.col("c_custkey")
    rows = spark.read.parquet(f"{folder}/customer.parquet").select(
        k,
        F.date_add(F.lit("1960-01-01").cast("date"), (k * 7919 % 15000).cast("int")).alias("birth_date"),
        F.when(k % 2 == 0, "L").otherwise("P").alias("gender"),
        F.col("c_nationkey").alias("nk"),
    )
    number = identity.compose_national_id(F.col("nk") + 11, k % 99 + 1, k % 97 + 1, F.col("birth_date"), F.col("gender"), k % 9999 + 1)
    composed = rows.withColumn("number", number)
    return composed.select(
        "c_custkey",
        "number",
        identity.compose_record_key(F.col("nk"), k).alias("record_key"),
        identity.national_id_gender(F.col("number")).alias("decoded_gender"),
        identity.national_id_agrees(F.col("number"), F.col("birth_date"), F.col("gender")).alias("agrees"),
    )


def national_id_quality(spark, folder):
    people = persons(spark, folder)
    agrees = identity.national_id_agrees(F.col("national_id"), F.col("birth_date"), F.col("gender"))
    return people.groupBy("gender").agg(F.count_if(agrees).alias("agree"), F.count_if(~agrees).alias("differ"), F.count_if(agrees.isNull()).alias("unknown"))


def inject_duplicates(spark, folder):
    return duplicates.inject_duplicates(persons(spark, folder).drop("true_entity"), rate=0.2, seed=9).select("record_id", "full_name", "address", "true_entity")


def pair_precision_recall(spark, folder):
    people = materialize(_cleaned(spark, folder).select("record_id", "true_entity", *DEFAULT_SETTINGS.columns))
    found = duplicates.pair_quality(linkage.link_all(people, FROZEN), people)
    return found.withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


def record_mapping(spark, folder):
    """Record to entity number of all staged records, batch by batch in one batch."""
    kept, _ = _batches(spark, folder, 1)
    return linkage.mapping(kept.read("keys"), linkage.current_clusters(kept))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_names, normalize_addresses, normalize_documents, clean_documents,
        extract_keyset, extract_limited, extract_half, extract_site_filter, extract_custom_sql, extract_resumed, source_contract,
        unmapped_anti_join, case_inner_fanout_latest, staging_rows, staging_upsert, high_water_mark,
        events_high_water_mark, mark_processed,
        null_profile, dup_groups_key, dup_groups_name_dob, length_histogram, document_length_histogram,
        top_values, value_counts, profile_report, profile_staged, sample_rows,
        tf_table, pairs_all_rules, pair_estimate, new_vs_all_pairs,
        jaro_winkler_pairs, dob_levels, order_date_levels, gamma_pattern_counts,
        scored_pairs_frozen, pairs_over_threshold, pairs_over_weight, scored_pairs_debug,
        u_from_random_pairs, prior_estimate, em_one_iteration, em_trained,
        connected_components, order_components, stable_cluster_id, resolve_entities, resolve_batch, resolve_batch_gaps,
        bridge_merges, apply_merges, incremental_two_batches, incremental_three_batches, run_statistics, tf_merged, stream_stage_and_link,
        record_mapping, nik_compose_decode, national_id_quality, inject_duplicates, pair_precision_recall,
    )
}
QUERIES.update({f"pairs_rule_{i}": _rule(i) for i in range(1, len(RULES) + 1)})
