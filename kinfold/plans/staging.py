"""From source records to staged, cleaned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold import schema
from kinfold.functions.text import clean_text
from kinfold.operators.blocking import with_block_keys
from kinfold.operators.frequency import value_counts
from kinfold.operators.profiles import profile_key
from kinfold.operators.sampling import first_n
from kinfold.session import forget, materialize
from kinfold.sources.batches import BatchTables
from kinfold.sources.tables import latest_per_key

# Source column and the cleaned column made from it.
CLEANED = {"full_name": "clean_name", "address": "clean_address", "father_name": "clean_father", "mother_name": "clean_mother"}


def with_clean_columns(df: DataFrame) -> DataFrame:
    """Cleaned columns. A text of which nothing is left says nothing: it is null, neither blocks nor compares."""
    return df.withColumns({clean: F.nullif(clean_text(F.col(raw)), F.lit("")) for raw, clean in CLEANED.items()})


def site_filter(sites: str | None) -> Column:
    """Condition from a comma-separated list; without one, every row."""
    names = [s.strip() for s in sites.split(",")] if sites else []
    return F.col("site_id").isin(names) if names else F.lit(True)


def source_order() -> list[Column]:
    """Which of several source rows with one id counts: the highest by site, then by the other columns."""
    return [F.desc_nulls_last(c) for c in ("site_id", *[n for n in schema.SOURCE.names if n not in ("record_id", "site_id")])]


def extract_increment(source: DataFrame, last_id: str | None = None, sites: str | None = None, limit: int | None = None) -> DataFrame:
    """Source rows after ``last_id`` (None: all), of the given sites, in id order up to ``limit``.

    One filtered scan: both conditions reach the source, and only the nine contract columns are read.
    """
    rows = schema.conform(schema.from_source_names(source), schema.SOURCE)
    rows = rows.filter(site_filter(sites))
    if last_id is not None:
        rows = rows.filter(F.col("record_id") > last_id)
    return rows if limit is None else first_n(rows, "record_id", limit)


def to_staging(increment: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One cleaned staging row per id, not processed yet."""
    rows = latest_per_key(increment, ["record_id"], source_order())
    at = F.current_timestamp() if extracted_at is None else extracted_at
    return schema.conform(with_clean_columns(rows).withColumns({"extracted_at": at, "processed_at": F.lit(None)}), schema.STAGING)


def high_water_mark(df: DataFrame) -> DataFrame:
    """``position``: the largest id, where the next extraction starts."""
    return df.agg(F.max("record_id").alias("position"))


def eligible(persons: DataFrame, mapped: DataFrame, cases: DataFrame, not_name: str, not_id: str) -> DataFrame:
    """Unmapped persons with a case, under the site of each of their cases; placeholders by name or id go."""
    rows = persons.join(mapped.select("record_id"), "record_id", "left_anti")
    rows = rows.filter((F.col("full_name") != "") & ~F.col("full_name").startswith(not_name) & ~F.col("record_id").startswith(not_id))
    held = cases.filter(F.col("case_id").isNotNull() & F.col("site_id").isNotNull()).select("record_id", "case_id", F.col("site_id").alias("case_site"))
    joined = rows.join(held, "record_id")
    return joined.withColumn("site_id", F.col("case_site")).drop("case_site")


def one_row_per_person(eligible_rows: DataFrame) -> DataFrame:
    """Of several cases of a person, the one with the highest number."""
    return latest_per_key(eligible_rows, ["record_id"], [F.desc("case_id")])


def _filter_name(sites: str | None) -> str:
    return ",".join(sorted(s.strip() for s in sites.split(","))) if sites else ""


def filter_position(state: DataFrame, sites: str | None) -> str | None:
    """Where the extraction with this site filter stopped; each filter has a position of its own.

    ``state`` is a table of ``sites, position``.
    """
    return state.filter(F.col("sites") == _filter_name(sites)).agg(F.max("position")).first()[0]


def position_row(increment: DataFrame, sites: str | None) -> DataFrame:
    """The row of the state table after an increment was staged."""
    return high_water_mark(increment).filter(F.col("position").isNotNull()).select(F.lit(_filter_name(sites)).alias("sites"), "position")


def stage_batch(tables: BatchTables, name: str, staged: DataFrame, **more: DataFrame) -> bool:
    """Add ``staged`` rows (the staging layout, one per id) as one batch, with all that linking will ask for.

    The block index gets the blocks of profiles that no earlier record had, and the frequencies what these rows add;
    rows that replace an earlier version of their record take back what that counted. False if the batch counts
    already. ``more`` are rows for further tables of the batch.
    """
    if tables.finished(name):
        return False
    settings = tables.settings
    rows = materialize(schema.conform(staged, schema.STAGING).withColumn("profile", profile_key(settings)))
    counts = value_counts(rows, settings)
    before = materialize(tables.read("keys", rows))
    if not before.isEmpty():
        counts = counts.unionByName(value_counts(tables.read("staging", before), settings, -1))
    profiles = rows.groupBy("profile").agg(*[F.min(c).alias(c) for c in settings.columns])
    known = tables.rows("keys").select("profile").join(rows.select("profile").distinct(), "profile", "left_semi").distinct()
    profiles = materialize(profiles.join(known, "profile", "left_anti"))
    tables.add_blocks(with_block_keys(profiles, settings.rules))
    done = tables.write(name, staging=rows, keys=rows, profiles=profiles, counts=counts, **more)
    forget(rows, before, profiles)
    return done


def extract_job(tables: BatchTables, source: DataFrame, run_id: str, sites: str | None = None, limit: int | None = None, restart: bool = False) -> int:
    """Extract what lies behind the filter's position, or everything with ``restart``; returns the number of rows.

    Rows and new position come to count together, so a run that fails is repeated from where it began, and one that
    is repeated under its ``run_id`` changes nothing.
    """
    last = None if restart else filter_position(tables.read("positions"), sites)
    rows = materialize(extract_increment(source, last, sites, limit))
    found = rows.count()
    if found:
        stage_batch(tables, run_id, to_staging(rows), positions=position_row(rows, sites))
    forget(rows)
    return found
