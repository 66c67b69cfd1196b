"""Registered queries beside their SQL; ``check.py`` runs all of them."""

import re
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, difference

CHOSEN = (
    "normalize_names", "normalize_documents", "clean_documents", "extract_custom_sql", "case_inner_fanout_latest", "staging_upsert",
    "profile_report", "tf_table", "pairs_all_rules", "new_vs_all_pairs", "order_date_levels", "scored_pairs_debug", "em_one_iteration",
    "resolve_batch", "resolve_batch_gaps", "apply_merges", "extract_half", "tf_merged", "nik_compose_decode", "inject_duplicates",
)


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query_agrees_with_sql(spark, folder, con, name):
    assert difference(queries()[name](spark, folder).toPandas(), con.execute(oracle_sql()[name]).df()) is None


def test_registry(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["record_id", "cluster_id", "cif_number"]


def test_registry_without_the_optional_parts(monkeypatch):
    """A module that is gone, or whose packages are, takes only its own queries with it."""
    everything = set(queries())
    monkeypatch.setitem(sys.modules, "kinfold.llm.queries", None)
    with pytest.warns(UserWarning, match="left out"):
        assert set(queries()) == {q for q in everything if not re.match("op[0-9]|pipeline$", q)}
        assert set(oracle_sql()) <= set(queries())
