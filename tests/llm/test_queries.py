import duckdb
import pytest

from check import difference
from kinfold.llm.oracles import ORACLES
from kinfold.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_and_sql_agree(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert difference(QUERIES[name](spark, folder).toPandas(), con.execute(ORACLES[name]).df()) is None
