"""Sources: files, relational tables, SQL."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from kinfold.operators.sampling import first_n


@dataclass(frozen=True)
class SourceSpec:
    """Where records come from.

    ``kind`` is a file format (parquet, orc, csv, json), ``table`` (catalog) or ``jdbc``. A relational source reads
    in parallel when ``bounds`` lists ascending key values: one read per range between them.
    """

    kind: str
    location: str
    table: str | None = None
    key: str = "NOMOR_INDUK"
    bounds: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)


def key_ranges(key: str, bounds: tuple[str, ...]) -> list[str]:
    """Conditions that split a key space at ``bounds``; together they cover every key exactly once."""
    marks = [b.replace("'", "''") for b in bounds]
    if not marks:
        return ["1 = 1"]
    inner = [f"{key} >= '{low}' AND {key} < '{high}'" for low, high in zip(marks, marks[1:])]
    return [f"{key} < '{marks[0]}' OR {key} IS NULL", *inner, f"{key} >= '{marks[-1]}'"]


def jdbc_url(default: str) -> str:
    """The environment decides over the configuration."""
    return os.environ.get("DATABASE_URL", default)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.kind == "table":
        return spark.table(spec.location)
    if spec.kind == "jdbc":
        if spec.table is None:
            raise ValueError("a relational source needs a table")
        properties = {k: str(v) for k, v in spec.options.items()}
        return spark.read.jdbc(jdbc_url(spec.location), spec.table, predicates=key_ranges(spec.key, spec.bounds), properties=properties)
    return spark.read.format(spec.kind).options(**spec.options).load(spec.location)


def read_query(spark: SparkSession, query: str, last_id: str | None = None, limit: int | None = None, key: str = "record_id") -> DataFrame:
    """A source query of the caller's own, with ``:last_id`` bound as a value.

    ``LIMIT :limit`` stands for the number of rows wanted: without one all rows come, and with one those of the
    smallest keys, chosen by a distributed cut instead of an ordered limit in one task.
    """
    unlimited = re.sub(r"(?i)\blimit\s+:limit\b", "LIMIT ALL", query)
    rows = spark.sql(unlimited, args={"last_id": "" if last_id is None else last_id})
    return rows if limit is None else first_n(rows, key, limit)


def append(df: DataFrame, location: str, kind: str = "parquet", table: str | None = None, batch_rows: int = 1000, **options: str) -> None:
    """Bulk append; a relational target receives ``batch_rows`` rows per statement."""
    if kind == "jdbc":
        df.write.option("batchsize", batch_rows).jdbc(jdbc_url(location), table, mode="append", properties=options)
    else:
        df.write.mode("append").format(kind).options(**options).save(location)

