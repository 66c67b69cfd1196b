"""Small helpers of this subpackage: shares of partitions, hot keys, files in the shared folder."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterable
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.session import checkpoint_root

#: The white space of the contracts: space and the five control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hot_keys(df: DataFrame, key: str, size: Column, tasks: int, share: float = 0.5) -> list:
    """Values of ``key`` that hold more than ``share`` of one task's rows or of its bytes.

    Rows are combined before the shuffle. At most ``2 * tasks / share`` values can qualify, which bounds what
    reaches the driver. The list steers only the layout of a shuffle, never a result.
    """
    sums = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    total = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    rows, size_ = (total["rows"] or 0) / tasks * share, (total["bytes"] or 0) / tasks * share
    found = sums.filter((F.col("rows") > 1) & ((F.col("rows") > rows) | (F.col("bytes") > size_)))
    return [r[0] for r in found.select(key).collect()]


def salt(key: Column, hot: Iterable, by: Column, tasks: int) -> Column:
    """0 for most rows; rows of a hot key are dealt over ``tasks`` values by ``by``."""
    hot = list(hot)
    return F.when(key.isin(hot), F.pmod(by, F.lit(tasks)).cast("int")).otherwise(0) if hot else F.lit(0)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own below the shared one, made by nobody yet."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system behind a folder of the cluster, as tasks see it: local, HDFS or an object store."""
    if re.match(r"file:/+", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, jobs read Parquet and hand Python at most so many rows at once: rows may be long, and a batch is held several times."""
    keys = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    before = [spark.conf.get(key) for key in keys]
    for key in keys:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, beside others that work."""
    pa.default_memory_pool().release_unused()
    # Not every C library has it.
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """(first row, texts) of a batch in runs of about ``limit`` characters, so that memory follows one run."""
    values = batch.column(batch.schema.get_field_index(column))
    run, start, size = [], 0, 0
    for i in range(len(values)):
        text = values[i].as_py()
        run.append(text)
        size += len(text or "")
        if size >= limit:
            yield start, run
            run, start, size = [], i + 1, 0
    if run:
        yield start, run
