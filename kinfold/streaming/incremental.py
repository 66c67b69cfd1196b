"""Staging and linking as records arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold import schema
from kinfold.operators.model import LinkModel
from kinfold.plans.linkage import BatchReport, commit_batch, link_batch, pending_rows
from kinfold.plans.staging import stage_batch, to_staging
from kinfold.session import forget
from kinfold.sources.batches import BatchTables


def source_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder, in the contract's columns; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema.SOURCE)
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(path)


def stage_and_link(
    tables: BatchTables,
    model: LinkModel,
    threshold: float = 0.9,
    max_pairs: int | None = None,
    report: Callable[[BatchReport], None] | None = None,
    run_name: str = "stream",
) -> Callable[[DataFrame, int], None]:
    """Handler for ``foreachBatch``: stage a micro-batch, then link what is not linked yet.

    Both batches are named after the micro-batch, so one that is replayed after a failure changes nothing twice. What
    a micro-batch costs follows its rows and what they touch, see :func:`kinfold.plans.linkage.link_batch`.
    """

    def handle(rows: DataFrame, number: int) -> None:
        stage_batch(tables, f"{run_name}-{number}-staged", to_staging(rows))
        name = f"{run_name}-{number}"
        if tables.finished(name):
            return
        read_at = F.lit(rows.sparkSession.range(1).select(F.current_timestamp()).first()[0])
        batch = pending_rows(tables)
        if not batch.isEmpty():
            done = commit_batch(tables, name, link_batch(tables, batch, model, threshold, max_pairs=max_pairs), read_at)
            if report is not None:
                report(done)
        forget(batch)

    return handle


def start(source: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``handler`` over a source stream; ``available_now`` takes what is there, in micro-batches, and stops."""
    writer = source.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()

