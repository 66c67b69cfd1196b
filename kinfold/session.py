"""Cutting lineage: intermediate results go to the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of a query as it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, one beside the warehouse's tables."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate")
    return sc.getCheckpointDir()


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library's own; nothing happens where there is none."""
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def forget(*frames: DataFrame) -> None:
    """Delete what :func:`materialize` wrote for these, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_written_to", None)
        if path is not None:
            delete(df.sparkSession, path)


def reading(df: DataFrame, written: DataFrame) -> DataFrame:
    """``df``, which alone still reads ``written``: to forget it is to delete that."""
    df._written_to = written._written_to
    return df


@contextmanager
def _shuffles_deleted(spark: SparkSession):
    """Queries run within it leave no shuffle files; each runs once, so that nothing reads them again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    One job, unlike ``checkpoint()`` which runs the last stage twice; the files outlive executors, and the
    planner sees their true size. What was shuffled for it is deleted. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
    with _shuffles_deleted(spark):
        df.write.options(**options).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_to = path
    return written
