"""What intermediate results leave on disk."""

import time

from pyspark.sql import functions as F

from kinfold.session import CLEANUP, forget, materialize


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffles_go_once_their_result_is_written(spark):
    before, conf = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(10_000).groupBy((F.col("id") % 97).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    written = materialize(rows.join(rows.withColumnRenamed("n", "m").hint("merge"), "key"))
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP, None) == conf
    assert written.count() == 97 and rows.count() == 97
    forget(written)
