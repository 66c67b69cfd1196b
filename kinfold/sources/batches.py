"""Tables that grow batch by batch: a batch is one partition of each table it adds to, and counts once it is marked."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold import schema
from kinfold.session import delete, exists
from kinfold.settings import DEFAULT_SETTINGS, LinkSettings
from kinfold.sources.tables import latest_per_key

_MARKS = T.StructType([T.StructField("name", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("batch_id", T.LongType())])
# Tables whose latest row per key counts; of the others every row does.
_KEYED = {"staging": "record_id", "keys": "record_id", "links": "record_id", "forest": "number", "positions": "sites"}


class BatchTables:
    """Tables under one folder, each partitioned by ``batch_id``, for one writer at a time.

    ``staging`` holds the staged records, ``keys`` the profile of each, ``profiles`` the compared columns of each
    profile, ``counts`` what each batch adds to the frequencies of values, ``links`` the number a record was given,
    ``forest`` the numbers that were merged and what into, ``positions`` how far extractions came. Beside them lies the
    block index, a bucketed table (:meth:`blocks`).

    Batches are numbered from 1 on. The mark, written last, makes one count in all its tables at once. What a run that
    died before its mark has left bears the number that comes next, and the next batch begins by deleting it.
    ``buckets`` belongs to the folder and must stay as it was.
    """

    def __init__(self, spark: SparkSession, root: str, settings: LinkSettings = DEFAULT_SETTINGS, buckets: int = 32):
        self.spark, self.root, self.settings, self.buckets = spark, root.rstrip("/"), settings, buckets
        self._last: int | None = None
        compared = [schema.STAGING[c] for c in settings.columns]
        self.layouts = {
            "staging": schema.STAGING,
            "keys": schema.KEYS,
            "profiles": T.StructType([T.StructField("profile", T.StringType()), *compared]),
            "counts": schema.COUNTS,
            "links": schema.CLUSTERS,
            "forest": schema.FOREST,
            "positions": schema.POSITIONS,
        }

    def marks(self) -> DataFrame:
        path = f"{self.root}/marks"
        return self.spark.read.schema(_MARKS).parquet(path) if exists(self.spark, path) else schema.empty(self.spark, _MARKS)

    def last(self) -> int:
        """The number of the last batch that counts; 0 before the first. Looked up once: there is no other writer."""
        if self._last is None:
            self._last = self.marks().agg(F.max("batch_id")).first()[0] or 0
        return self._last

    def finished(self, name: str) -> bool:
        return not self.marks().filter(F.col("name") == name).isEmpty()

    def _put(self, table: str, number: int, df: DataFrame) -> None:
        numbered = df.withColumn("batch_id", F.lit(number).cast("long"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.root}/{table}")

    def _mark(self, number: int, name: str) -> None:
        row = self.spark.createDataFrame([(name,)], "name string").withColumn("at", F.current_timestamp())
        self._put("marks", number, row.coalesce(1))

    def write(self, name: str, **frames: DataFrame) -> bool:
        """One batch of rows for the named tables; False if a batch of this name counts already."""
        if self.finished(name):
            return False
        number = self.last() + 1
        for table in self.layouts:
            delete(self.spark, f"{self.root}/{table}/batch_id={number}")
        for table, df in frames.items():
            self._put(table, number, schema.conform(df, self.layouts[table]))
        self._mark(number, name)
        self._last = number
        return True

    def rows(self, table: str) -> DataFrame:
        """Every row of the batches that count, with its ``batch_id``."""
        layout, path = self.layouts[table], f"{self.root}/{table}"
        layout = T.StructType([*layout.fields, T.StructField("batch_id", T.LongType())])
        if not exists(self.spark, path):
            return schema.empty(self.spark, layout)
        return self.spark.read.schema(layout).parquet(path).filter(F.col("batch_id") <= self.last())

    def read(self, table: str, among: DataFrame | None = None) -> DataFrame:
        """The latest row per key; with ``among``, of the keys that it lists, which are picked before anything moves."""
        key, rows = _KEYED[table], self.rows(table)
        if among is not None:
            rows = rows.join(among.select(key).distinct(), key, "left_semi")
        return latest_per_key(rows, [key], [F.desc("batch_id")]).select(*self.layouts[table].names)

    def blocks(self) -> DataFrame:
        """``rule, block, profile`` of every profile, bucketed by rule and block: joins on them leave it where it lies.

        Rows are only ever added. Some may come twice, or belong to a batch that never came to count; ``keys`` tells.
        """
        name = self._index()
        # A stream adds rows in a session of its own, which this one's list of files does not know of.
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def add_blocks(self, rows: DataFrame) -> None:
        name = self._index()
        rows.select("rule", "block", "profile").repartition(self.buckets, "rule", "block").write.insertInto(name)

    def _index(self) -> str:
        name = "blocks_" + hashlib.md5(self.root.encode()).hexdigest()
        folder = self.root.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (rule INT, block BIGINT, profile STRING) USING parquet "
            f"CLUSTERED BY (rule, block) INTO {self.buckets} BUCKETS LOCATION '{folder}/blocks'"
        )
        return name
