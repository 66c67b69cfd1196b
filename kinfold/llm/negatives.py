"""Hard negatives: rows of other labels that score almost as high for an anchor as its own kind."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.common import partitions
from kinfold.llm.hyperplanes import HIGHEST, LOWEST, SLACK, Queries, Tree, alive, between, far_apart, lifted, ranges
from kinfold.session import materialize

#: Rows of one tree; a larger cell is dealt over several.
TREE_ROWS = 4096
#: Split points of the first level at most, rows they are chosen from, and label buckets.
MOST_POINTS, POINT_SAMPLE, LABEL_BUCKETS = 64, 4096, 16
#: Questions that a task searches for at once.
ASKED = 8192


def vectors(table: DataFrame, id_column: str, label: Column, vector_column: str, scale: int) -> DataFrame:
    """``id, label, vec`` with ``floor(scale * x)`` for each component; rows with nulls or non-finite components go."""
    whole = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = table.select(F.col(id_column).alias("id"), label.alias("label"), F.col(vector_column).alias(vector_column)).filter("id is not null and label is not null").filter(whole)
    return kept.select("id", "label", F.transform(vector_column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vec"))


def _block(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


class _Cells:
    """The first level: split points, the cell and label bucket of each row, and what ranges they have."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        size = F.col("vec")
        found = rows.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.size(size)).alias("dims"),
            F.max(F.aggregate(size, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))).alias("longest"),
        ).first()
        self.n, self.dims, self.longest = found.n, found.dims or 0, found.longest or 0.0
        # No product of two rows is larger than the square of the longest.
        if self.longest >= 2.0**62:
            raise ValueError("inner products do not fit 64 bits")
        self.exact = self.longest < 2.0**52
        self.points = max(2, min(MOST_POINTS, -(-self.n // (8 * TREE_ROWS))))
        if not self.n or not self.dims:
            return
        padded = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), self.dims - F.size("vec"))).alias("vec")
        sample = rows.select("id", padded).filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < max(1, int(POINT_SAMPLE / self.n * (1 << 20))))
        taken = sample.limit(POINT_SAMPLE).collect() or rows.select("id", padded).limit(1).collect()
        self.split = far_apart(lifted(np.array([r.vec for r in sorted(taken)], np.int64), self.longest), self.points)
        split, dims, longest = self.split, self.dims, self.longest

        def place(batches):
            for batch in batches:
                cells = between(lifted(_block(batch, "vec", dims), longest), split).argmin(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

        bucket = F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int")
        kind = {c: t for c, t in rows.dtypes}
        placed = rows.select(F.xxhash64("id", "label", "vec").alias("row"), "id", "label", padded, bucket.alias("bucket"))
        placed = materialize(placed.mapInArrow(place, f"row long, id {kind['id']}, label {kind['label']}, vec array<bigint>, bucket int, cell int"))
        counts = {(r.bucket, r.cell): r.n for r in placed.groupBy("bucket", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        number = len(split)

        def measure(batches):
            low, high = np.full((LABEL_BUCKETS, number, number), np.inf), np.full((LABEL_BUCKETS, number, number), -np.inf)
            for batch in batches:
                away, of, cells = between(lifted(_block(batch, "vec", dims), longest), split), batch.column("bucket").to_numpy(), batch.column("cell").to_numpy()
                for b in np.unique(of):
                    least, most = ranges(away[of == b], cells[of == b], number)
                    low[b], high[b] = np.minimum(low[b], least), np.maximum(high[b], most)
            b, i, j = np.nonzero(np.isfinite(low))
            columns = [b.astype(np.int32), i.astype(np.int32), j.astype(np.int32), low[b, i, j], high[b, i, j]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["bucket", "point", "cell", "low", "high"])

        bounds = placed.mapInArrow(measure, "bucket int, point int, cell int, low double, high double").groupBy("bucket", "point", "cell")
        self.low, self.high = np.full((LABEL_BUCKETS, number, number), np.inf), np.full((LABEL_BUCKETS, number, number), -np.inf)
        for r in bounds.agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            self.low[r.bucket, r.point, r.cell], self.high[r.bucket, r.point, r.cell] = r.low, r.high
        self.parts = {group: -(-n // TREE_ROWS) for group, n in counts.items()}
        table = spark.createDataFrame([(b, c, n) for (b, c), n in self.parts.items()], "bucket int, cell int, parts int")
        part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        self.rows = placed.join(F.broadcast(table), ["bucket", "cell"]).withColumn("part", part).drop("parts")


def _searched(cells: _Cells, asked: DataFrame, k: int, same_label: bool) -> DataFrame:
    """``row, question, score, found_id``: the best ``k`` rows of each tree for each question of ``asked``.

    ``asked(row, id, label, vec, bucket, windows)`` holds an anchor per row and its windows ``least, most`` of scores.
    An anchor goes to the cells that may hold a row in one of its windows, and meets each tree of a cell in the task
    that holds it; trees of one task follow one another, and anchors come in bounded batches.
    """
    split, low, high, parts, dims, longest, exact = cells.split, cells.low, cells.high, cells.parts, cells.dims, cells.longest, cells.exact
    room = SLACK * (np.sqrt(longest) + 1)
    groups = sorted(parts)

    def route(batches):
        for batch in batches:
            flat = _block(batch, "vec", dims).astype(np.float64)
            away = between(np.concatenate([flat, np.zeros((len(flat), 1))], 1), split)
            base = (flat * flat).sum(1) + longest
            windows = batch.column("windows")
            of = windows.value_parent_indices().to_numpy(zero_copy_only=False)
            bounds = [windows.flatten().field(i).to_numpy().astype(np.float64) for i in (1, 0)]
            inner, outer = (np.sqrt(np.maximum(base[of] - 2 * b, 0.0)) for b in bounds)
            own = batch.column("bucket").to_numpy()
            for bucket in sorted({b for b, _ in groups}):
                may = alive(away[of], low[bucket], high[bucket], inner, outer, room)
                reached = np.zeros((batch.num_rows, may.shape[1]), bool)
                np.logical_or.at(reached, of, may)
                if same_label:
                    reached &= (own == bucket)[:, None]
                for cell in np.flatnonzero(reached.any(0)):
                    found = batch.filter(pa.array(reached[:, cell])).drop_columns(["bucket"])
                    for part in range(parts.get((bucket, int(cell)), 0)):
                        place = [pa.array(np.full(found.num_rows, x, np.int32)) for x in (bucket, cell, part)]
                        yield pa.RecordBatch.from_arrays([*place, *found.columns], ["bucket", "cell", "part", *found.schema.names])

    kind = dict(asked.dtypes)
    columns = ["row", "id", "label", "vec", "windows"]
    routed = asked.select(*columns, "bucket").mapInArrow(route, "bucket int, cell int, part int, " + ", ".join(f"{c} {kind[c]}" for c in columns))
    placed = cells.rows.withColumns({"role": F.lit(0), "windows": F.lit(None).cast(kind["windows"])})
    order = ["bucket", "cell", "part", "role", *columns]
    both = placed.select(*order).unionByName(routed.withColumn("role", F.lit(1)).select(*order))
    # Written in the order it is read, so that a tree's rows stand in front of its anchors.
    tasks = max(partitions(cells.rows.sparkSession), sum(parts.values()))
    dealt = both.repartition(min(tasks, 10_000), "bucket", "cell", "part").sortWithinPartitions("bucket", "cell", "part", "role")

    def search(batches):
        at, held, tree = None, [], None

        def numbers(batch):
            return np.stack([batch.column(i).to_numpy() for i in range(3)], 1)

        for batch in batches:
            where, roles = numbers(batch), batch.column("role").to_numpy()
            marks = np.concatenate([where, roles[:, None]], 1)
            cuts = np.r_[0, np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1, len(marks)] if len(marks) else np.array([0])
            for first, end in zip(cuts, cuts[1:]):
                if at != tuple(where[first]):
                    at, held, tree = tuple(where[first]), [], None
                own = batch.slice(first, end - first)
                if not roles[first]:
                    held.append((own.column("id").to_numpy(), own.column("label").to_numpy(), _block(own, "vec", dims)))
                    continue
                if not held and tree is None:
                    continue
                if tree is None:
                    tree = Tree(*(np.concatenate(c) for c in zip(*held)), longest, exact)
                    held = []
                for start in range(0, own.num_rows, ASKED):
                    some = own.slice(start, ASKED)
                    windows = some.column("windows")
                    of = windows.value_parent_indices().to_numpy(zero_copy_only=False)
                    least, most, question = (windows.flatten().field(i).to_numpy() for i in range(3))
                    queries = Queries(some.column("id").to_numpy(), some.column("label").to_numpy(), _block(some, "vec", dims), of, least, most, k, same_label)
                    tree.best(queries)
                    asked_, scores, ids = queries.answers()
                    rows = some.column("row").to_numpy()[of[asked_]]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (rows, question[asked_], scores, ids))], ["row", "question", "score", "found_id"])

    return dealt.mapInArrow(search, "row long, question int, score long, found_id long")


def _first(found: DataFrame, k: int) -> DataFrame:
    best = F.row_number().over(Window.partitionBy("row", "question").orderBy(F.desc("score"), "found_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k)


def hard_negatives(
    table: DataFrame,
    anchors: Column,
    label: Column | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` marks.

    A row's score is its inner product with the anchor, over components ``floor(scale * x)``; higher scores come
    first, of equal ones the smaller id. The positives of an anchor are its first ``positives`` other rows of the same
    label. For each of them come the first ``negatives`` rows of other labels whose score is from ``least_percent`` to
    ``most_percent`` of the positive's; none if that is no interval, as for a negative score. ``anchors`` is a condition
    on ``id``, ``label`` may be any expression over ``table``, by default its column ``label``.

    Rows go to cells by label bucket and nearest split point, large cells to several trees. Cells, and in each
    tree subtrees, are left out where the triangle inequality shows that they hold nothing within an anchor's
    windows; leaves are compared exactly. The split points come from a sample of at most POINT_SAMPLE rows, which
    changes no result. Anchors are shuffled to the cells they reach; nothing grows with the table but these rows.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Vectors of different length
    are filled up with zeros. Rows repeated in full count once; rows of one id are never candidates of each other, and
    each is an anchor of its own. Ids and labels are integers; an empty table, or one label alone, gives no rows.
    Products that do not fit 64 bits raise.
    """
    spark = table.sparkSession
    rows = vectors(table, id_column, F.col("label") if label is None else label, vector_column, scale)
    rows = materialize(rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "vec").distinct())
    cells = _Cells(rows)
    if not cells.n or not cells.dims:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    asked = materialize(cells.rows.filter(anchors).select("row", "id", "label", "vec", "bucket"))
    window = "array<struct<least:bigint,most:bigint,question:int>>"
    everything = F.array(F.struct(F.lit(int(LOWEST)).alias("least"), F.lit(int(HIGHEST)).alias("most"), F.lit(0).alias("question"))).cast(window)
    kin = materialize(_first(_searched(cells, asked.withColumn("windows", everything), positives, True), positives))
    bounds = kin.select(
        "row",
        F.struct(
            F.ceil(F.col("score").cast("decimal(20,0)") * least_percent / 100).cast("long").alias("least"),
            F.floor(F.col("score").cast("decimal(20,0)") * most_percent / 100).cast("long").alias("most"),
            F.col("rank").alias("question"),
        ).alias("window"),
    ).filter("window.least <= window.most")
    windows = bounds.groupBy("row").agg(F.collect_list("window").cast(window).alias("windows"))
    found = _first(_searched(cells, asked.join(windows, "row"), negatives, False), negatives)
    found = found.select("row", "question", "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    kin = kin.select("row", F.col("rank").alias("question"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = found.join(kin, ["row", "question"]).join(asked.select("row", F.col("id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
