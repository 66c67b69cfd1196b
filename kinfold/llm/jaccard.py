"""Links between texts whose word shingles overlap: a similarity join with PartEnum signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import partitions
from kinfold.llm.signatures import difference_bound, mix, shingle_set, signatures
from kinfold.operators.components import connected_components
from kinfold.session import forget, materialize

#: Sets that one task compares with the same first set, at least.
STAR_ROWS = 4_000
#: Documents whose signatures are looked at to lay out the shuffle of all signatures.
PROBE_DOCS = 20_000
#: Sets beside the same first set whose differences meet in one task; more are dealt over several by the differences.
REST_ROWS = 1_000
#: Pairs that a task holds before it lets them go.
PAIRS_HELD = 1 << 18
#: Words of 64 bits of a set's parity sketch.
SKETCH = 8
#: Copies of one set, and documents of the probe with one signature, that never count as many.
LARGE_CLASS, OFTEN = 1_000, 50


def _class_of(elements: np.ndarray) -> int:
    """A 64-bit name of a set; -1 is kept for the empty one."""
    total = np.sum(mix(elements), dtype=np.uint64, keepdims=True) + np.uint64(len(elements))
    name = int(mix(total).view(np.int64)[0])
    return name if name != -1 else -2


def _sketch(elements: np.ndarray) -> np.ndarray:
    """Parities of the elements dealt over ``64 * SKETCH`` bits, as integers.

    The bits in which the sketches of two sets differ are no more than the elements in which the sets do.
    """
    odd = np.bincount(((mix(elements) >> np.uint64(32)) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingle_classes(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class``: equal shingle sets have equal classes, rows without words none."""

    def run(batches):
        for batch in batches:
            sizes, names = [], []
            for text in batch.column(2):
                elements = shingle_set(text.as_py(), words)
                sizes.append(len(elements))
                names.append(_class_of(elements) if len(elements) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(names, pa.int64())], ["doc_id", "text_hash", "n_shingles", "class"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, class long")


def _keepers(classes: DataFrame) -> DataFrame:
    """``class, keep_id, keep_hash``: the row that stands for a class, one of smallest id; null ids come last."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = classes.filter("class is not null").groupBy("class").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
    return least.select("class", F.col("place.doc_id").alias("keep_id"), F.col("place.text_hash").alias("keep_hash"), "n")


def _texts_of(wanted: DataFrame, keepers: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``wanted`` with the text of their class. Repeated rows have one text and count once."""
    held = wanted.join(keepers.select("class", "keep_id", "keep_hash"), "class")
    same = (F.col("keep_hash") == F.col("text_hash")) & F.col("keep_id").eqNullSafe(F.col("doc_id"))
    return held.join(docs, same).drop("keep_id", "keep_hash", "doc_id", "text_hash")


def _signature_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``sig, class`` of every text, in batches of bounded size."""

    def run(batches):
        def batch_of(found, names):
            sizes = list(map(len, found))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(np.array(names, np.int64), sizes))], ["sig", "class"])

        for batch in batches:
            found, names, size = [], [], 0
            for text in batch.column(0):
                elements = shingle_set(text.as_py(), words)
                if not len(elements):
                    continue
                found.append(signatures(elements, percent))
                names.append(_class_of(elements))
                size += len(found[-1])
                if size > 1 << 18:
                    yield batch_of(found, names)
                    found, names, size = [], [], 0
            if found:
                yield batch_of(found, names)

    return docs.select("text").mapInArrow(run, "sig long, class long")


def _stars(docs: DataFrame, classes: DataFrame, words: int, percent: int, share: float) -> DataFrame:
    """Distinct pairs ``low, class``: each class beside the centre of those that have the same signature.

    The signatures cross one shuffle, and only those that two classes share go on. One that an unusual share of the
    documents has, judged by a probe of bounded size, is dealt over all tasks by class. Rows of a large group of
    copies are left out before: one of them stands for all.
    """
    spark = docs.sparkSession
    tasks = partitions(spark)
    rows = classes.count()
    # Copies beyond a fraction of a task's rows: few classes can be so large, at most tasks / share of them.
    most = max(LARGE_CLASS, int(rows / tasks * share))
    large = _keepers(classes).filter(F.col("n") > most)
    same = F.col("keep_hash").eqNullSafe(F.col("text_hash")) & F.col("keep_id").eqNullSafe(F.col("doc_id"))
    copies = classes.join(F.broadcast(large), "class").filter(~same).select("doc_id", "text_hash").distinct()
    source = docs
    if not large.isEmpty():
        source = docs.alias("d").join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.text_hash") == F.col("c.text_hash")), "left_anti")
    probe = docs
    if rows > PROBE_DOCS:
        probe = probe.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(PROBE_DOCS / rows * (1 << 20)))
    probed = min(rows, PROBE_DOCS)
    # A third of a task's signatures, if each document had a hundred.
    often = max(OFTEN, int(probed * 100 / tasks * share))
    hot = _signature_rows(probe, words, percent).groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > often).select("sig", F.lit(True).alias("hot"))
    hot = materialize(hot) if often < probed else None
    found = _signature_rows(source, words, percent)
    split = hot is not None and not hot.isEmpty()
    if split:
        found = found.join(F.broadcast(hot), "sig", "left").withColumn("part", F.when(F.col("hot"), F.pmod(F.hash("class"), F.lit(tasks))).otherwise(0))
    else:
        found = found.withColumns({"part": F.lit(0), "hot": F.lit(None).cast("boolean")})
    near = Window.partitionBy("sig", "part")
    found = found.select("sig", "class", "hot", F.min("class").over(near).alias("low"), F.max("class").over(near).alias("high"))
    shared = materialize(found.filter((F.col("low") < F.col("high")) | F.col("hot")).select("sig", "class").distinct())
    # The class with the most shared signatures is in most of the groups around it, so few classes serve as centres.
    degree = shared.groupBy("class").agg(F.count(F.lit(1)).alias("degree"))
    placed = shared.join(degree, "class")
    centre = placed.groupBy("sig").agg(F.max(F.struct("degree", "class")).alias("top")).select("sig", F.col("top.class").alias("low"))
    pairs = shared.join(centre, "sig").filter(F.col("low") != F.col("class"))
    return pairs.select("low", "class").distinct()


def _compared(docs: DataFrame, keepers: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """``low, class, linked, n, apart, delta, sketch`` of each pair, by the full shingle sets.

    ``n`` is the size of the set of ``class`` and ``apart`` the number of elements in which the two sets differ. These
    in an order that is the same for all sets beside one ``low``, first those that ``low`` has not, are ``delta``, as
    far as they can matter to :func:`_rest_pairs`. Half of each hash is enough there: what it confuses is compared again.
    Repeated rows of one document may give a pair twice.

    Each text is fetched once per pair it is the second of. The texts to be compared with the same first text meet
    in one stretch of a sorted partition, or in several if they are many; a task holds two sets at a time.
    """
    counts = pairs.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    stars = counts.select("low", F.ceil(F.col("n") / STAR_ROWS).cast("int").alias("parts"))
    first = stars.select("low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("low").alias("class"), F.lit(0).alias("role"))
    second = pairs.join(stars, "low").select("low", F.pmod(F.hash("class"), F.col("parts")).alias("part"), "class", F.lit(1).alias("role"))
    texts = _texts_of(first.union(second), keepers, docs).select("low", "part", "class", "role", "text")
    ordered = texts.repartition("low", "part").sortWithinPartitions("low", "part", "role")

    def run(batches):
        centre, own = None, None
        for batch in batches:
            rows = []
            for low, part, name, role, text in zip(*(batch.column(i) for i in range(5))):
                elements = shingle_set(text.as_py(), words)
                if role.as_py() == 0:
                    # A repeated row would give the same set again.
                    centre, own = (low.as_py(), part.as_py()), elements
                    continue
                if centre != (low.as_py(), part.as_py()):
                    raise RuntimeError("a star without its first set")
                n = len(elements)
                at = np.minimum(np.searchsorted(own, elements), len(own) - 1)
                held = own[at] == elements
                common = int(held.sum())
                apart = n + len(own) - 2 * common
                linked = common > 0 and 100 * common >= percent * (n + len(own) - common)
                most = difference_bound(n, n * 100 // percent + 1, percent) + 1
                delta = elements[~held][:most]
                if len(delta) < most:
                    delta = np.r_[delta, np.delete(own, at[held])[: most - len(delta)]]
                rows.append((low.as_py(), name.as_py(), linked, n, apart, (delta >> np.uint64(32)).astype(np.uint32).view(np.int32), _sketch(elements)))
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["low", "class", "linked", "n", "apart", "delta", "sketch"])

    return ordered.mapInArrow(run, "low long, class long, linked boolean, n long, apart long, delta array<int>, sketch array<bigint>")


def _differing_alike(stars: pa.Table, percent: int):
    """``low, class`` of the pairs within a ``low, part`` of ``stars`` that share a difference and may link."""
    low, part, name, root, n, apart = (stars.column(i).to_numpy() for i in range(6))
    sketches = stars.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)
    delta = stars.column("delta").combine_chunks()
    long = pc.list_value_length(delta).to_numpy()
    row = np.repeat(np.arange(len(low)), long)
    at = np.arange(len(row)) - np.repeat(np.cumsum(long) - long, long)
    some = stars.column("at").combine_chunks()
    if some.null_count < len(some):
        at[np.repeat(some.is_valid().to_numpy(zero_copy_only=False), long)] = some.flatten().to_numpy()
    star = np.cumsum(np.r_[0, (low[1:] != low[:-1]) | (part[1:] != part[:-1])])
    # Equal differences of one star become neighbours.
    key = star[row] << 32 | delta.flatten().to_numpy().view(np.uint32).astype(np.int64)
    order = np.argsort(key)
    key, row, left = key[order], row[order], apart[row[order]] - at[order]
    found, size = [], 0

    def pairs():
        both = np.unique(np.concatenate(found, 1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["low", "class"])

    first, step = np.arange(len(key)), 0
    while len(first):
        step += 1
        first = first[first + step < len(key)]
        first = first[key[first] == key[first + step]]
        a, b = row[first], row[first + step]
        sizes = n[a] + n[b]
        reach = 2 * np.minimum(left[first], left[first + step]) - apart[a] - apart[b]
        may = (name[a] != name[b]) & (root[a] != root[b]) & (n[a] * 100 >= n[b] * percent) & (n[b] * 100 >= n[a] * percent)
        may &= reach * (100 + percent) + (100 - percent) * sizes >= 0
        a, b, sizes = a[may], b[may], sizes[may]
        differ = np.bitwise_count(sketches[a] ^ sketches[b]).sum(1, dtype=np.int64)
        may = differ * (100 + percent) <= (100 - percent) * sizes
        a, b = name[a[may]], name[b[may]]
        found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        size += len(a)
        if size > PAIRS_HELD:
            yield pairs()
            found, size = [], 0
    if size:
        yield pairs()


def _rest_pairs(compared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs ``low, class`` of different components that may still link, from what they differ in from one ``low``.

    Linked sets share a signature and hence a ``low`` that both were compared with. Say they differ from it in D1 and
    D2. They differ from each other in ``|D1| + |D2| - 2 |D1 and D2|`` elements; if the bound k allows that without
    any common difference, one of them links to ``low``, and since its set is close, so does the other. Otherwise
    they share a difference. The first shared one, at places i and j, leaves at most ``min(|D1| - i, |D2| - j)``
    shared ones; what cannot reach ``(|D1| + |D2| - k) / 2`` is never formed, nor is a pair whose sketches differ in
    more than k bits. So texts that have much in common with ``low``, but each differ from it in their own way, or
    were changed in the same places by different words, do not meet.

    A set crosses the shuffle once with all its differences; of a large star each part gets some of these.
    """
    placed = compared.drop("linked").join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("component", "class"))
    mixed = placed.groupBy("low").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("rows")).filter(F.col("least") < F.col("most"))
    rows = placed.filter(F.size("delta") > 0).join(mixed.select("low", F.ceil(F.col("rows") / REST_ROWS).cast("int").alias("parts")), "low")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Null stands for all places.
    places = F.expr("if(parts > 1, filter(sequence(0, size(delta) - 1), i -> pmod(hash(delta[i]), parts) = part), null)")
    rows = rows.withColumn("at", places).filter("at IS NULL OR size(at) > 0")
    rows = rows.select("low", "part", "class", "root", "n", "apart", "sketch", F.expr("if(at IS NULL, delta, transform(at, i -> delta[i]))").alias("delta"), "at")
    dealt = rows.repartition("low", "part").sortWithinPartitions("low", "part")

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            low, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = int(np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (part[1:] != part[:-1])])[-1])
            # The last star may go on in the next batch.
            if cut or held and (held[-1].column(0)[-1], held[-1].column(1)[-1]) != (batch.column(0)[0], batch.column(1)[0]):
                yield from _differing_alike(pa.Table.from_batches([*held, batch.slice(0, cut)]), percent)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from _differing_alike(pa.Table.from_batches(held), percent)

    return dealt.mapInArrow(run, "low long, class long").distinct()


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80, share: float = 0.3) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash, kept`` for each row of ``docs``.

    Two texts link when ``100 * |common shingles| >= percent * |all shingles|`` of their sets of distinct word shingles;
    the component is the smallest id that links reach. Texts of fewer words than a shingle are one shingle; null,
    empty and blank texts have none and link with nothing, and a null id names no component unless all of it is null.
    Repeated rows and texts of equal sets are one class and get the same component. ``text_hash`` tells rows of the
    same id apart; texts under one id are documents of their own, though their components may then have one name.
    ``kept`` marks one document of each component, the one of smallest id (null ids last) and text hash, and every
    document without shingles; rows repeated in full are one document.

    No link is lost, though the pairs of a group are not formed: classes that share a signature are compared with one
    of them each (stars), and what they differ in from it tells which others have to be compared.
    """
    text = F.col(text_column)
    source = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    classes = materialize(shingle_classes(source, words))
    keepers = materialize(_keepers(classes))
    stars = materialize(_stars(source, classes, words, percent, share))
    compared = materialize(_compared(source, keepers, stars, words, percent))
    links = compared.filter("linked").select(F.col("low").alias("src"), F.col("class").alias("dst"))
    roots = materialize(connected_components(links))
    known = compared.select(F.least("low", "class").alias("low"), F.greatest("low", "class").alias("class"))
    rest = materialize(_rest_pairs(compared, roots, percent).join(known, ["low", "class"], "left_anti"))
    if not rest.isEmpty():
        more = _compared(source, keepers, rest, words, percent).filter("linked").select(F.col("low").alias("src"), F.col("class").alias("dst"))
        more = materialize(more)
        if not more.isEmpty():
            roots = materialize(connected_components(links.union(more)))
    named = keepers.join(roots, F.col("class") == F.col("node"), "left").select("class", "keep_id", "keep_hash", F.coalesce("component", "class").alias("root"))
    place = F.struct(F.col("keep_id").isNull().alias("none"), "keep_id", "keep_hash")
    first = named.groupBy("root").agg(F.min(place).alias("first"))
    grouped = materialize(named.join(first, "root").select("class", F.col("first.keep_id").alias("first_id"), F.col("first.keep_hash").alias("first_hash")))
    forget(keepers, stars, compared, rest, roots)
    kept = F.col("class").isNull() | (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")))
    joined = classes.join(grouped, "class", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("first_id", "doc_id").alias("component_id"), "text_hash", kept.alias("kept"))
