"""Phrases whose words occur together more often than apart, counted by tries over a corpus."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.common import LOWER, UPPER, arrow_rows, give_back, pieces
from kinfold.llm.tries import build
from kinfold.session import forget, materialize

#: Phrases of one trie, on average, and bytes of phrases that a task holds to count them before equal ones are summed.
TRIE_PHRASES, COUNTED_BYTES = 1 << 16, 24 << 20
#: Buckets of a filter are a power of two, at least one for each word of the corpus, up to this power: 32 MB.
MOST_BUCKET_BITS = 28
#: Distinct words a task counts or remembers before it lets them go, and keys of a row, up to the end of a piece.
WORDS_HELD, KEYS_AT_ONCE = 100_000, 1 << 14
#: Buckets of a row of a filter, spans that buckets are summed in, and occurrences that a task holds before it sends them.
BLOCK, SPANS, BUCKETS_HELD = 1 << 15, 1 << 10, 1 << 20
#: The widest gap between two places of a span that 16 bits tell.
WIDEST = (1 << 16) - 1
#: Buckets of the filters for each span that candidates are listed in, up to SPANS of these.
BUCKETS_OF_SPAN = 1 << 17
#: Words that have a number in all rows: 20 MB for each task.
MOST_NUMBERED = 1 << 20
#: Keys of a packed row, and candidates that a task holds before it looks for those it holds twice.
PACKED_KEYS, LISTED_HELD = 1 << 16, 1 << 20
#: Texts, and packed rows of keys, that a task takes over at once.
TEXTS_AT_ONCE, ROWS_AT_ONCE = 256, 4
#: Of rows so long the writer must look at each: by itself it fills a page with a hundred, and pages are held whole.
LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}
#: Numbers of words compress well.
PACKED_ROWS = {**LONG_ROWS, "compression": "zstd"}
#: Characters that are split into words at once.
RUN = 1 << 20

#: Ends a piece. The byte occurs in no UTF-8 text.
_END = b"\xff"
_SPELLED = bytes.maketrans(b".,;:!?\n\x0b\x0c\r" + UPPER.encode(), _END * 10 + LOWER.encode())
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def words_of(texts: list[str]) -> list[bytes]:
    """The words of the texts in a row, with an end mark behind each piece."""
    data = _END.join(t.encode() for t in texts).translate(_SPELLED)
    # What is left of ASCII white space is blank and tab.
    return (data + _END).replace(_END, b" " + _END + b" ").split()


def _by_group(batch: pa.RecordBatch):
    """(group, texts) of a batch in runs of bounded size; columns are group and text."""
    groups = batch.column(0)
    for start, run in pieces(batch, "text", RUN):
        held: dict[str, list[str]] = {}
        for i, text in enumerate(run):
            if text:
                held.setdefault(groups[start + i].as_py(), []).append(text)
        yield from held.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """``group, word, n, key`` of all words of ``docs(group, text)``; ``key`` is a 64-bit hash of group and word."""

    def run(batches):
        counts: dict[str, Counter] = {}
        distinct = 0

        def rows():
            for group, found in counts.items():
                found.pop(_END, None)
                words = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(found), pa.string()), words, pa.array(found.values(), pa.int64())], ["group", "word", "n"])
            counts.clear()

        for batch in batches:
            for group, texts in _by_group(batch):
                own = counts.setdefault(group, Counter())
                distinct -= len(own)
                own.update(words_of(texts))
                distinct += len(own)
                if distinct > WORDS_HELD:
                    yield from rows()
                    distinct = 0
        yield from rows()
        give_back()

    found = docs.select("group", "text").mapInArrow(run, "group string, word string, n long")
    return found.groupBy("group", "word").agg(F.sum("n").alias("n")).withColumn("key", F.xxhash64("group", "word"))


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _hash(*keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the phrase whose words are the keys."""
    total = np.zeros(len(keys[0]), np.uint64)
    for key, odd in zip(keys, _ODD):
        total ^= key.view(np.uint64)
        total *= odd
        total ^= total >> np.uint64(29)
    return total * _ODD[0]


class Filter:
    """One bit for each bucket of a hash: whether a phrase of this hash may occur often enough."""

    def __init__(self, blocks: DataFrame, bits: int):
        """``blocks(block, bitmap)``: the bits of ``BLOCK`` buckets each. All of ``2**bits / 8`` bytes pass the driver."""
        self.bits = bits
        flags = np.zeros(max(BLOCK, 1 << bits) // 8, np.uint8)
        for block, bitmap in blocks.toLocalIterator():
            flags[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(bitmap, np.uint8)
        self.flags = blocks.sparkSession.sparkContext.broadcast(flags)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        bucket = _bucket(hashes, self.bits)
        return (self.flags.value[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1


class Numbers:
    """Numbers of the most frequent words: 0 is key 0, then they come by falling frequency."""

    def __init__(self, words: DataFrame, min_count: int, most: int):
        """``words(key, n)``: as many of them as ``most`` allows pass the driver, of which those of one ``n`` all or none."""
        sizes = words.filter(F.col("n") >= min_count).groupBy("n").agg(F.count(F.lit(1)).alias("words"))
        upto = F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n")))
        # A corpus has far fewer different counts than words.
        least = sizes.withColumn("upto", upto).filter(F.col("upto") <= most).agg(F.min("n")).first()[0]
        found = words.filter(F.col("n") >= least if least is not None else F.lit(False)).select("key", "n").toArrow()
        keys, n = (found.column(i).to_numpy() for i in range(2))
        keys = np.r_[np.int64(0), keys[np.argsort(-n, kind="stable")]]
        order = np.argsort(keys, kind="stable")
        self.sent = words.sparkSession.sparkContext.broadcast((keys, keys[order], order.astype(np.uint32)))

    def pack(self, keys: np.ndarray) -> tuple[bytes, bytes]:
        """The distinct keys that have no number, and a number for each key; these are numbered behind the rest.

        Numbers have four bytes, of which first come the lowest of all and last the highest: most of these are zero.
        """
        known, ordered, numbers = self.sent.value
        words, at = np.unique(keys, return_inverse=True)
        place = np.minimum(np.searchsorted(ordered, words), len(ordered) - 1)
        rare = ordered[place] != words
        number = numbers[place]
        number[rare] = len(known) + np.arange(rare.sum(), dtype=np.uint32)
        return words[rare].tobytes(), number[at].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()

    def unpack(self, words: pa.Scalar, numbers: pa.Scalar) -> np.ndarray:
        known, words = self.sent.value[0], np.frombuffer(words.as_buffer(), np.int64)
        number = np.ascontiguousarray(np.frombuffer(numbers.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        keys = known[np.minimum(number, len(known) - 1)]
        rare = number >= len(known)
        keys[rare] = words[number[rare] - len(known)]
        return keys


def _encoded(docs: DataFrame, often: Filter, numbers: Numbers | None = None) -> DataFrame:
    """``keys``: the corpus as 64-bit keys, zero for the end of a piece and for words that cannot be frequent.

    With ``numbers`` it is ``words, numbers`` of longer rows, as :meth:`Numbers.pack` gives them.
    """
    at_once, columns = (PACKED_KEYS, ["words", "numbers"]) if numbers else (KEYS_AT_ONCE, ["keys"])

    def run(batches):
        memory: dict[str, dict[bytes, int]] = {}
        held, size, distinct = [], 0, 0

        def rows():
            keys = np.concatenate(held)
            # Of zeros in a row one says it all.
            keys = keys[np.r_[True, (keys[1:] != 0) | (keys[:-1] != 0)]]
            ends = np.flatnonzero(keys == 0) + 1
            cuts = [0, *np.unique(ends[np.searchsorted(ends, np.arange(at_once, len(keys), at_once))]).tolist()]
            cuts += [len(keys)] * (cuts[-1] < len(keys))
            found = [numbers.pack(keys[a:b]) if numbers else (keys[a:b].tobytes(),) for a, b in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], columns)

        for batch in batches:
            for group, texts in _by_group(batch):
                known = memory.setdefault(group, {_END: 0})
                words = words_of(texts)
                new = [w for w in set(words) if w not in known]
                if new:
                    seed = xxhash.xxh64_intdigest(group.encode(), 42)
                    keys = np.array([xxhash.xxh64_intdigest(w, seed) for w in new], np.uint64)
                    known.update(zip(new, np.where(often.passes(keys), keys, np.uint64(0)).view(np.int64).tolist()))
                held.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                size += len(words)
                distinct += len(new) + 1
                if distinct > WORDS_HELD:
                    memory.clear()
                    distinct = 0
                if size >= at_once:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()
        held, known = [], {}
        memory.clear()
        give_back()

    return docs.select("group", "text").mapInArrow(run, ", ".join(f"{c} binary" for c in columns))


def _chunks(batches, numbers: Numbers | None = None):
    """The keys of the rows of a batch in a row, with a zero between rows; ``numbers`` are those they were packed with."""
    end = np.zeros(1, np.int64)
    for batch in batches:
        if numbers:
            rows = list(map(numbers.unpack, batch.column(0), batch.column(1)))
        else:
            rows = [np.frombuffer(value.as_buffer(), np.int64) for value in batch.column(0)]
        if rows:
            yield np.concatenate([part for row in rows for part in (row, end)][:-1])
    give_back()


def _frequent(corpus: DataFrame, kept: list[Filter], bits: int, min_count: int, numbers: Numbers | None = None) -> Filter:
    """The buckets of phrases one word longer than the last of ``kept`` speaks of that hold ``min_count`` occurrences.

    Tasks send what they counted as one row per span of buckets, places and counts, so that a span is summed as an
    array; only whether a count reaches ``min_count`` matters, so none goes beyond it. There are as many spans for
    many buckets as for few, so that rows grow with the corpus, not with corpus times buckets.
    """
    words, kind = len(kept) + 2, np.min_scalar_type(min_count)
    # A power of two of blocks, whose number is that of SPANS at most however many buckets there are.
    span = max(BLOCK, (1 << bits) // SPANS)

    def count(batches):
        def rows(held):
            bucket, n = np.unique(np.concatenate(held), return_counts=True)
            n = np.minimum(n, min_count).astype(kind)
            of, gap = bucket // span, np.diff(bucket, prepend=0)
            first = np.r_[True, of[1:] != of[:-1]]
            gap[first] = bucket[first] % span
            # A place is told by its distance to the one before; over wide gaps come places that count nothing.
            steps = np.maximum(gap - 1, 0) // WIDEST
            at = np.cumsum(steps + 1) - 1
            gaps, counts = np.full(at[-1] + 1, WIDEST, np.uint16), np.zeros(at[-1] + 1, kind)
            gaps[at], counts[at] = gap - steps * WIDEST, n
            starts = (at - steps)[first].tolist()
            spans = list(zip(starts, [*starts[1:], len(gaps)]))
            columns = [of[first], [gaps[a:b].tobytes() for a, b in spans], [counts[a:b].tobytes() for a, b in spans]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["span", "gaps", "counts"])

        held, size = [], 0
        for keys in _chunks(batches, numbers):
            starts = _candidates(keys, kept, words)
            held.append(_bucket(_hash(*[keys[starts + i] for i in range(words)]), bits))
            size += len(starts)
            if size > BUCKETS_HELD:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    def add(batches):
        at, total = None, np.zeros(span, np.uint64)

        def row():
            bitmaps = np.packbits(total >= min_count, bitorder="little").reshape(-1, BLOCK // 8)
            blocks = np.arange(len(bitmaps), dtype=np.int32) + at * len(bitmaps)
            return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([b.tobytes() for b in bitmaps], pa.binary())], ["block", "bitmap"])

        for batch in batches:
            for number, gaps, counts in zip(*(batch.column(i) for i in range(3))):
                if at is not None and number.as_py() != at:
                    yield row()
                    total[:] = 0
                at = number.as_py()
                total[np.cumsum(np.frombuffer(gaps.as_py(), np.uint16), dtype=np.int64)] += np.frombuffer(counts.as_py(), kind)
        if at is not None:
            yield row()

    found = corpus.mapInArrow(count, "span int, gaps binary, counts binary")
    dealt = found.repartition("span").sortWithinPartitions("span")
    return Filter(materialize(dealt.mapInArrow(add, "block int, bitmap binary")), bits)


def _candidates(keys: np.ndarray, kept: list[Filter], words: int) -> np.ndarray:
    """Places where a phrase of so many words stands all of whose shorter parts may be frequent."""
    good = np.ones(max(0, len(keys) - words + 1), bool)
    for i in range(words):
        good &= keys[i : i + len(good)] != 0
    for shorter, filter_ in enumerate(kept[: words - 1], 2):
        first = np.flatnonzero(good)
        for at in range(words - shorter + 1):
            first = first[filter_.passes(_hash(*[keys[first + at + i] for i in range(shorter)]))]
        good = np.zeros(len(good), bool)
        good[first] = True
    return np.flatnonzero(good)


def _thinned(found: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns of ``found`` without repeats, whose ``n`` are added up, but for those that another column with the same hash parts."""
    order = np.argsort(_hash(*found[: len(_ODD)]), kind="stable")
    found = found[:, order]
    new = np.flatnonzero(np.r_[True, (found[:, 1:] != found[:, :-1]).any(0)])
    return found[:, new], np.add.reduceat(n[order], new)


def _ordered(found: np.ndarray, of: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct columns of ``found``, their ``of`` and the sums of their ``n``, in order of ``of`` and column; a phrase comes before its continuations."""
    order = np.lexsort([*found[::-1].view(np.uint64), of])
    found, of = found[:, order], of[order]
    new = np.flatnonzero(np.r_[True, (found[:, 1:] != found[:, :-1]).any(0)])
    return found[:, new], of[new], np.add.reduceat(n[order], new)


def _planes(n: np.ndarray) -> bytes:
    """Counts of as many bytes as the largest needs, first the lowest byte of all: most of the others are zero."""
    wide = max(1, -(-int(n.max()).bit_length() // 8))
    return n.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()


def _unplaned(planes: np.ndarray, rows: int) -> np.ndarray:
    """What :func:`_planes` was given."""
    n = np.zeros((rows, 8), np.uint8)
    n[:, : len(planes) // rows] = planes.reshape(-1, rows).T
    return n.view("<i8").ravel().astype(np.int64)


def _front_coded(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A byte for each column of ``found``, its keys that the column before has not, and their number.

    The byte tells how many keys are shared with the column before (none where ``first``) and how many there are.
    """
    level = np.arange(len(found))
    shared = np.r_[0, np.logical_and.accumulate(found[:, 1:] == found[:, :-1]).sum(0)]
    shared[first] = 0
    long = (found != 0).sum(0)
    own = (level >= shared[:, None]) & (level < long[:, None])
    return (shared << 4 | long).astype(np.uint8), found.T[own], long - shared


def _front_decoded(marks: np.ndarray, keys: np.ndarray, words: int) -> np.ndarray:
    """What :func:`_front_coded` was given."""
    level, shared, long = np.arange(words), marks >> 4, marks & 15
    found = np.zeros((len(marks), words), np.int64)
    found[(level >= shared[:, None]) & (level < long[:, None])] = keys
    for i in range(words - 1):
        found[:, i] = found[np.maximum.accumulate(np.where(shared <= i, np.arange(len(marks)), 0)), i]
    return np.ascontiguousarray(found.T)


def _listed(corpus: DataFrame, kept: list[Filter], words: int, numbers: Numbers, spans: int, phrases: int = TRIE_PHRASES, most_bytes: int = COUNTED_BYTES) -> DataFrame:
    """``k1, k2, ..., place, n``: the distinct phrases that every filter lets pass, and how often they occur.

    A task looks at each place for the longest such phrase that starts there. It sends those it has found, and how
    often, as a row per span of places: in order, and without the words that a phrase shares with the one before. The
    same phrase comes from many tasks, so this is most of what is shuffled. Of what comes for a span tries are built,
    and walked by the same: a phrase also counts where a longer one goes on. So the corpus takes one pass, and the
    work follows what is sent, however many tries there are.
    """
    names = [f"k{i + 1}" for i in range(words)]

    def run(batches):
        held, size = [], 0

        def rows():
            found, n = (np.concatenate(parts, -1) for parts in zip(*held))
            found, of, n = _ordered(found, _place(found[0], found[1]) % spans, n)
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            marks, keys, own = _front_coded(found, starts)
            ends, at = [*starts[1:].tolist(), len(of)], np.r_[0, np.cumsum(own)]
            parts = list(zip(starts.tolist(), ends))
            columns = [of[starts], [marks[a:b].tobytes() for a, b in parts], *zip(*[numbers.pack(keys[at[a] : at[b]]) for a, b in parts]), [_planes(n[a:b]) for a, b in parts]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4))], ["span", "marks", "words", "numbers", "counts"])

        for keys in _chunks(batches, numbers):
            longest = np.zeros(len(keys), np.int8)
            for long in range(2, words + 1):
                longest[_candidates(keys, kept, long)] = long
            starts = np.flatnonzero(longest)
            if len(starts):
                found = np.stack([np.where(longest[starts] > i, keys[np.minimum(starts + i, len(keys) - 1)], 0) for i in range(words)])
                held.append(_thinned(found, np.ones(len(starts), np.int64)))
                size += held[-1][0].shape[1]
            if size > LISTED_HELD:
                held = [_thinned(*(np.concatenate(parts, -1) for parts in zip(*held)))]
                size = held[0][0].shape[1]
                if size > LISTED_HELD // 2:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    def merge(batches):
        room = max(1, most_bytes // (8 * words + 8))
        at, held, size, most = None, [], 0, room

        def row():
            sent, n = (np.concatenate(parts, -1) for parts in zip(*held))
            shorter = [np.where(np.arange(words)[:, None] < i, sent[:, sent[i] != 0], 0) for i in range(2, words)]
            found = np.concatenate([sent, *shorter], 1)
            found, place, _ = _ordered(found, _place(found[0], found[1]), np.zeros(found.shape[1], np.int64))
            tries, total = -(-len(place) // phrases), np.zeros(len(place), np.int64)
            of, sent_of = place // spans % tries, _place(sent[0], sent[1]) // spans % tries
            for number in range(tries):
                inside, walked = np.flatnonzero(of == number), np.flatnonzero(sent_of == number)
                if len(inside):
                    keys = np.ascontiguousarray(sent[:, walked].T).ravel()
                    total[inside] = build(np.ascontiguousarray(found[:, inside].T)).count(keys, np.arange(len(walked)) * words, n[walked])
            return pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(place), pa.array(total)], [*names, "place", "n"])

        for batch in batches:
            for span, marks, rare, number, counts in zip(*(batch.column(i) for i in range(5))):
                if at is not None and span.as_py() != at:
                    yield row()
                    held, size, most = [], 0, room
                at = span.as_py()
                marks = np.frombuffer(marks.as_buffer(), np.uint8)
                held.append((_front_decoded(marks, numbers.unpack(rare, number), words), _unplaned(np.frombuffer(counts.as_buffer(), np.uint8), len(marks))))
                size += len(marks)
                if size > most:
                    held = [_thinned(*(np.concatenate(parts, -1) for parts in zip(*held)))]
                    size = held[0][0].shape[1]
                    most = max(room, 2 * size)
        if at is not None:
            yield row()
        held = []
        give_back()

    found = corpus.mapInArrow(run, "span int, marks binary, words binary, numbers binary, counts binary")
    dealt = found.repartition("span").sortWithinPartitions("span")
    return dealt.mapInArrow(merge, ", ".join(f"{n} long" for n in names) + ", place int, n long")


def _place(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where a phrase belongs, by its first two words alone: a place of the corpus is counted by one trie."""
    return (_hash(first, second) >> np.uint64(34)).astype(np.int32) & 0x3FFFFFFF


def phrase_counts(spark: SparkSession, docs: DataFrame, words: DataFrame, longest: int, min_count: int, phrases: int = TRIE_PHRASES, most_bytes: int = COUNTED_BYTES, most_bits: int = MOST_BUCKET_BITS) -> DataFrame | None:
    """``k1, k2, ..., n`` of the phrases of 2 to ``longest`` words that occur ``min_count`` times in ``docs(group, text)``.

    ``words`` comes from :func:`word_counts`. Candidates are Apriori-safe: a phrase is only looked at where every
    shorter phrase in it may be frequent, judged by occurrences per bucket of a hash, which are never too few. Their
    exact counts come from tries. None if there is no such phrase.
    """
    total = words.agg(F.sum("n")).first()[0] or 0
    bits = max(18, min(most_bits, int(total).bit_length()))
    keys = words.filter(F.col("n") >= min_count).select(F.shiftrightunsigned("key", 64 - bits).alias("bucket"))
    blocks = keys.groupBy((F.col("bucket") / BLOCK).cast("int").alias("block")).agg(F.bitmap_construct_agg(F.col("bucket") % BLOCK).alias("bitmap"))
    often, numbers = Filter(blocks, bits), Numbers(words, min_count, MOST_NUMBERED)
    with arrow_rows(spark, TEXTS_AT_ONCE):
        corpus = materialize(_encoded(docs, often, numbers), **PACKED_ROWS)
    kept: list[Filter] = []
    with arrow_rows(spark, ROWS_AT_ONCE):
        for _ in range(2, longest + 1):
            kept.append(_frequent(corpus, kept, bits, min_count, numbers))
        spans = max(1, min(SPANS, (1 << bits) // BUCKETS_OF_SPAN))
        found = materialize(_listed(corpus, kept, longest, numbers, spans, phrases, most_bytes).drop("place").filter(F.col("n") >= min_count))
    for filter_ in (often, *kept):
        filter_.flags.destroy()
    numbers.sent.destroy()
    forget(corpus)
    return None if found.isEmpty() else found


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 38 digits: exact for counts up to 15 digits."""
    return F.expr(f"cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) div (cast({left} as decimal(15,0)) * cast({right} as decimal(15,0)))")


def _scored(found: DataFrame, single: DataFrame) -> DataFrame:
    """``group, k1, k2, k3, a, l, r, score`` of each phrase, by its lowest-scoring cut; of equal cuts the first."""
    first = single.select(F.col("key").alias("k1"), "group", F.col("n").alias("first"))
    last = single.select(F.col("key").alias("last_key"), F.col("n").alias("last"))
    pairs = found.filter("k3 = 0")
    left = pairs.select("k1", "k2", F.col("n").alias("head"))
    right = pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("n").alias("tail"))
    ends = found.withColumn("last_key", F.when(F.col("k3") == 0, F.col("k2")).otherwise(F.col("k3")))
    both = ends.join(last, "last_key").join(first, "k1").withColumnRenamed("n", "a").drop("last_key")
    of_two = both.filter("k3 = 0").select("group", "k1", "k2", "k3", "a", F.col("first").alias("l"), F.col("last").alias("r")).withColumn("score", _score("a", "l", "r"))
    of_three = both.filter("k3 <> 0").join(left, ["k1", "k2"]).join(right, ["k2", "k3"])
    of_three = of_three.withColumns({"early": _score("a", "first", "tail"), "late": _score("a", "head", "last")})
    of_three = of_three.select(
        "group", "k1", "k2", "k3", "a",
        F.expr("if(early <= late, first, head)").alias("l"), F.expr("if(early <= late, tail, last)").alias("r"), F.least("early", "late").alias("score"),
    )
    return of_two.unionByName(of_three)


def _inside_longer(found: DataFrame, share: int) -> DataFrame:
    """``k1, k2, most``: the pairs that phrases of three words hold, with the most occurrences of one of these."""
    longer = found.filter("k3 <> 0").select("n", F.explode(F.array(F.struct(F.col("k1").alias("k1"), F.col("k2").alias("k2")), F.struct(F.col("k2").alias("k1"), F.col("k3").alias("k2")))).alias("part"))
    return longer.groupBy("part.k1", "part.k2").agg((F.max("n") * 100).alias("most"))


def collocations(docs: DataFrame, group_column: str = "lang", text_column: str = "text", min_count: int = 10, keep: int = 2000, share: int = 50, unknown: str = "und", **limits: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``keep`` phrases of two and three words of each group.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and
    tabs. ``a`` counts a phrase, overlaps included, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words
    of the group; ``score`` is ``floor(1000000 * a * a / (l * r))``. Phrases of fewer than ``min_count`` occurrences
    are none, and one that a longer phrase holds goes if that occurs in ``share`` percent of its places or more. Ties
    go to more occurrences, then to the phrase that comes first in UTF-8.

    The corpus is read twice: to count words, and to write it as 64-bit hashes of words. Everything else reads those.
    Filters of bounded size leave the places where a phrase can be frequent; tries, of bounded size each, count these
    exactly. ``limits`` are those of :func:`phrase_counts`.

    Null and empty texts hold no words; rows of a null group count as ``unknown``. Repeated rows count each time, a
    text may be of any length, other columns are ignored, and an empty table gives no rows. Two words of one group
    count as one if their 64-bit hashes agree: for 10**8 distinct words the odds of any such pair are 3 in 10,000.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(group_column).cast("string"), F.lit(unknown)).alias("group"), F.col(text_column).alias("text"))
    with arrow_rows(spark, TEXTS_AT_ONCE):
        words = materialize(word_counts(source))
    found = phrase_counts(spark, source, words, 3, min_count, **limits)
    if found is None:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    single = materialize(words.filter(F.col("n") >= min_count))
    scored = _scored(found, single).join(_inside_longer(found, share), ["k1", "k2"], "left")
    scored = scored.filter((F.col("k3") != 0) | F.col("most").isNull() | (F.col("most") < F.col("a") * share)).drop("most")
    # Only phrases that may be among the first get their words: the tasks drop the rest before the shuffle.
    best = F.rank().over(Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a")))
    scored = materialize(scored.withColumn("best", best).filter(F.col("best") <= keep).drop("best"))
    for key in ("k1", "k2", "k3"):
        scored = scored.join(single.select(F.col("key").alias(key), F.col("word").alias(f"{key}_word")), key, "left" if key == "k3" else "inner")
    scored = scored.withColumn("phrase", F.concat_ws(" ", "k1_word", "k2_word", "k3_word"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    totals = words.groupBy("group").agg(F.sum("n").alias("n"))
    ranked = scored.withColumn("rank", rank).filter(F.col("rank") <= keep).join(totals, "group")
    return ranked.select(F.col("group").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
