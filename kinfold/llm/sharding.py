"""Shards by jump consistent hashing (Lamping and Veach 2014) in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Multiplier of the generator in the published algorithm, 2862933555777941757, as 16-bit limbs from the low end.
LIMBS = [2862933555777941757 >> s & 0xFFFF for s in (0, 16, 32, 48)]
#: Jumps after which nearly every key has landed: it makes about ln(shards) of them.
USUAL_JUMPS = 40
#: Rows of one shard that one numbering group holds on average.
GROUP_ROWS = 500_000


def _digest(value: Column) -> Column:
    return F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def _hex(digest: Column, at: int, digits: int) -> Column:
    return F.conv(F.substring(digest, at, digits), 16, 10).cast("bigint")


def jump_hash(key: Column, shards: int) -> Column:
    """Struct ``shard, grown``: the bucket of ``key`` among ``shards`` buckets, and among one more.

    The key, of any type, is read as text (null: empty) and the first 64 bits of its MD5 seed the generator. 64-bit
    products are formed on 16-bit limbs, so that nothing overflows. One walk answers both counts: the last bucket
    below each of them.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    digest, zero, m = _digest(key), F.lit(0).cast("bigint"), LIMBS
    start = F.struct(*[_hex(digest, 13 - 4 * i, 4).alias(n) for i, n in enumerate("abcd")], *[zero.alias(n) for n in ("at", "shard", "grown")])

    def jump(s: Column, _: Column) -> Column:
        a, b, c, d = (s[x] for x in "abcd")
        r0 = a * m[0] + 1
        r1 = a * m[1] + b * m[0] + F.shiftright(r0, 16)
        r2 = a * m[2] + b * m[1] + c * m[0] + F.shiftright(r1, 16)
        r3 = a * m[3] + b * m[2] + c * m[1] + d * m[0] + F.shiftright(r2, 16)
        limbs = [x.bitwiseAND(F.lit(0xFFFF).cast("bigint")) for x in (r0, r1, r2, r3)]
        top = F.shiftleft(limbs[3], 15).bitwiseOR(F.shiftright(limbs[2], 1)) + 1
        to = F.floor((s["at"] + 1).cast("double") * (F.lit(2147483648.0) / top.cast("double"))).cast("bigint")
        kept = F.when(s["at"] < shards, s["at"]).otherwise(s["shard"])
        moved = F.struct(*[x.alias(n) for x, n in zip(limbs, "abcd")], to.alias("at"), kept.alias("shard"), s["at"].alias("grown"))
        return F.when(s["at"] > shards, s).otherwise(moved)

    def walk(jumps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, jump)

    # Each jump goes to a higher bucket, so shards + 2 of them always suffice.
    if shards + 2 <= USUAL_JUMPS:
        return walk(shards + 2)
    short = walk(USUAL_JUMPS)
    return F.when(short["at"] > shards, short).otherwise(walk(shards + 2))


def shard(docs: DataFrame, shards: int, key_column: str = "doc_id", text_column: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    The key alone decides the shard; with one more shard, rows move only into the new one. Slots number the rows of a
    shard from 0 without gaps, in the order of a hash of (key, size, checksum). That hash cuts each shard into groups
    of equal chance, as many as the row count asks for; groups are numbered inside, and their counts, one row per
    group, give the offsets. The numbering does not depend on how many groups there are.

    Size is the UTF-8 length plus 1. A null text has size 1 and checksum 0; null keys share one shard. Repeated rows
    get slots of their own. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(key_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(F.col(key_column), shards).alias("_jump"),
    )
    order = _digest(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32"))
    groups = max(1, -(-docs.count() // (shards * group_rows)))
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.col("_jump.shard").cast("int").alias("shard"), F.col("_jump.grown").cast("int").alias("grown_shard"), order.alias("_order")
    )
    # The leading bits of the order choose the group, so groups follow each other in that order.
    rows = rows.withColumn("_group", F.shiftright(_hex(F.col("_order"), 1, 8) * groups, 32).cast("int"))
    counts = rows.groupBy("shard", "_group").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_group").orderBy("_order", F.col("doc_id").asc_nulls_first())
    numbered = rows.withColumn("_slot", F.row_number().over(inside) - 1)
    # One row per group of ``group_rows`` rows: small against the data, and known from the count above.
    placed = numbered.join(F.broadcast(offsets) if groups * shards <= 100_000 else offsets, ["shard", "_group"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_slot") + F.col("_before")).cast("bigint").alias("slot"), "grown_shard")
