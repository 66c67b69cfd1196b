import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F


from kinfold.llm.sharding import jump_hash, shard
from tests.llm.rows import awkward, frame


def jump(key: int, buckets: int) -> int:
    at, last = 0, -1
    while at < buckets:
        last = at
        key = (key * 2862933555777941757 + 1) % 2**64
        at = int((last + 1) * (2.0**31 / ((key >> 33) + 1)))
    return last


def seed(value) -> int:
    return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("shards", [1, 2, 16, 300])
def test_jump_hash(spark, shards):
    found = spark.range(300).select("id", jump_hash(F.col("id"), shards).alias("j")).collect()
    assert [(r["id"], r["j"]["shard"], r["j"]["grown"]) for r in sorted(found)] == [(i, jump(seed(i), shards), jump(seed(i), shards + 1)) for i in range(300)]
    # One more shard takes rows only into itself.
    assert all(r["j"]["grown"] in (r["j"]["shard"], shards) for r in found)


@pytest.mark.parametrize("group_rows", [500_000, 1])
def test_slots(spark, group_rows):
    """The numbering does not depend on the number of groups, has no gaps and no repeats."""
    found = shard(frame(spark), 3, group_rows=group_rows).collect()
    rows = awkward()
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sorted((repr(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in found:
        assert r["shard"] == jump(seed(r["doc_id"]), 3) and r["law"] == "key"
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    other = shard(frame(spark), 3, group_rows=7).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, other)))


def test_empty_table(spark):
    assert shard(frame(spark, []), 4).count() == 0
    with pytest.raises(ValueError):
        shard(frame(spark), 0)
