import gzip
import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest

from kinfold.llm.common import fresh_folder, open_store
from kinfold.llm.warc import LoserTree, mark_revisits, merge_runs, read_archives, url_key, write_archives

SCHEMA = "page_id long, url string, captured_at timestamp, html string, digest string, first int, file string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows():
    long_ = "<p>long " * 40
    texts = [
        (5, "http://Example.com:80/b?q=1#x", long_),
        (3, "https://user@example.com/b?q=1", long_),
        (3, "https://user@example.com/b?q=1", long_),
        (9, "http://example.com/a", long_ + "!"),
        (None, "http://example.com/a", long_),
        (None, None, None),
        (11, None, ""),
        (12, "not a url", "short"),
        (13, "", "short"),
        (14, "http://x.org", "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 20),
        (15, "http://x.org/\n/é", "é" * 400_000),
    ]
    return [(i, u, None if n == 4 else START + timedelta(seconds=n % 3), h, "d", 1, "f") for n, (i, u, h) in enumerate(texts)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("limit", [1, 1 << 25])
def test_round_trip(spark, limit):
    """Whatever the size of the archives, every row comes back; equal long payloads refer to the smallest id."""
    runs = write_archives(frame(spark, rows()), fresh_folder(spark, "warc"), archive_bytes=limit)
    found = read_archives(runs, "bigint").collect()
    least = {}
    for r in rows():
        h = (r[3] or "").encode()
        if len(h) >= 100 and r[0] is not None:
            least[h] = min(r[0], least.get(h, r[0]))
    expected = []
    for r in rows():
        h = (r[3] or "").encode()
        to = least.get(h)
        to = None if to is None or to == r[0] else to
        expected.append((r[0], len(h), hashlib.sha256(h).hexdigest(), "response" if to is None else "revisit", to, h if to is None else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    # Offsets lead to records, and whole archives are gzip files.
    entry = runs.filter("page_id = 9").first()
    store, at = open_store(entry["file"])
    with store.open_input_file(at) as f:
        whole = f.read()
    assert gzip.decompress(whole[entry["offset"] : entry["offset"] + entry["length"]]).startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert gzip.decompress(whole).count(b"WARC-Record-ID") >= 1


def test_index_is_merged_in_order(spark):
    rng = random.Random(1)
    data = [(i, f"http://h{rng.choice('aab')}.org/{rng.choice('xxy')}", START + timedelta(seconds=rng.randint(0, 9)), "h", "d", 1, "f") for i in range(400)]
    runs = write_archives(frame(spark, data).repartition(5), fresh_folder(spark, "warc"), run_records=17)
    assert runs.select("run").distinct().count() > 20
    for ranges in (1, 7):
        found = merge_runs(runs, ranges).orderBy("range", "place").collect()
        keys = [(r["url_key"], r["captured_at"], r["page_id"]) for r in found]
        assert keys == sorted(keys) and len(keys) == 400
        seen = {}
        for r in found:
            seen[r["url_key"]] = seen.get(r["url_key"], 0) + 1
            assert r["capture"] == seen[r["url_key"]]


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        assert list(LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_key():
    assert url_key("https://User@Sub.Example.com:8080/A?b=C#d") == "com,example,sub)/a?b=c"
    assert [url_key(x) for x in (None, "", "plain", "http://x.org")] == ["-", "-", "plain", "org,x)/"]


def test_empty_table(spark):
    runs = write_archives(frame(spark, []), fresh_folder(spark, "warc"))
    assert runs.count() == 0 and merge_runs(runs).count() == 0 and read_archives(runs, "bigint").count() == 0
    assert mark_revisits(frame(spark, [])).count() == 0
