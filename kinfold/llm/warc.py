"""WARC archives with repeated payloads as revisits, and their index merged from sorted runs."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import open_store, partitions
from kinfold.session import materialize

#: Bytes after which an archive is closed and the next one begun, and records in a run of the index at most.
ARCHIVE_BYTES, RUN_RECORDS = 32 << 20, 50_000
#: Shorter payloads are always written in full.
REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Rows of the index that splitters are drawn from, for each range.
SAMPLE = 50

INDEX = "url_key string, captured_at timestamp, page_id {id}, run string, place int, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host without port, then path and query, in lower case; ``-`` for none."""
    if not url:
        return "-"
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)", url)
    if not found:
        return url.lower()
    return ",".join(reversed(found[1].lower().split("."))) + ")" + (found[2] or "/").lower()


def _header(value: str) -> str:
    """A value that stays on its line: control characters are written as percent codes."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value) if re.search(r"[\x00-\x1f\x7f]", value) else value


def _record(page_id, url, at: datetime, payload: bytes, digest: str, refers_to) -> bytes:
    """A record as its own gzip member; a revisit holds the headers of the response only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:capture:{'' if page_id is None else _header(str(page_id))}>"),
        ("WARC-Date", at.strftime("%Y-%m-%dT%H:%M:%SZ")),
        *([("WARC-Target-URI", _header(url))] if url else []),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:capture:{refers_to}>")] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def mark_revisits(pages: DataFrame) -> DataFrame:
    """Add ``digest`` and ``refers_to`` to ``page_id, url, captured_at, html``.

    Only digests are grouped, combined before the shuffle; of these, those that occur twice join the pages, where
    adaptive execution splits a frequent one.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "captured_at", "html").withColumns({"html": html, "digest": F.sha2(html.cast("binary"), 256)})
    long_ = rows.filter(F.octet_length("html") >= REVISIT_BYTES)
    first = long_.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("digest").alias("_digest"), "first")
    joined = rows.join(first, F.col("digest") == F.col("_digest"), "left")
    later = F.col("first").isNotNull() & (F.octet_length("html") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "captured_at", "html", "digest", F.when(later, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, run_records: int = RUN_RECORDS) -> DataFrame:
    """Write a record for each row of ``pages(page_id, url, captured_at, html)`` and return the sorted runs of the index.

    Of records with equal payloads of at least REVISIT_BYTES bytes, that with the smallest id holds the payload and
    the others refer to it; rows that repeat this id are responses too. A null payload is empty, a null id sorts
    behind all others and is never referred to, a null URL has no target and the key ``-``, a null time is 1970.

    Each task fills archives of about ``archive_bytes``; a record is a gzip member, so offsets lead to records. With
    each archive goes a run of index rows sorted by (URL key, time, id). A repeated task writes archives of its own,
    and only those that the returned runs name count.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = mark_revisits(pages.select("page_id", "url", F.coalesce("captured_at", F.timestamp_seconds(F.lit(0))).alias("captured_at"), "html"))

    def run(batches):
        store, at = open_store(folder)
        store.create_dir(at, recursive=True)
        out, name, size, entries = None, "", 0, []

        def close():
            out.close()
            # Null ids last, and never compared with others.
            entries.sort(key=lambda e: _order(e[:3]))
            columns = list(zip(*[(*e[:3], name, i, f"{folder}/{name}", e[3], e[4]) for i, e in enumerate(entries)]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["url_key", "captured_at", "page_id", "run", "place", "file", "offset", "length"])

        types = None
        for batch in batches:
            types = [pa.string(), pa.timestamp("us", "UTC"), batch.schema.field("page_id").type, pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            for page_id, url, when, html, digest, refers_to in zip(*batch.columns):
                if out is None:
                    name, size, entries = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = store.open_output_stream(f"{at}/{name}", compression=None)
                when = when.as_py().astimezone(timezone.utc)
                packed = _record(page_id.as_py(), url.as_py(), when, html.as_py().encode("utf-8", "surrogatepass"), digest.as_py(), refers_to.as_py())
                out.write(packed)
                entries.append((url_key(url.as_py()), when, page_id.as_py(), size, len(packed)))
                size += len(packed)
                if size >= archive_bytes or len(entries) >= run_records:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return materialize(rows.mapInArrow(run, INDEX.format(id=kind)))


def _order(key: tuple) -> tuple:
    return (key[0], key[1], key[2] is None, 0 if key[2] is None else key[2])


class LoserTree:
    """Merges k sorted lists: inner nodes hold the losers of their matches, so the next item costs log k comparisons."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * self.k
        self.winner = self._play(1) if self.k else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, node: int) -> int:
        """Winner below ``node``; runs are the leaves k to 2k - 1."""
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.heads[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merge_runs(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The index in global order: ``url_key, captured_at, page_id, file, offset, length, range, place``, then
    ``capture`` (number of the capture in the history of its URL, from 1).

    Splitters drawn from the runs cut the keys (URL key, time, id) into ranges of about equal size, so that a URL with
    very many captures spans ranges. Each run is cut at the splitters into slices, which stay sorted and travel as one
    row each; a task merges the slices of a range with a loser tree. (range, place) is the global order.
    """
    spark = runs.sparkSession
    total = runs.count()
    ranges = ranges or max(1, min(partitions(spark), total // 1000))
    kind = runs.schema["page_id"].dataType.simpleString()
    share = min(1.0, 2.0 * SAMPLE * ranges / max(total, 1))
    drawn = runs.select("url_key", "captured_at", "page_id").filter(F.pmod(F.xxhash64("file", "offset"), F.lit(1 << 20)) < int(share * (1 << 20))) if ranges > 1 else None
    sample = sorted(_order((r[0], r[1].astimezone(timezone.utc), r[2])) for r in drawn.collect()) if drawn is not None else []
    splitters = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    names = ["url_key", "captured_at", "page_id", "file", "offset", "length"]
    entry = f"url_key string, captured_at timestamp, page_id {kind}, file string, offset long, length long"
    fields = ", ".join(f"{x.split(' ')[0]}: {x.split(' ')[1]}" for x in entry.split(", "))

    def cut(batches):
        for batch in batches:
            kinds = pa.struct([batch.schema.field(n) for n in names])
            slices, last = [], None
            for run, row in zip(batch.column("run").to_pylist(), batch.select(names).to_pylist()):
                to = (run, bisect_right(splitters, _order((row["url_key"], row["captured_at"].astimezone(timezone.utc), row["page_id"]))))
                if to != last:
                    slices.append((to[1], []))
                    last = to
                slices[-1][1].append(row)
            if slices:
                yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in slices], pa.int32()), pa.array([s[1] for s in slices], pa.list_(kinds))], ["range", "slice"])

    def merge(batches):
        current, held, kinds = None, [], None

        def merged():
            tree = LoserTree(held, lambda r: _order((r["url_key"], r["captured_at"], r["page_id"])))
            rows = list(tree)
            return pa.RecordBatch.from_arrays(
                [*pa.array(rows, kinds).flatten(), pa.array([current] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32())], [*names, "range", "place"]
            )

        for batch in batches:
            kinds = batch.schema.field("slice").type.value_type
            for range_, slice_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                if range_ != current and held:
                    yield merged()
                    held = []
                current = range_
                held.append(slice_.as_py())
        if held:
            yield merged()

    sliced = runs.select("run", "place", *names).mapInArrow(cut, f"range int, slice array<struct<{fields}>>")
    ordered = sliced.repartition(ranges, "range").sortWithinPartitions("range")
    out = materialize(ordered.mapInArrow(merge, f"{entry}, range int, place int"))
    # Captures of a URL in the ranges before: one row per range and URL, of which only URLs at a border have several.
    parts = out.groupBy("url_key", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("url_key", "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    capture = (F.col("place") - F.col("first") + F.col("before") + 1).cast("bigint")
    return out.join(parts, ["url_key", "range"]).select(*names, "range", "place", capture.alias("capture"))


def read_archives(runs: DataFrame, id_type: str) -> DataFrame:
    """``file, offset, page_id, url, captured_at, record_type, refers_to, payload_bytes, payload_digest, payload`` of
    every record of the archives that ``runs`` names.

    A task streams through whole archives, one record in memory at a time. For a response, length and digest are
    taken from the payload itself and the digest is checked; a revisit has them in its headers and no payload.
    """
    files = runs.select("file").distinct()
    kind = {"bigint": int, "int": int, "smallint": int, "tinyint": int}.get(id_type, str)
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(id_type, pa.string())
    types = [pa.string(), pa.int64(), arrow_id, pa.string(), pa.timestamp("us", "UTC"), pa.string(), arrow_id, pa.int64(), pa.string(), pa.binary()]
    names = ["file", "offset", "page_id", "url", "captured_at", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

    def ident(value: str):
        found = value.removeprefix("<urn:capture:").removesuffix(">")
        return kind(found) if found else None

    def records(file: str):
        store, at = open_store(file)
        with store.open_input_stream(at, compression=None) as source:
            unpack, raw, start, place, data = zlib.decompressobj(31), [], 0, 0, b""
            while data or (data := source.read(1 << 20)):
                raw.append(unpack.decompress(data))
                place += len(data) - len(unpack.unused_data)
                data = unpack.unused_data
                if unpack.eof:
                    yield start, b"".join(raw)
                    start, raw, unpack = place, [], zlib.decompressobj(31)

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size = [], 0
                for offset, raw in records(file):
                    fields, block = _parse(raw)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    full = fields["WARC-Type"] == "response"
                    if full:
                        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"damaged record in {file} at {offset}")
                    when = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
                    refers = None if full else ident(fields["WARC-Refers-To"])
                    rows.append((file, offset, ident(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), when, fields["WARC-Type"], refers, length, digest, payload if full else None))
                    size += len(payload)
                    if size > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = f"file string, offset long, page_id {id_type}, url string, captured_at timestamp, record_type string, refers_to {id_type}, payload_bytes long, payload_digest string, payload binary"
    # A task for each archive: adaptive execution would see a short list of names and put it into one.
    listed = materialize(files)
    return listed.repartition(max(1, listed.count())).mapInArrow(run, schema)
