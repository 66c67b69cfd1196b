"""Secrets in texts: clear ones by pattern, doubtful ones where the other parts of a credential stand near."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import pieces
from kinfold.session import materialize

#: Parts whose starts are at most so many characters apart may belong to one credential.
REACH = 400

# What is a secret by itself, as (kind, pattern, least length of the last group).
CLEAR = [
    ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    ("access", r"(AKIA[A-Z0-9]+)", 18),
    ("hex", r"([0-9a-f]+)", 16),
]
# The kinds of all spans in the order of equal starts, and what the linked ones look like.
KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
IDENTIFIER = r"""\b(?ai:(?:access_?key_?|client_?|tenant_?|account_?)id|account_?name|user_?name|user|login)\b["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
NAMED_SECRET = r"""\b(?ai:secret_?access_?key|private_?key|access_?key|passphrase|pass|pwd)\b["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})"""
LONE_SECRET = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,100}+(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""\b(?:[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|(?ai:host(?:_?name)?|endpoint|server|bucket)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{3,})"""
#: A value of the clear patterns that is too short there but counts beside an identifier.
SHORT_SECRET = 6

_CLEAR = [re.compile(pattern) for _, pattern, _ in CLEAR]
# Of a run of hexadecimal digits only its length matters; short ones need not be looked at one by one.
_CLEAR[2] = re.compile(r"([0-9a-f]{16,})")
_IDENTIFIER, _NAMED, _LONE, _ENDPOINT = map(re.compile, (IDENTIFIER, NAMED_SECRET, LONE_SECRET, ENDPOINT))
_BLANK_LINE = re.compile(r"\n[ \t\r]*(?=\n)")

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_PART = "array<struct<start:int,kind:int,end:int,scope:int>>"


def clear_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of what is a secret by itself, in order, and (start, end) of assignments too short for it."""
    found, short = [], []
    for kind, (pattern, (_, _, least)) in enumerate(zip(_CLEAR, CLEAR)):
        if kind == 1 and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            size = len(m[m.lastindex])
            if size >= least:
                found.append((m.start(), kind, m.end()))
            elif kind == 0 and size >= SHORT_SECRET:
                short.append(m.span())
    return sorted(found), short


def doubtful_parts(text: str, clear: list[tuple[int, int, int]], short: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, scope) of everything that may be part of a credential, clear parts included.

    Without an identifier nothing doubtful is ever reported; the text is then not searched further.
    """
    identifiers = [(m.start(), 3, m.end()) for m in _IDENTIFIER.finditer(text)]
    known = [s for s in clear if s[1] < 2]
    if not identifiers and not any(kind == 1 for _, kind, _ in known):
        return []
    taken = sorted([(s, e) for s, _, e in clear] + [(s, e) for s, _, e in identifiers])
    starts, reached = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))

    def free(start: int, end: int) -> bool:
        at = bisect_right(starts, end - 1)
        return not at or reached[at - 1] <= start

    secrets = {span for span in short if free(*span)} | {m.span() for m in _NAMED.finditer(text) if free(*m.span())}
    named = sorted(secrets)
    for m in _LONE.finditer(text):
        value, at = m[0], bisect_right(named, (m.end(),)) - 1
        mixed = any(map(str.isdigit, value)) and any(map(str.isupper, value)) and any(map(str.islower, value))
        if mixed and free(*m.span()) and (at < 0 or named[at][1] <= m.start()):
            secrets.add(m.span())
    endpoints = [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    parts = known + identifiers + [(s, 4, e) for s, e in secrets] + endpoints
    ends = [m.start() for m in _BLANK_LINE.finditer(text)]
    return sorted((start, kind, end, bisect_right(ends, start)) for start, kind, end in parts)


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, clear, parts`` of each row of ``docs(doc_id, text_hash, text)``."""

    def run(batches):
        for batch in batches:
            for start, run_ in pieces(batch, "text"):
                clear, parts = [], []
                for text in run_:
                    found, short = clear_spans(text or "")
                    clear.append([dict(zip(("start", "kind", "end"), s)) for s in found])
                    parts.append([dict(zip(("start", "kind", "end", "scope"), p)) for p in (doubtful_parts(text, found, short) if text else [])])
                span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
                part = pa.struct([*span, pa.field("scope", pa.int32())])
                own = batch.slice(start, len(run_))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(clear, pa.list_(span)), pa.array(parts, pa.list_(part))], ["doc_id", "text_hash", "clear", "parts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, f"doc_id {kind}, text_hash long, clear {_SPAN}, parts {_PART}")


#: The roles of the parts: a column for each, and the kind that plays it.
_ROLES = {"clear_secret": 0, "clear_identifier": 1, "identifier": 3, "secret": 4, "endpoint": 5}


def linked_spans(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, text_hash, start, kind, end``: the doubtful ones of ``parts`` whose complements are in reach.

    ``parts(doc_id, text_hash, start, kind, end, scope)`` are those of :func:`doubtful_parts`. Two parts are in reach
    of each other if they have one scope and their starts are at most ``reach`` apart. Reported are an identifier
    beside a clear secret, or beside a doubtful secret and an endpoint; a secret beside a clear identifier, or beside a
    doubtful identifier and an endpoint; an endpoint beside an identifier and a secret of any sort.

    An interval join: each scope is cut into bins of ``reach`` characters, a bin offers the first and last start of
    each role, and the interval of a part overlaps three bins. Nothing in the bin before can lie too far behind but by
    its last start, nothing in the one after but by its first, so two numbers per role decide, and no pairs are formed.
    """
    by = ["doc_id", "text_hash", "scope", "bin"]
    placed = parts.withColumn("bin", F.floor(F.col("start") / reach).cast("int"))
    is_role = lambda kind: F.when(F.col("kind") == kind, F.col("start"))
    offers = [f(is_role(kind)).alias(f"{name}_{which}") for name, kind in _ROLES.items() for f, which in ((F.min, "first"), (F.max, "last"))]
    offered = placed.groupBy(*by).agg(*offers).withColumnsRenamed({b: f"offered_{b}" for b in by})
    asked = placed.filter(F.col("kind") >= 3).withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    same = F.col("doc_id").eqNullSafe(F.col("offered_doc_id"))
    for b in by[1:]:
        same = same & (F.col(b) == F.col(f"offered_{b}"))
    met = asked.join(offered, same)

    def near(role: str) -> Column:
        meets = (F.col(f"{role}_last") >= F.col("start") - reach) & (F.col(f"{role}_first") <= F.col("start") + reach)
        return F.coalesce(F.max(meets), F.lit(False)).alias(f"near_{role}")

    found = met.groupBy("doc_id", "text_hash", "start", "kind", "end").agg(*map(near, _ROLES))
    has = {role: F.col(f"near_{role}") for role in _ROLES}
    whole = (
        F.when(F.col("kind") == 3, has["clear_secret"] | (has["secret"] & has["endpoint"]))
        .when(F.col("kind") == 4, has["clear_identifier"] | (has["identifier"] & has["endpoint"]))
        .otherwise((has["clear_identifier"] | has["identifier"]) & (has["clear_secret"] | has["secret"]))
    )
    return found.filter(whole).select("doc_id", "text_hash", "start", "kind", "end")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = REACH) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_linked, clear, spans, text_hash`` of each row of ``docs``.

    ``clear`` lists as ``kind:start:end`` what is a secret by itself, ``spans`` also the ``n_linked`` doubtful parts of
    credentials (``identifier``, ``secret``, ``endpoint``) whose complements stand near, see :func:`linked_spans`. Both
    are ordered by start, then by kind as in KINDS, and joined by commas; places count code points, ends are exclusive.
    A scope is what stands between blank lines.

    Null and empty texts hold nothing; a null id is an id like others, repeated rows are each reported, and other
    columns are ignored. A text of any length is searched whole. An empty table gives no rows.
    """
    text = F.col(text_column)
    source = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    rows = materialize(scanned(source))
    parts = rows.filter(F.size("parts") > 0).select("doc_id", "text_hash", F.inline("parts")).distinct()
    linked = linked_spans(materialize(parts), reach).groupBy(F.col("doc_id").alias("linked_id"), F.col("text_hash").alias("linked_hash"))
    linked = linked.agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    joined = rows.join(linked, F.col("doc_id").eqNullSafe(F.col("linked_id")) & (F.col("text_hash") == F.col("linked_hash")), "left")
    joined = joined.withColumn("linked", F.coalesce("linked", F.expr(f"cast(array() as {_SPAN})")))
    number = lambda kind: F.size(F.filter("clear", lambda s: s["kind"] == kind)).cast("long")
    return joined.select(
        "doc_id",
        *[number(kind).alias(f"n_{name}") for kind, (name, _, _) in enumerate(CLEAR)],
        F.size("linked").cast("long").alias("n_linked"),
        _written(F.col("clear")).alias("clear"),
        _written(F.array_sort(F.concat("clear", "linked"))).alias("spans"),
        "text_hash",
    )
