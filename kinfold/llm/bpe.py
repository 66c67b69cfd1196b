"""Byte-level BPE: encoding with a segment tree over pair ranks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import pieces
from kinfold.llm.words import WordMemory

#: Characters of text that are encoded together.
SPAN = 1 << 21


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64(token) rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of lowest rank merges until no pair has a rank.

    Leaf i of the tree holds the rank of the pair that starts at live byte position i, inner nodes the minimum, so
    the root tells the next merge and a walk down its leftmost position. A merge changes the pairs of two live
    neighbours and takes one position away: three point updates of logarithmic cost.
    """
    if piece in ranks:
        return [ranks[piece]]
    size, none = len(piece), 1 << 62
    if size == 1:
        raise KeyError(f"byte {piece!r} has no rank")
    width = 1 << (size - 1).bit_length()
    tree = [none] * (2 * width)
    for i in range(size - 1):
        tree[width + i] = ranks.get(piece[i : i + 2], none)
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))

    def put(i: int, value: int) -> None:
        i += width
        tree[i] = value
        while i > 1:
            i >>= 1
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a <= b else b
            if tree[i] == least:
                return
            tree[i] = least

    while (least := tree[1]) < none:
        i = 1
        while i < width:
            i = 2 * i if tree[2 * i] == least else 2 * i + 1
        i -= width
        gone = after[i]
        end = after[i] = after[gone]
        put(gone, none)
        if end < size:
            before[end] = i
            put(i, ranks.get(piece[i : after[end]], none))
        else:
            put(i, none)
        if (left := before[i]) >= 0:
            put(left, ranks.get(piece[left:end], none))
    out, i = [], 0
    while i < size:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class PairTable:
    """Rank of the merge of two adjacent ids, for arrays of pairs: every split of a token into two tokens is a pair."""

    NONE = 1 << 62

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {(ranks[t[:i]] << 20) | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(self.keys)
        self.keys = np.r_[self.keys[order], np.int64(1 << 62)]
        self.ranks = np.r_[np.fromiter(pairs.values(), np.int64, len(pairs))[order], np.int64(self.NONE)]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left << 20) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], self.NONE)


def merge_many(pieces: list[bytes], byte_ids: np.ndarray, table: PairTable, width: int) -> list[bytes]:
    """``merge`` for many pieces of at most ``width`` bytes (a power of two): one segment tree each, walked together.

    Trees are the columns of an array whose first axis is the node, so each step of all walks is one array operation.
    Ids come as the bytes of 32-bit integers.
    """
    count, none = len(pieces), PairTable.NONE
    sizes = np.fromiter(map(len, pieces), np.int64, count)
    tokens = np.zeros((width + 1, count), np.int64)
    tokens[:width] = byte_ids[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width).T]
    places = np.arange(width + 1)[:, None]
    live = places < sizes
    after, before = np.repeat(places + 1, count, axis=1), np.repeat(places - 1, count, axis=1)
    tree = np.full((2 * width, count), none, np.int64)
    tree[width : 2 * width - 1] = np.where(live[1:width], table(tokens[: width - 1], tokens[1:width]), none)
    for i in range(width - 1, 0, -1):
        tree[i] = np.minimum(tree[2 * i], tree[2 * i + 1])
    busy = np.arange(count)
    while len(busy := busy[tree[1, busy] < none]):
        least = tree[1, busy]
        node = np.ones(len(busy), np.int64)
        for _ in range(width.bit_length() - 1):
            node *= 2
            node += tree[node, busy] != least
        at = node - width
        gone = after[at, busy]
        end = after[gone, busy]
        tokens[at, busy] = least
        live[gone, busy] = False
        after[at, busy] = end
        before[end, busy] = at
        left = before[at, busy]
        has_left = left >= 0
        right_rank = np.where(end < sizes[busy], table(least, tokens[end, busy]), none)
        left = np.where(has_left, left, at)
        left_rank = np.where(has_left, table(tokens[left, busy], least), right_rank)
        for leaf, value in ((gone, none), (at, right_rank), (left, left_rank)):
            tree[width + leaf, busy] = value
        for leaf in (gone, at, left):
            node = width + leaf
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                tree[node, busy] = np.minimum(tree[2 * node, busy], tree[2 * node + 1, busy])
    ids = tokens.T[live.T].astype(np.int32).tobytes()
    ends = (np.cumsum(live.sum(axis=0)) * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """Encodes texts as the ids of their pieces, and decodes ids to bytes."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.table = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.memory = WordMemory(self.words)

    def pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of distinct pieces. Pieces of similar length share one walk; very long ones are merged alone."""
        out, waiting, ranks = {}, {}, self.ranks
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            if raw in ranks:
                out[piece] = ranks[raw].to_bytes(4, "little")
            elif len(raw) > 128:
                out[piece] = np.array(merge(raw, ranks), np.int32).tobytes()
            else:
                waiting.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for bits, own in waiting.items():
            for at in range(0, len(own), 1 << 13):
                part = own[at : at + (1 << 13)]
                out.update(zip([p for p, _ in part], merge_many([r for _, r in part], self.byte_ids, self.table, 1 << bits)))
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of stretches between single blanks."""
        split = list(map(self.pattern.findall, words))
        ids = self.pieces(set(chain.from_iterable(split)))
        return [b"".join(map(ids.__getitem__, parts)) for parts in split]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return self.memory.encode(texts)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, in a row."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text", carry: list[str] = ()) -> DataFrame:
    """The columns ``carry``, then ``ids`` (array of int), for each row.

    ``path`` names a vocabulary file that every executor has. Each match of ``pattern`` is merged by itself, without
    special tokens. A null or empty text has no ids. Rows are independent: nothing is shuffled, and a lost executor
    costs its tasks only.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(True).alias("_some")).alias("carried"), F.col(text_column).alias("text"))

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            # Some texts at a time, since their ids take more room than they do.
            for start, texts in pieces(batch, "text", SPAN):
                ids = own.encode(texts)
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.ListArray.from_arrays(offsets, np.concatenate(ids))], ["carried", "ids"])

    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(run, f"carried {kind}, ids array<int>").select(*[F.col(f"carried.`{c}`").alias(c) for c in carry], "ids")


def decode(encoded: DataFrame, path: str, pattern: str, ids_column: str = "ids", carry: list[str] = ()) -> DataFrame:
    """The columns ``carry``, then ``decoded`` (binary), for each row; null ids decode to nothing."""
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(True).alias("_some")).alias("carried"), F.col(ids_column).alias("ids"))

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            decoded = [own.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["carried", "decoded"])

    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(run, f"carried {kind}, decoded binary").select(*[F.col(f"carried.`{c}`").alias(c) for c in carry], "decoded")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode and decode each text, of which only digests leave the
    task, and with ``with_ids`` the ``ids``.

    A null or empty text has no ids. The first digest is that of the decimal ids joined by commas, the second that of the decoded bytes.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            for start, texts in pieces(batch, "text", SPAN):
                counts, of_ids, of_bytes, encoded = [], [], [], own.encode(texts)
                for ids in encoded:
                    counts.append(len(ids))
                    ids = ids.tolist()
                    of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
                columns = [batch.column(0).slice(start, len(texts)), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.cumsum([0, *counts], dtype=np.int32), np.concatenate(encoded)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
