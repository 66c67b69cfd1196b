"""Token ids as Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import functools
import uuid
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import open_store, pieces
from kinfold.llm.words import WordMemory
from kinfold.session import materialize

#: Ids in a sequence, and sequences in a record batch.
SEQUENCE, BATCH = 2048, 512
#: Characters of text that are encoded together.
SPAN = 1 << 21

_encoders: dict[tuple[str, str], WordMemory] = {}
_added: dict[str, tuple[regex.Pattern | None, dict[str, int]]] = {}


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, else one above 255."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = [b for b in range(256) if b not in set(seen)]
    return {b: b for b in seen} | {b: 256 + i for i, b in enumerate(unseen)}


@functools.cache
def _tokenizer(path: str):
    """The tokenizer of a file, loaded once in each worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoder(path: str, pattern: str) -> WordMemory:
    """The byte-level BPE model of a file of the ``tokenizers`` library, one per worker, behind a memory of words.

    ``pattern`` is the one of its pre-tokenizer. It never joins a single blank to what stands in front of it, so words
    can be encoded apart, and matches are handed to the model as they are: added tokens are read as ordinary text, and
    :func:`encode_texts` takes them out before.
    """
    if (path, pattern) not in _encoders:
        pieces_of, letters = regex.compile(pattern).findall, byte_letters()
        tokenize = _tokenizer(path).model.tokenize

        blank = chr(letters[32])

        def spelled(piece: str) -> str:
            # All that ASCII shows is its own letter but the blank.
            return piece.replace(" ", blank) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(letters)

        def solve(words: list[str]) -> list[bytes]:
            split = list(map(pieces_of, words))
            ids = {p: array("i", [t.id for t in tokenize(spelled(p))]).tobytes() for p in set(chain.from_iterable(split))}
            return [b"".join(map(ids.__getitem__, parts)) for parts in split]

        _encoders[path, pattern] = WordMemory(solve)
    return _encoders[path, pattern]


def added_tokens(path: str) -> tuple[regex.Pattern | None, dict[str, int]]:
    """A pattern of the file's added tokens, the longest first, and their ids; read once in each worker."""
    if path not in _added:
        found = _tokenizer(path).get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in found.values()):
            raise ValueError(f"{path}: added tokens that take blanks with them, or single words only, are not supported")
        ids = {t.content: i for i, t in found.items()}
        _added[path] = (regex.compile("|".join(map(regex.escape, sorted(ids, key=len, reverse=True)))) if ids else None, ids)
    return _added[path]


def encode_texts(path: str, pattern: str, texts: list[str | None]) -> list[np.ndarray]:
    """Ids as the library's ``encode(text, add_special_tokens=False)`` gives them: an added token in a text is one id."""
    own, (found, ids_of) = encoder(path, pattern), added_tokens(path)
    marked = {i: found.findall(t) for i, t in enumerate(texts) if t and any(c in t for c in ids_of)} if found else {}
    if not marked:
        return own.encode(texts)
    parts = [found.split(t) if i in marked else [t] for i, t in enumerate(texts)]
    ids = iter(own.encode([p for some in parts for p in some]))
    out = []
    for i, some in enumerate(parts):
        row = [next(ids)]
        for token, _ in zip(marked.get(i, ()), some[1:]):
            row += [np.array([ids_of[token]], np.int32), next(ids)]
        out.append(row[0] if len(row) == 1 else np.concatenate(row).astype(np.int32))
    return out


def _schema(vocabulary: int, sequence: int) -> pa.Schema:
    ids = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(ids, sequence)), pa.field("mask", pa.list_(pa.bool_(), sequence))])


class _ShardWriter:
    """One shard: a file of sequences and a file of documents (id, start, count), written as they come."""

    def __init__(self, folder: str, kind: pa.DataType, vocabulary: int, sequence: int, batch: int):
        self.store, at = open_store(folder)
        self.store.create_dir(at, recursive=True)
        # A repeated task writes files of its own; the manifest names those of the one that counted.
        self.name = f"{at}/{uuid.uuid4().hex}"
        self.schema, self.sequence, self.batch = _schema(vocabulary, sequence), sequence, batch
        self.docs_schema = pa.schema([pa.field("doc_id", kind), pa.field("start", pa.int64()), pa.field("n_tokens", pa.int64())])
        self.out = self.store.open_output_stream(f"{self.name}.arrow")
        self.docs_out = self.store.open_output_stream(f"{self.name}.docs.arrow")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.docs_writer = pa.ipc.new_file(self.docs_out, self.docs_schema)
        self.waiting, self.held, self.total, self.docs = [], 0, 0, 0

    def add(self, ids: pa.Array, tokens: list[np.ndarray]) -> None:
        sizes = np.array([len(t) for t in tokens], np.int64)
        starts = self.total + np.cumsum(sizes) - sizes
        self.docs_writer.write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(sizes)], schema=self.docs_schema))
        self.docs += len(tokens)
        self.total += int(sizes.sum())
        self.waiting += tokens
        self.held += int(sizes.sum())
        if self.held >= self.sequence * self.batch:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([*self.waiting, np.empty(0, np.int32)]).astype(self.schema.field("ids").type.value_type.to_pandas_dtype())
        step = self.sequence * self.batch
        whole = len(flat) if last else len(flat) // step * step
        for at in range(0, whole, step):
            part = flat[at : min(at + step, whole)]
            rows = -(-len(part) // self.sequence)
            mask = np.arange(rows * self.sequence) < len(part)
            part = np.pad(part, (0, rows * self.sequence - len(part)))
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (part, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        rest = flat[whole:].astype(np.int32)
        self.waiting, self.held = [rest], len(rest)

    def close(self) -> None:
        self._flush(last=True)
        for x in (self.writer, self.docs_writer, self.out, self.docs_out):
            x.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    pattern: str,
    end_id: int,
    vocabulary: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence: int = SEQUENCE,
    batch: int = BATCH,
) -> DataFrame:
    """Write token files in ascending id order and return their manifest ``shard, file, n_docs, n_tokens``.

    Documents are range-partitioned and sorted by id (then by a hash of the text); each task writes one shard, whose
    documents follow those of the shard before. A shard is a run of ids, cut into sequences of equal length; only its
    last sequence is padded, with mask false. Each record batch has the same number of sequences, so sequence i is row
    ``i % batch`` of batch ``i // batch``, at a place known without reading: a memory map gives it without a copy.
    Beside it lies a file of the documents with their first place and number of ids.

    Every document ends with ``end_id``; a null or empty text is that id alone. Null ids come first. Repeated rows are
    documents of their own. An empty table has a manifest without rows. Ids are stored in 16 bits if the vocabulary
    allows. The manifest is written once, when all shards are whole; files of repeated tasks stay unnamed.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def run(batches):
        writer = None
        for b in batches:
            if writer is None:
                writer = _ShardWriter(folder, b.schema.field("doc_id").type, vocabulary, sequence, batch)
            for start, texts in pieces(b, "text", SPAN):
                writer.add(b.column(0).slice(start, len(texts)), [np.append(ids, np.int32(end_id)) for ids in encode_texts(tokenizer_path, pattern, texts)])
        if writer is not None:
            writer.close()
            # What is recorded is the folder's own name, which other tasks can open as well.
            name = f"{folder}/{writer.name.rsplit('/', 1)[1]}"
            columns = [[TaskContext.get().partitionId()], [name], [writer.docs], [writer.total]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["shard", "file", "n_docs", "n_tokens"])

    return materialize(ordered.mapInArrow(run, "shard int, file string, n_docs long, n_tokens long"))


def _stream(reader: pa.RecordBatchFileReader):
    """The ids of a sequence file, batch by batch, without the padding."""
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids, mask = batch.column(0).flatten(), batch.column(1).flatten()
        ids = ids.to_numpy()
        kept = mask.to_numpy(zero_copy_only=False)
        yield ids if kept.all() else ids[kept]


def read_sequence(file: str, number: int, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence by its number, through a memory map if the store is local."""
    store, at = open_store(f"{file}.arrow")
    source = pa.memory_map(at) if store.type_name == "local" else store.open_input_file(at)
    row = pa.ipc.open_file(source).get_batch(number // batch)
    ids, mask = (row.column(i)[number % batch].values for i in (0, 1))
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def read_token_files(spark: SparkSession, manifest: DataFrame, id_type: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, shard`` of each document, from the files alone.

    ``start`` counts the ids of all documents before it, over all shards. A task reads one shard after another, batch
    by batch. The manifest, one row per shard, is summed up on the driver.
    """
    shards = manifest.orderBy("shard").collect()
    firsts, total = [], 0
    for r in shards:
        firsts.append((r["shard"], r["file"], total))
        total += r["n_tokens"]
    todo = spark.createDataFrame(firsts, "shard int, file string, first long").repartition(max(1, len(firsts)))

    def run(batches):
        for b in batches:
            for shard, file, first in zip(*(c.to_pylist() for c in b.columns)):
                store, at = open_store(file)
                with store.open_input_file(f"{at}.arrow") as source, store.open_input_file(f"{at}.docs.arrow") as docs:
                    blocks, held = _stream(pa.ipc.open_file(source)), np.empty(0, np.uint16)
                    index = pa.ipc.open_file(docs)
                    for i in range(index.num_record_batches):
                        part = index.get_batch(i)
                        sums = []
                        for n in part.column(2).to_pylist():
                            crc = 0
                            while n:
                                if not len(held):
                                    held = next(blocks)
                                crc = zlib.crc32(held[:n].astype("<u4").tobytes(), crc)
                                n, held = n - min(n, len(held)), held[n:]
                            sums.append(crc)
                        starts = pa.array(part.column(1).to_numpy() + first)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0), starts, part.column(2), pa.array(sums, pa.int64()), pa.array([shard] * len(sums), pa.int32())],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                        )

    return todo.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, shard int")
