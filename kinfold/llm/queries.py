"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.bpe import encode_digests
from kinfold.llm.collocations import collocations
from kinfold.llm.common import fresh_folder
from kinfold.llm.decontaminate import find_leaks
from kinfold.llm.exact import exact_duplicates
from kinfold.llm.jaccard import jaccard_components
from kinfold.llm.language import identify, train
from kinfold.llm.licenses import known_licenses, license_scan
from kinfold.llm.lines import apply_bitmaps, line_bitmaps
from kinfold.llm.negatives import hard_negatives
from kinfold.llm.secret_scan import secret_scan
from kinfold.llm.sharding import shard
from kinfold.llm.tokenfiles import read_token_files, write_token_files
from kinfold.llm.warc import merge_runs, read_archives, write_archives
from kinfold.session import materialize

#: Pages carry no time of capture; theirs is one second apart from here, in the order of ids (2024-01-01T00:00:00Z).
FIRST_CAPTURE = 1704067200


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").withColumn("captured_at", F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + FIRST_CAPTURE))
    runs = write_archives(pages, fresh_folder(spark, "warc"))
    history = merge_runs(runs).select("file", "offset", "url_key", "capture")
    # Written, so that the planner knows how many there are and does not take them for a few file names.
    records = materialize(read_archives(runs, dict(runs.dtypes)["page_id"]).drop("payload"))
    return records.join(history, ["file", "offset"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = write_token_files(docs, fresh_folder(spark, "tokens"), path, public_tokenizers.PATTERN, end_id=2, vocabulary=50257)
    return read_token_files(spark, manifest, dict(docs.dtypes)["doc_id"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"), 16)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return identify(docs, train(docs.filter(~F.col("held_out"))), carry=["doc_id", "held_out"])


def op6_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85).drop("text_hash", "kept")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"), known_licenses(spark))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, line_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("clear", 256).alias("base_sha256"), "spans", "n_linked")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_token_files": op3_token_files,
    "op4_jump_hash_shards": op4_jump_hash_shards,
    "op5_language": op5_language,
    "op6_partenum_join": op6_partenum_join,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secret_scan": op13_secret_scan,
}
