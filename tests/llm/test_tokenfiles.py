import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinfold.llm.common import fresh_folder
from kinfold.llm.tokenfiles import encoder, read_sequence, read_token_files, write_token_files
from tests.llm.rows import awkward, frame

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_words_encode_like_whole_texts(tokenizer):
    texts = [r[1] for r in awkward() if r[1]] + ["  a  b\n\n c\t d\x85e  f", "don't 12 45!!  \n x", "　x　y z  q", "<|endoftext|> x", "a \x1c b\x1f c", " lead", "trail "]
    assert [e.tolist() for e in encoder(PATH, PATTERN).encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("sequence, batch", [(2048, 512), (16, 2), (7, 3)])
def test_round_trip(spark, tokenizer, sequence, batch):
    manifest = write_token_files(frame(spark), fresh_folder(spark, "tokens"), PATH, PATTERN, 2, 50257, sequence=sequence, batch=batch)
    found = read_token_files(spark, manifest, "bigint").orderBy("start").collect()
    ids = {}
    for r in awkward():
        own = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        ids.setdefault(r[0], []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    got = {}
    place = 0
    for r in found:
        assert r["start"] == place
        place += r["n_tokens"]
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
    order = [r["doc_id"] for r in found if r["doc_id"] is not None]
    assert order == sorted(order) and found[0]["doc_id"] is None
    # Any sequence is found by its number; only the last of a shard is padded.
    shard = manifest.filter("n_tokens > 40").first()
    last = (shard["n_tokens"] - 1) // sequence
    for number in {0, last}:
        values, mask = read_sequence(shard["file"], number, batch)
        assert len(values) == sequence and mask.sum() == min(sequence, shard["n_tokens"] - number * sequence)


def test_empty_table(spark):
    manifest = write_token_files(frame(spark, []), fresh_folder(spark, "tokens"), PATH, PATTERN, 2, 50257)
    assert manifest.count() == 0 and read_token_files(spark, manifest, "bigint").count() == 0
