import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kinfold.llm.common import fresh_folder
from kinfold.llm.tokenfiles import encode_texts, read_token_files, write_token_files

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x  <|endoftext|>\n\n y", "<|endoftext| > z", "plain text", "", "x" * 300 + "<|endoftext|> it's"]


def test_added_tokens_like_the_library_at_its_defaults(spark):
    whole = Tokenizer.from_file(PATH)
    want = [whole.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert want[0] == [64, 220, 50256, 275]
    assert [e.tolist() for e in encode_texts(PATH, PATTERN, TEXTS)] == want
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    manifest = write_token_files(docs, fresh_folder(spark, "tokens"), PATH, PATTERN, 2, 50257)
    place = 0
    for r, ids in zip(read_token_files(spark, manifest, "bigint").orderBy("doc_id").collect(), want):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (place, len(ids) + 1, zlib.crc32(np.array(ids + [2], "<u4").tobytes()))
        place += len(ids) + 1
