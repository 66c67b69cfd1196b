import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kinfold.llm.bpe import codec, decode, encode, encode_digests, load_ranks, merge, merge_many
from tests.llm.rows import awkward, frame

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def test_single_pieces(library):
    """A walk alone and walks together give what the library gives."""
    rng, own = random.Random(5), codec(PATH, PATTERN)
    for width in (2, 8, 64, 128):
        pieces = ["".join(rng.choice("abcdeinrst") for _ in range(rng.randint(width // 2 + 1, width))) for _ in range(200)]
        want = [library.encode_ordinary(p) for p in pieces]
        assert [merge(p.encode(), own.ranks) for p in pieces] == want
        pieces = [p.encode() for p in pieces if p.encode() not in own.ranks]
        want = [w for w in want if len(w) > 1]
        assert [np.frombuffer(x, np.int32).tolist() for x in merge_many(pieces, own.byte_ids, own.table, width)] == want


def test_texts(spark, library):
    docs = frame(spark)
    found = encode_digests(docs, PATH, PATTERN, with_ids=True).collect()
    want = []
    for r in awkward():
        ids = library.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_round_trip(spark):
    docs = frame(spark)
    back = decode(encode(docs, PATH, PATTERN, carry=["doc_id", "text", "_hash"]), PATH, PATTERN, carry=["doc_id", "text"])
    rows = back.collect()
    assert len(rows) == len(awkward()) and all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    assert decode(encode(frame(spark, []), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_odd_words(library):
    texts = ["a" * 5000, "  a  b\n\n c\t d\x85e  f", "don't 123 45!!  \n x", "　x　y z  q", "é" * 300 + " ü ", " ", "a \x1c b", "😀" * 50]
    assert [x.tolist() for x in codec(PATH, PATTERN).encode(texts)] == [library.encode_ordinary(t) for t in texts]
