import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from foliant.llm import bpe


@pytest.fixture(scope="module")
def tok():
    return bpe.tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids(tok, known):
    rng = random.Random(2)
    texts = ["", " ", "Hello  world\n\n x's 'll", "é̈ 漢字 🙂🙂", "<|endoftext|>", "a" * 5000, "ab" * 3000, "-" * 777, "  \t \n", "123456789" * 300]
    texts += ["".join(rng.choice("abcdeé '\n12漢!?") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += ["".join(rng.choice("abct") for _ in range(20_000))]
    for t in texts:
        ids = tok.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == known.encode_ordinary(t)
        assert tok.decode(ids).decode() == t


def test_queue_is_empty_afterwards(tok):
    merger = bpe.Merger(tok.ranks)
    for piece in (b"", b"a", b"unbelievable" * 50, bytes(range(256)) * 3, b"zzzz" * 99):
        merger.merge(piece) if piece else None
        assert not any(merger.low)
        assert not any(merger.mid)


def test_other_ranks():
    """The lowest rank goes first, of a rank the leftmost, and merges open new ones."""
    ranks = {bytes([c]): c for c in b"abc"} | {b"bc": 4096, b"ab": 200_000, b"abc": 64, b"aa": 5000}
    merge = bpe.Merger(ranks).merge
    assert merge(b"abca") == [64, 97]
    assert merge(b"aaa") == [5000, 97]
    assert merge(b"abab") == [200_000, 200_000]


def test_frames(spark):
    docs = spark.createDataFrame([(1, "Hi there"), (2, None), (3, ""), (1, "Hi there"), (None, "é")], "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == 5
    for r, t in zip(rows, ["Hi there", "", "", "Hi there", "é"], strict=True):
        assert (r.decoded_sha256, r.n_bytes) == (hashlib.sha256(t.encode()).hexdigest(), len(t.encode()))
    back = bpe.decode_documents(bpe.encode_documents(docs))
    assert [bytes(r.bytes).decode() for r in back.collect()] == ["Hi there", "", "", "Hi there", "é"]
    assert bpe.round_trip(docs.limit(0)).count() == 0
