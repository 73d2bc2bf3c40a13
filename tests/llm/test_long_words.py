"""Byte-level BPE of stretches without a break, whose blocks must leave no trace."""

import random

import pytest
from pyspark.sql import functions as F

from braidwork.llm import byte_bpe

P = pytest.importorskip("public_tokenizers")


def cases():
    rng = random.Random(4)
    letters = "etaoinshrdlucmfwyp"
    yield from ("".join(rng.choices(letters, k=n)) for n in (63, 64, 65, 127, 128, 129, 200, 1000))
    yield from ("a" * 300, "-" * 777, "ab" * 200, " " * 500, "=" * 64 + "a" * 64, "the" * 100, "é" * 130, "0123456789" * 40)
    yield "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(300))
    yield "".join(rng.choice(("the", "ing", "and", "ation", "----", "====")) for _ in range(200))


def coder_of(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})


def encoded(spark, texts, ranks):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r._ids for r in byte_bpe.encoded(docs, ranks)[0].orderBy("doc_id").select("_ids").collect()]


def test_blocks_leave_no_trace(spark):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    coder, texts = coder_of(ranks), list(cases())
    assert encoded(spark, texts, ranks) == [coder.encode_ordinary(t) for t in texts]


def test_very_long_words(spark):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1 << 16)), "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(1 << 15)), "x" * (1 << 16)]
    coder = coder_of(ranks)
    assert encoded(spark, texts, ranks) == [coder.encode_ordinary(t) for t in texts]


def test_every_rank_is_reached_by_pieces(spark):
    """Tokens of several bytes fold to themselves without the look-up of whole words."""
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    codec = byte_bpe.Codec(spark, ranks)
    rows = spark.createDataFrame([(bytearray(t), r) for t, r in ranks[::97]], "token binary, id int")
    assert rows.where(codec._numbers(codec.pieces(F.col("token"))) != F.array("id")).count() == 0
