"""Byte-level ids against the library's own over whole texts, and round trips."""

import random

import pytest
from pyspark.sql import functions as F

from catalog_sync.llm import byte_bpe
from catalog_sync.llm.byte_bpe import SPACES, decode, encode, encoding, ids_of, split

tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN
PARTS = [
    "a", "b", "'s", "'", "'ll", " ", "  ", "\n", "\t", "\r", "　", "\xa0", "\x1c", "\x85", "1", "23", ".", "!!",
    "漢字", "か", "、", "é", "​", "᠎", "﻿", "😀", "²", "ß", "Я", "[", "`", "{", "~", "<|endoftext|>",
]


@pytest.mark.parametrize("seed", range(4))
def test_splitting_changes_nothing(seed):
    rng = random.Random(seed)
    for _ in range(2000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        chunk = rng.randint(1, 9)
        assert "".join(split(text, chunk)) == text
        assert ids_of(text, PATH, PATTERN, chunk).tolist() == encoding(PATH, PATTERN).encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" + " " * 200_000 + "y z", " " * 90_000, "\n" * 70_000 + "1", "ab " * 50_000])
def test_long_runs_like_the_library(text):
    assert ids_of(text, PATH, PATTERN).tolist() == encoding(PATH, PATTERN).encode_ordinary(text)


@pytest.mark.parametrize("text", [" " * 1_500_000 + "a", "a" * 1_500_000, "-=" * 500_000, "漢字" * 300_000])
def test_runs_that_stop_the_library(text):
    ids = ids_of(text, PATH, PATTERN).tolist()
    assert encoding(PATH, PATTERN).decode_bytes(ids) == text.encode()
    assert len(list(split("ab, " * 100_000))) > 5 and SPACES.search(" " * byte_bpe.CHUNK)


def test_rows(documents):
    rows = [(1, "Don't, don't!  <|endoftext|> 漢字😀"), (2, None), (3, ""), (None, "no key"), (1, "again"), (1, "again"),
            (4, "word " * 60_000)]
    own = encoding(PATH, PATTERN)
    coded = encode(documents(rows).withColumn("ids", F.lit("clash")), "text", PATH, PATTERN)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "rank", "key", "component", "ids"]
    got = sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in decode(coded, PATH, PATTERN).collect()), key=repr)
    want = [(i, own.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert encode(documents(rows).where("false"), "text", PATH, PATTERN).count() == 0


def test_small_output_batches(documents):
    rows = [(i, "some words " * i) for i in range(20)]
    back = decode(encode(documents(rows), "text", PATH, PATTERN, group=3), PATH, PATTERN, group=9)
    assert {r.doc_id: bytes(r.bytes).decode() for r in back.collect()} == dict(rows)


def test_ids_of_bytes_and_unknown_ids(spark):
    broken = spark.createDataFrame([(1, b"a\xff b")], "doc_id long, text binary")
    row = decode(encode(broken, "text", PATH, PATTERN), PATH, PATTERN).first()
    assert bytes(row.bytes) == "a� b".encode()
    ids = spark.createDataFrame([(1, [300, 5]), (2, None), (3, [])], "k int, ids array<int>")
    out = {r.k: r.bytes for r in decode(ids, PATH, PATTERN).collect()}
    assert out[2] is None and bytes(out[3]) == b"" and len(out[1]) > 1
    with pytest.raises(Exception, match="1000000|KeyError"):
        decode(spark.createDataFrame([(1, [10**6])], "k int, ids array<int>"), PATH, PATTERN).collect()
