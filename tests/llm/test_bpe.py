import random

import brute
import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL

from docloom.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    return bpe.load(RANKS, PATTERN)


def test_parts_change_nothing(encoding, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(bpe, "PART", 40)
    for _ in range(300):
        text = "".join(rng.choice("ab'sé1 \n\t  \x1f漢😀.") for _ in range(rng.randint(0, 400)))
        assert bpe.encode_text(encoding, text) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("tail", ["", "x", "\nx"])
def test_long_white_space(encoding, monkeypatch, tail):
    text = "a b" + " \n" * 30_000 + tail + " c" + " " * 40_000 + tail
    whole = encoding.encode_ordinary(text)
    assert bpe.encode_text(encoding, text) == whole
    assert len(bpe.encode_text(encoding, "a" + " " * 3_000_000 + "b")) > 0


def test_table(spark, encoding):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, RANKS, PATTERN).collect()}
    for r in df.select("doc_id", "text").collect():
        ids = encoding.encode_ordinary(r.text or "")
        assert got.pop(r.doc_id) == (len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((r.text or "").encode()))
    assert not got


def test_nulls_repeated_rows_and_other_columns(spark):
    rows = [(None, "a b", b"old", 1), (None, "a b", b"old", 1), (2, None, None, None), (3, "", None, 2), (4, "<|endoftext|>é", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary, row int")
    out = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert out.columns == ["doc_id", "text", "row", "ids", "decoded"]
    assert sorted(((r.text or "").encode(), bytes(r.decoded)) for r in out.collect()) == sorted(((r[1] or "").encode(),) * 2 for r in rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(df, RANKS, PATTERN).collect() == []
