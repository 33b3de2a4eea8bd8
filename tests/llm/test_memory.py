"""What a task holds of a batch is a share of it, however large the batch is."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from docloom.llm import bpe, suffix_dedup, window_dedup
from docloom.llm.common import SHARE_BYTES, _pack, packed_shares, shares, sizes, unpacked
from docloom.llm.queries import RANKS


def batch(rows, length):
    rng = random.Random(rows)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(length // 6)).encode() for _ in range(rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(rows), pa.int64()), pa.array([0] * rows, pa.int32()), pa.array(texts, pa.binary())],
        names=["doc", "mark", "data"],
    )


def peak_mb(batches):
    """Peak of what Python and numpy hold while the results pass by."""
    tracemalloc.start()
    rows = sum(b.num_rows for b in batches)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return rows, peak


def test_phrases_of_a_large_batch():
    rows, peak = peak_mb(suffix_dedup._phrases(iter([batch(2000, 2000)])))
    assert rows > 10_000 and peak < 60


def test_cut_of_a_large_batch():
    whole = pa.Table.from_batches(_pack(iter([batch(6000, 2000)]))).combine_chunks().to_batches()[0]
    row = pa.array([{"n": i} for i in range(len(whole))])
    spans = pa.array([None if i % 2 else [{"start": 5, "end": 905}] for i in range(len(whole))])
    kept = whole.append_column("row", row).append_column("spans", spans)
    rows, peak = peak_mb(suffix_dedup._cutter(False)(iter([kept])))
    assert rows == 6000 and peak < 6
    starts = pa.array([None if i % 2 else [{"first": 5, "last": 9}] for i in range(len(whole))])
    rows, _ = peak_mb(window_dedup._cut(iter([kept.append_column("starts", starts)])))
    assert rows == 6000


def test_words_of_a_large_batch():
    whole = pa.Table.from_batches(_pack(iter([batch(2000, 2000)]))).combine_chunks().to_batches()[0]
    item = {"trigger": 1, "hot": False, "place": 60, "reach": 60 * 128}
    listed = [[{**item, "place": p} for p in range(60, 1500, 40)] for _ in range(len(whole))]
    fields = [("trigger", pa.int64()), ("hot", pa.bool_()), ("place", pa.int32()), ("reach", pa.int32())]
    wanted = pa.array(listed, pa.list_(pa.struct(fields)))
    given = whole.append_column("wanted", wanted)
    rows, peak = peak_mb(suffix_dedup._fetch_words(iter([given])))
    assert rows == 2000 * 36 and peak < 80
    texts = unpacked(whole)
    found = [r for b in suffix_dedup._fetch_words(iter([given])) for r in b.to_pylist()]
    for r in found[::997]:
        text, at = texts[r["doc"]].as_py(), r["place"] - 60
        assert r["bytes"] == text[at : r["place"] + 100]


def test_ids_of_a_large_batch():
    encoding = bpe.load(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    data = batch(1500, 2000).column("data")
    parts = list(bpe._encoded(iter([data]), encoding))
    assert len(parts) > 1 and sum(map(len, parts)) == 1500
    assert parts[-1][-1].as_py() == np.array(bpe.encode_text(encoding, data[-1].as_py().decode()), "<u4").tobytes()


def test_shares(spark):
    column = pa.array([b"", None, b"x" * SHARE_BYTES, b"y" * (3 * SHARE_BYTES), b"z", b""])
    assert list(shares(sizes(column))) == [(0, 3), (3, 4), (4, 6)]
    assert list(shares(sizes(column.slice(6)))) == []
    given = pa.RecordBatch.from_arrays([column.fill_null(b"")], names=["data"])
    parts = list(packed_shares(_pack(iter([given]))))
    assert [x.as_py() for p in parts for x in unpacked(p)] == [x.as_py() or b"" for x in column]
    # pieces of a batch find their rows again
    df = spark.range(3000).select("id", F.repeat(F.concat(F.col("id"), F.lit(" word")), 300).alias("text"))
    coded = bpe.encode(df.coalesce(1), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    back = bpe.decode(coded, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    assert back.where(F.col("text").cast("binary") != F.col("decoded")).count() == 0
