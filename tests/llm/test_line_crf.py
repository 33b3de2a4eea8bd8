import itertools
import zlib

import numpy as np
import pytest
from conftest import SMALL

from docloom.llm import line_crf


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(3)
    documents = [rng.standard_normal((n, line_crf.WIDTH)) for n in (3, 1, 4)]
    weights, moves = rng.standard_normal(line_crf.WIDTH) * 0.3, rng.standard_normal((2, 2))
    chains = line_crf.Chains(documents)
    good, _ = line_crf.marginals(chains, weights, moves)
    for k, i in enumerate(chains.order):
        x = documents[i]
        total, marked = 0.0, np.zeros(len(x))
        for labels in itertools.product((0, 1), repeat=len(x)):
            p = np.exp(sum(float(x[t] @ weights) for t in range(len(x)) if labels[t]) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
            total += p
            marked += p * np.array(labels)
        assert [good[t][k] for t in range(len(x))] == pytest.approx(marked / total)


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = line_crf.scores(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p for q, p in held if q == 1]) > 0.98
    assert np.mean([p for q, p in held if q == 0]) < 0.1


def test_nulls_ties_and_empty_tables(spark):
    rows = [(1, "A good line.\nAnd one more.", "k"), (1, "A good line.\nAnd one more.", "k"), (None, None, None), (3, "", "k"), (4, "\n" * 3000 + "x", "k"), (5, "long line " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 0, 0), (None, 1, 1), (9, None, 1)], "doc_id long, quality int, toxic int")
    got = line_crf.scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert len({r.score for r in got if r.doc_id in (None, 3)}) == 1
    assert {r.score for r in line_crf.scores(docs, labels.limit(0)).collect()} == {0.5}
    assert line_crf.scores(docs.limit(0), labels).collect() == []
