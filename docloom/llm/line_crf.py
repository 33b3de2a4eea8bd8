"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. What speaks for either are features of the line and of the
lines beside it, and the transition from line to line. Trained on labelled documents,
whose lines all get the document's label, the field gives each line a probability by
forward-backward; a document's score is the mean over its lines, weighted by their
words.

Training takes at most ``TRAIN_DOCUMENTS`` documents, those of the smallest id hashes
among the labelled ones that may be used; this bounds what the driver holds. Scoring is
one pass over whole texts.

Definitions. Labels are learnt only from rows whose crc32 of the id as text isn't 0
modulo ``FOLDS``; a null id counts as the empty text and so is held out. Of several
labels of one id the smallest counts. Lines without a word have no weight, a document
without words has the score of one empty line. Null text is empty text. Without labels
the score is 0.5. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents that the training takes at most.
TRAIN_DOCUMENTS = 2000
#: One of so many ids is held out.
FOLDS = 5
#: Scores from here on are predicted to be good.
THRESHOLD = 0.3
#: Steps, rate and penalty of the training.
STEPS, RATE, PENALTY = 300, 0.1, 1e-6
#: Lines that are scored at once, padding included.
CELLS = 1 << 16
#: Bytes of texts whose features are held at once.
SHARE = 1 << 22

_SYMBOLS = b"#*$%&|<>@^~=_{}[]\\+`"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_ENDS = (b".", b"!", b"?", b'"', b":", b";")
#: Features of a line by itself.
OWN = 11
#: With those of the lines before and after, and a constant.
WIDTH = 3 * OWN + 1


def _line(line: bytes) -> tuple[list[float], int]:
    words = line.split()
    n, size = len(words), max(1, len(line))
    if not n:
        return [0.0] * (OWN - 1) + [1.0], 0
    letters = size - len(line.translate(None, _LETTERS))
    symbols = size - len(line.translate(None, _SYMBOLS))
    upper = size - len(line.translate(None, _UPPER))
    shouts = line.count(b"!")
    echoes = sum(a == b for a, b in zip(words, words[1:]))
    distinct = len(set(words))
    chars = sum(map(len, words))
    return [
        min(1.0, symbols / n),
        min(1.0, shouts / n),
        min(1.0, 3 * upper / max(1, letters)),
        min(1.0, 3 * (size - len(line.translate(None, _DIGITS))) / size),
        echoes / n,
        distinct / n,
        min(2.0, chars / n / 8),
        np.log1p(n) / 6,
        float(line.rstrip().endswith(_ENDS)),
        letters / size,
        0.0,
    ], n


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line with those of its neighbours, and the lines' words."""
    own, words = zip(*map(_line, text.split(b"\n")))
    own = np.array(own)
    blank = np.zeros((1, OWN))
    before, after = np.concatenate([blank, own[:-1]]), np.concatenate([own[1:], blank])
    constant = np.ones((len(own), 1))
    return np.concatenate([own, before, after, constant], axis=1), np.array(words, float)


class Chains:
    """Documents as chains of lines, the longest first, so that step ``t`` has the first
    ``alive[t]`` documents."""

    def __init__(self, documents: list[np.ndarray]) -> None:
        lengths = np.array([len(d) for d in documents])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        steps = int(self.lengths[0])
        self.alive = [int((self.lengths > t).sum()) for t in range(steps)]
        self.lines = [np.stack([documents[i][t] for i in self.order[:n]]) for t, n in enumerate(self.alive)]


def marginals(chains: Chains, weights: np.ndarray, moves: np.ndarray):
    """Probabilities that lines are good, and expected moves from line to line.

    ``weights`` are the odds of a good line by its features, ``moves`` the 2 x 2 odds of
    going from one label to another.
    """
    steps = len(chains.alive)
    unary = []
    for x in chains.lines:
        odds = x @ weights
        unary.append(np.stack([np.zeros_like(odds), odds], axis=1))
    ahead = [unary[0]]
    for t in range(1, steps):
        n = chains.alive[t]
        last = ahead[-1][:n]
        ahead.append(unary[t] + np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1]))
    back = [None] * steps
    back[-1] = np.zeros((chains.alive[-1], 2))
    expected = np.zeros((2, 2))
    good = [None] * steps
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            n = chains.alive[t + 1]
            coming = unary[t + 1] + back[t + 1]
            on = np.logaddexp(moves[:, 0] + coming[:, :1], moves[:, 1] + coming[:, 1:])
            back[t] = np.zeros((chains.alive[t], 2))
            back[t][:n] = on
            joint = ahead[t][:n, :, None] + moves + coming[:, None, :]
            top = joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint - top)
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        both = ahead[t] + back[t]
        good[t] = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    return good, expected


def train(documents: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves of the largest penalised likelihood, by Adam."""
    weights, moves = np.zeros(WIDTH), np.zeros((2, 2))
    if not documents:
        return weights, moves
    chains = Chains(documents)
    truth = np.array(labels)[chains.order]
    total = sum(chains.alive)
    observed = np.zeros((2, 2))
    for label in (0, 1):
        observed[label, label] = (chains.lengths[truth == label] - 1).sum()
    flat = np.zeros(WIDTH + 4)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, STEPS + 1):
        good, expected = marginals(chains, flat[:WIDTH], flat[WIDTH:].reshape(2, 2))
        slope = np.zeros_like(flat)
        for t, x in enumerate(chains.lines):
            slope[:WIDTH] += x.T @ (truth[: chains.alive[t]] - good[t])
        slope[WIDTH:] = (observed - expected).ravel()
        slope = slope / total - PENALTY * flat
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        flat = flat + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return flat[:WIDTH], flat[WIDTH:].reshape(2, 2)


def score(texts: list[bytes], weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Mean probability of the lines, weighted by their words."""
    read = [features(t) for t in texts]
    out = np.zeros(len(texts))
    by_length = sorted(range(len(texts)), key=lambda i: -len(read[i][1]))
    at = 0
    while at < len(by_length):
        most = len(read[by_length[at]][1])
        group = by_length[at : at + max(1, CELLS // most)]
        chains = Chains([read[i][0] for i in group])
        good, _ = marginals(chains, weights, moves)
        total, weight = np.zeros(len(group)), np.zeros(len(group))
        plain = good[0].copy()
        for t, p in enumerate(good):
            n = chains.alive[t]
            words = np.array([read[group[chains.order[k]]][1][t] for k in range(n)])
            total[:n] += p * words
            weight[:n] += words
        mean = np.where(weight > 0, total / np.maximum(weight, 1), plain)
        for k, i in enumerate(chains.order):
            out[group[i]] = mean[k]
        at += len(group)
    return out


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The field of the labelled documents that aren't held out."""
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold() != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
    )
    texts = docs.select("doc_id", F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data"))
    # ids of labelled documents that are there, the smallest hashes first
    order = F.xxhash64("doc_id")
    sample = (
        texts.select("doc_id").join(usable, "doc_id").distinct().orderBy(order, "doc_id").limit(TRAIN_DOCUMENTS)
    )
    # bounded by the parameter above
    found = texts.join(F.broadcast(sample), "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [features(x.as_py())[0].tobytes() for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(data, pa.binary())],
                names=["doc_id", "label", "lines"],
            )

    chosen = found.select(F.col("doc_id").cast("long"), "label", "data")
    read = chosen.mapInArrow(rows, "doc_id long, label int, lines binary").collect()
    read.sort(key=lambda r: (r.doc_id, bytes(r.lines)))
    documents = [np.frombuffer(r.lines).reshape(-1, WIDTH) for r in read]
    return train(documents, [int(r.label > 0) for r in read])


def _shares(column: pa.Array) -> Iterator[pa.Array]:
    """Slices that start within one ``SHARE`` of bytes; a longer text is one by itself."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    share = (np.cumsum(size) - size) // SHARE
    cuts = np.flatnonzero(np.diff(share)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(column)]):
        yield column.slice(begin, end - begin)


def score_of(text: Column | str, model: tuple[np.ndarray, np.ndarray]) -> Column:
    """Score of each text. Only texts go to Python, and only numbers come back."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [score([x.as_py() or b"" for x in part], *model) for part in _shares(batch)]
            yield pa.array(np.concatenate(parts))

    return of(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` to every row; columns of these names are replaced."""
    judged = docs.drop("score", "predicted").withColumn("score", score_of(text, model))
    return judged.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document."""
    held_out = (fold() == 0).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long"), held_out, "text")
    return scored(rows, fit(docs, labels)).select("doc_id", "held_out", "score", "predicted")
