"""Quality scores from random-indexing word vectors and a small network (operator 3).

Every word bucket has a fixed sparse ternary index vector. A bucket's word vector
is the sum of the index vectors of its neighbours over the whole corpus. A text is
the mean and spread of its words' vectors; a two-layer network turns that into a
logit, and a temperature fitted on examples it did not learn from calibrates it.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.common import sample_ids
from landfall.llm.words import MULTIPLIERS, Words, mix, slices

# Word vectors are kept for this many hashed word buckets, whatever the vocabulary.
BUCKET_BITS = 13
DIMENSIONS = 32
NONZERO = 2
REACH = 2
# The network learns from at most this many labelled documents; all documents make the word vectors.
TRAIN_DOCS = 16384
HIDDEN = 24
EPOCHS = 60
BATCH = 128
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.7

# ASCII marks are words of their own: white space is put around them.
MARK_BYTES = [b for b in range(33, 127) if not chr(b).isalnum()]
PLACES = 1 << BUCKET_BITS


class Network(NamedTuple):
    """Standardisation, two layers and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class MarkedWords(Words):
    """Words as they are written, with ASCII marks as words of one byte."""

    MARK = np.zeros(256, bool)
    MARK[MARK_BYTES] = True

    def __init__(self, texts: pa.Array):
        super().__init__(texts)
        mark, solid = self.MARK[self.raw], self.raw > 32
        plain = solid & ~mark
        begin = mark.copy()
        begin[1:] |= plain[1:] & ~plain[:-1]
        if len(plain):
            begin[0] |= plain[0]
        end = mark.copy()
        end[:-1] |= plain[:-1] & ~plain[1:]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def buckets(self) -> np.ndarray:
        return (mix(self.hashes()) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    raw = mix(np.arange(1, PLACES * NONZERO + 1, dtype=np.uint64) * MULTIPLIERS[0]).reshape(PLACES, NONZERO)
    return (raw >> np.uint64(40)).astype(np.int64) % DIMENSIONS, np.where(raw & np.uint64(1), 1.0, -1.0)


def neighbour_sums(buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum over all words of the index vectors of their neighbours within reach, flat by bucket and dimension."""
    places, signs = index_vectors()
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = np.zeros(PLACES * DIMENSIONS)
    for step in range(1, REACH + 1):
        same = owner[:-step] == owner[step:]
        left, right = buckets[:-step][same], buckets[step:][same]
        for word, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(word * DIMENSIONS + places[other, k], signs[other, k], len(total))
    return total


def word_vectors(docs: DataFrame) -> np.ndarray:
    """One unit vector per bucket, from the neighbours of all words of all texts.

    Every task adds its texts up and hands on one row per bucket; the sums, a
    table of fixed size, reach the driver. Without words all vectors are zero.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PLACES * DIMENSIONS)
        for batch in batches:
            for part in slices(batch):
                words = MarkedWords(part.column("text"))
                if len(words.starts) > 1:
                    total += neighbour_sums(words.buckets(), words.first)
        rows = total.reshape(PLACES, DIMENSIONS)
        used = np.flatnonzero(rows.any(1))
        vectors = pa.array([r.astype(np.int64) for r in rows[used]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), vectors], names=["bucket", "sums"])

    partial = docs.select("text").mapInArrow(add_up, "bucket long, sums array<long>")
    added = partial.groupBy("bucket").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIMENSIONS)])
    out = np.zeros((PLACES, DIMENSIONS), np.float32)
    for row in added.collect():  # PLACES rows at most
        vector = np.array(row[1:], float)
        out[row[0]] = vector / max(np.linalg.norm(vector), 1e-9)
    return out


def pooled(words: MarkedWords, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and length of each text's word vectors; zeros for a text without words."""
    buckets = words.buckets()
    out = np.zeros((len(words), 2 * DIMENSIONS + 2), np.float32)
    for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
        if b > a:
            counts = np.bincount(buckets[a:b], minlength=0) if b - a > 4 * PLACES else None
            if counts is None:
                held = vectors[buckets[a:b]]
                mean, square = held.mean(0), np.einsum("ij,ij->j", held, held) / (b - a)
            else:  # a long text: each bucket once
                held = vectors[: len(counts)]
                mean, square = counts @ held / (b - a), counts @ (held * held) / (b - a)
            out[i, :DIMENSIONS] = mean
            out[i, DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(square - mean * mean, 0))
            out[i, -2:] = np.linalg.norm(mean), np.log1p(b - a)
    return out


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Fit the network by Adam on four fifths of the examples and its temperature on the rest.

    Examples come in a fixed order. None, or one class alone, gives a constant score.
    """
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    if len(x) < 10 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Network(
            np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
            float(np.log(rate / (1 - rate))), 1.0,
        )
    check = np.arange(len(x)) % 5 == 4
    mean, scale = x[~check].mean(0), x[~check].std(0) + 1e-3
    z = (x - mean) / scale
    parameters = [
        rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    rows, step = np.flatnonzero(~check), 0
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(rows)
        for at in np.array_split(order, max(1, len(order) // BATCH)):
            w1, b1, w2, b2 = parameters
            before = z[at] @ w1 + b1
            hidden = np.maximum(before, 0)
            error = 1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -30, 30))) - y[at]
            back = np.outer(error, w2) * (before > 0) / len(at)
            gradients = [z[at].T @ back + DECAY * w1, back.sum(0), hidden.T @ error / len(at) + DECAY * w2, np.array([error.mean()])]
            step += 1
            for p, g, (m, v) in zip(parameters, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w1, b1, w2, b2 = parameters
    raw = Network(mean, scale, w1, b1, w2, float(b2[0]), 1.0)
    logits, truth = raw.logits(x[check]), y[check]
    temperatures = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
    losses = [np.mean(np.logaddexp(0, np.where(truth == 1, -1, 1) * logits / t)) for t in temperatures]
    return raw._replace(temperature=float(temperatures[int(np.argmin(losses))]))


def learn(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality", limit: int = TRAIN_DOCS) -> Network:
    """Network learnt from at most ``limit`` labelled texts outside the held-out fold.

    Texts are pooled where they lie; only ``limit`` rows of fixed width reach the driver.
    """
    chosen = F.broadcast(sample_ids(labels, label, limit))  # at most ``limit`` rows
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"])
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = pooled(MarkedWords(part.column("text")), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.string()), part.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["id", "label", "x"],
                )

    rows = texts.mapInArrow(pool, "id string, label int, x binary").collect()
    rows.sort(key=lambda r: (hash_order(r["id"]), r["id"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(len(rows), 2 * DIMENSIONS + 2)
    return train(x.astype(float), np.array([r["label"] for r in rows], float))


def hash_order(text: str) -> int:
    """Place of an id in the order of learning."""
    return int(mix(np.array([sum(b * 257**i for i, b in enumerate(text.encode())) % 2**64], np.uint64))[0])


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """doc_id and score of every row. Texts without words, null ones too, score alike; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            for part in slices(batch):
                value = network.probability(pooled(MarkedWords(part.column("text")), vectors))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
