"""Toxicity scores by FTRL-proximal logistic regression (operator 1).

Features are hashed words, word pairs and skip pairs of a text, each present or
not. FTRL keeps a learning rate per coordinate and an L1 term that leaves most
weights at zero, so the model sent to the executors is the short list of the others.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.common import map_rows, sample_ids
from landfall.llm.words import MULTIPLIERS, PlainWords, mix, slices

HASH_BITS = 20
# Learning uses at most this many labelled documents; all documents are scored.
TRAIN_DOCS = 16384
EPOCHS = 4
ALPHA, BETA, L2 = 2.0, 1.0, 0.1
# L1 term per square root of the number of examples: what chance adds up to grows that way.
L1_RATE = 0.08
THRESHOLD = 0.3

class Weights(NamedTuple):
    """Hash places with a weight other than zero, sorted, their weights, and the bias."""

    places: np.ndarray
    values: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << HASH_BITS, np.float32)
        dense[self.places] = self.values
        return dense


def features(words: PlainWords) -> list[np.ndarray]:
    """Hash places of the words, neighbours and next-but-one pairs of all texts.

    Pairs that reach into the next text are among them; ``spans`` leaves them out.
    """
    h = words.hashes()
    shift = np.uint64(64 - HASH_BITS)
    one = mix(h) >> shift
    two = mix(h[:-1] * MULTIPLIERS[0] + mix(h[1:]) + np.uint64(2)) >> shift
    skip = mix(h[:-2] * MULTIPLIERS[0] + mix(h[2:]) + np.uint64(3)) >> shift
    return [x.astype(np.int32) for x in (one, two, skip)]


def spans(words: PlainWords) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per feature kind, where each text's features begin and end."""
    begin, end = words.first[:-1], words.first[1:]
    return [(begin, np.maximum(begin, end - reach)) for reach in range(3)]


def scores(words: PlainWords, table: np.ndarray, bias: float) -> np.ndarray:
    """Probability of each text; a feature counts once however often it occurs."""
    logit = np.full(len(words), bias, np.float64)
    for places, (begin, end) in zip(features(words), spans(words), strict=True):
        hit = np.flatnonzero(table[places])
        owner = np.searchsorted(begin, hit, side="right") - 1
        inside = hit < end[owner]
        hit, owner = hit[inside], owner[inside]
        once = np.unique(owner.astype(np.int64) << HASH_BITS | places[hit].astype(np.int64))
        np.add.at(logit, once >> HASH_BITS, table[once & ((1 << HASH_BITS) - 1)])
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def text_features(words: PlainWords) -> list[np.ndarray]:
    """Distinct hash places of each text."""
    found, kinds = features(words), spans(words)
    return [
        np.unique(np.concatenate([places[b[i] : e[i]] for places, (b, e) in zip(found, kinds, strict=True)]))
        for i in range(len(words))
    ]


def train(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal over the examples in the given order, ``epochs`` times. No examples give a bias of 0."""
    size = 1 << HASH_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    sparsity = L1_RATE * np.sqrt(len(rows))

    def weight(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        l1 = np.where(at == size, 0.0, sparsity)  # the bias has no L1 term
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for row, label in zip(rows, labels, strict=True):
            at = np.append(row, size)
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = p - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    places = np.flatnonzero(np.abs(z[:size]) > sparsity)
    return Weights(places, weight(places).astype(np.float32), float(weight(np.array([size]))[0]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = TRAIN_DOCS) -> Weights:
    """Weights learnt from at most ``limit`` labelled texts outside the held-out fold.

    Texts become hash places where they lie, and only those travel; one task
    learns from the bounded sample. Of an id's rows the one with the least places
    counts. Without usable labels every score is 0.5.
    """
    chosen = F.broadcast(sample_ids(labels, label, limit))  # at most ``limit`` rows
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = text_features(PlainWords(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.string()), part.column("label"), pa.array(found, pa.list_(pa.int32()))],
                    names=["id", "label", "places"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r for batch in batches for r in examples(batch)), key=lambda r: r[:2])
        model = train([r[3] for r in held], np.array([r[2] for r in held], float))
        places, values = np.append(model.places, -1), np.append(model.values.astype(float), model.bias)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], names=["place", "value"])

    found = texts.mapInArrow(extract, "id string, label int, places array<int>")
    once = found.groupBy("id", "label").agg(F.min("places").alias("places"))
    rows = once.repartition(1).mapInArrow(fit, "place long, value double").collect()  # the weights other than zero
    found = np.array([r["place"] for r in rows], np.int64)
    values = np.array([r["value"] for r in rows])
    order = np.argsort(found)
    if not len(order):
        return Weights(found, values, 0.0)
    found, values = found[order], values[order]
    return Weights(found[1:], values[1:], float(values[0]))


def examples(batch: pa.RecordBatch) -> list[tuple[int, str, int, np.ndarray]]:
    """(hash of the id, id, label, places) of each row; the hash gives the order of learning."""
    ids, labels, lists = batch.column("id").to_pylist(), batch.column("label").to_pylist(), batch.column("places")
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [
        (xxhash.xxh3_64_intdigest(i), i, label, flat[at[k] : at[k + 1]].copy())
        for k, (i, label) in enumerate(zip(ids, labels, strict=True))
    ]


def score(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id and score of every row. Null and empty texts score by the bias alone; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value.table(), shared.value.bias
        for batch in batches:
            for part in slices(batch):
                value = scores(PlainWords(part.column("text")), table, bias)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value.table(), shared.value.bias
        for batch in batches:
            for part in slices(batch):
                value = scores(PlainWords(part.column("text")), table, bias)
                yield part.filter(pa.array(value < threshold))

    return map_rows(docs, run)
