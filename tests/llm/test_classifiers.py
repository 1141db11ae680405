import zlib

import numpy as np
import pyarrow as pa
import pytest

from landfall.llm import quality, toxicity
from landfall.llm.queries import op1_toxicity, op3_quality


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize(("query", "label", "threshold"), [(op1_toxicity, "toxic", 0.3), (op3_quality, "quality", 0.7)])
def test_held_out_accuracy(spark, query, label, threshold):
    sf = "/root/testdata/sf0.1"
    rows = query(spark, sf).collect()
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in rows)
    test = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p == t for p, t in test]) >= 0.95


def test_toxicity_learns_sparse_weights(spark):
    rows = [(i, f"word{i % 13} plain{i % 7} {'awful' if i % 4 == 0 else 'fine'} tail{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    weights = toxicity.learn(docs, labels)
    assert 0 < len(weights.places) < 200
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, weights).collect()}
    assert all((scores[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    left = toxicity.drop_toxic(docs, weights).collect()
    assert sorted(r["doc_id"] for r in left) == [i for i in range(400) if i % 4]


def test_training_matches_a_plain_ftrl():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(60)]
    y = np.array([float(3 in r) for r in rows])
    got = toxicity.train(rows, y, 2)
    z, n = {}, {}
    l1 = toxicity.L1_RATE * np.sqrt(60)

    def weight(i):
        cut = 0.0 if i == "bias" else l1
        if abs(z.get(i, 0.0)) <= cut:
            return 0.0
        return -(z[i] - np.sign(z[i]) * cut) / ((toxicity.BETA + np.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(2):
        for row, label in zip(rows, y, strict=True):
            keys = [*row.tolist(), "bias"]
            w = {i: weight(i) for i in keys}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i in keys:
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (np.sqrt(before + g * g) - np.sqrt(before)) / toxicity.ALPHA * w[i]
                n[i] = before + g * g
    want = {i: weight(i) for i in z if i != "bias" and weight(i)}
    assert dict(zip(got.places.tolist(), got.values.tolist(), strict=True)) == pytest.approx(want, rel=1e-5)
    assert got.bias == pytest.approx(weight("bias"))


def test_word_vectors_are_sums_of_neighbours():
    words = quality.MarkedWords(pa.array(["a b, a", "c"]))
    assert [words.word(i) for i in range(5)] == [b"a", b"b", b",", b"a", b"c"]
    buckets = words.buckets()
    places, signs = quality.index_vectors()
    total = np.zeros((quality.PLACES, quality.DIMENSIONS))
    for i in range(4):
        for j in range(4):
            if i != j and abs(i - j) <= quality.REACH:
                np.add.at(total[buckets[i]], places[buckets[j]], signs[buckets[j]])
    assert np.array_equal(quality.neighbour_sums(buckets, words.first).reshape(total.shape), total)


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(600) < 0.1)).astype(float)
    network = quality.train(x, y)
    assert np.mean((network.probability(x) >= 0.5) == y) > 0.8 and network.temperature > 0.5
    assert np.allclose(quality.train(x[:3], y[:3]).probability(x), (y[:3].sum() + 1) / 5)


def test_edge_cases(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (8, 1, 0), (99, None, None)], "doc_id long, toxic int, quality int")
    none = labels.limit(0)
    for given in (labels, none):
        weights = toxicity.learn(edge_docs, given)
        assert toxicity.score(edge_docs, weights).count() == 11
        assert toxicity.drop_toxic(edge_docs, weights, 1.1).collect() == edge_docs.collect()
    vectors = quality.word_vectors(edge_docs)
    network = quality.learn(edge_docs, labels, vectors)
    scores = {r["doc_id"]: r["score"] for r in quality.score(edge_docs, vectors, network).collect()}
    assert scores[1] == scores[2] == scores[3]
    assert toxicity.score(empty_docs, toxicity.learn(empty_docs, none)).count() == 0
    assert quality.score(empty_docs, quality.word_vectors(empty_docs), quality.learn(empty_docs, none, vectors)).count() == 0
