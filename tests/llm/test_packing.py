import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm import packing
from landfall.llm.queries import op6_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def pieces(rows, capacity):
    """(doc_id, piece, start, length, crc) of every piece, cut the plain way."""
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out += [(doc, k, s, len(ids[s : s + capacity]), crc(ids[s : s + capacity])) for k, s in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=str)


def check(placed, rows, capacity):
    result = [tuple(r) for r in placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert sorted((r[:5] for r in result), key=str) == pieces(rows, capacity)
    held = defaultdict(list)
    for r in result:
        held[r[5]].append((r[6], r[3]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(r[3] for r in result)


def test_query_packs_all_documents_tightly(spark, sf_rows):
    sequences, ids = check(op6_packing(spark, "/root/testdata/sf0.001"), sf_rows, 2048)
    assert sequences <= -(-ids // 2048) * 1.02 + 1


def test_small_capacity_and_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(packing.pack_documents(edge_docs, PATH, 64), rows, 64)
    assert packing.pack_documents(empty_docs, PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 300))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 3000))) if seed % 2 else (rng.beta(1, 4, 2000) * (capacity - 1)).astype(int) + 1
    histogram = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.pack_histogram(histogram, capacity)
    used = Counter()
    for pattern, count in plan.items():
        assert sum(pattern) <= capacity and count > 0
        for length in pattern:
            used[length] += count
    assert used == Counter(lengths.tolist())
    places = packing.layout(plan)
    assert places.count.sum() == len(lengths)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(9)
    lengths = np.minimum((rng.lognormal(6, 1, 200_000)).astype(int) + 1, 2048)
    plan = packing.pack_histogram(np.bincount(lengths, minlength=2049), 2048)
    assert sum(plan.values()) <= 1.002 * lengths.sum() / 2048 + 1


def test_fit_solves_an_exact_histogram():
    patterns = packing.full_patterns(np.array([2, 3, 5]), 8)
    assert sorted(map(tuple, patterns.tolist())) == [(3, 3, 2), (5, 3, 0)]
    histogram = np.zeros(9)
    histogram[[2, 3, 5]] = [10, 26, 6]
    assert np.allclose(packing.fit_counts(patterns, histogram), [6, 10] if tuple(patterns[0]) == (5, 3, 0) else [10, 6], atol=0.05)


def test_sequences_hold_the_ids(spark, sf_docs, sf_rows):
    placed = packing.pack_documents(sf_docs, PATH)
    built = {r["sequence_id"]: (r["doc_ids"], r["ids"]) for r in packing.sequences(placed, sf_docs, PATH).collect()}
    for r in placed.collect():
        doc_ids, ids = built[r["sequence_id"]]
        assert r["doc_id"] in doc_ids
        assert crc(ids[r["offset"] : r["offset"] + r["length"]]) == r["ids_crc32"]
