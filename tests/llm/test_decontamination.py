import random

import numpy as np
import pytest

from landfall.llm import decontamination as d
from landfall.llm.queries import op4_decontamination


def plain_score(text, item):
    """Smith-Waterman over the whole text, cell by cell."""
    best, before = 0, [0] * (len(text) + 1)
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, before[j] + (d.MATCH if other == word else d.MISMATCH), before[j + 1] + d.GAP, row[j] + d.GAP))
        best, before = max(best, *row), row
    return best


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(1)
    for _ in range(300):
        text, item = (rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64) for _ in range(2))
        score, end = d.align(text, item)
        assert score == plain_score(text.tolist(), item.tolist())
        assert score == 0 or plain_score(text[:end].tolist(), item.tolist()) == score


def made(rng):
    items = [(i, " ".join(f"w{rng.randint(0, 4000)}" if rng.random() < 0.7 else "the" for _ in range(rng.randint(9, 50)))) for i in range(30)]
    prose = lambda n: " ".join(f"w{rng.randint(0, 4000)}" if rng.random() < 0.6 else "the" for _ in range(n))
    docs, leaks = [], {}
    for i in range(240):
        text = prose(rng.randint(0, 200))
        if i % 3 == 0:
            k = rng.randrange(30)
            words = items[k][1].split()
            if i % 6 == 0:  # edited: a tenth of the words exchanged, one dropped, marks and capitals
                words = [w if rng.random() > 0.1 else "edited" for w in words]
                del words[rng.randrange(len(words))]
                words = [w.capitalize() + rng.choice(["", ",", "."]) for w in words]
            text = f"{text} {' '.join(words)} {prose(rng.randint(0, 50))}"
            leaks[i] = k
        docs.append((i, text))
    return items, docs, leaks


@pytest.mark.parametrize("block_words", [1_000_000, 120])
def test_leaks_are_found_and_nothing_else(spark, block_words):
    items, docs, leaks = made(random.Random(3))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([*items, (77, None), (78, ""), (79, "...")], "item_id long, text string")
    found = {(r["doc_id"], r["item"]): r["score"] for r in d.contaminated(frame, benchmark, block_words=block_words).collect()}
    assert set(found) == set(leaks.items())
    assert all(found[i, k] == 1.0 for i, k in leaks.items() if i % 6)
    kept = d.drop_contaminated(frame, benchmark, block_words=block_words)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(240) if i not in leaks]


def test_query_agrees_with_a_plain_search(spark, sf_rows):
    sf = "/root/testdata/sf0.001"
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    verbatim = {(doc, i) for doc, text in sf_rows for i, item in items.items() if item in (text or "")}
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in op4_decontamination(spark, sf).collect()}
    assert verbatim <= set(found) and all(found[k] == 1.0 for k in verbatim)
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "")).lower().split()
    for doc, text in sf_rows:
        mine = words(text)
        if len(mine) <= 150:
            for i, item in items.items():
                target = words(item)
                score = plain_score(mine, target) / (d.MATCH * len(target)) if mine else 0
                assert ((doc, i) in found) == (score >= d.THRESHOLD)


def test_edge_cases(spark, edge_docs, empty_docs):
    benchmark = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six"), (3, "z")], "item_id long, text string")
    found = sorted((r["doc_id"], r["item"]) for r in d.contaminated(edge_docs, benchmark).collect())
    assert found == [(5, 1), (6, 1), (6, 1), (9, 3)]
    assert d.drop_contaminated(edge_docs, benchmark).columns == edge_docs.columns
    assert d.drop_contaminated(edge_docs, benchmark.limit(0)).count() == 11
    assert d.drop_contaminated(empty_docs, benchmark).count() == 0


def test_a_long_excerpt_of_a_long_item(spark):
    rng = random.Random(21)
    vocabulary = [f"word{i}" for i in range(4000)]
    item = [rng.choice(vocabulary) for _ in range(500)]
    other = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(n, f"{other(80)} {' '.join(item[150 : 150 + n])} {other(80)}") for n in (10, 40, 60, 200, 240)] + [(0, other(700))]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in d.contaminated(docs, bench).collect()}
    assert sorted(found) == [60, 200, 240] and found[200] == 1.0
    assert sorted(r["doc_id"] for r in d.drop_contaminated(docs, bench).collect()) == [0, 10, 40]
