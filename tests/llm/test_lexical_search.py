import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from landfall.llm import lexical_search
from landfall.llm.lexical_search import Block, Corpus, Terms, best_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SF = "/root/testdata/sf0.001"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, top):
    held = [(d, Counter(terms(t))) for d, t in rows]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    sets = {}
    for item, text in items:
        sets.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in sets.items():
        scored = []
        for d, c in held:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted & c.keys()
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms_end_at_ascii_marks_only():
    texts = ["It's A-1 x_y\x7fz É é 漢字。b", None, "", " \t-"]
    found = Terms(pa.array(texts))
    got = [[found.word(i).decode() for i in range(a, b)] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    assert got == [terms(t) for t in texts]


@pytest.mark.parametrize("block_postings", [600_000, 700])
def test_whole_table(spark, sf_docs, sf_rows, block_postings):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    assert result(best_documents(sf_docs, benchmark, 50, block_postings=block_postings)) == brute(sf_rows, items, 50)


def test_ties_frequent_terms_and_blocks_of_items(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 6)))) for i in range(400)]
    rows += [(i, "the same text") for i in range(400, 480)]
    items = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(4))) for i in range(30)] + [(90, "SAME text"), (91, "-"), (92, "nowhere")]
    docs, bench = spark.createDataFrame(rows, "doc_id int, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items, 7)
    assert result(best_documents(docs, bench, 7, block_postings=40)) == want
    assert result(best_documents(docs, bench, 7, block_terms=20)) == want


def test_bounds_prune(monkeypatch):
    """Few documents are scored where one item term is rare."""
    n, scored = 5000, []
    ids, length = np.arange(n), np.full(n, 10)
    place = np.concatenate([[0, 1] if i == 4321 else [0] for i in range(n)])
    count = np.array([2 if i == 4321 else 1 for i in range(n)])
    block = Block(ids, length, place, count, np.ones(len(place)), Corpus(n, 10 * n, np.array([1, 9000])))
    best = lexical_search.Best(1)
    add = best.add
    monkeypatch.setattr(best, "add", lambda i, s: (scored.extend(i.tolist()), add(i, s)))
    lexical_search.search_block(block, np.array([0, 1]), best)
    assert best.ids.tolist() == [4321] and len(scored) < 60


def test_odd_rows(spark, edge_docs, empty_docs):
    items = spark.createDataFrame(
        [(1, "one TWO", "x"), (1, "three", "x"), (1, "three", "x"), (None, "漢字 text", "y"), (2, None, "y"), (3, "word x", "z")],
        "item_id long, text string, doc_id string",
    )
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert result(best_documents(edge_docs, items)) == brute(rows, [(r["item_id"], r["text"]) for r in items.collect()], 50)
    assert best_documents(empty_docs, items).collect() == []
    nothing = best_documents(edge_docs, items.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
