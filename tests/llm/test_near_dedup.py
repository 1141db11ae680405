import random

import pytest

from landfall.llm.components import components
from landfall.llm.near_dedup import drop_near_duplicates, near_components


def brute(rows, n, percent):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
        sets.append(frozenset(grams))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def family(rng, first, size, edits):
    """A text, copies of it with a few words exchanged, and copies of those."""
    words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(15, 120))]
    texts = [words]
    for _ in range(size):
        copy = list(rng.choice(texts))
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 3000)}"
        texts.append(copy)
    return [(first + i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words", [2, 5])
def test_families_match_all_pairs(spark, words):
    rng = random.Random(words)
    rows = [r for f in range(14) for r in family(rng, 1000 * f, rng.choice([0, 3, 25]), rng.choice([2, 6]))]
    rows += [(90_000 + i, " ".join(rng.choice(["a", "b", "c"]) for _ in range(rng.randint(1, 7)))) for i in range(60)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_components(docs, words)) == brute(rows, words, 80)


def test_copies_of_one_base_that_are_apart_from_each_other(spark):
    """The base links to each, they do not link to each other, and its id is not the least."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(200), 9):
            copy[at] = f"x{i}_{at}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = got(near_components(docs, 2))
    assert result == brute(rows, 2, 80)


@pytest.mark.parametrize("block", [1024, 3])
def test_blocks_compare_what_stars_leave(spark, monkeypatch, block):
    """Without a second round, and with blocks of three members, the result is the same."""
    import functools

    import landfall.llm.near_dedup as module

    monkeypatch.setattr(module, "ROUNDS", (1,))
    monkeypatch.setattr(module, "block_links", functools.partial(module.block_links, block=block))
    rng = random.Random(21)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(70):
        copy = list(base)
        for at in rng.sample(range(150), rng.randint(3, 14)):
            copy[at] = f"x{rng.randint(0, 25)}_{at}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = got(near_components(docs, 2))
    assert result == brute(rows, 2, 80) and len({r[2] for r in result}) > 1


def test_real_rows(spark, sf_docs, sf_rows):
    assert got(near_components(sf_docs, 2)) == brute(sf_rows, 2, 80)


def test_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    expected = [(d, n, c, True if d is None and c is None else k) for d, n, c, k in brute(rows, 2, 80)]
    assert got(near_components(edge_docs, 2)) == sorted(expected, key=str)
    assert near_components(empty_docs).count() == 0


def test_stage_keeps_one_of_each_group(edge_docs, empty_docs):
    kept = drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, 8, None, 9], key=str)
    assert drop_near_duplicates(empty_docs).count() == 0


def test_stage_judges_rows_not_ids(spark):
    first, second, third, fourth, fifth = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcde")
    rows = [
        (1, first), (1, first), (1, second),  # a repeated kept row; another text of that id
        (2, first + " more"), (2, third),  # one text a near copy of another document, one not
        (None, first + " again"), (None, fourth), (None, fourth), (None, None), (None, ""), (None, None),
        (3, fifth), (3, fifth + " more"), (4, None), (4, ""), (4, None),
    ]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = [tuple(r) for r in kept.collect()]
    of_three = [r for r in found if r[0] == 3]
    assert len(of_three) == 1 and of_three[0] in rows
    expected = [(1, first), (1, second), (2, third), (None, fourth), (None, None), (None, ""), (4, None), (4, "")]
    assert sorted((r for r in found if r[0] != 3), key=str) == sorted(expected, key=str)


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = spark.createDataFrame(chain + star + [(7, 7), (3, 2)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}


def test_query_against_its_sql(spark):
    import duckdb

    from landfall.llm.queries import ORACLE, op10_near_dedup

    sf = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    result = connection.execute(ORACLE["op10_near_dedup"])
    names = [c[0] for c in result.description]
    assert got(op10_near_dedup(spark, sf).select(*names)) == sorted(result.fetchall(), key=str)
