import zlib
from collections import defaultdict

import pytest

from landfall.llm.queries import op2_sharding
from landfall.llm.sharding import longest_first, shard_documents


def check(df, rows, shards):
    result = [tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]
    data = [(d, (t or "").encode()) for d, t in rows]
    assert sorted((r[:3] for r in result), key=str) == sorted(((d, len(t) + 1, zlib.crc32(t)) for d, t in data), key=str)
    slots, homes, loads = defaultdict(list), defaultdict(set), defaultdict(int)
    for _, size, crc, shard, slot in result:
        assert 0 <= shard < shards
        slots[shard].append(slot)
        homes[crc, size].add(shard)
        loads[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    return [loads[s] for s in range(shards)]


def test_query_is_even(spark, sf_rows):
    df = op2_sharding(spark, "/root/testdata/sf0.001")
    assert {(r["law"], r["grown_shard"]) for r in df.select("law", "grown_shard").distinct().collect()} == {("bytes", None)}
    loads = check(df, sf_rows, 16)
    assert max(loads) <= max(1.05 * sum(loads) / 16, max(len((t or "").encode()) for _, t in sf_rows) * 1.2)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_a_third_of_all_rows_alike(spark, shards):
    rows = [(i, "the same text again " * 5) for i in range(300)] + [(300 + i, f"text {i} " * (i % 17 + 1)) for i in range(600)]
    loads = check(shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards), rows, shards)
    rest = sorted(loads)[: shards - 1]
    assert not rest or max(rest) - min(rest) <= 0.02 * max(rest) + 20


def test_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(shard_documents(edge_docs, 4), rows, 4)
    assert shard_documents(empty_docs, 4).count() == 0


def test_longest_goes_to_the_least_loaded():
    placed = longest_first([(7, (0,)), (5, (1,)), (4, (2,)), (3, (3,)), (2, (4,))], 2)
    assert placed == {(0,): 0, (1,): 1, (2,): 1, (3,): 0, (4,): 1}
