import hashlib
import os
import random
import tracemalloc
from collections import Counter

import pytest

from landfall.llm.queries import op8_suffix_dedup
from landfall.llm.suffix_dedup import (
    HOT_REGIONS, PREFIX, Entry, counted_stretches, regions, repeated_places, repeated_stretches, window_rows, without_repeats,
)
from landfall.llm.suffix_runs import front_coded, merge


def brute(rows, length):
    """(doc_id, spans, kept) by counting every window of every text."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [i for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((doc, len(t), sum(gone), len(spans), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    return sorted(
        ((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in rows), key=str
    )


def passages(rng):
    """Random texts that share stretches of many lengths, some cut short, some repeated inside a text, some periodic."""
    make = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [make(rng.randint(20, 140)) for _ in range(8)]
    rows = []
    for i in range(90):
        parts = []
        for _ in range(rng.randint(1, 5)):
            part = rng.choice(shared)
            a = rng.randint(0, len(part) // 2)
            parts += [make(rng.randint(0, 60)), part[a : rng.randint(a, len(part))]]
        if i % 15 == 0:
            parts.append(rng.choice(["ab", "x", "abcdefg"]) * rng.randint(10, 40))
        rows.append((i, "".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(5)]
    return rows


@pytest.mark.parametrize("hot", [200_000, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_every_byte_as_by_brute_force(spark, seed, hot):
    rows = passages(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(without_repeats(docs, length=40, gram=16, hot_regions=hot)) == brute(rows, 40)


def test_memory_of_the_largest_group():
    """Strings that differ at one end, as many as may meet in one group, by what a thousand of them need."""
    rng, count = random.Random(6), 1000
    passage = rng.randbytes(400 + 60)
    strings = sorted(b"\0" * PREFIX + passage + rng.randbytes(77) for _ in range(count))
    group = [Entry(s, 0, False, [(b"k" * 16, i)]) for i, s in enumerate(strings)]
    tracemalloc.start()
    found = list(repeated_stretches(group, 400))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = Counter(s[PREFIX + o : PREFIX + o + 400] for s in strings for o in range(138))
    ends = [max(o for o in range(138) if seen[s[PREFIX + o : PREFIX + o + 400]] > 1) + 400 for s in strings]
    assert found == [(b"k" * 16, i, i + end) for i, end in enumerate(ends)] and min(ends) == 460
    assert peak / count * HOT_REGIONS < 300e6


def shuffled_rows(df, key):
    """Rows written by the shuffles by ``key`` of an executed frame."""
    rows, nodes = [], [df._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange" and f"hashpartitioning({key}#" in node.simpleString(100):
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
    return rows


def test_rows_of_a_hot_gram_are_not_dealt_by_gram(spark, tmp_path):
    rows = [(7, i % 9, i) for i in range(3000)] + [(8, i, 5) for i in range(20)] + [(100 + i, i, 6) for i in range(50)] + [(9, 1, 8), (9, 1, 9)]
    spark.createDataFrame(rows, "gram long, short long, place long").write.parquet(str(tmp_path / "rows"))
    # As for tables too large for a broadcast.
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = repeated_places(spark.read.parquet(str(tmp_path / "rows")), 20)
        places = {r["short"]: (sorted(r["merged"]), sorted(r["counted"])) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    wanted = {i: ([5] + [8, 9] * (i == 1), [p for p in range(3000) if p % 9 == i] if i < 9 else []) for i in range(20)}
    assert places == wanted
    assert 0 < sum(shuffled_rows(found, "gram")) < 500


def test_windows_of_a_periodic_text_travel_once(spark, tmp_path):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
    line = noise(30)
    data = noise(50) + line * 40 + noise(70) + line * 3 + noise(20)
    first, last, _ = regions(data, 40, 16)
    hashes, starts, sizes, held = window_rows(data, first, last, 40)
    assert sum(held) == len(data) - 39 and len(hashes) < 300
    covered = lambda ranges: {i for a, b in ranges for i in range(a, b)}
    seen = Counter(data[i : i + 40] for i in range(len(data) - 39))
    wanted = covered((i, i + 40) for i in range(len(data) - 39) if seen[data[i : i + 40]] > 1)
    often = {h for h, n in zip(hashes, held, strict=True) if n > 1}
    assert covered((a, a + n) for h, a, n in zip(hashes, starts.tolist(), sizes.tolist(), strict=True) if h in often) == wanted
    rows = [(b"1" * 16, data, copies, first.tolist()) for copies in (1, 2)]
    spark.createDataFrame(rows[:1], "key binary, data binary, copies int, counted array<long>").write.parquet(str(tmp_path / "rows"))
    found = counted_stretches(spark.read.parquet(str(tmp_path / "rows")), 40, 16)
    assert covered((r["start"], r["end"]) for r in found.collect()) == wanted
    assert found.count() < 100
    assert counted_stretches(spark.createDataFrame(rows[1:], "key binary, data binary, copies int, counted array<long>"), 40, 16).count() == 0


def test_segments_of_a_long_text(spark, monkeypatch):
    import landfall.llm.suffix_dedup as module

    monkeypatch.setattr(module, "SEGMENT", 64)
    rng = random.Random(5)
    data = "".join(rng.choice("abcd") for _ in range(700))
    raw = data.encode()
    whole, cut = module.regions(raw, 40, 16), None
    monkeypatch.setattr(module, "SEGMENT", 1 << 20)
    cut = module.regions(raw, 40, 16)
    spread = lambda r: {p: a for f, b, a in zip(*r, strict=True) for p in range(f, b + 1)}
    assert spread(whole) == spread(cut) and len(spread(cut)) == 661


def test_query_on_real_rows(spark, sf_rows):
    expected = [(d, n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in brute(sf_rows, 400)]
    result = [tuple(r)[:5] for r in op8_suffix_dedup(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(result, key=str) == sorted(expected, key=str)


def test_edge_cases(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(without_repeats(edge_docs, length=20, gram=8)) == brute(rows, 20)
    assert without_repeats(empty_docs).count() == 0


def test_merge_of_front_coded_runs():
    rng = random.Random(1)
    for _ in range(400):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 8))}) for _ in range(rng.randint(0, 7))]
        merged = list(merge([front_coded(r) for r in runs]))
        assert [(s, i) for _, s, i in merged] == sorted((s, i) for i, r in enumerate(runs) for s in r)
        before = b""
        for shared, string, _ in merged:
            assert shared == len(os.path.commonprefix([before, string]))
            before = string
