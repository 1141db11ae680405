import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from landfall.llm import spelling
from landfall.llm.spelling import Runs, spelling_groups


def brute(rows, least=5):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{d}:{run}".encode())
            if d is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least}
    near = defaultdict(set)
    holders = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holders[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in counts:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for held in holders.values():
        for w in held:
            near[w] |= held - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table(sf_docs, sf_rows):
    got = result(spelling_groups(sf_docs))
    assert got == brute(sf_rows) and any(r[1] for r in got)


@pytest.mark.parametrize("range_words", [3, 100_000])
def test_dense_words_over_many_ranges(spark, monkeypatch, range_words):
    """Words of few letters, near each other in every way, whatever range of a trie they fall in."""
    monkeypatch.setattr(spelling, "RANGE_WORDS", range_words)
    rng = random.Random(range_words)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(300)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "y" * 3000, "y" * 3001}
    times = {"zzzzzz": 3, "zzzzzzx": 20, "zzzzzzxx": 140}  # a chain of forms
    rows = []
    for i, w in enumerate(sorted(words | set(times))):
        count = times.get(w) or rng.choice([1, 2, 3, 12, 60])
        rows += [(i * 1000 + k, f"{w.upper() if w.isascii() else w}-{w} {w}") for k in range(count)]
    got = result(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert ("zzzzzz", "zzzzzzx", "zzzzzzxx") in [r[:3] for r in got]


def test_checksums_and_damage():
    texts = ["Häuser, häuser Straßenbahn " + "q" * 200, None, "", "ÀÿÀÿÀÿ x", "abcdef"]
    runs = Runs(pa.array(texts), 6)
    seeds = np.array([crc32(f"{i}:".encode()) for i in range(5)], np.uint32)
    owner = np.repeat(np.arange(5), np.diff(runs.first))
    words = [runs.word(i).decode() for i in range(len(owner))]
    assert words == ["häuser", "häuser", "straßenbahn", "q" * 200, "ÀÿÀÿÀÿ", "abcdef"]
    assert runs.length.tolist() == [len(w) for w in words]
    assert runs.checksums(seeds).tolist() == [crc32(f"{o}:{w}".encode()) for o, w in zip(owner.tolist(), words, strict=True)]
    held = [i for i in range(100_000) if crc32(f"{i}:abcdefgh".encode()) % 199 == 0][:4]
    got = Counter(dict(spelling.batch_words(held, pa.array(["abcdefgh"] * 4))))
    assert all(len(w) == 7 for w in got)


def test_odd_rows(edge_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert result(spelling_groups(edge_docs, least=1)) == brute(rows, 1)
    assert spelling_groups(empty_docs).collect() == []
