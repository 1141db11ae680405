import random
import re
import string
from collections import Counter

import pyarrow as pa
import pytest
import zstandard

from landfall.llm.queries import op9_quality_rules
from landfall.llm.quality_rules import chunk_scores, keep_by_rules, repeated_words
from landfall.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, the plain way."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held, covered = Counter(triples), set()
    for i, t in enumerate(triples):
        if held[t] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def check(df, rows):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    result = df.select(*names, "kept").collect()
    assert sorted((tuple(r)[:7] for r in result), key=str) == sorted(((d, *base(t)) for d, t in rows), key=str)
    assert not any(r["kept"] and r["base_failed"] for r in result)
    return {r["doc_id"]: r["kept"] for r in result}


def test_query_on_real_rows(spark, sf_rows):
    kept = check(op9_quality_rules(spark, "/root/testdata/sf0.001"), sf_rows)
    good = {r["doc_id"] for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").collect()}
    long = [d for d, t in sf_rows if d in good and len((t or "").split()) >= 50]
    assert sum(kept[d] for d in long) >= 0.98 * len(long)


def test_edge_cases(edge_docs, empty_docs):
    check(keep_by_rules(edge_docs), [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert keep_by_rules(empty_docs).count() == 0


def test_bands(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(900))
    caps = (" ".join(rng.choice(vocabulary) for _ in range(40)) + "\n") * 1
    noise = "".join(rng.choice(string.printable[:94]) + (" " if i % 6 == 0 else "") for i in range(6000))
    half = prose + "".join(chr(rng.randint(0x4E00, 0x9FFF)) + (" " if i % 5 == 0 else "") for i in range(4000))
    repeats = "".join(f"{caps.strip()} {i}\n" for i in range(60))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, repeats), (4, half)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in keep_by_rules(docs).collect()}
    assert found[1]["kept"] and not found[3]["kept"]
    assert not found[2]["kept"] and not found[2]["base_failed"] and not found[2]["in_text_band"]
    assert not found[4]["in_chunk_band"]


@pytest.mark.parametrize("size", [600, 1500, 3000, 8100])
def test_junk_at_either_end_of_a_text(spark, size):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(3000))
    junk = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(size))
    half = size // 2 + 20
    rows = [(1, prose[:size]), (2, prose[:half] + " " + junk[: size - half]), (3, junk[: size - half] + " " + prose[:half])]
    found = {r["doc_id"]: r for r in keep_by_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["in_chunk_band"] and found[1]["in_text_band"]
    assert not found[2]["in_chunk_band"] and not found[3]["in_chunk_band"]


def test_chunks_reach_the_end():
    compressor = zstandard.ZstdCompressor(level=3)
    sizes = {0: 0, 511: 0, 512: 1, 513: 2, 1023: 2, 1024: 1, 4095: 4, 4096: 1, 4097: 2, 8192: 2, 8193: 3}
    assert {n: chunk_scores(compressor, b"x" * n)[0] for n in sizes} == sizes


def test_repeats_stay_inside_their_text():
    texts = ["a b c", "a b c d a b c", "x y z x y", "", "b c d"]
    assert repeated_words(Words(pa.array(texts))).tolist() == [0, 6, 0, 0, 0]


def test_only_a_fitted_band_rejects(spark):
    """Lists of short cells and lines of codes, all words distinct, pass the base rules and the fixed limits."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(200, 260)))) for i in range(300)]
    codes = [(i, " ".join("".join(rng.choice("ABCDEFGHIJKLMNOP0123456789") for _ in range(6)) for _ in range(200))) for i in range(300, 304)]
    cells = [(i, " | ".join(f"item {k} of {i}" for k in range(90))) for i in range(304, 308)]
    docs = spark.createDataFrame(rows + codes + cells, "doc_id long, text string")
    found = {r["doc_id"]: r for r in keep_by_rules(docs).collect()}
    junk = [found[i] for i, _ in codes]
    assert not any(r["base_failed"] or r["kept"] for r in junk) and all(r["in_chunk_band"] for r in junk)
    assert sum(found[i]["kept"] for i, _ in rows) >= 298


def test_few_texts_of_a_length_are_not_told_apart(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randint(0, 10**n)}" for _ in range(80)) for n in (3, 4, 5)]
    rows = keep_by_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r["in_text_band"] for r in rows)
