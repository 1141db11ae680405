import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from landfall.llm.token_counts import TokenCounts, count_tokens, merge_count

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", "▁", "▁▁ ▁", "a\n\nb\t c", "<s> </s><unk> <0x0A>", "İstanbul ß ﬁ ½ 漢字かな交じり 🙂🙂 ​\x00x", "x" * 5000 + " " * 70 + "é" * 900,
    "int main() {\n\treturn 0; //  ok\n}", "don't  stop,  now...  \r\n",
]


def test_counts_are_the_library_s():
    rng = random.Random(5)
    alphabet = "abcdeéß ▁\n.,(1漢🙂"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    library = SentencePieceProcessor(model_file=PATH)
    counter = TokenCounts(PATH)
    want = [len(library.encode(t)) for t in texts]
    assert counter.count(texts).tolist() == want
    assert counter.count(texts[::-1]).tolist() == want[::-1]  # chunks remembered
    assert counter.count([]).tolist() == []


def test_lowest_rank_first_then_leftmost():
    ranks = {"ab": 2.0, "bc": 1.0, "abc": 3.0, "aa": 5.0, "aaa": 4.0}
    assert merge_count("abc", ranks) == 2  # bc, then a with bc
    assert merge_count("aaaa", ranks) == 2  # aa, then aaa by its lower rank; the last a stays
    assert merge_count("", ranks) == merge_count("x", ranks) == 0


def test_whole_table(spark, sf_docs, sf_rows):
    library = SentencePieceProcessor(model_file=PATH)
    want = [(d, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 900) for d, t in sf_rows]
    assert sorted(map(tuple, count_tokens(sf_docs, PATH, 900).collect())) == sorted(want)


def test_odd_rows(edge_docs, empty_docs):
    rows = count_tokens(edge_docs, PATH).collect()
    library = SentencePieceProcessor(model_file=PATH)
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in edge_docs.collect()]
    assert sorted([tuple(r)[:3] for r in rows], key=str) == sorted(want, key=str)
    assert [r["over_limit"] for r in rows if r["doc_id"] == 8] == [True]
    assert count_tokens(empty_docs, PATH).collect() == []


def test_other_kinds_of_model_are_refused(tmp_path):
    with pytest.raises(Exception):  # noqa: B017 - the library's own error
        TokenCounts(str(tmp_path / "none.model"))
