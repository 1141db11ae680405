import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from landfall.llm.tokens import WordTokens
from landfall.llm.words import PlainWords, Words, slices, windows

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "a", "a b\n\tc\x0bd\x0c e\r", "It's THE'LL don't, x²½ ... '' 's", "a<|endoftext|>b <|startoftext|>, X<|ENDOFTEXT|>",
    "İstanbul ΣΑΣ naïvé éá b \x1c \x85z 你好 ﬁ ​", "é,è. ×. ÷! ñ### ok### 12.5% ---", "w" * 3000 + " " + "é" * 600, " x y",
]


def found(words):
    return [[words.word(i) for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def test_words_are_what_split_gives():
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert found(Words(pa.array(texts))) == [(t or "").encode().split() for t in texts]
    lower = [(t or "").encode().lower().split() for t in texts]
    assert found(Words(pa.array(texts), lower=True)) == lower


def test_hashes_depend_on_the_word_alone():
    texts = ["alpha beta gammagammagamma " + "long" * 500, "beta " + "long" * 500, "gammagammagamma alpha"]
    words = Words(pa.array(texts))
    hashes, names = words.hashes().tolist(), [w for t in found(words) for w in t]
    assert len({(n, h) for n, h in zip(names, hashes, strict=True)}) == len(set(names)) == len(set(hashes))


def test_windows_and_plain_words():
    words = PlainWords(pa.array(["One, two;three--four", "x", None]))
    assert found(words) == [[b"one", b"two", b"three", b"four"], [b"x"], []]
    hashes = words.hashes()
    assert len(windows(hashes, 3)) == 3 and len(windows(hashes[:2], 3)) == 0
    assert windows(hashes, 2)[0] != windows(hashes[::-1], 2)[-1]


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * 50, "", "c" * 10])})
    assert [p.num_rows for p in slices(batch, limit=20)] == [2, 1, 2]
    assert list(slices(batch.slice(0, 0))) == []


def test_ids_equal_the_tokenizer(sf_rows):
    whole, own = Tokenizer.from_file(PATH), WordTokens(PATH)
    texts = ODD + [t for _, t in sf_rows]
    for group in ([t for t in texts if "<|" not in (t or "")], texts):
        ids, first = own.encode(Words(pa.array(group)))
        for i, text in enumerate(group):
            assert ids[first[i] : first[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids
