"""Token ids of whole texts, with each distinct word encoded once per worker.

The tokenizer drops white space and none of its tokens spans it, so the ids of a
text are the ids of its white-space separated chunks in order. A chunk of plain
Latin characters is cut into pre-tokens here and handed to the tokenizer's own
BPE model in one call for many chunks; every other chunk, and any that may hold
a special token, goes through the complete tokenizer.
"""

import copy
import os
import re
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from landfall.llm.words import LOWER, Words

# Distinct chunks kept by one worker; beyond it the store starts anew.
STORE_WORDS = 500_000

# The tokenizer's pre-token pattern and the mark of a word's end in its vocabulary.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
# Characters whose lower case and normal form are a matter of one character.
PLAIN = re.compile(r"[!-~¡-įı-ſ]+").fullmatch


# Marks cut off a word's end before it is looked up, and the bytes a cut may follow.
TAIL = np.zeros(256, bool)
TAIL[list(b".,!?;:#*$%&")] = True
ALNUM = np.zeros(256, bool)
ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
TAIL_BYTES = 8


def without_tails(words: Words) -> Words:
    """The same text cut finer: marks that follow a letter or digit at a word's end become words.

    A letter or digit and a mark never share a pre-token, so ids stay the same.
    ASCII letters become lower case unless the text may hold special tokens.
    """
    out = copy.copy(words)
    raw, starts, ends = words.raw, words.starts, words.ends
    if not len(starts):
        return out
    core = ends.copy()
    for _ in range(TAIL_BYTES):
        marks = (core > starts) & TAIL[raw[core - 1]]
        if not marks.any():
            break
        core = core - marks
    last, lead = raw[core - 1], raw[np.maximum(core - 2, 0)]
    accented = (lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7) & (core - starts >= 2)
    cut = (core > starts) & (core < ends) & (ALNUM[last] | accented)
    core = np.where(cut, core, ends)
    count = 1 + cut
    place = np.cumsum(count) - count
    out.starts, out.ends = np.repeat(starts, count), np.repeat(core, count)
    tails = place[cut] + 1
    out.starts[tails], out.ends[tails] = core[cut], ends[cut]
    out.first = np.concatenate((place, [count.sum()]))[words.first]
    if not ((raw[:-1] == ord("<")) & (raw[1:] == ord("|"))).any():
        out.raw = LOWER[raw]
    return out


def byte_letters() -> dict[int, int]:
    """Table of the byte-level alphabet: printable bytes stand for themselves, the others for 256 and up."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


class WordTokens:
    """Encodes batches of texts; keeps what it has learnt about words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        vocabulary = self.whole.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.is_end[i] = token.endswith(WORD_END)
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def pieces(self, chunk: str) -> list[str] | None:
        """Pre-tokens of a plain chunk in the model's alphabet, None for any other chunk."""
        if not PLAIN(chunk) or "<|" in chunk:
            return None
        found = PRE_TOKENS.findall(chunk.lower())
        if chunk.isascii():
            return found
        return [x.encode().decode("latin-1").translate(self.letters) for x in found]

    def learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        """Add chunks, whose sorted hashes are ``keys``, to the store."""
        ids: list = [None] * len(chunks)
        pre, counts, owners = [], [], []
        for i, chunk in enumerate(chunks):
            text = chunk.decode()
            found = self.pieces(text)
            if found is None:
                ids[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                pre += found
                counts.append(len(found))
                owners.append(i)
        if owners:
            got = self.bare.encode_batch_fast([pre], is_pretokenized=True, add_special_tokens=False)[0].ids
            got = np.array(got, np.uint32)
            ends = np.concatenate(([0], np.flatnonzero(self.is_end[got]) + 1))
            cuts = ends[np.concatenate(([0], np.cumsum(counts)))]
            for i, a, b in zip(owners, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                ids[i] = got[a:b]
        length = np.array([len(x) for x in ids], np.int64)
        slots = len(self.start) + np.arange(len(ids))
        self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(length) - length))
        self.length = np.concatenate((self.length, length))
        self.ids = np.concatenate((self.ids, *ids))
        place = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, place, keys), np.insert(self.slots, place, slots)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text begins in them (one entry more than texts)."""
        words = without_tails(words)
        hashes = words.hashes()
        if not len(hashes):
            return np.empty(0, np.uint32), np.zeros(len(words) + 1, np.int64)
        keys, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > STORE_WORDS:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            self.learn(keys[~known], [words.word(i) for i in sample[~known].tolist()])
            place = np.searchsorted(self.keys, keys)
        slots = self.slots[place][inverse]
        length = self.length[slots]
        end = np.cumsum(length)
        gather = np.repeat(self.start[slots] - (end - length), length) + np.arange(end[-1])
        return self.ids[gather], np.concatenate(([0], end))[words.first]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """The worker's encoder for a tokenizer file; it outlives a task."""
    return WordTokens(path)
