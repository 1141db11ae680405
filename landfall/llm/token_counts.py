"""Token counts by heap-and-linked-list byte-pair merging (operator 12).

The symbols of a string form a linked list; a heap holds the adjacent pairs that
are pieces of the vocabulary. The pair of lowest rank is merged again and again,
so the number of tokens is the number of symbols at first minus the merges, and
no token is ever named. A character outside the vocabulary counts as its UTF-8
bytes. Two characters that stand side by side in no piece can never be merged:
texts are cut there, and each distinct chunk is merged once per worker.
"""

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from sentencepiece import SentencePieceProcessor

from landfall.llm.words import MULTIPLIERS, mix, slices, text_bytes

# The mark that stands for a space, before the text too.
MARK = "▁"
LIMIT = 4096
# Distinct chunks a worker remembers; beyond it the store starts anew.
STORE_CHUNKS = 1_000_000
CODES = 0x110000


def merge_count(chunk: str, ranks: dict[str, float]) -> int:
    """Merges in a chunk. Ends link each symbol to the next one; of equal ranks the leftmost pair goes first."""
    size = len(chunk)
    ends, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(ranks[chunk[i : i + 2]], i, i + 2) for i in range(size - 1) if chunk[i : i + 2] in ranks]
    heapify(heap)
    merges = 0
    while heap:
        _, left, stop = heappop(heap)
        right = ends[left]
        if not left < right < size or ends[right] != stop:
            continue  # one of the two has been merged since
        merges += 1
        ends[left], ends[right] = stop, 0
        if stop < size:
            before[stop] = left
            rank = ranks.get(chunk[left : ends[stop]])
            if rank is not None:
                heappush(heap, (rank, left, ends[stop]))
        if before[left] >= 0:
            rank = ranks.get(chunk[before[left] : stop])
            if rank is not None:
                heappush(heap, (rank, before[left], stop))
    return merges


class TokenCounts:
    """Counts tokens of texts under one vocabulary; remembers the chunks it has seen."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        probe = " a  b\tİ²ﬁ"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path} changes more of a text than its spaces")
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.ranks = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        letters = sorted({c for piece in self.ranks for c in piece})
        self.known = frozenset(c for c in letters if c in self.ranks)
        self.index = np.zeros(CODES, np.uint16)
        self.index[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        place = {c: i + 1 for i, c in enumerate(letters)}
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for piece in self.ranks:
            for a, b in zip(piece, piece[1:], strict=False):
                self.beside[place[a], place[b]] = True
        self.seen: dict[int, int] = {}

    def tokens(self, chunk: str) -> int:
        symbols = sum(1 if c in self.known else len(c.encode()) for c in chunk)
        return symbols - merge_count(chunk, self.ranks)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; an empty one has none."""
        texts = [MARK + t if t else "" for t in texts]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).copy()
        if not len(codes):
            return np.zeros(len(texts), np.int64)
        codes[codes == ord(" ")] = ord(MARK)
        at = self.index[codes]
        fresh = np.ones(len(codes) + 1, bool)
        fresh[1:-1] = ~self.beside[at[:-1], at[1:]]
        fresh[bounds] = True
        starts = np.flatnonzero(fresh[:-1])
        lengths = np.diff(starts, append=len(codes))
        places = (np.arange(len(codes)) - np.repeat(starts, lengths)).astype(np.uint64)
        keys = np.add.reduceat(mix((places << np.uint64(21)) + codes + np.uint64(1)), starts)
        keys = mix(keys * MULTIPLIERS[0] + lengths.astype(np.uint64))
        distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.seen) > STORE_CHUNKS:
            self.seen = {}
        held = [self.seen.get(k) for k in distinct.tolist()]
        for i in (i for i, n in enumerate(held) if n is None):
            begin = int(starts[sample[i]])
            chunk = codes[begin : begin + int(lengths[sample[i]])].tobytes().decode("utf-32-le")
            held[i] = self.seen[int(distinct[i])] = self.tokens(chunk)
        total = np.concatenate(([0], np.cumsum(np.array(held, np.int64)[inverse])))
        first = np.searchsorted(starts, bounds)
        return total[first[1:]] - total[first[:-1]]


@lru_cache(maxsize=2)
def token_counts(path: str) -> TokenCounts:
    """The worker's counter for a vocabulary file; it outlives a task."""
    return TokenCounts(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    ``path`` is a byte-pair model of the sentencepiece library that leaves texts
    as they are but for spaces. ``docs`` needs doc_id and text; other columns are
    ignored. Null and empty texts have no bytes and no tokens. Special strings
    in a text are text. Repeated rows are counted each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counts(path)
        for batch in batches:
            for part in slices(batch):
                texts = text_bytes(part.column("text"))
                counts = counter.count([t.decode() for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts), pa.array(counts > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    fields = T._parse_datatype_string("n_bytes long, n_tokens long, over_limit boolean").fields
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *fields]))
