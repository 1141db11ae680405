"""Best-fit packing of token pieces into sequences by fitted length patterns (operator 6).

Only the histogram of piece lengths, at most ``capacity`` numbers, reaches the
driver. There, patterns of two or three lengths that fill a sequence are
enumerated, their repeat counts fitted to the histogram by non-negative least
squares and rounded, and what they leave is packed best-fit decreasing. Every
piece then finds its place by its rank among the pieces of its length.
"""

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from landfall.llm.common import PARTS
from landfall.llm.tokens import word_tokens
from landfall.llm.words import Words, slices
from landfall.workspace import written

CAPACITY = 2048
END_ID = 0
FIT_STEPS = 400

PIECES = "piece int, start long, length long, ids_crc32 long"


class Layout(NamedTuple):
    """Where the n-th piece of each length goes.

    Entry i takes ``count[i]`` pieces of ``length[i]``, ranks ``rank[i]`` and up, into
    sequences ``sequence[i]`` and up, at ``offset[i]``. Entries are sorted by length, rank.
    """

    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``capacity`` ids.

    Null and empty texts hold the end id alone and make one piece of length 1.
    """
    id_field = docs.schema["doc_id"]
    schema = T.StructType([T.StructField("doc_id", id_field.dataType), *T._parse_datatype_string(PIECES).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids, first = encoder.encode(Words(part.column("text")))
                flat = np.insert(ids.astype("<u4"), first[1:], end_id)
                begin = first + np.arange(len(first))
                size = np.diff(begin)
                pieces = -(-size // capacity)
                owner = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(size[owner] - start, capacity)
                view, at = memoryview(flat).cast("B"), begin[owner] + start
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def full_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Triples a >= b >= c of present lengths that add up to the capacity; c is 0 for pairs."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    present[0] = True
    found = [np.empty((0, 3), np.int64)]
    for a in np.flatnonzero(present[: capacity]).tolist():
        rest = capacity - a
        b = np.arange(-(-rest // 2), min(a, rest) + 1)
        b = b[(b > 0) & present[b] & present[rest - b]]
        found.append(np.stack([np.full(len(b), a), b, rest - b], 1))
    return np.concatenate(found)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts >= 0 that least miss the histogram, by accelerated projected gradients."""
    size = len(histogram)
    flat = patterns.ravel()
    used = np.where(np.arange(size) > 0, 1.0, 0.0)  # length 0 fills pairs up and counts nothing
    times = lambda x: np.bincount(flat, np.repeat(x, 3), size) * used
    back = lambda r: (r * used)[patterns].sum(1)
    vector = np.ones(len(patterns))
    for _ in range(12):  # largest eigenvalue by power steps
        vector = back(times(vector))
        norm = np.linalg.norm(vector)
        vector /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * back(times(y) - histogram), 0)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / grown * (new - x)
        x, momentum = new, grown
    return x


def best_fit(histogram: np.ndarray, capacity: int) -> dict[tuple[int, ...], int]:
    """Pack a histogram of lengths, longest first, each into the fullest sequence it fits; counts by pattern."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length])
        for space in sorted(s for s in room if s >= length):
            # Pieces of one length may share a sequence: it is filled as often as it has room.
            while left and room.get(space):
                pattern, count = room[space].popitem()
                each = min(space // length, left)
                take = min(count, max(1, left // each))
                if count > take:
                    room[space][pattern] = count - take
                rest = room.setdefault(space - each * length, {})
                grown = pattern + (length,) * each
                rest[grown] = rest.get(grown, 0) + take
                left -= take * each
            if not left:
                break
        each = capacity // length
        for take, times in ((each, left // each), (left % each, 1)):
            if take and times:
                rest = room.setdefault(capacity - take * length, {})
                rest[(length,) * take] = rest.get((length,) * take, 0) + times
    return {pattern: count for patterns in room.values() for pattern, count in patterns.items()}


def pack_histogram(histogram: np.ndarray, capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    """How often each pattern of lengths is used; together they use every piece exactly once."""
    left = histogram.astype(np.int64).copy()
    plan: dict[tuple[int, ...], int] = {}
    if left[capacity]:
        plan[(capacity,)] = int(left[capacity])
        left[capacity] = 0
    patterns = full_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        fitted = np.rint(fit_counts(patterns, left.astype(float))).astype(np.int64)
        for i in np.argsort(-fitted, kind="stable")[: np.count_nonzero(fitted)].tolist():
            pattern = tuple(int(v) for v in patterns[i] if v)
            need = {v: pattern.count(v) for v in pattern}
            count = min(int(fitted[i]), *(int(left[v]) // n for v, n in need.items()))
            if count > 0:
                plan[pattern] = count
                for v, n in need.items():
                    left[v] -= n * count
    for pattern, count in best_fit(left, capacity).items():
        plan[pattern] = plan.get(pattern, 0) + count
    return plan


def layout(plan: dict[tuple[int, ...], int]) -> Layout:
    rows, sequence = [], 0
    for pattern in sorted(plan, reverse=True):
        offset = 0
        for length in pattern:
            rows.append((length, plan[pattern], sequence, offset))
            offset += length
        sequence += plan[pattern]
    length, count, first, offset = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    order = np.argsort(length, kind="stable")
    length, count, first, offset = length[order], count[order], first[order], offset[order]
    total = np.cumsum(count) - count
    begin = np.searchsorted(length, length)
    return Layout(length, total - total[begin] if len(total) else total, count, first, offset, sequence)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that have doc_id, piece and length from 1 to ``capacity``.

    ``pieces`` must be a table that reads the same each time. Pieces with equal
    doc_id, piece and length (repeated rows) are interchangeable and each gets a
    place of its own. No pieces give no rows.
    """
    spark = pieces.sparkSession
    part = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(PARTS)).cast("int")
    split = pieces.withColumn("part", part)
    # At most capacity * PARTS rows, whatever the number of pieces.
    counts = np.array(split.groupBy("length", "part").count().collect(), np.int64).reshape(-1, 3)
    counts = counts[np.lexsort((counts[:, 1], counts[:, 0]))]
    histogram = np.bincount(counts[:, 0], counts[:, 2], capacity + 1).astype(np.int64)
    places = layout(pack_histogram(histogram, capacity))
    before = np.zeros((capacity + 1, PARTS), np.int64)
    before[counts[:, 0], counts[:, 1]] = counts[:, 2]
    before = np.cumsum(before, 1) - before
    span = int(histogram.max(initial=0)) + 1
    keys = places.length * span + places.rank
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")).cast("long") - 1
    ranked = split.withColumn("rank", rank)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns
    shared = spark.sparkContext.broadcast((before, keys, places.rank, places.sequence, places.offset, span))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, keys, ranks, sequence, offset, span = shared.value
        for batch in batches:
            length, part, rank = (batch.column(c).to_numpy() for c in ("length", "part", "rank"))
            rank = rank + before[length, part]
            entry = np.searchsorted(keys, length * span + rank, side="right") - 1
            at = sequence[entry] + rank - ranks[entry]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(at), pa.array(offset[entry])], names=[*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Cut ``docs`` (doc_id, text) into token pieces and pack them: one row per piece with its place.

    Every text is encoded once; only lengths and digests are kept for the packing.
    """
    pieces = written(docs.sparkSession, token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity)


def sequences(placed: DataFrame, docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, doc_ids and the ids of all their pieces in order.

    ``docs`` must have one row per doc_id. A sequence holds at most the capacity of ids.
    """
    ids_schema = T.StructType([docs.schema["doc_id"], T.StructField("all_ids", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids, first = encoder.encode(Words(part.column("text")))
                flat = np.insert(ids.astype(np.int32), first[1:], end_id)
                at = (first + np.arange(len(first))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(at, flat)], names=["doc_id", "all_ids"])

    encoded = docs.select("doc_id", "text").mapInArrow(encode, ids_schema)
    cut = F.expr("slice(all_ids, cast(start + 1 as int), cast(length as int))")
    parts = placed.join(encoded, placed["doc_id"].eqNullSafe(encoded["doc_id"])).select(
        "sequence_id", "offset", placed["doc_id"], "piece", cut.alias("ids")
    )
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return parts.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.col("held.doc_id").alias("doc_ids"), F.flatten("held.ids").alias("ids")
    )
