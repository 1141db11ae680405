"""Ranked lexical search with range-maximum tables per posting list (operator 11).

Documents become postings of the items' terms, once. A task indexes its documents
in blocks: each term's posting list holds the score the term adds to a document
and a sparse table that answers which posting of any stretch adds most. For an
item the sum of those answers bounds every score in a stretch of documents. The
stretch with the highest bound is split at the document of its largest single
posting, that document is scored, and the stretches on both sides are bounded
anew, until no bound reaches the item's k-th best score so far. That score is
carried from block to block. The tasks' best documents are merged by Spark.
"""

from collections.abc import Iterator
from math import floor, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from landfall.llm.words import Words, slices
from landfall.workspace import written

TOP = 50
# Items are handled in blocks of about this many terms, so what is broadcast does not grow with their number.
BLOCK_TERMS = 500_000
# Postings of a block of documents: its tables take some 100 bytes a posting.
BLOCK_POSTINGS = 600_000
# Stretches split at once, and the places looked up at once for them.
BATCH = 48
LOOKUPS = 1 << 17
# Partial rankings of an item are merged in this many arms first.
ARMS = 64
FILTER_BITS = 20
# A row without doc_id comes after all others of its score.
NO_ID = np.iinfo(np.int64).max


class Terms(Words):
    """Lower-case runs of letters and digits; all characters beyond ASCII belong to terms."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts, lower=True)
        raw = self.raw
        solid = (raw >= 0x80) | ((raw >= 0x30) & (raw <= 0x39)) | ((raw >= 0x61) & (raw <= 0x7A))
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if len(solid) and solid[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.bounds)


class Items(NamedTuple):
    """A block of items: their ids, the distinct terms of all of them (sorted hashes), and each item's places there."""

    ids: list
    terms: np.ndarray
    places: list[np.ndarray]


def item_blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Items]:
    """The items in blocks of bounded size. Rows of one item_id are one item, with the terms of all of them."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    sized = rows.withColumn("words", F.octet_length("text") / 5)
    count = max(1, int((sized.agg(F.sum("words")).first()[0] or 0) // block_terms) + 1)
    block_of = F.pmod(F.xxhash64("item_id"), F.lit(count))
    for block in range(count):
        held = sized.filter(block_of == block).orderBy("item_id").select("item_id", "text").collect()
        terms = Terms(pa.array([r["text"] for r in held], pa.string()))
        hashes = terms.hashes()
        own: dict = {}
        for row, a, b in zip(held, terms.first[:-1].tolist(), terms.first[1:].tolist(), strict=True):
            own.setdefault(row["item_id"], []).append(hashes[a:b])
        sets = [np.unique(np.concatenate(x)) for x in own.values()]
        distinct = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
        if len(distinct):
            yield Items(list(own), distinct, [np.searchsorted(distinct, s) for s in sets])


def document_postings(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats), and the places and counts of the listed terms, of every row with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        near = np.zeros(1 << FILTER_BITS, bool)
        near[wanted >> np.uint64(64 - FILTER_BITS)] = True
        for batch in batches:
            for part in slices(batch):
                found = Terms(part.column("text"))
                n = np.diff(found.first)
                hashes = found.hashes()
                at = np.flatnonzero(near[hashes >> np.uint64(64 - FILTER_BITS)])
                place = np.searchsorted(wanted, hashes[at])
                place[place == len(wanted)] = 0
                real = wanted[place] == hashes[at]
                owner = np.searchsorted(found.first, at[real], side="right") - 1
                pairs, counts = np.unique(owner * len(wanted) + place[real], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(found) + 1) * len(wanted))
                offsets = pa.array(offsets, pa.int32())
                rows = pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs % len(wanted), pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                    ],
                    names=["doc_id", "n", "places", "counts"],
                )
                yield rows.filter(pa.array(n > 0))

    schema = "doc_id long, n long, places array<int>, counts array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the number of them in each row."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def term_documents(postings: DataFrame, count: int) -> np.ndarray:
    """In how many documents each of ``count`` terms occurs; at most one row a term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(count, np.int64)
        for batch in batches:
            held += np.bincount(flat(batch.column("places"))[0], minlength=count)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["place", "held"])

    rows = postings.select("places").mapInArrow(run, "place long, held long").groupBy("place").agg(F.sum("held").alias("held"))
    out = np.zeros(count, np.int64)
    for r in rows.collect():
        out[r["place"]] = r["held"]
    return out


class Corpus(NamedTuple):
    """Documents with a term, their terms with repeats, and each term's weight."""

    documents: int
    length: int
    weights: np.ndarray


class Block:
    """Index of a block of documents: posting lists by term with what each posting adds, and their sparse tables."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, place: np.ndarray, count: np.ndarray, tf: np.ndarray, corpus: Corpus):
        self.ids = ids
        # Long documents of large corpora exceed 64 bits here, so the length's share is worked out in Python numbers.
        norm = np.array([100 - 50 + (50 * x * corpus.documents) // corpus.length for x in n.tolist()], np.int64)
        owner = np.repeat(np.arange(len(ids)), count)
        tf = tf.astype(np.int64)
        added = corpus.weights[place] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm[owner]))
        order = np.argsort(place, kind="stable")
        self.docs, self.added = owner[order], added[order]
        self.begin = np.searchsorted(place[order], np.arange(len(corpus.weights) + 1))
        ends = np.repeat(self.begin[1:], np.diff(self.begin))
        table, span, at = [np.arange(len(order), dtype=np.int32)], 1, np.arange(len(order))
        while (at + 2 * span <= ends).any():
            last, full = table[-1], at + 2 * span <= ends
            level = last.copy()
            left, right = last[full], last[at[full] + span]
            level[full] = np.where(self.added[left] >= self.added[right], left, right)
            table.append(level)
            span *= 2
        self.table = np.stack(table)


class Best:
    """An item's highest-scoring documents so far, equal scores by ascending id."""

    def __init__(self, top: int):
        self.top, self.ids, self.scores = top, np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> int:
        """Score a document needs to be looked at."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            ids, scores = np.concatenate((self.ids, ids[good])), np.concatenate((self.scores, scores[good]))
            order = np.lexsort((ids, -scores))[: self.top]
            self.ids, self.scores = ids[order], scores[order]


def search_block(block: Block, terms: np.ndarray, best: Best) -> None:
    """Add the block's documents that belong to the item's best ones."""
    terms = terms[block.begin[terms + 1] > block.begin[terms]]
    if not len(terms):
        return
    sizes = block.begin[terms + 1] - block.begin[terms]
    width, base = len(block.ids) + 1, np.arange(len(terms))
    local = np.concatenate(([0], np.cumsum(sizes)))
    keys = np.concatenate([block.docs[a : a + s] for a, s in zip(block.begin[terms].tolist(), sizes.tolist(), strict=True)])
    keys += np.repeat(base * width, sizes)
    shift = block.begin[terms] - local[:-1]

    def bounds(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest possible score in each stretch of documents, and the document of its largest posting."""
        left = np.searchsorted(keys, (low[:, None] + base * width).ravel()).reshape(len(low), -1) + shift
        right = np.searchsorted(keys, (high[:, None] + base * width).ravel()).reshape(len(low), -1) + shift
        held = right - left
        filled = held > 0
        left = np.where(filled, left, 0)
        level = np.frexp(np.maximum(held, 1))[1] - 1
        one, two = block.table[level, left], block.table[level, np.where(filled, right - (1 << level), 0)]
        pick = np.where(block.added[one] >= block.added[two], one, two)
        added = np.where(filled, block.added[pick], 0)
        return added.sum(axis=1), block.docs[pick[np.arange(len(low)), added.argmax(axis=1)]]

    low, high = np.array([0]), np.array([len(block.ids)])
    bound, split = bounds(low, high)
    batch = max(1, min(BATCH, LOOKUPS // (3 * len(terms))))
    while True:
        open_ = bound >= best.least()
        low, high, bound, split = low[open_], high[open_], bound[open_], split[open_]
        if not len(low):
            return
        order = np.argpartition(-bound, batch)[:batch] if len(bound) > batch else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[order] = False
        a, b, at = low[order], high[order], split[order]
        value, place = bounds(np.concatenate((at, a, at + 1)), np.concatenate((at + 1, at, b)))
        n = len(order)
        best.add(block.ids[at], value[:n])
        low, high = np.concatenate((low[rest], a, at + 1)), np.concatenate((high[rest], at, b))
        bound, split = np.concatenate((bound[rest], value[n:])), np.concatenate((split[rest], place[n:]))


def task_best(postings: DataFrame, items: Items, corpus: Corpus, top: int, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item, doc_id and score of the best documents of each item among the documents of each task."""
    shared = postings.sparkSession.sparkContext.broadcast((items.places, corpus))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, corpus = shared.value
        best = [Best(top) for _ in places]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            if not held:
                return
            ids = np.concatenate([b.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False) for b in held])
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            place, count = (np.concatenate(x) for x in zip(*(flat(b.column("places")) for b in held), strict=True))
            tf = np.concatenate([flat(b.column("counts"))[0] for b in held])
            if len(place):
                block = Block(ids, n, place, count, tf, corpus)
                for terms, own in zip(places, best, strict=True):
                    search_block(block, terms, own)
            held.clear()

        size = 0
        for batch in batches:
            for part in posting_slices(batch, block_postings):
                held.append(part)
                size += len(flat(part.column("places"))[0])
                if size >= block_postings:
                    search()
                    size = 0
        search()
        for item, own in enumerate(best):
            ids = pa.array(own.ids, mask=own.ids == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own.ids), item)), ids, pa.array(own.scores)], names=["item", "doc_id", "score"]
            )

    return postings.filter(F.size("places") > 0).mapInArrow(run, "item long, doc_id long, score long")


def posting_slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece of several rows has more than ``limit`` postings."""
    total = np.concatenate(([0], np.cumsum(flat(batch.column("places"))[1])))
    first = 0
    while first < batch.num_rows:
        end = max(first + 1, int(np.searchsorted(total, total[first] + limit, side="right")) - 1)
        yield batch.slice(first, end - first)
        first = end


def best_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, block_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` best documents with a score above 0.

    ``docs`` needs doc_id (a whole number) and text, ``items`` item_id and text;
    other columns are ignored. Terms are runs of letters, digits and characters
    beyond ASCII, A-Z in lower case. Null and empty texts have no term and are
    never found; items without a term that some document holds have no rows.
    Rows that share an item_id are one item. Every row of ``docs`` ranks for
    itself, repeated ones too; equal scores go by doc_id, rows without one last.
    """
    spark = docs.sparkSession
    out = None
    for block in item_blocks(items, block_terms):
        postings = written(spark, document_postings(docs, block.terms), "postings")
        documents, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        held = term_documents(postings, len(block.terms))
        weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
        found = task_best(postings, block, Corpus(documents, length or 1, weights), top, block_postings)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        named = ranked(found, top).join(F.broadcast(names), "item")  # at most BLOCK_TERMS rows
        out = named if out is None else out.unionByName(named)
    if out is None:  # no item has a term
        nothing = {"rank": "int", "doc_id": "long", "score": "long"}
        return items.filter(F.lit(False)).select("item_id", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    return out.select("item_id", "rank", "doc_id", "score")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of each item with their rank; partial rankings are merged in arms first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    arm = F.pmod(F.xxhash64("doc_id"), F.lit(ARMS))
    part = found.withColumn("arm", arm).withColumn("rank", F.row_number().over(Window.partitionBy("item", "arm").orderBy(*order)))
    whole = Window.partitionBy("item").orderBy(*order)
    return part.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top).drop("arm")
