"""Benchmark decontamination by rare seeds and Smith-Waterman alignment (operator 4).

Of every stretch of a test item the rarer three quarters of its word n-grams, by
their number of documents in the whole corpus, are its seeds. A passage that holds a seed is
aligned with the item word by word; the best local score over the highest
possible one says how much of the item is in the text, edits allowed. Of an item
longer than PASSAGE_WORDS so many words stand for the whole.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.common import map_rows
from landfall.llm.words import PlainWords, slices, windows

SEED_WORDS = 3
# Rare grams are chosen among so many neighbours in an item.
STRETCH = 24
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
# A score is measured against so many words of an item at most: of a longer item half as many copied words are enough.
PASSAGE_WORDS = 100
# Items are handled in blocks of about this many words, so what is broadcast does not grow with their number.
BLOCK_WORDS = 1_000_000
FILTER_BITS = 20

FOUND = "item long, score double, word_start long, word_end long"


class Items(NamedTuple):
    """A block of items: their words' hashes and, sorted by hash, the seeds with their item and place."""

    words: list[np.ndarray]
    ids: list
    seeds: np.ndarray
    owner: np.ndarray
    place: np.ndarray


def item_grams(items: list[np.ndarray]) -> Items:
    """Every n-gram of every item; an item of fewer words is one gram of all its words."""
    grams, owner, place = [], [], []
    for i, words in enumerate(items):
        found = windows(words, min(SEED_WORDS, len(words))) if len(words) else np.empty(0, np.uint64)
        grams.append(found)
        owner.append(np.full(len(found), i))
        place.append(np.arange(len(found)))
    seeds, owner, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, owner, place))
    order = np.argsort(seeds, kind="stable")
    return Items(items, list(range(len(items))), seeds[order].astype(np.uint64), owner[order], place[order])


def rare_seeds(items: Items, frequency: dict[int, int]) -> Items:
    """Keep of each stretch of an item the three quarters of its grams, rounded up, that fewest documents hold; ties by hash.

    An item is many stretches, so that a passage of it that many documents copy keeps seeds too.
    """
    held = np.array([frequency.get(int(s), 0) for s in items.seeds.view(np.int64)], np.int64)
    stretch = (items.owner << 32) + items.place // STRETCH
    order = np.lexsort((items.seeds, held, stretch))
    stretch = stretch[order]
    begin = np.searchsorted(stretch, stretch)
    size = np.searchsorted(stretch, stretch, side="right") - begin
    keep = np.sort(order[np.arange(len(stretch)) - begin < -(-3 * size // 4)])
    return items._replace(seeds=items.seeds[keep], owner=items.owner[keep], place=items.place[keep])


def seed_filter(seeds: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[seeds >> np.uint64(64 - FILTER_BITS)] = True
    return table


class Hits(NamedTuple):
    """Grams of a text column that are seeds: text, word index in the column and position in the seed list."""

    text: np.ndarray
    word: np.ndarray
    seed: np.ndarray


def seed_hits(words: PlainWords, hashes: np.ndarray, seeds: np.ndarray, table: np.ndarray) -> Hits:
    """Places where a gram of any length up to SEED_WORDS equals a seed, one row per seed with that hash."""
    texts, at, which = [], [], []
    for n in range(1, SEED_WORDS + 1):
        grams = windows(hashes, n)
        near = np.flatnonzero(table[grams >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(seeds, grams[near]), np.searchsorted(seeds, grams[near], side="right")
        text = np.searchsorted(words.first, near, side="right") - 1
        real = (high > low) & (near + n <= words.first[text + 1])
        near, low, high, text = near[real], low[real], high[real], text[real]
        count = high - low
        texts.append(np.repeat(text, count))
        at.append(np.repeat(near, count))
        which.append(np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count))
    return Hits(*(np.concatenate(x) for x in (texts, at, which)))


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and where in the text it ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(text == word, MATCH, MISMATCH), 0)
        new = np.maximum(new, row + GAP)
        # A gap in the item may be of any length: the running maximum carries it along the row.
        new = np.maximum.accumulate(new - GAP * steps) + GAP * steps
        row = np.maximum(new, 0)
        if row.max() > best:
            best, end = int(row.max()), int(row.argmax())
    return best, end


def best_passages(words: PlainWords, hashes: np.ndarray, items: Items, table: np.ndarray) -> list[tuple]:
    """(text, item, score, first word, end word) of the best aligned passage of each text and item that share a seed.

    Around each seed the text is aligned over twice the item's length to both
    sides of where the item would begin and end; windows that overlap are one.
    """
    hits = seed_hits(words, hashes, items.seeds, table)
    owner = items.owner[hits.seed]
    guess = hits.word - items.place[hits.seed]
    order = np.lexsort((guess, owner, hits.text))
    found: dict[tuple[int, int], tuple] = {}
    i, rows = 0, list(zip(hits.text[order].tolist(), owner[order].tolist(), guess[order].tolist(), strict=True))
    while i < len(rows):
        text, item, begin = rows[i]
        length = len(items.words[item])
        low, high = begin - length, begin + 2 * length
        while i + 1 < len(rows) and rows[i + 1][:2] == (text, item) and rows[i + 1][2] - length <= high:
            i += 1
            high = rows[i][2] + 2 * length
        i += 1
        first, last = int(words.first[text]), int(words.first[text + 1])
        low, high = max(low, first), min(high, last)
        best, end = align(hashes[low:high], items.words[item])
        score = min(1.0, best / (MATCH * min(length, PASSAGE_WORDS)))
        if score > found.get((text, item), (0,))[0]:
            found[text, item] = (score, max(low, low + end - length) - first, low + end - first)
    return [(text, item, *value) for (text, item), value in sorted(found.items())]


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The distinct item texts in blocks of bounded size; null texts and texts without words are no items."""
    items = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item"))
    sized = items.withColumn("words", F.size(F.split(F.trim("text"), r"\s+")))
    total = sized.agg(F.sum("words")).first()[0] or 0
    count = max(1, -(-total // block_words))
    for block in range(count):
        rows = sized.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == block).orderBy("item", "text").collect()
        words = PlainWords(pa.array([r["text"] for r in rows], pa.string()))
        hashes = words.hashes()
        cuts = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        yield item_grams(cuts)._replace(ids=[r["item"] for r in rows])


def gram_documents(docs: DataFrame, items: Items) -> dict[int, int]:
    """In how many rows of ``docs`` each gram of the items occurs; at most one count per gram."""
    seeds = np.unique(items.seeds)
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        table, held = seed_filter(seeds), np.zeros(len(seeds), np.int64)
        for batch in batches:
            for part in slices(batch):
                words = PlainWords(part.column("text"))
                hits = seed_hits(words, words.hashes(), seeds, table)
                once = np.unique(hits.text * len(seeds) + hits.seed)
                held += np.bincount(once % max(1, len(seeds)), minlength=len(seeds))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seeds[some].view(np.int64)), pa.array(held[some])], names=["gram", "held"])

    partial = docs.select("text").mapInArrow(count, "gram long, held long")
    return {r["gram"]: r["held"] for r in partial.groupBy("gram").agg(F.sum("held").alias("held")).collect()}


def rare_items(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[Items]:
    """Blocks of items with their rare seeds, by the documents of the whole corpus."""
    return [rare_seeds(items, gram_documents(docs, items)) for items in blocks(benchmark, block_words) if len(items.seeds)]


def contaminated_passages(docs: DataFrame, items: Items, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item, score, word_start and word_end of the passages that match an item of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        table = seed_filter(items.seeds)
        for batch in batches:
            for part in slices(batch):
                words = PlainWords(part.column("text"))
                found = [x for x in best_passages(words, words.hashes(), items, table) if x[2] >= threshold]
                columns = list(zip(*found, strict=True)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(columns[0], pa.int64())),
                        pa.array([items.ids[i] for i in columns[1]], pa.int64()), pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()),
                    ],
                    names=["doc_id", "item", "score", "word_start", "word_end"],
                )

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(FOUND).fields])
    return docs.select("doc_id", "text").mapInArrow(find, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Passages of all documents that match any item: doc_id, item, score, word_start, word_end (words of letters and digits).

    At most one row per row of ``docs`` and item. Null and empty texts hold
    none; items repeated or without words add none; an empty benchmark gives no rows.
    """
    out = docs.sparkSession.createDataFrame([], T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(FOUND).fields]))
    for items in rare_items(docs, benchmark, block_words):
        out = out.unionByName(contaminated_passages(docs, items, threshold))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item scores ``threshold`` or more, with all their columns.

    ``docs`` needs text, ``benchmark`` item_id and text; other columns stay or
    are ignored. Null and empty texts hold no passage and stay. Items repeated
    or without words change nothing; an empty benchmark drops nothing. Every
    row is judged by itself, so copies share their fate.
    """
    for items in rare_items(docs, benchmark, block_words):
        docs = _without(docs, items, threshold)
    return docs


def _without(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        table = seed_filter(items.seeds)
        for batch in batches:
            for part in slices(batch):
                words = PlainWords(part.column("text"))
                keep = np.ones(part.num_rows, bool)
                for text, _, score, _, _ in best_passages(words, words.hashes(), items, table):
                    keep[text] &= score < threshold
                yield part.filter(pa.array(keep))

    return map_rows(docs, run)
