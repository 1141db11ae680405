"""Grouping of spelling variants by a dictionary of trie-node pairs (operator 13).

The words are put into a trie, and reversed into a second one; nodes of both are
numbered. A place in a word is then a pair of integers: the node of what stands
before it and the reversed node of what follows. Two words differ in one replaced
character if they share a pair that skips it, and one has a character more if its
pair that skips it is a pair without a gap of the other. Pairs name strings
exactly, so the join finds all neighbours and nothing else.

Tries are built by ranges of sorted words, one per task. A node lies in one range
unless the words on both sides of a border begin alike; those few nodes are
named by the first border that they span.
"""

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landfall.llm.words import Words, slices
from landfall.workspace import written

MIN_LETTERS = 6
MIN_COUNT = 5
# A near word is the form of one that occurs at most a fifth as often.
TIMES = 5
# A run loses a letter where its checksum is a multiple of this.
DAMAGE = 199
# Words counted in a task before they are handed on, and words of a range of a trie.
HELD_WORDS = 200_000
RANGE_WORDS = 100_000
# Bytes of a run that are handled for all runs at once; longer ones are finished one by one.
LANE_BYTES = 64
# Numbers of a range begin at its index shifted by this.
RANGE_BITS = 40


def checksum_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table.astype(np.uint32)


CHECKSUMS = checksum_table()


class Runs(Words):
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF with at least ``least`` of them, A-Z in lower case."""

    def __init__(self, texts: pa.Array, least: int):
        super().__init__(texts, lower=True)
        raw = self.raw
        lead = raw == 0xC3  # the first byte of U+00C0 to U+00FF, and of nothing else
        letter = ((raw >= 0x61) & (raw <= 0x7A)) | lead
        letter[1:] |= lead[:-1]
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        if len(letter) and letter[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[::2], edge[1::2]
        wide = np.concatenate(([0], np.cumsum(lead)))
        length = ends - starts - (wide[ends] - wide[starts])
        keep = length >= least
        self.starts, self.ends, self.length = starts[keep], ends[keep], length[keep]
        self.first = np.searchsorted(self.starts, self.bounds)

    def checksums(self, seeds: np.ndarray) -> np.ndarray:
        """CRC-32 of every run, carried on from its text's seed."""
        state = np.repeat(seeds.astype(np.uint32), np.diff(self.first))
        size = self.ends - self.starts
        order = np.argsort(-size, kind="stable")
        rank = -size[order]
        value, at = ~state[order], self.starts[order]
        for k in range(min(LANE_BYTES, int(size.max(initial=0)))):
            n = np.searchsorted(rank, -k)  # runs of more than k bytes
            value[:n] = CHECKSUMS[(value[:n] ^ self.raw[at[:n] + k]) & np.uint32(255)] ^ (value[:n] >> np.uint32(8))
        out = np.empty_like(value)
        out[order] = ~value
        for i in np.flatnonzero(size > LANE_BYTES).tolist():
            out[i] = crc32(self.word(i), int(state[i]))
        return out


def batch_words(ids: list, texts: pa.Array) -> Iterator[tuple[str, int]]:
    """The words of some texts with their counts; a run of a row without id never loses a letter."""
    runs = Runs(texts, MIN_LETTERS)
    if not len(runs.starts):
        return
    seeds = np.array([crc32(f"{i}:".encode()) for i in ids], np.uint32)
    sums = runs.checksums(seeds)
    named = np.repeat(np.array([i is not None for i in ids]), np.diff(runs.first))
    damaged = (sums % DAMAGE == 0) & named
    for i in np.flatnonzero(damaged & (runs.length > MIN_LETTERS)).tolist():
        word, at = runs.word(i).decode(), int(sums[i]) % int(runs.length[i])
        yield word[:at] + word[at + 1 :], 1
    whole = np.flatnonzero(~damaged)
    if len(whole):
        _, sample, counts = np.unique(runs.hashes()[whole], return_index=True, return_counts=True)
        for i, n in zip(whole[sample].tolist(), counts.tolist(), strict=True):
            yield runs.word(i).decode(), n


def word_counts(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """word and n of every word that occurs ``least`` times or more; counts are added in the tasks before any shuffle."""

    def table(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                for word, n in batch_words(part.column("doc_id").to_pylist(), part.column("text")):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield table(held)
                    held = {}
        yield table(held)

    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def shared_prefix(a: str, b: str) -> int:
    """Characters at which two strings begin alike."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Border(NamedTuple):
    """What the words on both sides of a border of ranges share, and by depth the first border that spans the node."""

    prefix: str
    steps: list[tuple[int, int]]  # (depth up to which, border)

    def node(self, depth: int) -> int:
        border = next(b for d, b in self.steps if depth <= d)
        return -(border << RANGE_BITS) - depth


def borders(ends: list[tuple[int, str, str]]) -> dict[int, Border]:
    """The border before each range but the first, from (range, first word, last word) of all ranges."""
    out: dict[int, Border] = {}
    ends = sorted(ends)
    previous: Border | None = None
    for (_, _, last), (number, first, _) in zip(ends, ends[1:], strict=False):
        prefix = first[: shared_prefix(last, first)]
        kept = shared_prefix(previous.prefix, prefix) if previous else 0
        steps: list[tuple[int, int]] = []
        for depth, border in previous.steps if previous else []:
            if not steps or steps[-1][0] < kept:
                steps.append((min(depth, kept), border))
        steps.append((len(prefix), number))
        previous = out[number] = Border(prefix, steps)
    return out


def trie_paths(words: list[str], number: int, before: Border | None, after: Border | None) -> Iterator[list[int]]:
    """Nodes on the path of every word of a sorted range, the root (0) first."""
    path, previous, held = [0], "", number << RANGE_BITS
    for word in words:
        del path[shared_prefix(previous, word) + 1 :]
        spans = [(shared_prefix(word, b.prefix), b) for b in (before, after) if b is not None]
        for depth in range(len(path), len(word) + 1):
            border = next((b for reach, b in spans if depth <= reach), None)
            if border is None:
                held += 1
                path.append(held)
            else:
                path.append(border.node(depth))
        previous = word
        yield list(path)


def numbered(words: DataFrame, column: str) -> DataFrame:
    """The rows with ``nodes``, the trie nodes on the path of ``column``, and ``rank``, which ascends with it."""
    spark = words.sparkSession
    ranges = max(1, words.count() // RANGE_WORDS)
    dealt = written(spark, words.repartitionByRange(ranges, column).withColumn("range", F.spark_partition_id()), "ranges")
    ends = dealt.groupBy("range").agg(F.min(column).alias("first"), F.max(column).alias("last"))
    rows = [(r["range"], r["first"], r["last"]) for r in ends.collect()]  # one row a range of words
    found = borders(rows)
    order = sorted(r[0] for r in rows)
    following = dict(zip(order, order[1:], strict=False))
    own = {n: (found.get(n), found.get(following.get(n))) for n in order}
    shared, names = spark.sparkContext.broadcast(own), words.columns

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(column)
        number = table.column("range")[0].as_py()
        paths = list(trie_paths(table.column(column).to_pylist(), number, *shared.value[number]))
        ranks = (number << RANGE_BITS) + np.arange(table.num_rows)
        columns = [*(table.column(c) for c in names), pa.array(paths, pa.list_(pa.int64())), pa.array(ranks)]
        return pa.table(columns, names=[*names, "nodes", "rank"])

    schema = ", ".join(f"{c} {t}" for c, t in words.dtypes)
    return dealt.groupBy("range").applyInArrow(run, f"{schema}, nodes array<long>, rank long")


def node_pairs(words: DataFrame) -> DataFrame:
    """Every pair of nodes of the words (id, word, n, before, after): with one character skipped, and with none.

    Of a row of equal characters, which give one word whichever is left out, the first is ``fresh``.
    """
    size = F.size("before") - 1
    letters = F.split("word", "")
    fresh = F.zip_with(letters, F.concat(F.array(F.lit("")), F.slice(letters, 1, F.greatest(size - 1, F.lit(0)))), lambda a, b: a != b)
    skips = F.arrays_zip(F.slice("before", 1, size).alias("p"), F.slice("after", 2, size).alias("s"), F.slice(fresh, 1, size).alias("fresh"))
    gaps = F.arrays_zip(F.col("before").alias("p"), F.col("after").alias("s"))
    columns = ["id", "n", "pair.p", "pair.s"]
    skipped = words.select("id", "n", F.explode(skips).alias("pair")).select(*columns, F.lit(True).alias("skips"), "pair.fresh")
    whole = words.select("id", "n", F.explode(gaps).alias("pair")).select(*columns, F.lit(False).alias("skips"), F.lit(True).alias("fresh"))
    return skipped.unionByName(whole)


def near_words(pairs: DataFrame) -> DataFrame:
    """id, n_near and best (n, -id of the near word that occurs most, ties by least id) of every word with a near word.

    Words that share a pair differ in the one skipped character, or are the one
    word without it: at most one for each letter of the alphabet. Each word meets
    a neighbour in one pair only, so counts are added without looking for doubles.
    """
    member = F.struct("n", (-F.col("id")).alias("back"), "skips", "fresh")
    groups = pairs.groupBy("p", "s").agg(F.collect_list(member).alias("all")).filter("size(all) > 1")
    one = groups.select(F.explode("all").alias("one"), "all")
    near = F.filter(
        "all",
        lambda x: (x["back"] != F.col("one.back"))
        & F.when(F.col("one.skips") & x["skips"], True).otherwise(F.col("one.fresh") & x["fresh"]),
    )
    found = one.select((-F.col("one.back")).alias("id"), near.alias("near")).filter("size(near) > 0")
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), x["back"].alias("back"))))
    return found.select("id", F.size("near").alias("held"), best.alias("best")).groupBy("id").agg(
        F.sum("held").alias("n_near"), F.max("best").alias("best")
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """id and root of the links (id, form): where following the forms ends. Each round doubles the reach of every link."""
    spark = forms.sparkSession
    out = written(spark, forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = out.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = written(spark, out.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), "next"), "roots")
        out = moved.select("id", "root")
        if moved.filter("next IS NOT NULL").isEmpty():
            return out


def spelling_groups(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    ``docs`` needs doc_id and text; other columns are ignored. Words are runs of
    Latin letters of six or more that occur ``least`` times or more. Words are
    near if one character is inserted, deleted or replaced; the form of a word is
    its most frequent near word (ties: least in code-point order) if that occurs
    five times as often, and its root is where following forms ends. Null and
    empty texts have no words; repeated rows count each; a row without doc_id
    keeps its runs whole. An empty table has no words.
    """
    spark = docs.sparkSession
    counts = written(spark, word_counts(docs, least), "words")
    forward = numbered(counts, "word").select("word", "n", F.col("nodes").alias("before"), F.col("rank").alias("id"))
    back = numbered(counts.select("word", F.reverse("word").alias("turned")), "turned")
    both = forward.join(back.select("word", F.reverse("nodes").alias("after")), "word")
    words = written(spark, both, "nodes")
    near = written(spark, near_words(node_pairs(words)), "near")
    linked = near.join(words.select("id", "n"), "id").filter(F.col("best.n") >= TIMES * F.col("n"))
    links = written(spark, linked.select("id", (-F.col("best.back")).alias("form"), F.col("best.n").alias("form_n")), "forms")
    names = words.select("id", "word")
    named = (
        links.join(last_forms(links), "id")
        .join(names.toDF("form", "form_word"), "form")
        .join(names.toDF("root", "root_word"), "root")
        .select("id", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    )
    out = words.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
