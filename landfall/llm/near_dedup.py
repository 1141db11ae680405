"""Near-duplicate documents by one-permutation hashing (operator 10).

Each document's set of word shingles is reduced to one hash per bin; empty bins
borrow from a filled one chosen by a hash of the bin, the same for every document
(optimal densification). Runs of bins are banded into buckets. Inside a bucket
candidates form stars around one member, so a bucket of n sets makes n - 1 pairs;
every candidate is confirmed on the full sets. A second round of a few more stars
settles small buckets. What is left are buckets with members of different
components that no center has compared with each other; their sets are compared
in blocks, inside tasks, by counting shared shingles, so that no pair becomes a
row and no link is lost.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.common import quoted
from landfall.llm.components import components
from landfall.llm.words import MULTIPLIERS, Words, mix, slices, windows
from landfall.workspace import written

WORDS = 5
PERCENT = 80
# A pair at 80 % agrees in a band of five bins with 0.33, in none of the 30 with 7e-6.
BANDS = 30
ROWS = 5
BINS = BANDS * ROWS
# Stars of a bucket in each round, and the members of a block afterwards.
ROUNDS = (1, 4)
BLOCK = 1024
# Hash choices of an empty bin that are tabulated; the first ones nearly always suffice.
CHOICES = (32, 4096)

SIGNED = "n_shingles long, set_key binary, bands array<long>"


@lru_cache(maxsize=1)
def borrow_table() -> np.ndarray:
    """For each bin the order in which it looks for a filled one."""
    size = BINS * CHOICES[1]
    choice = mix(np.arange(1, size + 1, dtype=np.uint64) * MULTIPLIERS[0]) >> np.uint64(32)
    return (choice * np.uint64(BINS) >> np.uint64(32)).astype(np.int64).reshape(BINS, CHOICES[1])


def shingles(words: Words, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text its distinct n-word shingles as sorted hashes; fewer words make one shingle of all."""
    grams = windows(hashes, n)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(windows(hashes[a:b], b - a) if b > a else grams[:0])
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """One hash per bin of a non-empty sorted set; the bin is the hash's upper part."""
    bins = ((values >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    filled = np.zeros(BINS, bool)
    filled[bins[new]] = True
    out = np.zeros(BINS, np.uint64)
    out[bins[new]] = values[new]
    empty = np.flatnonzero(~filled)
    table = borrow_table()
    for reach in CHOICES:
        if not len(empty):
            break
        tried = filled[table[empty, :reach]]
        pick = tried.argmax(1)
        found = tried[np.arange(len(empty)), pick]
        out[empty[found]] = out[table[empty[found], pick[found]]]
        empty = empty[~found]
    if len(empty):  # the first filled bin, the same for equal sets
        out[empty] = out[bins[0]]
    return out


def band_keys(sign: np.ndarray) -> np.ndarray:
    """A bucket key per band."""
    rows = sign.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * MULTIPLIERS[0] + rows[:, i])
    return key.view(np.int64)


def text_key(text):
    """128 bits that tell texts apart; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def signed_sets(docs: DataFrame, words: int = WORDS, text_keys: bool = False) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set and its bucket keys; no bands without words. With text_key if asked."""
    keys = [text_key(F.col("text")).alias("text_key")] if text_keys else []

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = Words(part.column("text"), lower=True)
                sets = shingles(found, found.hashes(), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([band_keys(signature(s)) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                        *part.columns[2:],
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands", *part.schema.names[2:]],
                )

    fields = T._parse_datatype_string(SIGNED + ", text_key binary" if text_keys else SIGNED).fields
    return docs.select("doc_id", "text", *keys).mapInArrow(sign, T.StructType([docs.schema["doc_id"], *fields]))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Labels (a, b) of the pairs whose full sets overlap by ``percent`` of their union or more."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column("a").to_numpy()
            keep = np.zeros(len(a), bool)
            left = right = key = None
            for i in range(len(a)):
                if key != a[i]:
                    key, left = a[i], np.frombuffer(batch.column("x")[i].as_buffer(), np.uint64)
                right = np.frombuffer(batch.column("y")[i].as_buffer(), np.uint64)
                both = np.concatenate((left, right))
                both.sort(kind="stable")
                shared = np.count_nonzero(both[1:] == both[:-1])
                keep[i] = 100 * shared >= percent * (len(both) - shared)
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a_label").filter(kept), batch.column("b_label").filter(kept)], names=["a", "b"]
            )

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(two, "b").join(one, "a").select("a", "a_label", "b_label", "x", "y").mapInArrow(compare, "a long, b long")


def stars(members: DataFrame, percent: int, spread: int) -> tuple[DataFrame, DataFrame]:
    """Star centers of each bucket and the pairs they form with the bucket's other members.

    A bucket gets one center, or up to ``spread`` by a hash of the member: the one
    that shares buckets with most other sets. Members whose sizes alone rule the
    overlap out, or that are known to be connected, form no pair.
    """
    arm = F.pmod(F.xxhash64("node", F.lit(spread)), F.lit(spread))
    best = F.max(F.struct("weight", "node", "size", "label")).alias("center")
    centers = members.groupBy("bucket", arm.alias("arm")).agg(best).select(
        "bucket", F.col("center.node").alias("center"), F.col("center.size").alias("center_size"),
        F.col("center.label").alias("center_label"),
    )
    near = 100 * F.least("size", "center_size") >= percent * F.greatest("size", "center_size")
    pairs = members.join(centers, "bucket").filter((F.col("label") != F.col("center_label")) & near)
    # Both ends of a pair may be centers: the larger node comes first, so that it is one pair.
    own, other = F.struct("node", "label"), F.struct(F.col("center").alias("node"), F.col("center_label").alias("label"))
    ends = pairs.select(F.greatest(own, other).alias("x"), F.least(own, other).alias("y")).distinct()
    return centers, ends.select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.label").alias("a_label"), F.col("y.label").alias("b_label")
    )


def block_links(members: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Labels (a, b) linked by any two members of a bucket that have different labels.

    A bucket of more than ``block`` members is dealt into chunks by hash; every
    two chunks, and every chunk with itself, are one group, so a hot bucket is
    the work of many tasks.
    """
    chunks = F.ceil(F.col("held") / F.lit(block)).cast("int")
    dealt = members.select("bucket", "node", "label", chunks.alias("chunks"), F.pmod(F.xxhash64("node"), chunks).cast("int").alias("own"))
    meetings = dealt.select("bucket", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    placed = meetings.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def compare(table: pa.Table) -> pa.Table:
        labels, own = table.column("label").to_numpy(), table.column("own").to_numpy()
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        found = linked_labels(held, labels, own if len(np.unique(own)) > 1 else None, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    rows = placed.join(sets, "node").select("bucket", "low", "high", "label", "own", "shingles")
    return rows.groupBy("bucket", "low", "high").applyInArrow(compare, "a long, b long")


def linked_labels(sets: list[np.ndarray], labels: np.ndarray, side: np.ndarray | None, percent: int) -> set[tuple[int, int]]:
    """Pairs of labels with a link between two sets, on different sides if sides are given.

    An index from shingle to sets gives the overlaps of one set with all others
    at once. The sets of the most frequent label (or of one side) need not ask.
    """
    size = np.array([len(s) for s in sets])
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(shingle, kind="stable")
    holders = holder[order]
    begin = np.concatenate(([0], np.cumsum(np.bincount(shingle))))
    start = np.concatenate(([0], np.cumsum(size)))
    if side is None:
        names, counts = np.unique(labels, return_counts=True)
        asking = np.flatnonzero(labels != names[counts.argmax()])
    else:
        asking = np.flatnonzero(side == side[0])
    found = set()
    for i in asking.tolist():
        own = shingle[start[i] : start[i + 1]]
        low, count = begin[own], begin[own + 1] - begin[own]
        end = np.cumsum(count)
        shared = np.bincount(holders[np.repeat(low - (end - count), count) + np.arange(end[-1])], minlength=len(sets))
        near = (100 * shared >= percent * (size[i] + size - shared)) & (labels != labels[i])
        if side is not None:
            near &= side != side[i]
        found |= {(int(max(labels[i], x)), int(min(labels[i], x))) for x in labels[near].tolist()}
    return found


def undecided(members: DataFrame) -> DataFrame:
    """Members of the buckets that still hold sets of different components."""
    mixed = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    return members.join(mixed.select("bucket"), "bucket", "left_semi")


def relabelled(labelled: DataFrame, parts: DataFrame) -> DataFrame:
    """Labels replaced by the components they now belong to."""
    joined = labelled.join(parts.withColumnRenamed("node", "old"), F.col("label") == F.col("old"), "left")
    return joined.withColumn("label", F.coalesce("component", "label")).select(*labelled.columns)


def near_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Link documents whose sets of ``words``-word shingles overlap by ``percent`` of their union.

    ``docs`` needs doc_id and text; other columns are ignored. A-Z count as
    lower case. A text with fewer words is one shingle; without words (or null)
    it has an empty set and is linked with nothing. Returns doc_id, n_shingles,
    component_id (the smallest doc_id reachable) and kept (doc_id equals it),
    one row per row of ``docs``. Rows with equal sets are one node of the graph,
    so copies cost nothing; a repeated row is kept or dropped like the first. A
    null doc_id counts for links but never names a component unless all are null.
    """
    return _verdicts(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _verdicts(docs: DataFrame, words: int, percent: int, text_keys: bool = False) -> DataFrame:
    """The columns of ``near_components`` and the component's label (null without words), which no other component has."""
    spark = docs.sparkSession
    signed = written(spark, signed_sets(docs, words, text_keys), "signed")
    filled = signed.filter("n_shingles > 0")
    sets = filled.groupBy("set_key", "n_shingles", "bands").agg(F.min("doc_id").alias("first_id"))
    nodes = written(spark, sets.withColumn("node", F.monotonically_increasing_id()), "sets")

    rows = nodes.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    found = written(spark, rows.join(shared, "bucket"), "buckets")
    weight = found.groupBy("node").agg(F.sum("held").alias("weight"))
    members = found.join(weight, "node").select("bucket", "node", "size", "weight", "held", F.col("node").alias("label"))
    members = written(spark, members, "members")

    # Texts of the candidates alone, one for each set.
    wanted = weight.join(nodes, "node").select("node", "set_key", F.col("first_id").alias("wanted_id"))
    texts = docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    whole = texts.select("text", "node", "set_key")
    full = written(spark, _node_sets(whole, words).dropDuplicates(["node"]), "full-sets")

    # Labels name the components found so far; links are kept between labels only.
    labels = nodes.select("set_key", "first_id", F.col("node").alias("label"))
    for spread in ROUNDS:
        centers, pairs = stars(members, percent, spread)
        links = written(spark, confirmed(pairs, full, percent), "confirmed")
        members = members.join(centers.select("bucket", F.col("center").alias("node")), ["bucket", "node"], "left_anti")
        if not links.isEmpty():
            parts = components(links)
            members, labels = relabelled(members, parts), relabelled(labels, parts)
        members = written(spark, undecided(members), "members")
    links = written(spark, block_links(members, full, percent), "confirmed")
    if not links.isEmpty():
        labels = relabelled(labels, components(links))

    names = labels.groupBy("label").agg(F.min("first_id").alias("component_id"))
    labels = labels.join(names, "label").select("set_key", "component_id", "label")
    out = signed.join(labels, "set_key", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).drop("set_key", "bands")


def _node_sets(texts: DataFrame, words: int) -> DataFrame:
    """node and shingles of the rows (text, node, set_key) whose text has that set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = Words(part.column("text"), lower=True)
                data = [s.tobytes() for s in shingles(found, found.hashes(), words)]
                keys = part.column("set_key").to_pylist()
                keep = pa.array([xxhash.xxh3_128_digest(x) == k for x, k in zip(data, keys, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").filter(keep), pa.array(data, pa.binary()).filter(keep)], names=["node", "shingles"]
                )

    return texts.mapInArrow(build, "node long, shingles binary")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; all columns stay.

    Rows of one doc_id and text are one row, and of several texts of that doc_id
    in a group one stays. Rows without doc_id stay unless they are linked to a
    document that has one.
    """
    kept = _verdicts(docs, words, percent, text_keys=True).filter("kept")
    kept = kept.groupBy("doc_id", "text_key", "label").agg(F.count(F.lit(1)).alias("copies"))
    named = F.col("doc_id").isNotNull() & F.col("label").isNotNull()
    one = kept.filter(named).groupBy("label").agg(F.min(F.struct("text_key", "doc_id", "copies")).alias("one")).select("one.*")
    chosen = one.unionByName(kept.filter(~named).select("text_key", "doc_id", "copies"))
    verdict = written(docs.sparkSession, chosen.withColumnsRenamed({"doc_id": "kept_id", "text_key": "kept_key"}), "kept")

    def rows(of: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(of["kept_id"]) & text_key(docs["text"]).eqNullSafe(of["kept_key"])
        return docs.join(of.hint("shuffle_hash"), same).select(*[docs[quoted(c)] for c in docs.columns])

    repeated = verdict.filter("copies > 1")
    if repeated.isEmpty():
        return rows(verdict)
    return rows(verdict.filter("copies = 1")).unionByName(rows(repeated).dropDuplicates(["doc_id", "text"]))
