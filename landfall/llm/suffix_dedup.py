"""Removal of long byte strings that occur more than once (operator 8).

Sorting every suffix of the corpus would move each text hundreds of times, so
suffixes are sampled: of the grams in every ``length``-byte window the one with
the least hash is its anchor. Equal windows have equal anchors at equal places, so
a window can only repeat where its anchor's gram does; all others drop out after
one count of gram hashes. The windows that share an anchor form a region, a string
of little more than ``length`` bytes. Regions with repeated anchors are sorted by
(gram hash, string): every task sorts and front-codes runs, the runs are exchanged
by gram hash and merged by loser trees that never compare a known prefix again.
Where a string's whole length is shared with a neighbour, all its windows repeat.
The strings of one gram hash are adjacent, so windows of a region that repeats
only in part (at the ends of a passage) are compared there, by 128-bit hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from landfall.llm.suffix_runs import Run, front_coded, merge
from landfall.llm.words import mix
from landfall.workspace import written

LENGTH = 400
GRAM = 128
RUN_BYTES = 16 << 20
PART_BYTES = 24 << 20
SEGMENT = 1 << 20
# Regions of one gram hash beyond this number are not gathered for a merge: their windows are counted by Spark.
# At the ends of a passage all strings of a group differ and each has a hash for up to 273 windows in memory.
HOT_REGIONS = 20_000
# So many regions of one text have their windows counted together; at most 70,000 hashes are in memory.
REGIONS_AT_ONCE = 256
PREFIX = 8


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def regions(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of every region of a text; none if it is shorter than a window.

    Very long texts are cut into segments of windows, which only splits regions.
    """
    count = len(data) - length + 1
    firsts, lasts, anchors = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    raw = np.frombuffer(data, np.uint8)
    for begin in range(0, max(count, 0), SEGMENT):
        windows = min(SEGMENT, count - begin)
        grams = windows + length - gram
        lanes = np.lib.stride_tricks.as_strided(raw[begin:], (grams, 8), (1, 1)).copy().view(np.uint64).ravel()
        order = (mix(lanes) & ~np.uint64(0xFFFFFFFF)) | np.arange(grams, dtype=np.uint64)
        least = (sliding_least(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change - 1, [windows - 1]))
        firsts.append(first + begin)
        lasts.append(last + begin)
        anchors.append(least[first] + begin)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(anchors)


def gram_hashes(data: bytes, anchors: np.ndarray, gram: int) -> list[int]:
    view = memoryview(data)
    return [xxhash.xxh3_64_intdigest(view[a : a + gram]) for a in anchors.tolist()]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, data (UTF-8 bytes, null is empty) and key (its 128-bit digest)."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", data.alias("data")).withColumn("key", F.unhex(F.md5("data")))


def short_key():
    """64 bits of the key; texts that share them by chance only get more candidates."""
    return F.xxhash64("key").alias("short")


def anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """gram hash, short key and first window of every region of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, shorts, places = [], [], []
            for short, data in zip(batch.column("short").to_pylist(), batch.column("data").to_pylist(), strict=True):
                first, _, anchors = regions(data, length, gram)
                grams.append(np.array(gram_hashes(data, anchors, gram), np.uint64).view(np.int64))
                shorts.append(np.full(len(first), short))
                places.append(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (grams, shorts, places)], names=["gram", "short", "place"]
            )

    return texts.select(short_key(), "data").mapInArrow(run, "gram long, short long, place long")


def repeated_places(rows: DataFrame, hot_regions: int) -> DataFrame:
    """short and the places whose gram occurs more than once: ``merged`` ones, and ``counted`` ones of hot grams.

    Rows of hot grams are found where they lie, as a shuffle by gram would give all of one to a single task; such grams
    are at most one in ``hot_regions`` rows. The others meet by a merge join at any size, so its disk grows with the input.
    """
    held = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    counts = written(rows.sparkSession, held, "grams")
    hot = F.broadcast(counts.filter(F.col("held") > hot_regions).select("gram"))
    often = counts.filter(F.col("held") <= hot_regions).select("gram").hint("merge")
    merged = rows.join(hot, "gram", "left_anti").join(often, "gram", "left_semi").select("short", "place", F.lit(False).alias("hot"))
    found = merged.unionByName(rows.join(hot, "gram", "left_semi").select("short", "place", F.lit(True).alias("hot")))
    return found.groupBy("short").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("place"))).alias("merged"), F.collect_set(F.when(F.col("hot"), F.col("place"))).alias("counted")
    )


def part_of(gram: int, parts: int) -> int:
    """Gram hashes are even, so equal ranges of them are even parts."""
    return gram * parts >> 64


RUN_SCHEMA = "part int, shared binary, length binary, rest binary, copies binary, keys binary, places binary, gram binary, stretch binary"


def run_rows(strings: dict[bytes, list], parts: int) -> Iterator[dict]:
    """Front-coded runs of (gram hash, string) entries, one for each part that has any."""
    ordered = sorted(strings)
    cuts = [part_of(int.from_bytes(s[:PREFIX], "big"), parts) for s in ordered]
    begin = 0
    while begin < len(ordered):
        end = begin
        while end < len(ordered) and cuts[end] == cuts[begin]:
            end += 1
        held = ordered[begin:end]
        run, owners = front_coded(held), [strings[s] for s in held]
        yield {
            "part": cuts[begin], "shared": run.shared.tobytes(), "length": run.length.tobytes(), "rest": run.rest,
            # How often each string occurs, 2 standing for more, and the texts that want to know.
            "copies": np.array([min(2, o[0]) for o in owners], np.uint8).tobytes(),
            "keys": b"".join(k for o in owners for k, _ in o[1]),
            "places": np.array([p for o in owners for _, p in o[1]], np.int64).tobytes(),
            "gram": np.array([len(o[1]) for o in owners], np.uint32).tobytes(), "stretch": None,
        }
        begin = end


def found_twice(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Per string, whether each of its windows occurs again, in it or in another one."""
    digests, ends = bytearray(), []
    for string in strings:
        digests += b"".join(window_hashes(string, length))
        ends.append(len(digests) // 16)
    high, low = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
    order = np.lexsort((low, high))
    same = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.split(twice, ends[:-1])


def window_hashes(data: bytes, length: int) -> list[bytes]:
    view = memoryview(data)
    return [xxhash.xxh3_128_digest(view[o : o + length]) for o in range(len(data) - length + 1)]


def sorted_runs(candidates: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """Runs of the candidates (key, data, copies, merged), and rows of ``counted`` regions for counting by Spark.

    A text that has copies is sent along for others to find; it does not ask for itself.
    """
    names = [f.name for f in T._parse_datatype_string(RUN_SCHEMA).fields]
    types = [pa.int32(), *[pa.binary()] * 8]

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                data, wanted = row["data"], set(row["merged"])
                first, last, anchors = regions(data, length, gram)
                chosen = np.flatnonzero(np.isin(first, np.array(sorted(wanted), np.int64)))
                for i, h in zip(chosen.tolist(), gram_hashes(data, anchors[chosen], gram), strict=True):
                    begin = int(first[i])
                    string = h.to_bytes(PREFIX, "big") + data[begin : int(last[i]) + length]
                    held = strings.get(string)
                    if held is None:
                        held = strings[string] = [0, []]
                        size += len(string)
                    held[0] += row["copies"]
                    if row["copies"] == 1:
                        held[1].append((row["key"], begin))
                if size > RUN_BYTES:
                    for r in run_rows(strings, parts):
                        yield table([r])
                    strings, size = {}, 0
        for r in run_rows(strings, parts):
            yield table([r])

    return candidates.select("key", "data", "copies", "merged").mapInArrow(run, RUN_SCHEMA)


class Entry:
    """A merged string, what it shares with its neighbours, and who wants to know."""

    __slots__ = ("string", "before", "after", "repeated", "owners")

    def __init__(self, string: bytes, before: int, repeated: bool, owners: list[tuple[bytes, int]]):
        self.string, self.before, self.after, self.repeated, self.owners = string, before, 0, repeated, owners

    def decided(self) -> bool:
        return self.repeated or max(self.before, self.after) >= len(self.string)


def stretches(offsets: list[int], length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by windows at ascending offsets."""
    out: list[tuple[int, int]] = []
    for o in offsets:
        if out and o <= out[-1][1]:
            out[-1] = (out[-1][0], o + length)
        else:
            out.append((o, o + length))
    return out


def repeated_stretches(group: list[Entry], length: int) -> Iterator[tuple[bytes, int, int]]:
    """(key, start, end) of the repeated windows of the regions that share a gram hash."""
    if all(e.decided() for e in group):
        for e in group:
            for key, place in e.owners:
                yield key, place, place + len(e.string) - PREFIX
        return
    if len(group) == 1:
        return
    for e, twice in zip(group, found_twice([e.string[PREFIX:] for e in group], length), strict=True):
        whole = [(0, len(e.string) - PREFIX)]
        found = whole if e.decided() else stretches(np.flatnonzero(twice).tolist(), length)
        for key, place in e.owners:
            for a, b in found:
                yield key, place + a, place + b


def merged_entries(rows: list[dict]) -> Iterator[Entry]:
    """Strings of all runs of a part in order, equal ones as one entry."""
    runs, owners = [], []
    for row in rows:
        runs.append(Run(np.frombuffer(row["shared"], np.uint32), np.frombuffer(row["length"], np.uint32), row["rest"]))
        counts = np.frombuffer(row["gram"], np.uint32).tolist()
        places = np.frombuffer(row["places"], np.int64).tolist()
        keys = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
        owners.append(_owners(counts, np.frombuffer(row["copies"], np.uint8).tolist(), keys, places))
    entry = None
    for shared, string, source in merge(runs):
        copies, own = next(owners[source])
        if entry is not None and shared == len(string) == len(entry.string):
            entry.repeated = True
            entry.owners += own
            continue
        if entry is not None:
            entry.after = shared
            yield entry
        entry = Entry(string, shared, copies > 1, own)
    if entry is not None:
        yield entry


def _owners(counts: list[int], copies: list[int], keys: list[bytes], places: list[int]):
    at = 0
    for count, copy in zip(counts, copies, strict=True):
        yield copy, list(zip(keys[at : at + count], places[at : at + count], strict=True))
        at += count


STRETCH_SCHEMA = "key binary, start long, end long"


def merged_stretches(runs: DataFrame, parts: int, length: int) -> DataFrame:
    """key, start and end of what repeats, from the merge of each part's runs."""

    def run(table: pa.Table) -> pa.Table:
        found: list[tuple[bytes, int, int]] = []
        group: list[Entry] = []
        for entry in merged_entries(table.to_pylist()):
            if group and group[-1].string[:PREFIX] != entry.string[:PREFIX]:
                found += repeated_stretches(group, length)
                group = []
            group.append(entry)
        if group:
            found += repeated_stretches(group, length)
        keys, starts, ends = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"key": pa.array(keys, pa.binary()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64())})

    return runs.select("part", "shared", "length", "rest", "copies", "keys", "places", "gram").groupBy("part").applyInArrow(
        run, STRETCH_SCHEMA
    )


def window_rows(data: bytes, first: np.ndarray, last: np.ndarray, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, size and count of the windows of some regions of a text: a row for each stretch of bytes that windows
    of one hash cover. The first row of a hash has the count of its windows, the others have 0."""
    digests = b"".join(d for a, b in zip(first.tolist(), last.tolist(), strict=True) for d in window_hashes(data[a : b + length], length))
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
    high, low = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
    order = np.lexsort((starts, low, high))
    high, low, starts = high[order], low[order], starts[order]
    other = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    begins = np.flatnonzero(other | np.concatenate(([True], starts[1:] > starts[:-1] + length)))
    ends = np.concatenate((begins[1:], [len(starts)])) - 1
    held = np.zeros(len(starts), np.int64)
    held[other] = np.diff(np.concatenate((np.flatnonzero(other), [len(starts)])))
    hashes = [digests[16 * i : 16 * i + 16] for i in order[begins].tolist()]
    return hashes, starts[begins], starts[ends] + length - starts[begins], held[begins]


def counted_stretches(candidates: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for regions of hot grams: their windows are counted by hash over all tasks.

    A periodic text has the same few windows over and over: those of some regions travel as one row for each stretch they cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, last, _ = regions(row["data"], length, gram)
                chosen = np.flatnonzero(np.isin(first, np.array(row["counted"], np.int64)))
                for i in range(0, len(chosen), REGIONS_AT_ONCE):
                    some = chosen[i : i + REGIONS_AT_ONCE]
                    hashes, starts, sizes, held = window_rows(row["data"], first[some], last[some], length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes, pa.binary()), pa.array([row["key"]] * len(hashes), pa.binary()),
                            # A text that has copies does not ask for itself.
                            pa.array(starts), pa.array(sizes if row["copies"] == 1 else np.zeros_like(sizes)), pa.array(held * row["copies"]),
                        ],
                        names=["hash", "key", "start", "size", "held"],
                    )

    hot = candidates.filter(F.size("counted") > 0).select("key", "data", "copies", "counted")
    rows = hot.mapInArrow(run, "hash binary, key binary, start long, size long, held long")
    twice = rows.groupBy("hash").agg(F.sum("held").alias("held")).filter("held > 1").select("hash")
    return rows.join(twice, "hash", "left_semi").filter("size > 0").select("key", "start", (F.col("start") + F.col("size")).alias("end"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """key (md5 of the bytes) and ``spans``, the repeated stretches, of every text that has any.

    A text that occurs more than once repeats as a whole if it is long enough.
    """
    spark = docs.sparkSession
    texts = keyed(docs)
    light = texts.select("key", "doc_id", F.octet_length("data").cast("long").alias("n_bytes"))
    sizes = written(spark, light.groupBy("key", "n_bytes").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")), "texts")
    rows = written(spark, anchor_rows(texts.filter(F.octet_length("data") >= length), length, gram), "anchors")
    places = repeated_places(rows, hot_regions)
    wanted = written(spark, places.join(sizes.withColumn("short", F.xxhash64("key")), "short"), "places")
    # One row of each text with candidates, with its bytes.
    chosen = wanted.select(
        F.col("key").alias("wanted_key"), "first_id", F.least("copies", F.lit(2)).alias("copies"), "merged", "counted"
    ).hint("shuffle_hash")
    same = (F.col("key") == F.col("wanted_key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    candidates = texts.join(chosen, same).select("key", "data", "copies", "merged", "counted")

    totals = wanted.agg(F.sum(F.size("merged")), F.sum(F.size("counted"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (totals[0] or 0) * 2 * length // PART_BYTES)
    found = merged_stretches(sorted_runs(candidates, parts, length, gram), parts, length)
    if totals[1]:
        found = found.unionByName(counted_stretches(candidates, length, gram))
    ranges = found.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("stretches"))
    copied = sizes.filter(F.col("copies") > 1).filter(F.col("n_bytes") >= length)
    wholes = copied.select("key", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("stretches"))
    return written(spark, ranges.unionByName(wholes), "stretches")


def joined(stretches_of_text: list[dict]) -> list[tuple[int, int]]:
    """Ascending ranges without overlap; ranges that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in stretches_of_text):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


CUT = "n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary"


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_regions: int = HOT_REGIONS) -> DataFrame:
    """doc_id, n_bytes, ``spans`` (removed byte ranges) and ``kept`` (the other bytes) of every row.

    ``docs`` needs doc_id and text; other columns are ignored. Each byte covered
    by a ``length``-byte string that also starts anywhere else, in the same text
    or another, goes; strings are judged on the input and never cross texts. Null
    and empty texts keep nothing and lose nothing; texts shorter than ``length``
    stay whole. Repeated rows are copies of each other, whatever their doc_id.
    """
    found = repeats(docs, length, gram, hot_regions).select(F.col("key").alias("found_key"), "stretches").hint("shuffle_hash")
    texts = keyed(docs)
    rows = texts.join(found, F.col("key") == F.col("found_key"), "left").select("doc_id", "data", "stretches")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for data, stretches_of_text in zip(batch.column("data").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
                ranges = joined(stretches_of_text or [])
                edges = [0, *(x for r in ranges for x in r), len(data)]
                spans.append([{"start": a, "end": b} for a, b in ranges])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(run, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(CUT).fields]))
