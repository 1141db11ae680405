"""Quality rules with compression bands (operator 9).

A text's zstandard ratio (bytes over compressed bytes) is taken of the whole text
and of fixed chunks of it, the last of which ends where the text ends. Repetitive text compresses too well, noise too badly;
what is normal depends on the length, so each band of lengths has its own limits:
fixed ones for what no text should be, and narrower ones fitted to the table.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.llm.words import MULTIPLIERS, Words, mix, slices, text_bytes, windows
from landfall.workspace import written


class Band(NamedTuple):
    """Lowest and highest ratio allowed to texts (or chunks) of at least ``size`` bytes."""

    size: int
    low: float
    high: float


LEVEL = 3
# Fitted limits: bins of lengths an octave, and how far beyond the 5th and 95th percentile a limit lies.
BINS_AN_OCTAVE = 2
REACH = 2.5
# Limits by length, for a whole text. A text shorter than the first band is not judged.
TEXT_BANDS = (
    Band(128, 0.95, 3.2), Band(512, 1.20, 3.6), Band(1024, 1.40, 4.0), Band(4096, 1.60, 5.0),
    Band(16384, 1.70, 6.5), Band(65536, 1.70, 9.0),
)
# The same for chunks; a text's chunks have the largest of these sizes that it reaches. A shorter text has none.
CHUNK_BANDS = (Band(512, 1.30, 3.6), Band(1024, 1.40, 4.0), Band(4096, 1.50, 6.0))
# Share of a text's chunks that may lie outside their band.
BAD_CHUNKS = 0.25

MIN_WORDS = 50
REPEAT_PERCENT = 50
# Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\v\f\r"

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long,"
    " text_ratio double, n_chunks long, n_bad_chunks long"
)


def ratio(compressor: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(data) / len(compressor.compress(data))


def chunk_scores(compressor: zstandard.ZstdCompressor, data: bytes, bands: tuple[Band, ...] = CHUNK_BANDS) -> tuple[int, int]:
    """Chunks of a text, and how many lie outside their band.

    All bytes are judged: what is left behind the last full chunk lies in one more
    chunk of the same size, which ends with the text and overlaps the one before.
    """
    band = max((b for b in bands if b.size <= len(data)), default=None)
    if band is None:
        return 0, 0
    starts = [*range(0, len(data) - band.size + 1, band.size)]
    if len(data) % band.size:
        starts.append(len(data) - band.size)
    bad = sum(not band.low <= ratio(compressor, data[i : i + band.size]) <= band.high for i in starts)
    return len(starts), bad


def repeated_words(words: Words, n: int = 3) -> np.ndarray:
    """Per text, the words that lie in an n-word window found more than once in the text."""
    hashes = words.hashes()
    grams = windows(hashes, n)
    count = len(words)
    if not len(grams):
        return np.zeros(count, np.int64)
    owner = np.repeat(np.arange(count), np.diff(words.first))
    inside = owner[: len(grams)] == owner[n - 1 :]
    at = np.flatnonzero(inside)
    key = mix(grams[at] + owner[at].astype(np.uint64) * MULTIPLIERS[0])
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + n, -1)
    covered = np.cumsum(cover)[:-1] > 0
    total = np.concatenate(([0], np.cumsum(covered)))
    return total[words.first[1:]] - total[words.first[:-1]]


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for part in slices(batch):
            words, texts = Words(part.column("text")), text_bytes(part.column("text"))
            n_words = np.diff(words.first)
            chars = [len(x.decode()) - (len(x) - len(x.translate(None, WHITE))) for x in texts]
            symbols = [len(x) - len(x.translate(None, SYMBOLS)) for x in texts]
            chunks = [chunk_scores(compressor, x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(chars, pa.int64()),
                    pa.array(symbols, pa.int64()), pa.array([duplicate_lines(x) for x in texts], pa.int64()),
                    pa.array(repeated_words(words)), pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([ratio(compressor, x) if x else 1.0 for x in texts]),
                    pa.array([c for c, _ in chunks], pa.int64()), pa.array([b for _, b in chunks], pa.int64()),
                ],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes",
                       "text_ratio", "n_chunks", "n_bad_chunks"],
            )


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text.

    ``docs`` needs doc_id and text; other columns are ignored. Null and empty
    texts have no words, zero counts and ratio 1. Repeated rows are measured each.
    Texts shorter than the smallest chunk have no chunks, only the whole ratio.
    """
    fields = T._parse_datatype_string(COLUMNS).fields
    return docs.select("doc_id", "text").mapInArrow(measure, T.StructType([docs.schema["doc_id"], *fields]))


def in_band(size, value, bands=TEXT_BANDS):
    """Whether a text's ratio lies in the band of its size."""
    verdict = F.lit(True)
    for band in bands:
        verdict = F.when(size >= band.size, value.between(band.low, band.high)).otherwise(verdict)
    return verdict


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def length_bin() -> Column:
    return F.floor(F.log2("n_bytes") * BINS_AN_OCTAVE).cast("int").alias("bin")


def fitted_bands(measures: DataFrame) -> DataFrame:
    """bin, low and high: the ratios that texts of a length have, from all texts the base rules leave.

    A limit lies REACH times as far from the median as the 5th or the 95th
    percentile does, so what is rare at a length lies outside, and nothing does
    where texts are too few to tell.
    """
    usual = measures.filter(~base_failed() & (F.col("n_bytes") >= TEXT_BANDS[0].size))
    tails = F.percentile_approx("text_ratio", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)), F.lit(10_000))
    p = usual.groupBy(length_bin()).agg(tails.alias("p"))
    low, middle, high = (F.col("p")[i] for i in range(3))
    return p.select("bin", (middle - REACH * (middle - low)).alias("low"), (middle + REACH * (high - middle)).alias("high"))


def judge(measures: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """Add base_failed, in_text_band, in_chunk_band and kept to measures; a text must lie in its fixed and its fitted band."""
    bands = fitted_bands(measures) if bands is None else bands
    out = measures.select("*", length_bin()).join(F.broadcast(bands), "bin", "left")  # one row a bin of lengths
    usual = F.coalesce(F.col("text_ratio").between(F.col("low"), F.col("high")), F.lit(True))
    return out.select(
        *measures.columns,
        base_failed().alias("base_failed"),
        (in_band(F.col("n_bytes"), F.col("text_ratio")) & usual).alias("in_text_band"),
        (F.col("n_bad_chunks") <= BAD_CHUNKS * F.col("n_chunks")).alias("in_chunk_band"),
    ).withColumn("kept", ~F.col("base_failed") & F.col("in_text_band") & F.col("in_chunk_band"))


def keep_by_rules(docs: DataFrame) -> DataFrame:
    """The measures and verdict of every document; the limits are fitted to all of ``docs``."""
    return judge(written(docs.sparkSession, text_measures(docs), "measures"))
