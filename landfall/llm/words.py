"""Words of a batch of texts, found and hashed with array operations.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Null texts count as empty.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Texts are handled in slices of at most this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multipliers of the 64-bit mixing steps.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xCA5A826395121157], np.uint64)
MARKS = np.zeros(256, bool)
MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
LANE_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
LANES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    x = x * MULTIPLIERS[1]
    x ^= x >> np.uint64(32)
    x *= MULTIPLIERS[2]
    x ^= x >> np.uint64(29)
    return x


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Cut a batch so that the texts of each piece stay below ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


class Words:
    """Words of an Arrow column of texts.

    ``starts`` and ``ends`` are byte positions in ``raw``, where every text is
    followed by a line feed; words ``first[i]`` to ``first[i + 1]`` belong to text i.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        column = texts.cast(pa.large_binary())
        joined = pc.binary_join_element_wise(
            column, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()),
            null_handling="replace", null_replacement=b"",
        )
        count = len(joined)
        offsets = np.frombuffer(joined.buffers()[1], np.int64, count + 1) if count else np.zeros(1, np.int64)
        self.bounds = offsets
        raw = np.frombuffer(joined.buffers()[2], np.uint8, int(offsets[-1])) if offsets[-1] else np.empty(0, np.uint8)
        self.raw = LOWER[raw] if lower else raw
        space = SPACE[self.raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, eight bytes a step."""
        length = self.ends - self.starts
        out = length.astype(np.uint64) * MULTIPLIERS[0]
        if not len(out):
            return out
        padded = np.concatenate((self.raw, np.zeros(8, np.uint8)))
        lanes = np.lib.stride_tricks.as_strided(padded, (len(self.raw), 8), (1, 1))
        todo, at, left = np.arange(len(out)), self.starts, length
        for _ in range(LANES):
            lane = lanes[at].view(np.uint64).ravel() & LANE_MASK[np.minimum(left, 8)]
            out[todo] = mix(out[todo] ^ lane)
            more = left > 8
            todo, at, left = todo[more], at[more] + 8, left[more] - 8
            if not len(todo):
                return out
        for i in todo:  # words of hundreds of bytes
            out[i] = xxhash.xxh3_64_intdigest(self.word(i))
        return out


class PlainWords(Words):
    """Lower-case words; ASCII marks and control characters separate words too."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts, lower=True)
        solid = (self.raw > 32) & ~MARKS[self.raw]
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if len(solid) and solid[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.bounds)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count] + np.uint64(n)
    for step in range(1, n):
        out = mix(out) + hashes[step : step + count] * MULTIPLIERS[0]
    return mix(out)
