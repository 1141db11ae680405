"""Sorted runs of suffix strings: front coding and merging by a loser tree that knows common prefixes."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np


class Run(NamedTuple):
    """Distinct strings in ascending order, each as the length of its prefix shared with the one before and the rest."""

    shared: np.ndarray
    length: np.ndarray
    rest: bytes

    def strings(self) -> Iterator[tuple[int, bytes]]:
        """(shared prefix with the string before, string)."""
        at, before = 0, b""
        for shared, length in zip(self.shared.tolist(), self.length.tolist(), strict=True):
            step = length - shared
            before = before[:shared] + self.rest[at : at + step]
            at += step
            yield shared, before


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in the first ``known`` bytes."""
    high = min(len(a), len(b))
    if a[known:high] == b[known:high]:
        return high
    low, step = known, 8
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(strings: list[bytes]) -> Run:
    """Run of ascending distinct strings."""
    shared = [0, *(common_prefix(a, b) for a, b in zip(strings, strings[1:], strict=False))][: len(strings)]
    rest = b"".join(s[n:] for s, n in zip(strings, shared, strict=True))
    return Run(np.array(shared, np.uint32), np.array([len(s) for s in strings], np.uint32), rest)


def merge(runs: list[Run]) -> Iterator[tuple[int, bytes, int]]:
    """All strings of all runs in order: prefix shared with the string before, the string, and its run.

    A loser tree: each inner node holds the run that lost there and how much its
    head shares with the last string given out. Of two heads the one that shares
    more is smaller without a look at it; heads that share the same amount are
    compared from there on, so no known prefix is read again. Equal strings come
    out in order of their runs.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    streams = [r.strings() for r in runs]
    heads: list[bytes | None] = [None] * leaves
    shared = [0] * leaves
    for i, stream in enumerate(streams):
        heads[i] = next(stream, (0, None))[1]
    losers = [-1] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        known = common_prefix(x, y, shared[a])
        first = a < b if known == len(x) == len(y) else known == len(x) or (known < len(y) and x[known] < y[known])
        winner, loser = (a, b) if first else (b, a)
        shared[loser] = known
        return winner, loser

    winners = [0] * leaves + list(range(leaves))
    for node in range(leaves - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if leaves > 1 else 0
    while heads[top] is not None:
        yield shared[top], heads[top], top
        shared[top], heads[top] = next(streams[top], (0, None))
        node = (top + leaves) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
