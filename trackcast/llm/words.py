"""Words of texts as numpy arrays: where they are and 128-bit names of them, many texts at a time."""

from __future__ import annotations

from typing import Iterator

import numpy as np

from trackcast.llm.common import CHUNK, pair_name

#: The six white-space characters between words; none occurs inside a UTF-8 sequence.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


class WordNames:
    """Names words by polynomial hashes over random byte values, by prefix sums, in two lanes."""

    def __init__(self):
        rng = np.random.default_rng(20240229)
        self.values = rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)
        self.base = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
        self.powers = [self._powers(b, 2 * CHUNK) for b in self.base]

    @staticmethod
    def _powers(base: int, n: int):
        inverse = pow(base, -1, 1 << 64)
        up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(b))]), dtype=np.uint64)
                    for b in (base, inverse))
        return up, down

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of a byte array."""
        gap = np.concatenate([[True], _SPACE[data], [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        return edge[::2], edge[1::2]

    def name(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
        n = len(data)
        up, down = self.powers[lane]
        if n >= len(up):  # a single word or text longer than a chunk
            up, down = self._powers(self.base[lane], n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.values[lane][data] * up[:n], dtype=np.uint64)])
        return pair_name((sums[ends] - sums[starts]) * down[starts], (ends - starts).astype(np.uint64), lane)

    def of(self, texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Number of words of each text, and the two lanes of names of all words, in order.

        Long texts are named in parts cut at white space, so memory beside the names stays at a few chunks.
        """
        counts, lanes = np.zeros(len(texts), np.int64), ([], [])
        for batch in _chunks(texts):
            data = np.frombuffer(b" ".join(part for _, part in batch), np.uint8)
            if lower:
                data = LOWER[data]
            starts, ends = self.find(data)
            size = np.array([len(part) + 1 for _, part in batch])
            at = np.cumsum(size) - size
            per = np.diff(np.concatenate([np.searchsorted(starts, at), [len(starts)]]))
            np.add.at(counts, [k for k, _ in batch], per)
            for lane in (0, 1):
                lanes[lane].append(self.name(data, starts, ends, lane))
        none = np.empty(0, np.uint64)
        return counts, [np.concatenate(x) if x else none for x in lanes]


def _chunks(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(number of text, part) in groups of about CHUNK bytes; long texts are cut at white space."""
    group, size = [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or at == 0:
            end = len(text)
            if end - at > CHUNK:
                end = at + CHUNK
                while end < len(text) and not _SPACE[text[end]]:
                    end += 1
            group.append((k, text[at:end]))
            size += end - at
            at = max(end, 1)
            if size >= CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


def gram_names(words: list[np.ndarray], sizes: tuple[int, ...], lane: int) -> dict[int, np.ndarray]:
    """Names of the word sequences of the given lengths that start at each word, by doubling."""
    out, have, h = {}, {1: words[lane]}, 1
    while h <= max(sizes):
        for n in sizes:
            if h <= n < 2 * h:
                x = have[h]
                out[n] = x if n == h else pair_name(x[:len(x) - (n - h)], x[n - h:], lane)
        x = have[h]
        have[2 * h] = pair_name(x[:-h], x[h:], lane) if len(x) > h else x[:0]
        h *= 2
    return out
