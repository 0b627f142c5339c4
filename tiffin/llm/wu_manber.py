"""Wu-Manber search for many patterns at once, over byte strings, in numpy.

A text is searched in windows as long as the shortest pattern. The block of bytes that ends a window is
looked up in the shift table, which tells how far the window can move without passing an occurrence.
Where the shift is 0 the block may be the end of a pattern's first window; its hash then selects a
bucket of patterns, and these are compared with the text byte by byte.

Many stretches ("lanes") of a text move their windows at the same time: one array operation serves all
of them, and each goes on by its own shift.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

_LANE_BYTES = 512
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class WuManber:
    """Patterns are distinct and not empty."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.window = min(map(len, patterns))
        self.block = min(8, self.window)
        places = self.window - self.block + 1
        bits = min(22, max(12, (len(patterns) * places).bit_length() + 3))
        self._drop = np.uint64(64 - bits)
        self._mask = np.uint64((1 << 8 * self.block) - 1)
        self._last = places - 1
        heads, at = _words_at(b"".join(p[: self.window] for p in patterns)), self.window
        first = np.arange(len(patterns)) * at
        self._shift = np.full(1 << bits, places, np.int64)
        for place in range(places):
            np.minimum.at(self._shift, self._codes(heads, first + place), self._last - place)
        self._buckets: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, code in enumerate(self._codes(heads, first + self._last).tolist()):
            self._buckets[code][patterns[i][: self.window]].append(i)
        self.looked_at = 0

    def _codes(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hashes of the blocks that start at ``at``."""
        return (((words[at] & self._mask) * _SPREAD) >> self._drop).astype(np.int64)

    def _candidates(self, words: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows that the shift table cannot rule out, in order, with the codes of their blocks."""
        lanes = max(1, windows // _LANE_BYTES)
        edges = np.linspace(0, windows, lanes + 1).astype(np.int64)
        at, end = edges[:-1], edges[1:]
        found, codes = [], []
        while len(at):
            code = self._codes(words, at + self._last)
            shift = self._shift[code]
            self.looked_at += len(at)
            hit = np.flatnonzero(shift == 0)
            if len(hit):
                found.append(at[hit])
                codes.append(code[hit])
                shift[hit] = 1
            at = at + shift
            alive = at < end
            at, end = at[alive], end[alive]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        order = np.argsort(where := np.concatenate(found), kind="stable")
        return where[order], np.concatenate(codes)[order]

    def occurrences(self, text: bytes) -> list[tuple[int, int]]:
        """``(start, pattern number)`` of every occurrence, overlapping ones too, by start."""
        windows = len(text) - self.window + 1
        if windows <= 0:
            return []
        out = []
        starts, codes = self._candidates(_words_at(text), windows)
        for start, code in zip(starts.tolist(), codes.tolist(), strict=True):
            bucket = self._buckets.get(code)
            for i in bucket.get(text[start : start + self.window], ()) if bucket else ():
                if text.startswith(self.patterns[i], start):
                    out.append((start, i))
        return out


def _words_at(text: bytes) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the text."""
    return np.ndarray((len(text) + 1,), np.dtype("<u8"), text + bytes(8), 0, (1,))
