"""Words of texts as byte positions and 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

from coderail.llm.common import mix64

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """BASE**i and its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            while len(self.up) < n:
                self.up = np.concatenate([self.up, self.up * (self.up[-1] * BASE)])
                self.down = np.concatenate([self.down, self.down * (self.down[-1] * inverse)])


powers = Powers()


class Batch:
    """Bytes, words and word hashes of some texts, each text followed by one blank."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() + b" " for t in texts]
        self.ends = np.cumsum([len(r) for r in raw])
        self.starts = self.ends - [len(r) for r in raw]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.blank = BLANK[self.data]
        edge = np.diff(np.concatenate([[1], self.blank.astype(np.int8)]))
        self.word_start, self.word_end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.word_doc = np.searchsorted(self.ends, self.word_start, side="right")
        powers.to(len(self.data) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(self.data)])])
            self.word_hash = mix64((sums[self.word_end] - sums[self.word_start]) * powers.down[self.word_start])
        self.n_words = np.bincount(self.word_doc, minlength=len(raw))


def running(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    size, out = 1, x
    while 2 * size <= width:
        out = best(out[: len(out) - size], out[size:])
        size *= 2
    return best(out[: len(x) - width + 1], out[width - size : len(x) - size + 1]) if size < width else out
