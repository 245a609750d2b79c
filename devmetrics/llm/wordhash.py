"""Hashes of words and of runs of words, for whole Arrow batches at once.

Words are runs of anything but the six ASCII white-space characters. The bytes
of all texts of a batch lie in one buffer; a word's hash is the difference of
two running sums over it, so no Python object is made per word. Texts longer
than a portion are hashed in parts that end between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at a time: a handful of arrays of eight times that size exist at once.
PORTION = 1 << 21

_rng = np.random.default_rng(20)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_STEP, PORTION + 1)
_DOWN = _powers(_BACK, PORTION + 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words_of(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of at most ``PORTION`` bytes."""
    edge = np.diff(np.concatenate([[True], _IS_SPACE[data], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    code = _CODE[_LOWER[data] if lower else data]
    n = len(data) + 1
    up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_STEP, n), _powers(_BACK, n))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * up[: len(data)], dtype=np.uint64)])
    h = (total[end] - total[start]) * down[start]
    return mixed(h + (end - start).astype(np.uint64)), start, end


class Batch:
    """The words of the texts of an Arrow string array.

    ``hash``, ``start`` and ``end`` (bytes in ``data``) are per word; the words
    of text ``i`` are ``first[i]`` up to ``first[i + 1]``. A null has none.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        # A space behind each text keeps the words of neighbours apart.
        texts = pc.binary_join_element_wise(
            texts.cast(pa.large_string()).fill_null(""), pa.scalar("", pa.large_string()),
            pa.scalar(" ", pa.large_string()),
        )
        _, offsets, values = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
        self.data = raw[at[0] : at[-1]] if len(at) else raw[:0]
        at = at - at[0]
        parts, done = [], 0
        while done < len(self.data):
            stop = self._stop(done)
            h, s, e = _words_of(self.data[done:stop], lower)
            parts.append((h, s + done, e + done))
            done = stop
        if not parts:
            parts = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
        self.hash, self.start, self.end = (np.concatenate(x) for x in zip(*parts))
        self.first = np.searchsorted(self.start, at)

    def _stop(self, done: int) -> int:
        """Where the portion from ``done`` on ends: behind a space, or later if a word is longer."""
        limit = min(done + PORTION, len(self.data))
        while limit < len(self.data):
            space = np.flatnonzero(_IS_SPACE[self.data[done:limit]])
            if len(space):
                return done + int(space[-1]) + 1
            limit = min(limit + PORTION, len(self.data))
        return limit

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def runs(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of ``length`` words that lies inside one text; by start."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rng = np.random.default_rng(length)
    factor = rng.integers(1, 1 << 63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for k in range(length):
        h += hashes[k : k + n] * factor[k]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    inside = np.arange(length, n + length) <= first[text + 1]
    return mixed(h), np.where(inside, text, -1)
