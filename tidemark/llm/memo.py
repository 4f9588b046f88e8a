"""What a worker remembers about pieces of text that come again and again."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from tidemark.llm.textbatch import equal_ranges

#: Pieces, and bytes of pieces and of their numbers, after which a worker starts anew.
MOST_PIECES = 300_000
MOST_BYTES = 64 << 20


class PieceTable:
    """The numbers of each different piece, worked out once by ``encode`` and kept side by side.

    Pieces are told apart by their bytes. ``encode`` gets new pieces, sorted. Once
    the table is large, those that came only once are dropped between two calls, or
    all if few are; the answers are the same without it.
    """

    def __init__(self, encode: Callable[[list[bytes]], list]):
        self._encode = encode
        self._clear()

    def _clear(self) -> None:
        self._slot: dict[bytes, int] = {}
        self._key_bytes = self._used = 0
        self._flat = np.zeros(1 << 16, np.uint32)
        self._start, self._size, self._hits = (np.zeros(1 << 12, np.int64) for _ in range(3))

    def numbers(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all these ranges of ``data`` in a row, and where those of each begin (one more at the end)."""
        if len(self._slot) > MOST_PIECES or self._key_bytes + 4 * self._used > MOST_BYTES:
            self._shrink()
        group, shown = equal_ranges(data, begin, end)
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(begin[shown].tolist(), end[shown].tolist(), strict=True)]
        new = sorted(set(pieces).difference(self._slot))
        if new:
            self._add(new, self._encode(new))
        which = np.fromiter(map(self._slot.__getitem__, pieces), np.int64, len(pieces))[group]
        seen = np.bincount(which)
        self._hits[: len(seen)] += seen
        sizes = self._size[which]
        total = np.zeros(len(which) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        source = np.repeat(self._start[which] - total[:-1], sizes)
        source += np.arange(total[-1])
        return self._flat[source], total

    def _shrink(self) -> None:
        """Keep what came again, if that is less than half of what may be held."""
        pieces = list(self._slot)
        again = np.flatnonzero(self._hits[: len(pieces)] > 1)
        kept = [pieces[i] for i in again.tolist()]
        values = [self._flat[a : a + n] for a, n in zip(self._start[again].tolist(), self._size[again].tolist(), strict=True)]
        self._clear()
        if 2 * len(kept) <= MOST_PIECES and 2 * sum(len(k) + 4 * len(v) for k, v in zip(kept, values, strict=True)) <= MOST_BYTES:
            self._add(kept, values)

    def _add(self, pieces: list[bytes], values: list) -> None:
        if not pieces:
            return
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        begin, have = self._used, len(self._slot)
        self._used += int(sizes.sum())
        self._flat = _grown(self._flat, self._used)
        self._start, self._size, self._hits = (_grown(x, have + len(pieces)) for x in (self._start, self._size, self._hits))
        self._flat[begin : self._used] = np.fromiter(chain.from_iterable(values), np.uint32, int(sizes.sum()))
        self._size[have : have + len(pieces)] = sizes
        self._start[have : have + len(pieces)] = begin + np.cumsum(sizes) - sizes
        self._slot.update(zip(pieces, range(have, have + len(pieces)), strict=True))
        self._key_bytes += sum(map(len, pieces))


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    more = np.zeros(max(size, 2 * len(array)), array.dtype)
    more[: len(array)] = array
    return more
