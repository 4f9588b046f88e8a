"""Words of whole texts as arrays over the UTF-8 bytes of an Arrow column.

A word is a longest run of bytes other than space and 0x09-0x0D. These bytes
never occur inside a longer UTF-8 sequence, so bytes and code points agree on
where words are. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into arrays at a time; a longer text is taken alone.
SLICE_BYTES = 1 << 20

#: Bytes whose hashes are worked out at a time.
HASH_BYTES = 1 << 17

_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_powers: dict[int, np.ndarray] = {}


@dataclass
class Words:
    data: np.ndarray  #: bytes of all texts
    starts: np.ndarray  #: of each word, in ``data``
    ends: np.ndarray
    first: np.ndarray  #: number of the first word of each text, and the number of words


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each value begins (one more at the end)."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("").cast(column.type))
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` bytes of text each."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(at, at[begin] + size, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def words(column: pa.Array) -> Words:
    data, at = utf8(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(at), np.int64))
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begin, last = ~space, ~space
    edge = at[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    solid, before = ~space[edge], ~space[edge - 1]
    begin[1:] &= space[:-1]
    last[:-1] &= space[1:]
    begin[edge] = solid
    last[edge - 1] = before
    starts = np.flatnonzero(begin)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the public splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


class Rolling:
    """Polynomial hashes, modulo 2**64, of any ranges of a sequence of numbers."""

    def __init__(self, values: np.ndarray, base: int = _WORD_BASE):
        n = len(values)
        self.back = _power(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power(base, n), out=self.sums[1:])

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.back[:n])


_PRIME = (1 << 31) - 1
_PRIME_BASE = 0x5BD1E995
_prime_powers: list[np.ndarray] = []


def _power_of_prime(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the second base and of its inverse modulo the prime."""
    if not _prime_powers or len(_prime_powers[0]) < n:
        size = max(n, 1 << 16)
        _prime_powers[:] = [_powers_modulo(b, size) for b in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME))]
    return _prime_powers[0][:n], _prime_powers[1][:n]


def _powers_modulo(base: int, size: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), _PRIME)) % np.uint64(_PRIME)))
    return out


class Names(Rolling):
    """As :class:`Rolling`, with a second polynomial, modulo a prime.

    Modulo 2**64 alone there are sequences, such as a Thue-Morse word of 1 024
    signs and its complement, that have one value under every base.
    """

    def __init__(self, values: np.ndarray, base: int = _WORD_BASE):
        super().__init__(values, base)
        n = len(values)
        forth, self.prime_back = _power_of_prime(n + 1)
        self.prime_sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values % np.uint64(_PRIME) * forth[:n] % np.uint64(_PRIME), out=self.prime_sums[1:])

    def _second(self, begin, end) -> np.ndarray:
        return mix((self.prime_sums[end] - self.prime_sums[begin]) % np.uint64(_PRIME) * self.prime_back[begin] % np.uint64(_PRIME))

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(super().ranges(begin, end) ^ self._second(begin, end))

    def grams(self, k: int) -> np.ndarray:
        first = super().grams(k)
        at = np.arange(len(first))
        return mix(first ^ self._second(at, at + k))


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: type[Rolling] = Rolling) -> np.ndarray:
    """One 64-bit number for each range of bytes; equal ranges have equal numbers.

    The ranges are in order and do not overlap; some hundred kilobytes are taken
    at a time, which the caches of a processor hold.
    """
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        base = begin[at]
        stop = max(at + 1, int(np.searchsorted(end, base + HASH_BYTES, side="right")))
        part = kind(data[base : end[stop - 1]].astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        out[at:stop] = part.ranges(begin[at:stop] - base, end[at:stop] - base)
        at = stop
    return out


def word_hashes(w: Words) -> np.ndarray:
    """One 64-bit number per word; equal words have equal numbers."""
    return range_hashes(w.data, w.starts, w.ends)


def range_names(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As :func:`range_hashes`, for telling ranges apart."""
    return range_hashes(data, begin, end, Names)


def equal_ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range the number of its group of equal ones, and for each group one of its ranges.

    Groups are found by hash and then compared byte by byte with the one that is
    shown; ranges that differ from it, which only happens where hashes collide, get groups of their own.
    """
    group, different = pd.factorize(range_hashes(data, begin, end))
    shown = np.empty(len(different), np.int64)
    shown[group[::-1]] = np.arange(len(group))[::-1]
    like = shown[group]
    size = end - begin
    apart = size != size[like]
    again = np.flatnonzero((like != np.arange(len(like))) & ~apart)
    each = size[again]
    before = np.cumsum(each) - each
    at = np.repeat(begin[again] - before, each)
    at += np.arange(len(at))
    unlike = data[at] != data[at + np.repeat(begin[like[again]] - begin[again], each)]
    if unlike.any():
        apart[again[np.searchsorted(before, np.flatnonzero(unlike), side="right") - 1]] = True
    own: dict[bytes, int] = {}
    for i in np.flatnonzero(apart).tolist():
        raw = data[begin[i] : end[i]].tobytes()
        if raw not in own:
            own[raw] = len(shown)
            shown = np.append(shown, i)
        group[i] = own[raw]
    return group, shown


def word_names(w: Words) -> np.ndarray:
    """As :func:`word_hashes`, for telling words apart."""
    return range_names(w.data, w.starts, w.ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < width:
        n = len(values) - width + 1
        out = np.minimum(out[:n], out[width - have : width - have + n])
    return out


def windows_by_minimum(values: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows that share their smallest gram.

    ``values`` are the hashes of all texts' units, ``first`` the number of each
    text's first unit. A window is ``width`` units of one text; it is named by
    the least hash of its ``gram``-unit grams, so that equal windows have equal
    names wherever they stand. Returns for each run: text, first unit, unit after
    the last, name, and a hash of its units.
    """
    rolling = Names(values)
    names = sliding_min(rolling.grams(gram), width - gram + 1)
    if not len(names):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.arange(len(names))
    text = np.searchsorted(first, at, side="right") - 1
    inside = at + width <= first[np.minimum(text + 1, len(first) - 1)]
    at, text, names = at[inside], text[inside], names[inside]
    if not len(at):
        return at, at, at, names, names
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    begin, end = at[head], at[tail] + width
    return text[head], begin, end, names[head], rolling.ranges(begin, end)


def union_of_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, sorted and merged where they touch."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out
