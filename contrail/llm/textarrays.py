"""Whole Arrow columns of text as arrays: words, hashes of runs, and minimizers.

All functions work over many texts at once; a text's bounds are respected by masks, so the
cost is a few array passes a byte, with no Python work a word.

Two kinds of hashes. ``Sums`` are quick rolling ones that choose and group candidates; they are
linear, so texts can be built that they don't tell apart, and nothing is decided by them. What
decides is ``digests``: XXH3 with 128 bits over the bytes themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are worked on at once; a longer text is a slice by itself.
SLICE = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def byte_values(seed: int) -> np.ndarray:
    """256 odd pseudorandom 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000)) * _BASE) | np.uint64(1)


class Sums:
    """Hashes of runs of values in constant time each, from running sums modulo 2**64."""

    def __init__(self, values: np.ndarray):
        p, self.inverse = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * p[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        runs = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(runs + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def digests(buffer: bytes, starts: np.ndarray, ends: np.ndarray, salt: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """XXH3-128 of each run of bytes as two arrays of longs; a salt keeps runs of another shape apart."""
    of = xxhash.xxh3_128_digest
    out = np.frombuffer(b"".join([of(buffer[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]), "<u8").reshape(-1, 2)
    one, two = out[:, 0].copy(), out[:, 1].copy()
    if salt is not None:
        one ^= mixed(salt.astype(np.uint64) + np.uint64(1))
    return one.view(np.int64), two.view(np.int64)


def parts(column: pa.Array, limit: int = SLICE):
    """(first row, row past the last, bytes, offsets of the rows in them); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """The words of texts: starts and ends as bytes, first[r] the number of words before row r."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        inside = np.concatenate(([False], ~_SPACE[data], [False]))
        bound = np.zeros(len(data) + 1, bool)
        bound[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | bound))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | bound))
        self.first = np.searchsorted(self.starts, offsets)
        self.row_end = np.repeat(self.first[1:], np.diff(self.first))  # for each word

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int) -> np.ndarray:
        return Sums(byte_values(seed)[self.data]).of(self.starts, self.ends)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space behind each, and where they start and end there."""
        keep = np.zeros(len(self.data) + 1, bool)
        steps = np.zeros(len(self.data) + 2, np.int8)
        steps[self.starts] += 1
        steps[self.ends] -= 1
        keep[:] = np.cumsum(steps[:-1], dtype=np.int8) > 0
        sizes = self.ends - self.starts
        ends = np.cumsum(sizes + 1) - 1 if len(sizes) else np.zeros(0, np.int64)
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
        inside = np.ones(len(out), bool)
        inside[ends] = False
        out[inside] = self.data[keep[:-1]]
        return out.tobytes(), ends - sizes, ends

    def run_starts(self, k: int) -> np.ndarray:
        """The words at which a run of k words of one text starts."""
        i = np.arange(len(self))
        return i[i + k <= self.row_end]


def runs(hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    return Sums(hashes).of(starts, starts + k)


#: Places are told by the lower bits of a key, so windows are taken in blocks of fewer.
_PLACE = np.uint64((1 << 24) - 1)
BLOCK = 1 << 20


def minimizers(grams: np.ndarray, valid: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    """For each window the place of its least gram, the leftmost of equal ones.

    grams[i] is the hash of the gram at i, valid[i] whether it lies in one text; a window at w
    holds the grams w..w+width-1; windows rise. Order is by the upper 40 bits of the hash, then by
    place. Any number of grams: they are taken in overlapping blocks.
    """
    out = np.empty(len(windows), np.int64)
    for lo in range(0, len(grams), BLOCK):
        a, b = np.searchsorted(windows, (lo, lo + BLOCK))
        if a < b:
            part = slice(lo, lo + BLOCK + width - 1)
            out[a:b] = lo + _least(grams[part], valid[part], windows[a:b] - lo, width)
    return out


def _least(grams: np.ndarray, valid: np.ndarray, windows: np.ndarray, width: int) -> np.ndarray:
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    key[~valid] = np.uint64(0xFFFFFFFFFFFFFFFF)
    done, least = 1, key
    while done < width:
        step = min(done, width - done)
        shifted = np.full(len(least), np.uint64(0xFFFFFFFFFFFFFFFF))
        shifted[: len(least) - step] = least[step:]
        least = np.minimum(least, shifted)
        done += step
    return (least[windows] & _PLACE).astype(np.int64)


def anchors(at: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) for each gram that is the least of some windows.

    The least gram of a window only moves right as the window does, so a gram's windows are one run.
    """
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[cut], windows[cut], windows[np.concatenate((cut[1:] - 1, [len(at) - 1]))]


def spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges first..last, one range after another."""
    n = last - first + 1
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def covered(firsts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in first..end-1 of some range."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, firsts, 1)
    np.subtract.at(steps, np.minimum(ends, n), 1)
    return np.cumsum(steps[:n]) > 0
