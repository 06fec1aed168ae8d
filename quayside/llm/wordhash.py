"""64-bit hashes of words and word sequences of many texts at once, as array operations.

A sequence c0 c1 ... has the value sum(c_k * B**k) modulo 2**64, taken from differences of running sums,
and is then mixed. Words are sequences of bytes, word sequences are sequences of word hashes. Two hashes
with different bases are independent.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
# Odd multipliers drawn once; any odd values serve.
BASES = (
    (_U(0x9E6D62D06F6A9A9B), _U(0xD1342543DE82EF95)),
    (_U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25)),
)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 18
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, ``n`` of each at least."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = _U(pow(int(base), -1, 1 << 64))
        made = []
        for b in (base, inverse):
            row = np.full(size, b, _U)
            row[0] = 1
            made.append(np.cumprod(row, dtype=_U))
        have = _powers[int(base)] = (made[0], made[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the word (the finaliser of SplitMix64)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Words:
    """Where the words of consecutive texts are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        n_docs = len(offsets) - 1
        if len(data) == 0:
            self.starts = self.ends = self.doc = np.zeros(0, np.int64)
            self.first = np.zeros(n_docs + 1, np.int64)
            return
        space = _SPACE[self.data]
        cut = np.empty(len(data) + 1, bool)
        cut[0] = cut[-1] = True
        cut[1:-1] = space[:-1]
        cut[offsets] = True
        self.starts = np.flatnonzero(~space & cut[:-1])
        cut[:-1] |= space
        cut[offsets] = True
        self.ends = np.flatnonzero(~space & cut[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(n_docs), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A hash of every word."""
        base = BASES[which][0]
        out = np.empty(len(self.starts), _U)
        at = 0
        while at < len(out):
            lo = self.starts[at]
            if self.ends[at] - lo > _PIECE:
                out[at] = self._long(lo, self.ends[at], base)
                at += 1
                continue
            upto = max(int(np.searchsorted(self.ends, lo + _PIECE, "right")), at + 1)
            hi = self.ends[upto - 1]
            power, inverse = _tables(base, int(hi - lo) + 1)
            total = np.zeros(hi - lo + 1, _U)
            np.cumsum((self.data[lo:hi].astype(_U) + _U(1)) * power[: hi - lo], out=total[1:])
            s, e = self.starts[at:upto] - lo, self.ends[at:upto] - lo
            out[at:upto] = (total[e] - total[s]) * inverse[s]
            at = upto
        return mix(out)

    def _long(self, lo: int, hi: int, base: np.uint64) -> np.uint64:
        """The value of a word longer than a piece, piece by piece, so that no table grows with it."""
        power, _ = _tables(base, _PIECE)
        total, before, step = 0, 1, pow(int(base), _PIECE, 1 << 64)
        for at in range(int(lo), int(hi), _PIECE):
            part = self.data[at : min(at + _PIECE, int(hi))].astype(_U) + _U(1)
            total += before * int((part * power[: len(part)]).sum(dtype=_U))
            before = before * step % (1 << 64)
        return _U(total % (1 << 64))


def windows(values: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    base = BASES[which][1]
    out = np.empty(count, _U)
    for at in range(0, count, _PIECE):
        part = values[at : min(at + _PIECE, count) + n - 1]
        power, inverse = _tables(base, len(part) + 1)
        total = np.zeros(len(part) + 1, _U)
        np.cumsum(part * power[: len(part)], out=total[1:])
        out[at : at + _PIECE] = (total[n:] - total[:-n]) * inverse[: len(total) - n]
    return mix(out)
