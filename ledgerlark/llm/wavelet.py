"""A wavelet matrix over token ids: one bit-plane per binary digit, most significant first.

The ids that occur are numbered in order, so there are as many planes as their number needs. Each plane holds one bit per token, packed, and the number of ones before every block of BLOCK bits. From plane to
plane the tokens are stably regrouped, those with a zero bit first, so that rank leads from a position to its place in
the next plane and select leads back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 4096  # bits between two stored counts


@dataclass(frozen=True)
class WaveletMatrix:
    n: int
    symbols: np.ndarray  # the ids that occur, ascending; the planes hold their places
    zeros: list[int]  # zero bits of each plane
    bits: list[np.ndarray]  # uint8, packed, first token in the highest bit
    ones: list[np.ndarray]  # uint32, ones before each block

    @staticmethod
    def build(ids: np.ndarray) -> WaveletMatrix:
        n, occurs = len(ids), np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=bool)
        occurs[ids] = True
        symbols = np.flatnonzero(occurs).astype(np.uint32)
        planes = max(len(symbols) - 1, 1).bit_length()
        ids = (np.cumsum(occurs) - 1).astype(np.uint16 if planes <= 16 else np.uint32)[ids] if n else ids.astype(np.uint16)
        zeros, bits, ones = [], [], []
        for plane in range(planes - 1, -1, -1):
            one = (ids & ids.dtype.type(1 << plane)) != 0
            packed = np.packbits(one)
            whole = np.zeros(-(-max(n, 1) // BLOCK) * (BLOCK // 8), dtype=np.uint8)
            whole[: len(packed)] = packed
            in_block = np.bitwise_count(whole.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            ones.append(np.concatenate([[0], np.cumsum(in_block, dtype=np.uint32)[:-1]]).astype(np.uint32))
            bits.append(packed)
            zeros.append(n - int(np.count_nonzero(one)))
            ids = np.concatenate([ids.compress(~one), ids.compress(one)])
        return WaveletMatrix(n, symbols, zeros, bits, ones)

    @property
    def planes(self) -> int:
        return len(self.bits)

    def _place(self, token: int) -> int | None:
        at = int(np.searchsorted(self.symbols, token))
        return at if at < len(self.symbols) and self.symbols[at] == token else None

    def _bit(self, plane: int, i: int) -> int:
        return int(self.bits[plane][i >> 3]) >> (7 - (i & 7)) & 1

    def _rank(self, plane: int, i: int) -> int:
        """Ones before position i of a plane."""
        block = min(i // BLOCK, len(self.ones[plane]) - 1)
        part = self.bits[plane][block * BLOCK // 8 : (i >> 3) + 1]
        count = int(np.bitwise_count(part[: (i >> 3) - block * BLOCK // 8]).sum())
        if i & 7:
            count += (int(part[-1]) >> (8 - (i & 7))).bit_count()
        return int(self.ones[plane][block]) + count

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value in a plane."""
        before = self.ones[plane].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.bits[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8])[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The token at position i."""
        code = 0
        for plane in range(self.planes):
            bit, ones = self._bit(plane, i), self._rank(plane, i)
            code, i = code << 1 | bit, self.zeros[plane] + ones if bit else i - ones
        return int(self.symbols[code])

    def _range(self, code: int, i: int) -> tuple[int, int]:
        """Where the occurrences of a code before position i stand below the last plane."""
        lo, hi = 0, i
        for plane in range(self.planes):
            a, b = self._rank(plane, lo), self._rank(plane, hi)
            one = code >> (self.planes - 1 - plane) & 1
            lo, hi = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences of a token before position i (of all, without i)."""
        code = self._place(token)
        if code is None:
            return 0
        lo, hi = self._range(code, self.n if i is None else i)
        return hi - lo

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        code = self._place(token)
        if code is None:
            raise IndexError(f"token {token} does not occur")
        at = self._range(code, 0)[0] + k
        for plane in range(self.planes - 1, -1, -1):
            one = code >> (self.planes - 1 - plane) & 1
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def positions(self, token: int) -> np.ndarray:
        """All positions of a token, ascending."""
        code = self._place(token)
        if code is None:
            return np.zeros(0, dtype=np.int64)
        lo, hi = self._range(code, self.n)
        at = np.arange(lo, hi)
        for plane in range(self.planes - 1, -1, -1):
            one = code >> (self.planes - 1 - plane) & 1
            of_bit = np.flatnonzero(np.unpackbits(self.bits[plane])[: self.n] == one)
            at = of_bit[at - self.zeros[plane] if one else at]
        return at

    def decode(self) -> np.ndarray:
        """All tokens in order, by undoing the regrouping from the last plane to the first."""
        ids = np.zeros(self.n, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for plane in range(self.planes - 1, -1, -1):
            one = np.unpackbits(self.bits[plane])[: self.n].astype(bool)
            before = np.empty_like(ids)
            before[np.flatnonzero(~one)] = ids[: self.zeros[plane]]
            before[np.flatnonzero(one)] = ids[self.zeros[plane] :] | ids.dtype.type(1 << (self.planes - 1 - plane))
            ids = before
        return self.symbols[ids] if self.n else np.zeros(0, dtype=np.uint32)
