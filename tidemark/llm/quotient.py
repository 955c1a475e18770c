"""Counting quotient filters over packed n-grams of word ids: exact counters in sorted, compact form.

An n-gram's ids are packed into lanes of up to 64 bits and permuted by an invertible function. The high bits of the
first lane are the quotient, all other bits the remainder; nothing is hashed away, so equal entries are equal n-grams
and an entry gives its n-gram back. Entries are kept in order, so filters merge in one pass.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Odd multipliers of the permutation.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
ROUNDS = 2
#: A counter takes one byte up to this; a larger one is kept behind.
ESCAPE = 255


class Packing:
    """n-grams of `words` ids of `bits` bits each as lanes, permuted and back."""

    def __init__(self, words: int, bits: int):
        per = 64 // bits
        self.words, self.bits = words, bits
        self.counts = [min(per, words - i) for i in range(0, words, per)]  # words in each lane
        self.widths = [c * bits for c in self.counts]
        self.masks = [_U((1 << w) - 1) for w in self.widths]

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Lanes of n-grams given as one array for each word place."""
        lanes, at = [], 0
        for c in self.counts:
            lane = ids[at].astype(_U)
            for one in ids[at + 1 : at + c]:
                lane = (lane << _U(self.bits)) | one.astype(_U)
            lanes.append(lane)
            at += c
        return lanes

    def unpack(self, lanes: list[np.ndarray]) -> np.ndarray:
        """One row of ids for each n-gram."""
        mask = _U((1 << self.bits) - 1)
        places = [(lane >> _U(self.bits * (c - 1 - j))) & mask for lane, c in zip(lanes, self.counts) for j in range(c)]
        return np.stack(places, axis=1).astype(np.int64)

    def _turn(self, x: np.ndarray, i: int, back: bool) -> np.ndarray:
        """An invertible step within one lane: a multiplication between two folds of its upper half."""
        width, mask = self.widths[i], self.masks[i]
        half = _U((width + 1) // 2)
        odd = _ODD[i % 3] | 1
        by = _U((pow(odd, -1, 1 << 64) if back else odd) & ((1 << 64) - 1))
        x = x ^ (x >> half)
        x = (x * by) & mask
        return x ^ (x >> half)

    def permute(self, lanes: list[np.ndarray], back: bool = False) -> list[np.ndarray]:
        lanes, m = list(lanes), len(lanes)
        steps = [(i, (i + 1) % m) for _ in range(ROUNDS) for i in range(m)]
        with np.errstate(over="ignore"):
            for i, other in reversed(steps) if back else steps:
                if not back:
                    lanes[i] = self._turn(lanes[i], i, False)
                if m > 1:  # a lane takes up what another one says
                    y = lanes[other] * _U(_ODD[2])
                    lanes[i] = lanes[i] ^ ((y ^ (y >> _U(29))) & self.masks[i])
                if back:
                    lanes[i] = self._turn(lanes[i], i, True)
        return lanes


def merged(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """One sorted set of entries from several: counters of equal entries are added."""
    lanes = [np.concatenate(x) for x in zip(*[p[0] for p in parts])]
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    lanes, counts = [x[order] for x in lanes], counts[order]
    if not len(counts):
        return lanes, counts
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
    first = np.flatnonzero(new)
    return [x[first] for x in lanes], np.add.reduceat(counts, first)


def _bytes_of(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (width + 7) // 8].tobytes()


def _read(raw: memoryview, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    b = (width + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :b] = np.frombuffer(raw, np.uint8, n * b, at).reshape(n, b)
    return out.reshape(-1).view("<u8").astype(_U), at + n * b


def write_filter(packing: Packing, lanes: list[np.ndarray], counts: np.ndarray, shard_bits: int) -> bytes:
    """A filter of sorted entries that share the first `shard_bits` bits, which are left out.

    Two bits an entry or quotient tell the runs: which quotients are occupied, and where their runs end."""
    n, left = len(counts), packing.widths[0] - shard_bits
    q = min(left, max(0, n - 1).bit_length())
    own = lanes[0] & _U((1 << left) - 1)
    quotient = (own >> _U(left - q)).astype(np.int64)
    occupied, ends = np.zeros(1 << q, bool), np.ones(n, bool)
    occupied[quotient] = True
    ends[:-1] = quotient[1:] != quotient[:-1]
    low = counts.astype(_U)
    big = low[low >= ESCAPE]
    out = [np.array([n, q], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), _bytes_of(own & _U((1 << (left - q)) - 1), left - q)]
    out += [_bytes_of(x, w) for x, w in zip(lanes[1:], packing.widths[1:])]
    return b"".join([*out, np.minimum(low, _U(ESCAPE)).astype(np.uint8).tobytes(), big.astype("<u8").tobytes()])


def read_filter(packing: Packing, raw: bytes, shard: int, shard_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted entries of a filter: permuted lanes and counters."""
    view = memoryview(raw)
    n, q = (int(x) for x in np.frombuffer(view, "<u4", 2))
    left, at = packing.widths[0] - shard_bits, 8
    size = ((1 << q) + 7) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view, np.uint8, size, at), count=1 << q))
    at += size
    size = (n + 7) // 8
    ends = np.unpackbits(np.frombuffer(view, np.uint8, size, at), count=n)
    at += size
    run = np.cumsum(ends) - ends  # runs that ended before an entry
    rest, at = _read(view, at, n, left - q)
    lanes = [(occupied[run].astype(_U) << _U(left - q)) | rest if n else rest]
    if left < 64:
        lanes[0] = lanes[0] | (_U(shard) << _U(left))
    for w in packing.widths[1:]:
        lane, at = _read(view, at, n, w)
        lanes.append(lane)
    counts = np.frombuffer(view, np.uint8, n, at).astype(np.int64)
    escaped = counts == ESCAPE
    counts[escaped] = np.frombuffer(view, "<u8", int(escaped.sum()), at + n).astype(np.int64)
    return lanes, counts


class Lookup:
    """Whether n-grams are in a set of sorted entries: the quotient gives a run, the remainders in it are compared."""

    def __init__(self, packing: Packing, lanes: list[np.ndarray]):
        self.packing, self.lanes, n = packing, lanes, len(lanes[0])
        q = min(packing.widths[0], max(0, n - 1).bit_length())
        self.shift = _U(packing.widths[0] - q)
        quotient = self._quotient(lanes[0])
        self.first = np.searchsorted(quotient, np.arange((1 << q) + 1))

    def _quotient(self, lane: np.ndarray) -> np.ndarray:
        return (lane >> self.shift).astype(np.int64) if self.shift < 64 else np.zeros(len(lane), np.int64)

    def __call__(self, lanes: list[np.ndarray]) -> np.ndarray:
        quotient = self._quotient(lanes[0])
        at, end = self.first[quotient], self.first[quotient + 1]
        found, open_ = np.zeros(len(quotient), bool), np.flatnonzero(at < end)
        while len(open_):
            same = np.logical_and.reduce([mine[at[open_]] == x[open_] for mine, x in zip(self.lanes, lanes)])
            found[open_[same]] = True
            at[open_] += 1
            open_ = open_[~same & (at[open_] < end[open_])]
        return found
