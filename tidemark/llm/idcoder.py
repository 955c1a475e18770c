"""Adaptive context-mixing range coder for token ids, in independently reset, checksummed blocks.

The id that followed the last two ids (order 2) and the last id (order 1) are predicted, and how well both have done
tells how they are mixed: for each pair of confidences the coder learns how often each of them is right. Where both
fail, the id is coded by its order-0 frequency in the block so far, or, if it is new there, by what is likely for new
ids. A carryless range coder (64 bits, 32 written at once) codes the choice and, where needed, the id.

Choices between two values are made by multiplying with 0 or 1: a branch that no processor can foresee takes longer.

Blocks share nothing. A block is coded as several streams side by side, which learn from each other: each has a range
coder and mixing weights of its own, while predictions and frequencies are the block's. So numpy codes many streams of
many blocks at once, one lane each.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS, TABLE, IDS = 1 << 14, 1 << 13, 1 << 16
MAGIC = b"TMB3"
_FULL, _32, _15 = np.uint64(2**64 - 1), np.uint64(32), np.uint64(15)
_TOP, _LOW = np.uint64(1 << 32), np.uint64(2**32 - 1)
_HEAD = struct.Struct("<4sIIII")
#: One document's part of a block: its number in the file, its id, its ids here; flags: 1 null id.
PIECE = np.dtype([("doc_no", "<i8"), ("doc_id", "<i8"), ("n", "<u4"), ("flags", "<u4")])
#: Ids that a stream has at least, and streams of a block at most.
STREAM_IDS, STREAMS = 2048, 8
#: Frequencies of ids that are new in a block: low ids, merged first, are likelier.
_NEW = 1 + (1 << 14) // (np.arange(IDS) + 64)
_NEW_ALL = int(_NEW.sum())
#: Lanes that are turned into columns at once, and what keeps their rows from beginning a power of two apart (such rows share
#: few places of a cache).
_SIDE, _APART = 128, 16
#: Steps after which the order-0 frequencies are summed anew, as a share of those done.
_GROWTH = 1 / 8
#: Orders 2 and 1 in rows: a prediction is id << 6 with its confidence in these bits; bit 5 tells the orders apart.
_SURE, _ROW = np.array([[56], [6]], np.int32), np.array([[32], [0]], np.int32)
#: What a prediction gains, by its bits and whether it was right (bit 0).
_GAIN = np.zeros(64, np.int32)
_GAIN[[33, 41, 49]], _GAIN[[40, 48, 56]], _GAIN[[1, 3, 5]], _GAIN[[2, 4, 6]] = 8, -8, 2, -2
#: A mixing weight: how often of 2^15 order 2 is right, or else order 1, or the id is known, as sums in 16 bits each.
_FIELD, _SHIFTS = np.uint64(0xFFFF), np.arange(0, 64, 16, dtype=np.uint64)
_BEGIN = np.uint64(5000 | 10000 << 16 | 23000 << 32 | 1 << 63)
#: Each sum moves by 1/32 of its way towards an end, but stays apart from the next.
_KEEP = np.uint64(0x07FF07FF07FF)
_TO = np.array([sum((1020 + i if choice <= i else 1 + i) << 16 * i for i in range(3)) for choice in range(4)], np.uint64)


def _sums(most: int) -> set[int]:
    """The steps before which order-0 frequencies are summed."""
    steps, at = set(), 0
    while at < most:
        steps.add(at)
        at += max(4, int(at * _GROWTH))
    return steps


def _streams(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each lane, by falling length: its block, where in it the stream begins, its length; and lanes that are active at each step."""
    count = np.clip(lengths // STREAM_IDS, 1, STREAMS)
    block = np.repeat(np.arange(len(lengths)), count)
    share = -(-lengths // count)[block]
    start = (np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)) * share
    size = np.clip(lengths[block] - start, 0, share)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(size.max()), "left")
    return block[order], start[order], size[order], active


class _Frequencies:
    """Order-0 frequencies of all blocks as they are decoded: runs of equal ids in the sorted ids so far, after the runs of all new ids."""

    def __init__(self, block: np.ndarray, steps: int, most: int):
        self.key = (block << 16).astype(np.uint32)
        self.ids = np.zeros((steps, len(block)), np.uint32)  # of each step and lane
        self.keys, self.sizes, self.done = np.zeros(0, np.uint32), np.zeros(0, np.int32), 0
        self.new = (np.cumsum(_NEW) - _NEW) << 32 | _NEW << 16 | np.arange(IDS)
        self.run = np.zeros(_NEW_ALL + most, np.int32)  # the run of each place
        self.run[:_NEW_ALL] = np.repeat(np.arange(IDS, dtype=np.int32), _NEW)

    def sum_up(self, t: int, k: int):
        """Takes in the steps before t, in which at least k lanes were active."""
        added = np.sort((self.ids[self.done : t, :k] | self.key[:k]).ravel())
        heads = np.flatnonzero(np.diff(added, prepend=~added[:1]))
        own, times, at = added[heads], np.diff(heads, append=len(added)), np.searchsorted(self.keys, added[heads])
        fresh = self.keys.take(at, mode="clip") != own if len(self.keys) else np.ones(len(own), bool)
        self.sizes[at[~fresh]] += times[~fresh]
        to = at[fresh] + np.arange(fresh.sum())  # where ids that are new in their block go
        keys, sizes, old = (np.empty(len(self.keys) + len(to), x) for x in (np.uint32, np.int32, bool))
        old[:], old[to] = True, False
        keys[old], keys[to], sizes[old], sizes[to] = self.keys, own[fresh], self.sizes, times[fresh]
        self.keys, self.sizes, self.done = keys, sizes, t
        upto = np.zeros(1 + len(sizes), np.int64)
        np.cumsum(sizes, out=upto[1:])
        run = self.run[_NEW_ALL : _NEW_ALL + upto[-1]]
        run[:] = 0
        run[upto[:-1]] = 1
        run[:1] = IDS
        np.add.accumulate(run, out=run)
        # of each run: where it begins, its size in 16 bits, its id in 16 bits
        self.runs = np.concatenate([self.new, (upto[:-1] + _NEW_ALL) << 32 | sizes << np.int64(16) | keys & np.uint32(0xFFFF)]).view(np.uint64)
        first, last = (upto[np.searchsorted(self.keys, x, side)] for x, side in ((self.key[:k], "left"), (self.key[:k] | np.uint32(0xFFFF), "right")))
        # of known ids: where they begin, and their total
        self.begin, self.total = (_NEW_ALL + first).view(np.uint64), np.maximum(1, last - first).view(np.uint64)
        self.to_new = np.uint64(_NEW_ALL) - self.total  # what makes it the total of new ids


class _Counts:
    """The same frequencies where all ids are known before: runs of all new ids, then of all different ids of each block."""

    def __init__(self, blocks: list[np.ndarray], block: np.ndarray, steps: int):
        self.places, self.bounds, self.done = np.zeros((steps, len(block)), np.int32), np.zeros(len(blocks) + 1, np.int64), 0
        self.runs = []  # of each block's ids
        seen, place = np.zeros(IDS, bool), np.zeros(IDS, np.int32)
        for i, ids in enumerate(blocks):
            ids = np.asarray(ids).astype(np.intp)
            seen[ids] = True
            own = np.flatnonzero(seen)
            seen[own] = False
            self.bounds[i + 1] = self.bounds[i] + len(own)
            place[own] = np.arange(self.bounds[i], self.bounds[i + 1], dtype=np.int32)
            self.runs.append(place[ids])
        self.block = block
        self.sizes = np.zeros(1 + self.bounds[-1], np.uint32)
        self.sizes[0] = _NEW_ALL
        self.upto, self.first_new = self.sizes.copy(), (np.cumsum(_NEW) - _NEW).astype(np.uint32)

    def sum_up(self, t: int, k: int):
        """Takes in the steps before t, in which at least k lanes were active."""
        np.add.at(self.sizes[1:], self.places[self.done : t, :k].ravel().astype(np.intp), np.uint32(1))
        self.done = t
        np.add.accumulate(self.sizes, out=self.upto)
        self.begin = self.upto[self.bounds[self.block[:k]]]
        self.total = np.maximum(self.upto[self.bounds[self.block[:k] + 1]] - self.begin, np.uint32(1))

    def look_up(self, ids: np.ndarray, to: int):
        """Of the steps from here to `to`: which ids are new; where each begins, its frequency, and the total of its kind."""
        places = self.places[self.done : to, : ids.shape[1]].astype(np.intp)
        first = self.upto.take(places)
        places += 1
        size = self.upto.take(places) - first
        first -= self.begin
        new = size == 0
        total = np.empty_like(first)
        total[:] = self.total
        at = np.flatnonzero(new)
        own = ids.ravel().take(at)
        first.ravel()[at], size.ravel()[at], total.ravel()[at] = self.first_new.take(own), _NEW.take(own), _NEW_ALL
        return new, first, size, total


class _Model:
    """Predictions of each block and mixing weights of each lane; lanes 0..k-1 are active at a step."""

    def __init__(self, block: np.ndarray, blocks: int):
        lanes = len(block)
        self.table = np.full(blocks * 2 * TABLE, IDS << 6, np.int32)
        self.table.reshape(blocks, 2, TABLE)[:, 0] |= 32
        self.base = np.stack([block * 2 * TABLE, block * 2 * TABLE + TABLE]).astype(np.intp)
        self.weight, self.own = np.full(lanes * 32, _BEGIN), np.arange(lanes) * 32 - 32
        self.context = np.zeros((2, lanes), np.uint32)  # the last two ids; the last id

    def keep(self, k: int):
        """From now on lanes 0..k-1 are active."""
        self.base, self.own, self.context = self.base[:, :k].copy(), self.own[:k], self.context[:, :k].copy()

    def predict(self):
        """The ids of order 2 and 1, and the weights."""
        self.at = (self.context * np.uint32(2654435761) >> np.uint32(19)).astype(np.intp)
        self.at += self.base
        self.found = self.table.take(self.at)
        self.sure = self.found & _SURE
        self.ids = self.found >> 6
        place = self.sure[0] + self.sure[1]
        place += self.ids[0] == self.ids[1]
        self.place = place.astype(np.intp)
        self.place += self.own
        self.now = self.weight.take(self.place)
        return self.ids, self.now

    def update(self, ids: np.ndarray, choice: np.ndarray, right: np.ndarray):
        """right: which of the predictions were."""
        now = self.now - (self.now >> np.uint64(5) & _KEEP)
        now += _TO.take(choice)
        self.weight[self.place] = now
        sure = self.sure + right
        after = self.found + _GAIN.take(sure)
        other = (ids << 6) | _ROW
        other -= after
        other *= sure == _ROW
        after += other
        self.table[self.at.ravel()] = after.ravel()  # of streams that meet, the last one counts
        context = self.context
        context[0] <<= 16
        context[0] |= ids.view(np.uint32)
        context[1] = ids


def encode_ids(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of at most BLOCK_IDS ids; an id outside 0..65535 raises ValueError."""
    lengths = np.array([len(b) for b in blocks], dtype=np.int64)
    if not len(lengths):
        return []
    if any(len(b) and not 0 <= int(np.min(b)) <= int(np.max(b)) < IDS for b in blocks) or lengths.max() > BLOCK_IDS:
        raise ValueError("ids must be 0..65535, and a block's length at most BLOCK_IDS")
    block, starts, sizes, active = _streams(lengths)
    known, model, lanes = _Counts(blocks, block, len(active)), _Model(block, len(blocks)), len(block)
    steps_ids = np.zeros(known.places.shape, np.int32)  # of each step and lane
    for all_rows, of in ((steps_ids, blocks), (known.places, known.runs)):
        for first in range(0, lanes, _SIDE):
            some = slice(first, first + _SIDE)
            rows = np.zeros((len(block[some]), len(active) + _APART), np.int32)[:, : len(active)]
            for row, b, start, n in zip(rows, block[some], starts[some], sizes[some]):
                row[:n] = of[b][start : start + n]
            all_rows[:, some] = rows.T
    del known.runs
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, _FULL)
    room = len(active) + 2  # a step writes one word at most
    out, at_word = np.zeros(lanes * room, np.uint32), np.arange(lanes)  # the first words of all lanes, the second ones, ...
    sums, now = sorted(_sums(len(active)) | {0, len(active)}), -1
    for t0, t1 in zip(sums, sums[1:]):
        k = active[t0]
        known.sum_up(t0, k)
        new, firsts, freqs, totals = known.look_up(steps_ids[t0:t1, :k], t1)  # of lanes that end before t1 too
        kind = new.view(np.uint8) + np.uint8(2)
        for t in range(t0, t1):
            if active[t] != now:
                now = k = active[t]
                model.keep(k)
                low_k, rng_k = low[:k], rng[:k]
            ids = steps_ids[t, :k]
            predicted, w = model.predict()
            right = predicted == ids
            raw = ~(right[0] | right[1])
            choice = kind[t - t0, :k] * raw.view(np.uint8)
            choice += right[1] > right[0]
            bits = (choice << np.uint8(4)).astype(np.uint64)  # where the choice's sum lies
            start, end = (w << np.uint64(16)) >> bits & _FIELD, w >> bits & _FIELD
            r = rng_k >> _15
            start *= r
            end *= r
            np.subtract(end, start, out=rng_k)
            low_k += start
            # the id itself, where it was not predicted
            raw = raw.astype(np.uint64)
            r = rng_k // totals[t - t0, :k]
            other = r * freqs[t - t0, :k]
            other -= rng_k
            other *= raw
            rng_k += other
            r *= firsts[t - t0, :k]
            r *= raw
            low_k += r
            todo = np.flatnonzero(rng_k < _TOP)
            tl, tr = low_k.take(todo), rng_k.take(todo)
            # a range that straddles a word is cut to what lies before the boundary
            tr = np.where((tl ^ (tl + tr)) < _TOP, tr, -tl & _LOW)
            place = at_word.take(todo)
            out[place] = (tl >> _32).astype(np.uint32)
            at_word[todo] = place + lanes
            low_k[todo] = tl << _32
            rng_k[todo] = tr << _32
            model.update(ids, choice.astype(np.intp), right)
    for shift in (_32, np.uint64(0)):
        out[at_word] = (low >> shift) & _LOW
        at_word += lanes
    count = at_word // lanes
    words = np.ascontiguousarray(out.reshape(room, lanes)[: count.max()].T, "<u4")
    codes: list[list] = [[] for _ in blocks]
    for lane in np.lexsort([starts, block]):
        codes[block[lane]].append(words[lane, : count[lane]])
    return [np.array([len(c) for c in own], "<u4").tobytes() + b"".join(c.tobytes() for c in own) for own in codes]


def decode_ids(codes: list[bytes], lengths) -> list[np.ndarray]:
    """The ids of each code; lengths: how many."""
    lengths = np.asarray(lengths, dtype=np.int64)
    if not len(lengths):
        return []
    if lengths.max() > BLOCK_IDS:
        raise ValueError("block length")
    block, starts, sizes, active = _streams(lengths)
    known, model, lanes = _Frequencies(block, len(active), int(lengths.sum())), _Model(block, len(codes)), len(block)
    in_order = np.lexsort([starts, block])
    count = np.bincount(block, minlength=len(codes))
    parts: list = [None] * lanes  # the words of each lane
    for c, own in zip(codes, np.split(in_order, np.cumsum(count)[:-1])):
        data = np.frombuffer(c, "<u4", len(c) // 4)
        ends = len(own) + np.cumsum(data[: len(own)].astype(np.int64))
        if len(ends) != len(own) or ends[-1] != len(data):
            raise ValueError("lengths of a block's streams")
        for lane, part in zip(own, np.split(data, [len(own), *ends[:-1]])[1:]):
            parts[lane] = part
    data = np.zeros((lanes, 2 + max(map(len, parts))), np.uint32)
    for row, part in zip(data, parts):
        row[: len(part)] = part
    data, at_word = np.ascontiguousarray(data.T).ravel(), np.arange(lanes)  # the first words of all lanes, the second ones, ...
    word = lambda at: data.take(at, mode="clip").astype(np.uint64)
    low, rng, code = np.zeros(lanes, np.uint64), np.full(lanes, _FULL), (word(at_word) << _32) | word(at_word + lanes)
    at_word += 2 * lanes
    sums, now = _sums(len(active)), -1
    for t, k in enumerate(active):
        if k != now:
            now = k
            model.keep(k)
            lane = np.arange(k)
            low_k, rng_k, code_k = low[:k], rng[:k], code[:k]
            bounds = np.zeros((5, k), np.uint64)
        if t in sums:
            known.sum_up(t, k)
        predicted, w = model.predict()
        r, off = rng_k >> _15, code_k - low_k
        upper = bounds[1:]
        np.right_shift(w, _SHIFTS[:, None], out=upper)
        upper &= _FIELD
        upper *= r
        over = off >= bounds[1:4]
        choice = over.view(np.int8).sum(0, dtype=np.int8).astype(np.intp)
        place = choice * k + lane
        start = bounds.take(place)
        place += k
        width = bounds.take(place) - start
        # the id itself, where it was not predicted
        raw, new = over[1:].astype(np.uint64)
        total, begin = known.total[:k] + known.to_new[:k] * new, known.begin[:k] * (np.uint64(1) - new)
        r = width // total
        off -= start
        total -= np.uint64(1)
        target = np.minimum(off // np.maximum(r, np.uint64(1)), total)
        target += begin
        here = known.runs.take(known.run.take(target.view(np.int64), mode="clip"))
        low_k += start
        low_k += r * ((here >> _32) - begin) * raw
        r *= here >> np.uint64(16) & _FIELD
        r -= width
        r *= raw
        np.add(width, r, out=rng_k)
        ids = predicted[0] + (predicted[1] - predicted[0]) * over[0]
        ids += ((here & _FIELD).astype(np.int32) - ids) * over[1]
        ids &= IDS - 1  # a damaged block may lead anywhere; its checksum tells
        todo = np.flatnonzero(rng_k < _TOP)
        tl, tr, at = low_k.take(todo), rng_k.take(todo), at_word.take(todo)
        tr = np.where((tl ^ (tl + tr)) < _TOP, tr, -tl & _LOW)
        low_k[todo] = tl << _32
        rng_k[todo] = tr << _32
        code_k[todo] = (code_k.take(todo) << _32) | word(at)
        at_word[todo] = at + lanes
        known.ids[t, :k] = ids
        model.update(ids, choice, predicted == ids)
    out = [np.zeros(n, np.int32) for n in lengths]
    for first in range(0, lanes, _SIDE):
        some = slice(first, first + _SIDE)
        rows = np.empty((len(block[some]), len(active) + _APART), np.uint32)[:, : len(active)]
        rows[:] = known.ids[:, some].T
        for row, b, start, n in zip(rows, block[some], starts[some], sizes[some]):
            out[b][start : start + n] = row[:n]
    return out


def write_blocks(ids: np.ndarray, pieces: list[np.ndarray], sizes: list[int]) -> list[bytes]:
    """Blocks of the given numbers of ids with their pieces: magic, counts, crc32 of pieces and ids, pieces, code."""
    ends = np.cumsum(sizes)
    parts = [ids[e - n : e] for e, n in zip(ends, sizes)]
    out = []
    for part, piece, code in zip(parts, pieces, encode_ids(parts)):
        table = piece.tobytes()
        crc = zlib.crc32(part.astype("<u4").tobytes(), zlib.crc32(table))
        out.append(_HEAD.pack(MAGIC, len(part), len(piece), crc, len(code)) + table + code)
    return out


def read_blocks(blocks: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pieces, ids) of each block; a damaged block raises ValueError."""
    tables, codes, lengths, crcs = [], [], [], []
    for b in blocks:
        if len(b) < _HEAD.size or b[:4] != MAGIC:
            raise ValueError("not a block")
        _, n, k, crc, size = _HEAD.unpack_from(b)
        at = _HEAD.size + k * PIECE.itemsize
        if len(b) != at + size:
            raise ValueError("block length")
        tables.append(b[_HEAD.size : at])
        codes.append(b[at:])
        lengths.append(n)
        crcs.append(crc)
    out = []
    for table, ids, crc in zip(tables, decode_ids(codes, lengths), crcs):
        if zlib.crc32(ids.astype("<u4").tobytes(), zlib.crc32(table)) != crc:
            raise ValueError("block checksum")
        out.append((np.frombuffer(table, PIECE), ids))
    return out


def _zero_bytes(count: int = 48) -> list[list[int]]:
    """For each k what 2^k zero bytes do to the bits of a crc32."""
    m = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        m = [_times(m, x) for x in m]
    out = [m]
    for _ in range(count - 1):
        m = [_times(m, x) for x in m]
        out.append(m)
    return out


def _times(matrix: list[int], v: int) -> int:
    total, i = 0, 0
    while v:
        if v & 1:
            total ^= matrix[i]
        v, i = v >> 1, i + 1
    return total


_ZEROS = _zero_bytes()


def crc32_join(a: int, b: int, length: int) -> int:
    """crc32 of two byte strings one after the other, from their crc32 and the second's length."""
    k = 0
    while length:
        if length & 1:
            a = _times(_ZEROS[k], a)
        length, k = length >> 1, k + 1
    return a ^ b
