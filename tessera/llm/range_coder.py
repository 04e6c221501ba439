"""An adaptive context-mixing range coder for token ids, run on many blocks side by side.

Each block is coded from a fresh model, so blocks are independent; numpy advances all blocks of a
batch by one id at a time. Orders 2 and 1 each predict an id (the one last seen after the two, or
one, ids before, with a confidence). A mixer of adaptive chances, chosen by both confidences and by
whether both agree, says how likely either is right. What they miss is coded by order 0: the low
byte by counts of those missed so far, which come into force at fixed ids of the block; then, by
adaptive chances of that low byte, whether the high byte is one of the two last seen with it; else
the high byte.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 2048
MAGIC = b"TSB2"
_ONE, _TWO = 1 << 10, 1 << 11
_MIXES = 128
#: Ids of a block before which the counts of low bytes come into force, and the bits of their total.
_RENEWED = frozenset((0, 32, 64, 128, 256, 512, 1024, 1536))
_TOTAL = 12
_COUNT = 24
_U = np.uint64
#: Adaptive chances are shares of 2**16 that stay between 1/64 and 63/64, so that an id takes at most 44
#: bits of a span that has 48 at least.
_LEAST, _MOST, _16, _8, _RATE, _FAST, _48 = _U(1024), _U(64512), _U(16), _U(8), _U(5), _U(4), _U(48)
_SHORT = _U(1 << 48)
_SURER = np.array([1] * 7 + [0], np.int64)
_DOUBT = np.array([(c >> 1) - c for c in range(8)], np.int64)


class _Model:
    """Counts, chances and predictions of a batch of blocks."""

    def __init__(self, lanes: int, decodes: bool):
        lane = np.arange(lanes)
        self.guess = [np.zeros(lanes * n, np.int32) for n in (_ONE, _TWO)]  # (id + 1) * 8 + confidence; 0 is none
        self.base = (lane * _ONE, lane * _TWO)
        start = np.where(np.arange(_MIXES) % 64 > 0, 32768, 8192).astype(np.uint64)
        self.second, self.first = np.tile(start, lanes), np.tile(start, lanes)
        self.newest, self.older = np.full(lanes * 256, 32768, np.uint64), np.full(lanes * 256, 32768, np.uint64)
        self.mix0, self.low0, self.bound0 = lane * _MIXES, lane * 256, lane * 257
        self.counts = np.full((lanes, 256), 2, np.int64)
        self.high = [np.full(lanes * 256, -1, np.int32) for _ in range(2)]
        self.last = [np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)]
        self.decodes, self.lanes = decodes, lanes

    def renew(self) -> None:
        """Puts the counts of low bytes into force: bounds of their shares, each at least 1."""
        sums = np.cumsum(self.counts, 1)
        self.bounds = np.zeros((self.lanes, 257), np.uint64)
        self.bounds[:, 1:] = sums * ((1 << _TOTAL) - 256) // sums[:, -1:] + np.arange(1, 257)
        if self.decodes:  # the low byte at each place of the total
            marks = np.zeros((self.lanes, 1 << _TOTAL), np.uint8)
            np.put_along_axis(marks, self.bounds[:, 1:256].astype(np.int64), 1, 1)
            self.at = np.cumsum(marks, 1, dtype=np.uint8).reshape(-1)
            self.at0 = np.arange(self.lanes) << _TOTAL
        self.bounds = self.bounds.reshape(-1)

    def predict(self, k: int):
        """For the first k blocks: places and values of both predictions, places and values of the
        chances that the second order's, or else the first order's, is right."""
        one, two = self.last[0][:k], self.last[1][:k]
        at1 = self.base[0][:k] + (one * 40503 >> 6) % _ONE
        at2 = self.base[1][:k] + (one * 40503 + two * 30011 >> 5) % _TWO
        g1, g2 = self.guess[0].take(at1).astype(np.int64), self.guess[1].take(at2).astype(np.int64)
        mix = self.mix0[:k] + ((g2 & 7) << 3) + (g1 & 7) + ((g1 ^ g2) < 8) * 64
        return at1, at2, g1, g2, mix, self.second.take(mix), self.first.take(mix)

    def learn(self, k: int, ids, at1, at2, g1, g2, mix, p2, p1, is2, is1) -> None:
        self.second[mix] = np.where(is2, p2 + ((_MOST - p2) >> _RATE), p2 - ((p2 - _LEAST) >> _RATE))
        self.first[mix] = np.where(is2, p1, np.where(is1, p1 + ((_MOST - p1) >> _RATE), p1 - ((p1 - _LEAST) >> _RATE)))
        fresh = (ids + 1) << 3
        for table, at, g in ((self.guess[0], at1, g1), (self.guess[1], at2, g2)):
            sure = g & 7
            table[at] = np.where(g >> 3 == ids + 1, g + _SURER.take(sure), np.where(sure > 0, g + _DOUBT.take(sure), fresh))
        self.last[1][:k] = self.last[0][:k]
        self.last[0][:k] = ids

    def tops(self, k: int, low):
        """Place of the low bytes, the two high bytes last seen with each, and the chances of either."""
        at = self.low0[:k] + low
        return at, self.high[0].take(at), self.high[1].take(at), self.newest.take(at), self.older.take(at)

    def learn_missed(self, missed, at, high, top1, top2, is1, is2, p1, p2) -> None:
        self.newest[at] = np.where(missed, np.where(is1, p1 + ((_MOST - p1) >> _FAST), p1 - ((p1 - _LEAST) >> _FAST)), p1)
        self.older[at] = np.where(missed & ~is1, np.where(is2, p2 + ((_MOST - p2) >> _FAST), p2 - ((p2 - _LEAST) >> _FAST)), p2)
        moved = missed & ~is1
        self.high[1][at] = np.where(moved, top1, top2)
        self.high[0][at] = np.where(moved, high, top1)
        self.counts.reshape(-1)[at] += missed * _COUNT


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks by falling length, their lengths, and how many are longer than each id's place."""
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    return order, lengths, np.searchsorted(-lengths, -np.arange(steps), "left")


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Self-contained coded blocks: magic, number of ids, CRC-32 of the ids as little-endian unsigned
    32-bit integers, and the coded 16-bit words. At most BLOCK ids below 65,535 a block."""
    out = []
    for start in range(0, len(blocks), LANES):
        out += _encode(blocks[start : start + LANES])
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    order, lengths, alive = _by_length(np.array([len(b) for b in blocks], np.int64))
    lanes, steps = len(blocks), len(alive)
    ids_at = np.zeros((steps, lanes), np.int32)
    for lane, b in enumerate(order):
        ids_at[: lengths[lane], lane] = blocks[b]
    model, width = _Model(lanes, False), 3 * steps + 8
    words = np.zeros(lanes * width, np.uint16)
    low, span, pos = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64), np.arange(lanes) * width
    for t in range(steps):
        k = int(alive[t])
        if t in _RENEWED:
            model.renew()
        ids = ids_at[t, :k].astype(np.int64)
        at1, at2, g1, g2, mix, p2, p1 = model.predict(k)
        is2, is1 = g2 >> 3 == ids + 1, g1 >> 3 == ids + 1
        missed = ~(is2 | is1)
        whole = span[:k]
        w2 = (whole >> _16) * p2
        left = whole - w2
        w1 = (left >> _16) * p1
        # What both miss: low byte, then high byte.
        byte, rank = ids & 255, ids >> 8
        at = model.bound0[:k] + byte
        below = model.bounds.take(at)
        unit = (left - w1) >> _U(_TOTAL)
        here = unit * (model.bounds.take(at + 1) - below)
        place, top1, top2, c1, c2 = model.tops(k, byte)
        is_top1, is_top2 = top1 == rank, top2 == rank
        u1 = (here >> _16) * c1
        after = here - u1
        u2 = (after >> _16) * c2
        each = (after - u2) >> _8
        off = np.where(is2, _U(0), np.where(is1, w2, w2 + w1 + unit * below + np.where(is_top1, _U(0), np.where(is_top2, u1, u1 + u2 + each * rank.view(np.uint64)))))
        now = np.where(is2, w2, np.where(is1, w1, np.where(is_top1, u1, np.where(is_top2, u2, each))))
        model.learn_missed(missed, place, rank, top1, top2, is_top1, is_top2, c1, c2)
        moved = low[:k] + off
        over = np.flatnonzero(moved < off)
        if len(over):  # a carry
            at = pos[over] - 1
            words[at] += np.uint16(1)
            while len(at := at[words[at] == 0]):
                at = at - 1
                words[at] += np.uint16(1)
        low[:k], span[:k] = moved, now
        short = np.flatnonzero(now < _SHORT)
        while len(short):
            held = low[short]
            words[pos[short]] = (held >> _48).astype(np.uint16)
            pos[short] += 1
            low[short] = held << _16
            wider = span[short] << _16
            span[short] = wider
            short = short[wider < _SHORT]
        model.learn(k, ids, at1, at2, g1, g2, mix, p2, p1, is2, is1 & ~is2)
    for shift in (48, 32, 16, 0):
        words[pos] = ((low >> _U(shift)) & _U(65535)).astype(np.uint16)
        pos += 1
    out = [b""] * lanes
    for lane, b in enumerate(order):
        ids = np.asarray(blocks[b], dtype="<u4")
        head = np.array([len(ids), zlib.crc32(ids.tobytes())], "<u4").tobytes()
        out[b] = MAGIC + head + words[lane * width : pos[lane]].astype("<u2").tobytes()
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of coded blocks; raises ValueError if a block is damaged."""
    out = []
    for start in range(0, len(coded), LANES):
        out += _decode(coded[start : start + LANES])
    return out


def _decode(coded: list[bytes]) -> list[np.ndarray]:
    for block in coded:
        if block[:4] != MAGIC or len(block) < 20 or len(block) % 2:
            raise ValueError("not a coded block")
    heads = np.array([np.frombuffer(b, "<u4", 2, 4) for b in coded], np.int64).reshape(-1, 2)
    if len(heads) and heads[:, 0].max() > BLOCK:
        raise ValueError("a block's number of ids is damaged")
    order, lengths, alive = _by_length(heads[:, 0])
    lanes, steps = len(coded), len(alive)
    width = 3 * steps + 16
    words = np.zeros((lanes, width), np.uint16)
    for lane, b in enumerate(order):
        found = np.frombuffer(coded[b], "<u2", offset=12)[:width]
        words[lane, : len(found)] = found
    first = words[:, :4].astype(np.uint64)
    words = words.reshape(-1)
    rest = (first[:, 0] << _48) | (first[:, 1] << _U(32)) | (first[:, 2] << _16) | first[:, 3]
    span, pos, last = np.full(lanes, 2**64 - 1, np.uint64), np.arange(lanes) * width + 4, np.arange(1, lanes + 1) * width - 1
    model, ids_at = _Model(lanes, True), np.zeros((steps, lanes), np.int32)
    for t in range(steps):
        k = int(alive[t])
        if t in _RENEWED:
            model.renew()
        at1, at2, g1, g2, mix, p2, p1 = model.predict(k)
        whole, value = span[:k], rest[:k]
        w2 = (whole >> _16) * p2
        left, after2 = whole - w2, value - w2
        w1 = (left >> _16) * p1
        is2 = value < w2
        is1 = ~is2 & (after2 < w1)
        missed = ~(is2 | is1)
        # Of blocks that don't miss these are numbers without a meaning, inside the tables.
        unit = (left - w1) >> _U(_TOTAL)
        value0 = after2 - w1
        byte = model.at.take(model.at0[:k] + np.minimum(value0 // unit, _U((1 << _TOTAL) - 1)).view(np.int64)).astype(np.int64)
        at = model.bound0[:k] + byte
        below = model.bounds.take(at)
        value0 = value0 - unit * below
        here = unit * (model.bounds.take(at + 1) - below)
        place, top1, top2, c1, c2 = model.tops(k, byte)
        u1 = (here >> _16) * c1
        after, value1 = here - u1, value0 - u1
        u2 = (after >> _16) * c2
        each, value2 = (after - u2) >> _8, value1 - u2
        is_top1 = value0 < u1
        is_top2 = ~is_top1 & (value1 < u2)
        other = np.minimum(value2 // np.maximum(each, _U(1)), _U(255))
        rank = np.where(is_top1, top1, np.where(is_top2, top2, other.view(np.int64)))
        ids = np.where(is2, g2 >> 3, np.where(is1, g1 >> 3, (rank << 8 | byte) + 1)) - 1
        ids = np.clip(ids, 0, 65534)  # only a damaged block leaves the range
        rest[:k] = np.where(is2, value, np.where(is1, after2, np.where(is_top1, value0, np.where(is_top2, value1, value2 - each * other))))
        now = np.where(is2, w2, np.where(is1, w1, np.where(is_top1, u1, np.where(is_top2, u2, each))))
        model.learn_missed(missed, place, rank, top1, top2, is_top1, is_top2, c1, c2)
        span[:k] = now
        short = np.flatnonzero(now < _SHORT)
        while len(short):
            place = pos[short]
            rest[short] = (rest[short] << _16) | words.take(np.minimum(place, last[short])).astype(np.uint64)
            pos[short] = place + 1
            wider = np.maximum(span[short], _U(1)) << _16
            span[short] = wider
            short = short[wider < _SHORT]
        model.learn(k, ids, at1, at2, g1, g2, mix, p2, p1, is2, is1)
        ids_at[t, :k] = ids
    out: list = [None] * lanes
    for lane, b in enumerate(order):
        ids = ids_at[: lengths[lane], lane].astype("<u4")
        if zlib.crc32(ids.tobytes()) != heads[b, 1]:
            raise ValueError("a block's checksum doesn't match")
        out[b] = ids
    return out
