"""Adaptive context-mixing range coder for token ids, for many independent blocks in step.

A block is coded from an empty model, so any block can be read without the others. For every id the
contexts of order 2 (the two ids before) and order 1 (the id before) each name the id they expect
and how sure they are; order 0 holds the frequencies of the block's ids so far, and ids new to the
block are spelled out. How far each order is to be trusted, given how sure the two contexts are, is
learned while coding: one adaptive distribution over the four sources for each of 32 states. The
mixed prediction is one interval of a range coder with a 64-bit window and 32-bit digits.

All blocks take a step at a time together, as numpy arrays with one lane per block.
"""

import zlib

import numpy as np

MAX_ID = (1 << 16) - 1
SOURCE_BITS, INNER_BITS, ZERO_BITS = 12, 16, 15
TOTAL_BITS = SOURCE_BITS + INNER_BITS
#: Order 0 is counted again after so many ids of a block.
RECOUNT = (256, 1024, 4096)
HASH_BITS = 10
LANES = 1024
#: Steps whose model-independent values are laid out together.
STRETCH = 256

_ORDER2, _ORDER1, _ORDER0, _NEW = range(4)
_U = np.uint64
_DIGIT, _SHIFT, _INNER = _U(32), _U(TOTAL_BITS), _U(INNER_BITS)
_LOW_DIGIT = _U(0xFFFFFFFF)
_ALL_INNER = _U(1 << INNER_BITS)
_HASH_A, _HASH_B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_HASH_SHIFT = np.uint32(32 - HASH_BITS)

# The distribution over the four sources is three borders of 16 bits in one word, with the total in
# the fourth field. A border b moves to b - b / 32 + a, so it tends to 32 a; the a of a source keep
# the borders at least one apart, whatever the history.
_FIELD = [16 * j for j in range(4)]
_START = sum((j + 1) << (SOURCE_BITS - 2) << _FIELD[j] for j in range(4))
_DECAY = _U(sum(0x7F << _FIELD[j] for j in range(3)))
_TOWARDS = np.array(
    [sum((124 + j + 1 if j >= s else j + 1) << _FIELD[j] for j in range(3)) for s in range(4)], _U
)
_16, _FIELD_MASK = _U(16), _U(0xFFFF)
_LOWER_SHIFT = np.array(_FIELD, _U)


def _zero_frequencies(ids):
    """(distinct ids, borders) of every lane: order 0 after some ids (steps by lanes), in shares of
    2**ZERO_BITS. `borders` has one more entry than there are ids."""
    ordered = np.sort(np.ascontiguousarray(ids.T, np.uint16), axis=1)
    n = ordered.shape[1]
    last = np.ones(ordered.shape, bool)
    last[:, :-1] = ordered[:, 1:] != ordered[:, :-1]
    for lane in range(len(ordered)):
        at = np.flatnonzero(last[lane])
        count = np.diff(at, prepend=-1)
        share = count * ((1 << ZERO_BITS) - len(at)) // n + 1
        borders = np.zeros(len(at) + 1, np.int64)
        np.cumsum(share, out=borders[1:])
        # what rounding leaves goes to the last id
        borders[-1] = 1 << ZERO_BITS
        yield ordered[lane, at].astype(np.int64), borders


class _Model:
    """What the contexts of order 2 and 1 expect, and the trust in the sources; a lane per block.

    A context's entry is an id and, in the last two bits, how sure it is. `held` has the entries of
    order 2 in its first row and those of order 1 in its second.
    """

    def __init__(self, lanes):
        self.entries = np.zeros(2 * lanes << HASH_BITS, np.int32)
        self.trust = np.full(32 * lanes, _START, _U)
        lane = np.arange(lanes)
        self.base = np.stack([lane << HASH_BITS, (lanes + lane) << HASH_BITS])
        self.trust_base = lane << 5

    def narrow(self, n):
        self.base, self.trust_base = self.base[:, :n], self.trust_base[:n]

    def look(self, at):
        self.at = at
        self.held = held = self.entries.take(at)
        sure = held & 3
        state = (sure[0] << 3) + (sure[1] << 1) + ((held[0] ^ held[1]) < 4)
        self.at_trust = self.trust_base + state
        self.sure, self.borders = sure, self.trust.take(self.at_trust)
        return self.borders

    def learn(self, entry, right, source):
        """`entry` is the id's entry with no sureness; `right` tells which contexts expected it."""
        b = self.borders
        self.trust[self.at_trust] = b - ((b >> _U(5)) & _DECAY) + _TOWARDS.take(source)
        held = self.held
        wrong = np.where(self.sure > 0, held - 1, entry)
        self.entries[self.at] = np.where(right, np.minimum(held + 1, entry + 3), wrong)


def _stretches(length):
    """(from, to) of runs of steps; order 0 is counted again at the start of some."""
    edges = sorted({0, length, *[t for t in RECOUNT if t < length], *range(0, length, STRETCH)})
    return list(zip(edges[:-1], edges[1:]))


def _contexts(before, last, base):
    """Where the entries of contexts lie, order 2 first."""
    a = last.astype(np.uint32) * _HASH_A
    two = (before.astype(np.uint32) * _HASH_B + (a ^ (a >> np.uint32(15)))) * _HASH_A
    return base + np.stack([two >> _HASH_SHIFT, a >> _HASH_SHIFT], axis=-2)


def encode(blocks) -> list[bytes]:
    """Every block of ids (arrays, up to MAX_ID) as bytes of its own."""
    out = []
    for i in range(0, len(blocks), LANES):
        out += _encode(blocks[i : i + LANES])
    return out


def _laid_out(sizes):
    """Order of the blocks by falling size, and how many are at work in each step."""
    sizes = np.asarray(sizes)
    order = np.argsort(-sizes, kind="stable")  # lanes that end early are the last ones
    return order, np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")


def _next_count(begin, length):
    return min([t for t in RECOUNT if begin < t < length] + [length])


def _zero_values(ids, begin, stop, lanes):
    """Order 0 of the ids before `begin`: for the ids of the steps from there on, where each starts
    among 2**ZERO_BITS and its share of them; 0 for ids that are new to the block."""
    start, share = np.zeros((stop - begin, lanes), np.uint16), np.zeros((stop - begin, lanes), np.uint16)
    start_of, share_of = np.zeros(MAX_ID + 1, np.uint16), np.zeros(MAX_ID + 1, np.uint16)
    for lane, (found, borders) in enumerate(_zero_frequencies(ids[:begin, :lanes])):
        start_of[found], share_of[found] = borders[:-1], np.diff(borders)
        own = ids[begin:stop, lane]
        start[:, lane], share[:, lane] = start_of[own], share_of[own]
        share_of[found] = 0
    return start, share


def _encode(blocks):
    order, alive = _laid_out([len(b) for b in blocks])
    lanes, length = len(blocks), len(alive)
    ids = np.zeros((length + 2, lanes), np.int32)  # two ids of 0 before the start
    for lane, b in enumerate(order):
        own = np.asarray(blocks[b])
        if len(own) and (own.max() > MAX_ID or own.min() < 0):
            raise ValueError(f"ids are 0 to {MAX_ID}")
        ids[2 : 2 + len(own), lane] = own
    model = _Model(lanes)
    all_low, all_span = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    # a digit holds 32 bits, an id takes 28 at most; few take more than 16: more room is made when needed
    width = length // 2 + STRETCH + 3
    digits, all_filled = np.zeros(lanes * width, _U), np.arange(lanes) * width
    low, span, filled = all_low, all_span, all_filled
    counted = 0
    for begin, stop in _stretches(length):
        n = int(alive[begin])
        if (all_filled - np.arange(lanes) * width).max(initial=0) + stop - begin + 3 > width:
            digits = np.pad(digits.reshape(lanes, width), ((0, 0), (0, width))).ravel()
            all_filled += np.arange(lanes) * width
            width *= 2
        x = ids[begin + 2 : stop + 2, :n]
        fallback, start_in, share_in = np.full(x.shape, _NEW), x, np.ones(x.shape, np.int32)
        if begin in RECOUNT:
            counted, until = begin, _next_count(begin, length)
            start0, share0 = _zero_values(ids[2:], begin, until, n)
        if counted:
            start, share = start0[begin - counted : stop - counted, :n], share0[begin - counted : stop - counted, :n]
            seen = share > 0
            fallback[seen] = _ORDER0
            start_in = np.where(seen, start.astype(np.int32) << 1, x)
            share_in = np.where(seen, share.astype(np.int32) << 1, 1)
        start_in, share_in, entries = start_in.astype(_U), share_in.astype(_U), x << 2
        at = _contexts(ids[begin:stop, :n], ids[begin + 1 : stop + 1, :n], model.base[:, :n])
        for t in range(stop - begin):
            if int(alive[begin + t]) != len(low):
                n = int(alive[begin + t])
                model.narrow(n)
                low, span, filled = low[:n], span[:n], filled[:n]
            n = len(low)
            borders = model.look(at[t, :, :n])
            entry = entries[t, :n]
            right = (model.held ^ entry) < 4
            source = fallback[t, :n]
            np.putmask(source, right[1], _ORDER1)
            np.putmask(source, right[0], _ORDER2)
            shift = _LOWER_SHIFT.take(source)
            outer = ((borders << _16) >> shift) & _FIELD_MASK
            wide = ((borders >> shift) & _FIELD_MASK) - outer
            model.learn(entry, right, source)
            expected = source < _ORDER0
            r = span >> _SHIFT
            step = r * ((outer << _INNER) + wide * np.where(expected, _U(0), start_in[t, :n]))
            low += step
            carry = low < step
            if carry.any():
                digits[filled[carry] - 1] += _U(1)
            np.multiply(r, wide * np.where(expected, _ALL_INNER, share_in[t, :n]), out=span)
            e = np.flatnonzero(span <= _LOW_DIGIT)
            if len(e):
                part = low[e]
                digits[filled[e]] = part >> _DIGIT
                filled[e] += 1
                low[e] = part << _DIGIT
                span[e] <<= _DIGIT
    for part in (all_low >> _DIGIT, all_low & _LOW_DIGIT):
        digits[all_filled] = part
        all_filled += 1
    digits = digits.reshape(lanes, width)
    while (over := digits[:, 1:] >> _DIGIT).any():  # a carry into a full digit goes on to the next
        digits[:, 1:] &= _LOW_DIGIT
        digits[:, :-1] += over
    out = [b""] * lanes
    for lane, b in enumerate(order):
        out[b] = digits[lane, : all_filled[lane] - lane * width].astype("<u4").tobytes()
    return out


def decode(parts, sizes) -> list[np.ndarray]:
    """The ids of every block, from its bytes and its number of ids."""
    out = []
    for i in range(0, len(parts), LANES):
        out += _decode(parts[i : i + LANES], sizes[i : i + LANES])
    return out


def _decode(parts, sizes):
    order, alive = _laid_out(sizes)
    lanes, length = len(parts), len(alive)
    width = max([len(p) // 4 for p in parts], default=0) + 3
    digits = np.zeros((lanes, width), _U)
    for lane, b in enumerate(order):
        digits[lane, : len(parts[b]) // 4] = np.frombuffer(parts[b], "<u4")
    value, span = (digits[:, 0] << _DIGIT) | digits[:, 1], np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    read, digits = np.arange(lanes) * width + 2, digits.ravel()
    ids = np.zeros((length + 2, lanes), np.int32)
    model = _Model(lanes)
    most = _U((1 << TOTAL_BITS) - 1)
    counted, slots, known, edges = 0, None, None, None
    for begin, stop in _stretches(length):
        if begin in RECOUNT:
            n, counted = int(alive[begin]), begin
            slots = np.zeros((n, 1 << ZERO_BITS), np.uint16)
            known, edges = np.zeros((n, begin), np.int32), np.zeros((n, begin + 1), np.int64)
            for lane, (found, borders) in enumerate(_zero_frequencies(ids[2 : 2 + begin, :n])):
                known[lane, : len(found)], edges[lane, : len(borders)] = found, borders << 1
                slots[lane] = np.repeat(np.arange(len(found), dtype=np.uint16), np.diff(borders))
            slots, known, edges = slots.ravel(), known.ravel(), edges.ravel()
        for t in range(begin, stop):
            if int(alive[t]) != len(span):
                n = int(alive[t])
                model.narrow(n)
                value, span, read = value[:n], span[:n], read[:n]
            n = len(span)
            borders = model.look(_contexts(ids[t, :n], ids[t + 1, :n], model.base))
            r = span >> _SHIFT
            place = np.minimum(value // r, most)
            outside = place >> _INNER
            source = (outside >= (borders & _FIELD_MASK)).astype(np.int64)
            source += outside >= ((borders >> _16) & _FIELD_MASK)
            source += outside >= ((borders >> _U(32)) & _FIELD_MASK)
            shift = _LOWER_SHIFT.take(source)
            outer = ((borders << _16) >> shift) & _FIELD_MASK
            wide = ((borders >> shift) & _FIELD_MASK) - outer
            inside = ((place - (outer << _INNER)) // wide).astype(np.int64)
            entry = np.where(source == _ORDER1, model.held[1], model.held[0]) & -4
            begin_in, size_in = np.zeros(n, np.int64), np.full(n, 1 << INNER_BITS)
            other = np.flatnonzero(source >= _ORDER0)
            if len(other):
                new = source[other] == _NEW
                inner = inside[other]
                if counted:
                    slot = slots.take((other << ZERO_BITS) + (inner >> 1)).astype(np.int64)
                    x = np.where(new, inner, known.take(other * counted + slot))
                    edge = other * (counted + 1) + slot
                    first = edges.take(edge)
                    begin_in[other] = np.where(new, inner, first)
                    size_in[other] = np.where(new, 1, edges.take(edge + 1) - first)
                else:
                    x = inner
                    begin_in[other], size_in[other] = inner, 1
                entry[other] = x << 2
            ids[t + 2, :n] = entry >> 2
            model.learn(entry, (model.held ^ entry) < 4, source)
            value -= r * ((outer << _INNER) + wide * begin_in.astype(_U))
            np.multiply(r, wide * size_in.astype(_U), out=span)
            e = np.flatnonzero(span <= _LOW_DIGIT)
            if len(e):
                value[e] = (value[e] << _DIGIT) | digits[read[e]]
                span[e] <<= _DIGIT
                read[e] += 1
    out = [None] * lanes
    for lane, b in enumerate(order):
        out[b] = ids[2 : 2 + sizes[b], lane].copy()
    return out


def checksum(ids) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
