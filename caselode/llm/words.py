"""Words and windows of many texts at once, as numpy arrays over the bytes of an Arrow column.

Texts are worked on in pieces of about 256 kB, whole documents each, so memory stays bounded
by the longest text. A word, line or window is known by a 64-bit hash. A word's hash mixes each of its blocks of
eight bytes with the block's place, so no arithmetic pattern in a text makes two words agree; unequal ones
do with a chance of about 2**-64 a pair, if the text was not made with this very function in hand.
"""

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
SPACES = (0x20, *range(0x09, 0x0E))

#: Fixed odd multipliers; the hash must agree between executors and runs.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
_powers = {}


def powers(base, n):
    """base**i and its inverse modulo 2**64 for i < n."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, PIECE + 1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        held = _powers[base] = tuple(both)
    return held[0][:n], held[1][:n]


def mixed(h):
    """Spread every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def space_words():
    """Byte table: words are runs without space, tab, line or form feeds and carriage returns."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def letter_words():
    """Byte table: words are runs of digits, lower-case letters and all non-ASCII characters."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def lower_case():
    """Byte table that maps A-Z to a-z and leaves the rest."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def text_bytes(column):
    """Bytes of all texts in a row and the n + 1 borders between them; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    borders = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[borders[0] : borders[-1]], borders - borders[0]


def pieces(column, size=PIECE):
    """(first row, row after the last, bytes, borders) of runs of whole texts of about `size` bytes."""
    data, borders = text_bytes(column)
    n, at = len(borders) - 1, 0
    while at < n:
        end = int(np.searchsorted(borders, borders[at] + size, "right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, data[borders[at] : borders[end]], borders[at : end + 1] - borders[at]
        at = end


#: The bytes of a block that belong to a span with so many bytes left.
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """Words of some texts: byte ranges, hashes, and for each text the index of its first word."""

    def __init__(self, data, borders, table, fold=None):
        self.data = data = fold[data] if fold is not None else data
        self.borders = borders
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = table[data]
        edge = np.zeros(n + 2, bool)
        edge[borders + 1] = True
        here, before = inside[1:], inside[:-1]
        self.start = np.flatnonzero(here & (~before | edge[1:]))
        self.end = np.flatnonzero(before & (~here | edge[1:]))
        # `first` has one entry more than there are texts
        self.first = np.searchsorted(self.start, borders)
        self.count = np.diff(self.first)

        self._loads = None

    def span_hashes(self, start, end):
        """A hash of the bytes of each span."""
        if self._loads is None:
            padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
            self._loads = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))  # eight bytes from every place on
        size = end - start
        total = self._blocks(start, size, 0)
        long = np.flatnonzero(size > 8)
        if len(long):
            more = (size[long] - 1) // 8
            first = np.cumsum(more) - more
            block = np.arange(int(more.sum())) - np.repeat(first, more) + 1
            at = np.repeat(start[long], more) + 8 * block
            total[long] += np.add.reduceat(self._blocks(at, np.repeat(end[long], more) - at, block), first)
        return mixed(total + size.astype(np.uint64) * np.uint64(WORD_BASE))

    def _blocks(self, at, left, number):
        """Mixed blocks of eight bytes at the most, by their numbers in their spans."""
        value = self._loads[at] & _KEPT[np.minimum(left, 8)]
        return mixed(mixed(value + np.uint64(BYTE_BASE)) + np.asarray(number, np.uint64) * np.uint64(BYTE_BASE))

    def hashes(self):
        return self.span_hashes(self.start, self.end)

    def lines(self):
        """Byte ranges of the \\n-split lines that have a word, and their texts' positions."""
        borders = self.borders
        breaks = np.flatnonzero(self.data == 10)
        start = np.unique(np.concatenate([borders[:-1], breaks + 1]))
        start = start[start < len(self.data)]
        start = start[self.data[start] != 10]
        stop = np.unique(np.concatenate([borders[1:], breaks]))
        end = stop[np.searchsorted(stop, start, "right")]
        has = np.searchsorted(self.start, end) > np.searchsorted(self.start, start)
        start, end = start[has], end[has]
        return start, end, np.searchsorted(borders, start, "right") - 1

    def text_of_word(self):
        return np.repeat(np.arange(len(self.count)), self.count)


def windows(hashes, first, width):
    """Window hashes, and the index of each window's first word; windows stay inside a text."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if width <= 6:
        p, _ = powers(WORD_BASE, width + 1)
        total = hashes[: n - width + 1] * p[0]
        for i in range(1, width):
            total = total + hashes[i : n - width + 1 + i] * p[i]
    else:
        p, inverse = powers(WORD_BASE, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * p[:n], out=sums[1:])
        total = (sums[width:] - sums[:-width]) * inverse[: n - width + 1]
    ends = np.repeat(first[1:], np.diff(first))[: n - width + 1]
    at = np.flatnonzero(np.arange(width, n + 1) <= ends)
    return mixed(total[at] + np.uint64(width)), at


def repeated(keys, texts):
    """Masks of the keys that occur twice or more in their text, and of those after the first."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    own = mixed(keys + (texts.astype(np.uint64) + np.uint64(1)) * np.uint64(WORD_BASE))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def covered(n, starts, width):
    """Mask of the n words that lie in some window of `width` words (one width, or one each)."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, starts + width, 1)
    return np.cumsum(steps[:-1]) > 0


def per_text(mask, first):
    """How many of the marked words each text has."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
