"""Column-wise construction of a collection's Burrows-Wheeler order with common prefixes.

All texts of the collection grow by one symbol at the front in each round. Kept
between rounds are, for all suffixes so far in sorted order, the first symbol
with the place of the suffix without it (which is what the transform stores,
seen from the other end), and the length of the prefix shared with the suffix
before. A round sorts the new suffixes by (symbol, place of the old one), merges
them in one sequential pass, and takes common prefixes of the new neighbours
from range minima of the old ones.

Texts are strings of units, bytes or words. A symbol is a block of several units,
and every text enters once per shift of the blocks, so there is a suffix for every
unit and as many rounds fewer as a block has units. Symbols are numbered by a 64-bit
code; strings compare equal for all their codes in a row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import xxhash

LENGTH = 400
SYMBOL = 40
BLOCK = 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


_BYTE_CODES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_ODD), n, 1 << 64))


def block_codes(data: np.ndarray, width: int) -> np.ndarray:
    """Code of the ``width`` bytes from each place on (width: 40 or 48), for
    places where they are whole."""
    codes, n = _BYTE_CODES[data], 1
    while n < 8:
        codes = codes[:-n] * _power(n) + codes[n:]
        n *= 2
    eight = mixed(codes)
    sixteen = eight[:-8] * _power(8) + eight[8:]
    wide = mixed(sixteen[:-16] * _power(16) + sixteen[16:])
    rest = {40: eight, 48: sixteen}[width][32:]
    return mixed(wide[: len(rest)] * _power(32) + rest)


def window_codes(units: np.ndarray, width: int) -> np.ndarray:
    """Code of the ``width`` units from each place on, for places where they are
    whole, from a 64-bit code of each unit."""
    if len(units) < width:
        return np.zeros(0, np.uint64)
    out, offset, level, n = None, 0, units, 1
    while True:
        if width & n:
            piece = level[offset:]
            out = piece if out is None else mixed(out[: len(piece)] * _power(n) + piece)
            offset += n
        if 2 * n > width:
            return out
        level = mixed(level[:-n] * _power(n) + level[n:])
        n *= 2


#: Bytes of text that are split into words at once.
_WORDS_AT_ONCE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _byte_units(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def _word_units(data: bytes) -> np.ndarray:
    """A 64-bit code per word; words are what stands between ASCII white space."""
    parts, lo = [np.zeros(0, "<u8")], 0
    while lo < len(data):
        blank = _BLANK.search(data, lo + _WORDS_AT_ONCE) if len(data) - lo > _WORDS_AT_ONCE else None
        hi = blank.start() if blank else len(data)
        words = data[lo:hi].split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), "<u8", len(words)))
        lo = hi
    return np.concatenate(parts)


def _byte_cuts(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return spans


def _word_cuts(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges of spans of words: each from its first word to the next word behind it."""
    wanted = sorted({i for span in spans for i in span})
    at, words, place = {}, iter(wanted), None
    place = next(words, None)
    for i, word in enumerate(_WORD.finditer(data)):
        if i == place:
            at[i] = word.start()
            place = next(words, None)
            if place is None:
                break
    return [(at[a], at.get(b, len(data))) for a, b in spans]


@dataclass(frozen=True)
class Strings:
    """What texts are strings of, and how long a repeated string is, in units.

    ``symbol`` units are one symbol of the construction (``length`` is a multiple),
    ``gram`` units have a code that competes for a string's place (see repeats).
    """

    name: str
    length: int
    symbol: int
    gram: int
    item: int  # bytes of a unit in a body
    least_bytes: int  # of a text that can hold a string
    units: Callable[[bytes], np.ndarray]
    codes: Callable[[np.ndarray, int], np.ndarray]
    cuts: Callable[[bytes, list[tuple[int, int]]], list[tuple[int, int]]]

    @property
    def symbols(self) -> int:
        return self.length // self.symbol

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1

    def read(self, body: bytes) -> np.ndarray:
        return np.frombuffer(body, np.uint8 if self.item == 1 else "<u8")

    def bound(self, step: Callable) -> Callable:
        """A step over batches with this kind of strings."""
        return step if self is BYTES else lambda batches: step(batches, self)


BYTES = Strings("bytes", LENGTH, SYMBOL, 48, 1, LENGTH, _byte_units, block_codes, _byte_cuts)


def word_strings(more_than: int) -> Strings:
    """Runs of more than so many words."""
    length = more_than + 1
    symbol = max(n for n in range(1, max(2, length // 3 + 1)) if length % n == 0)
    return Strings("words", length, symbol, max(1, length // 4), 8, 2 * length - 1, _word_units, window_codes, _word_cuts)


class _RangeMinimum:
    """Minima of ranges (a, b] of an array of small numbers."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK)
        padded = np.full(n * BLOCK, 255, np.uint8)
        padded[: len(values)] = values
        self.values = padded
        rows = padded.reshape(n, BLOCK)
        self.up_to = np.minimum.accumulate(rows, axis=1).ravel()
        self.from_on = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [rows.min(axis=1)]
        while 2 ** len(self.levels) <= n:
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def over(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(values[a + 1 .. b]) for a < b."""
        lo = a + 1
        first, last = lo // BLOCK, b // BLOCK
        out = np.minimum(self.from_on[lo], self.up_to[b])
        inside = np.nonzero(last - first > 1)[0]
        if len(inside):
            x, y = first[inside] + 1, last[inside]
            level = np.frexp((y - x).astype(np.float64))[1] - 1
            for k in np.unique(level):
                own = level == k
                table = self.levels[k]
                i = inside[own]
                out[i] = np.minimum(out[i], np.minimum(table[x[own]], table[y[own] - 2**k]))
        same = np.nonzero(first == last)[0]
        if len(same):
            at, end = lo[same].copy(), b[same]
            least = self.values[at]
            for _ in range(BLOCK - 1):
                at = np.minimum(at + 1, end)
                least = np.minimum(least, self.values[at])
            out[same] = least
        return out


def repeated_starts(texts: list[bytes], strings: Strings = BYTES) -> list[np.ndarray]:
    """For each text (its units as bytes) a boolean per start of a string of
    ``strings.length`` units: whether it also starts anywhere else in the collection.

    Shorter texts have no starts. The work is units times rounds, the rounds are
    the longest text by the units of a symbol.
    """
    length, width = strings.length, strings.symbol
    lengths = np.array([len(t) // strings.item for t in texts], np.int64)
    if not (lengths >= length).any():
        return [np.zeros(max(0, n - length + 1), bool) for n in lengths]
    data = strings.read(b"".join(texts))
    base = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    codes = np.unique(strings.codes(data, width), return_inverse=True)[1].astype(np.int64)

    # one member of the collection per text and shift, longest first
    text = np.repeat(np.arange(len(texts)), width)
    shift = np.tile(np.arange(width), len(texts))
    n_symbols = np.maximum(lengths[text] - shift, 0) // width
    by_length = np.argsort(-n_symbols, kind="stable")
    text, shift, n_symbols = text[by_length], shift[by_length], n_symbols[by_length]
    n_members = int(np.count_nonzero(n_symbols))
    first_byte = (base[text] + shift)[:n_members]
    n_symbols = n_symbols[:n_members]

    # the empty suffixes stand first, in the order of the members
    keys = np.arange(n_members, dtype=np.int64) - (1 << 32)
    shared = np.zeros(n_members, np.uint8)
    place = np.arange(n_members, dtype=np.int64)
    for taken in range(1, int(n_symbols[0]) + 1):
        active = int(np.searchsorted(-n_symbols, -taken, side="right"))
        symbol = codes[first_byte[:active] + width * (n_symbols[:active] - taken)]
        new = symbol << 32 | place[:active]
        order = np.argsort(new)
        new = new[order]
        at = np.searchsorted(keys, new) + np.arange(active)
        is_old = np.ones(len(keys) + active, bool)
        is_old[at] = False
        moved_to = np.flatnonzero(is_old)
        merged = np.empty(len(is_old), np.int64)
        merged[is_old] = keys
        merged[at] = new
        prefix = np.zeros(len(is_old), np.uint8)
        prefix[is_old] = shared
        # new suffixes and the ones right behind them have another neighbour before them
        is_new = ~is_old
        is_new[1:] |= ~is_old[:-1]
        changed = np.flatnonzero(is_new)
        here, before = merged[changed], merged[changed - 1]
        alike = (here >> 32) == (before >> 32)
        prefix[changed] = 0
        if alike.any():
            tail_here, tail_before = here[alike] & 0xFFFFFFFF, before[alike] & 0xFFFFFFFF
            least = _RangeMinimum(shared).over(tail_before, tail_here)
            prefix[changed[alike]] = np.minimum(least, 253) + 1
        # the tails have moved, too
        tails = merged & 0xFFFFFFFF
        tails[:n_members] = np.arange(n_members)
        keys = (merged >> 32 << 32) + moved_to[tails]
        keys[:n_members] = np.arange(n_members) - (1 << 32)
        place[:active][order] = at
        shared = prefix
        # members that are whole keep their place as others move in
        place[active:] = moved_to[place[active:]]

    is_repeated = shared >= strings.symbols
    is_repeated[:-1] |= is_repeated[1:]
    out = np.zeros(len(data), bool)
    # from each member's whole text down to its last symbols
    active = np.arange(n_members)
    at = place
    for done in range(int(n_symbols[0]) - strings.symbols + 1):
        alive = n_symbols[active] - done >= strings.symbols
        active, at = active[alive], at[alive]
        if not len(active):
            break
        out[first_byte[active] + width * done] = is_repeated[at]
        at = keys[at] & 0xFFFFFFFF
    return [out[b : b + max(0, n - length + 1)] for b, n in zip(base, lengths)]
