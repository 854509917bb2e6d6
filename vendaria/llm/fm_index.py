"""An index of word sequences that finds phrases backwards, over the Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np

#: Every so many places of the text have their suffix noted.
SAMPLE = 8


class Bits:
    """A row of bits that counts the ones before a place: one total for each 64 bits, and a population count."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.longs = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.longs.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.longs), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """The ones before each place."""
        long, rest = at >> 6, (at & 63).astype(np.uint64)
        below = self.longs[long] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[long] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.longs[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Wavelets:
    """A sequence of symbols as one row of bits per digit, each row stably parted by the digit before."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.rows = []
        for digit in reversed(range(max(1, int(n_symbols - 1).bit_length()))):
            bit = (symbols >> digit) & 1 == 1
            self.rows.append((digit, Bits(bit)))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each place."""
        start = np.zeros_like(at)
        for digit, row in self.rows:
            one = (symbol >> digit) & 1 == 1
            ones_start, ones_at = row.ones(start), row.ones(at)
            start = np.where(one, row.zeros + ones_start, start - ones_start)
            at = np.where(one, row.zeros + ones_at, at - ones_at)
        return at - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it comes before."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for digit, row in self.rows:
            one = row.get(at)
            symbol |= one.astype(symbol.dtype) << digit
            ones_start, ones_at = row.ones(start), row.ones(at)
            start = np.where(one, row.zeros + ones_start, start - ones_start)
            at = np.where(one, row.zeros + ones_at, at - ones_at)
        return symbol, at - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of a text in the order of what follows them, by doubling the length that is compared.

    The last symbol of the text must come only once, so that no two suffixes are equal. Only places that are still
    level with others are sorted again.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    slots, key = np.arange(n), text[order]
    rank = np.empty(n, np.int64)
    width = 1
    out = order.copy()
    while len(slots):
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
        level = ~(first & np.concatenate([first[1:], [True]]))
        slots, order = slots[level], order[level]
        key = rank[order] * n + rank[np.minimum(order + width, n - 1)]
        by_key = np.argsort(key, kind="stable")
        key, order = key[by_key], order[by_key]
        out[slots] = order
        width *= 2
    return out


class FmIndex:
    """Phrases are looked up in stretches of symbols (1 to `n_symbols` - 1); none reaches over a stretch's end."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        """`symbols` holds the stretches one after another. Symbol 0 ends each, in the index a different one each time."""
        n = len(symbols) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        is_end = np.zeros(n, bool)
        is_end[ends] = True
        text = np.zeros(n, np.int64)
        text[~is_end] = symbols
        #: The place of each place of the text in `symbols`.
        self.place = np.cumsum(~is_end) - 1
        distinct = text + len(ends) - 1
        distinct[ends] = np.arange(len(ends))
        suffixes = suffix_array(distinct)
        before = text[suffixes - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.wavelets = Wavelets(before, n_symbols)
        # A stretch's first place is noted too, so that no step back crosses an end.
        noted = np.arange(n) % sample == 0
        noted[ends + 1 - n] = True
        self.noted = Bits(noted[suffixes])
        self.places = suffixes[noted[suffixes]]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows (from, to) of the suffixes that start with each phrase; a phrase fills the end of its row."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), int(self.first[-1]), np.int64)
        left = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            left = left[(lengths[left] > step) & (low[left] < high[left])]
            if not len(left):
                break
            symbol = phrases[left, phrases.shape[1] - 1 - step].astype(np.int64)
            both = self.wavelets.rank(np.tile(symbol, 2), np.concatenate([low[left], high[left]]))
            low[left] = self.first[symbol] + both[: len(left)]
            high[left] = self.first[symbol] + both[len(left) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in `symbols` of each row's suffix: steps back to the next one that is noted."""
        at, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        left = np.flatnonzero(~self.noted.get(at))
        while len(left):
            symbol, rank = self.wavelets.symbol_and_rank(at[left])
            at[left] = self.first[symbol] + rank
            steps[left] += 1
            left = left[~self.noted.get(at[left])]
        return self.place[self.places[self.noted.ones(at)] + steps]
