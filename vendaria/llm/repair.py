"""Runs in sequences of symbols by way of a grammar: Re-Pair, then the runs across each rule's middle, found once.

A run of length n and smallest period q counts here if n >= max(6, 4q).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from vendaria.llm.words import mixed

SHORTEST, EXPONENT = 6, 4

#: Periods from here on are looked for by equal stretches of as many words, shorter ones one by one.
GRAM = 16
#: Pairs of places that are compared by hash at a time.
AT_ONCE = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Grammar(NamedTuple):
    """Rules that replace a pair of symbols each, and where they did.

    Symbols below `n_symbols` are words, `n_symbols + r` is rule `r`. `length` has the words of every symbol and
    `left` those of a rule's first half. Rule `rule[i]` was applied at word `place[i]`, in all places that are in the
    derivation. What is left are the symbols that begin at the words `top`, of the stretches `top_stretch`.
    """

    n_symbols: int
    length: np.ndarray
    left: np.ndarray
    rule: np.ndarray
    place: np.ndarray
    top: np.ndarray
    top_stretch: np.ndarray


def repair(words: np.ndarray, stretch: np.ndarray, n_symbols: int) -> Grammar:
    """Replace the most frequent pairs, again and again, until none comes twice. No pair reaches over two stretches.

    The pairs of a round do not overlap: one is replaced where it is more frequent than the pairs it shares a symbol
    with. So the most frequent of all is replaced wherever it stands, and others that it does not touch along with
    it. Of a pair of equal symbols every second one in a row counts.
    """
    symbol, at, of = words.astype(np.int64), np.arange(len(words)), stretch
    lengths, lefts, rules, places = [np.ones(n_symbols, np.int64)], [], [], []
    n = n_symbols
    length = lengths[0]
    while len(symbol) > 1:
        is_pair = of[1:] == of[:-1]
        key = np.where(is_pair, symbol[:-1] * n + symbol[1:], -1)
        # Equal pairs in a row overlap: they are of one symbol, and every second one counts.
        first = np.concatenate([[True], key[1:] != key[:-1]])
        offset = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        counts_here = np.flatnonzero(is_pair & (offset % 2 == 0))
        kinds, kind, count = np.unique(key[counts_here], return_inverse=True, return_counts=True)
        again = count > 1
        if not again.any():
            break
        # A number for each kind of pair: the more frequent ones are greater, ties by hash; 0 if it comes once.
        rank = np.zeros(len(kinds), np.int64)
        rank[np.lexsort((mixed(kinds.astype(np.uint64)), count))] = np.arange(1, len(kinds) + 1)
        rank[~again] = 0
        priority = np.zeros(len(key), np.int64)
        priority[counts_here] = rank[kind]
        odd = np.flatnonzero(is_pair & (offset % 2 == 1))
        priority[odd] = priority[odd - 1]
        # Rows of equal pairs against what is before and after them.
        begins = np.flatnonzero(first)
        level = priority[begins]
        before, after = np.append(0, level[:-1]), np.append(level[1:], 0)
        highest = np.repeat((level > before) & (level > after), np.diff(np.append(begins, len(key))))
        chosen = highest[counts_here]
        n_chosen = np.bincount(kind[chosen], minlength=len(kinds))
        replaced = (n_chosen > 1)[kind] & chosen
        here = counts_here[replaced]
        new = np.cumsum(n_chosen > 1) - 1
        made = np.flatnonzero(n_chosen > 1)
        one, two = kinds[made] // n, kinds[made] % n
        lefts.append(length[one])
        lengths.append(length[one] + length[two])
        length = np.concatenate([length, lengths[-1]])
        rules.append(new[kind[replaced]] + n - n_symbols)
        places.append(at[here])
        symbol[here] = rules[-1] + n_symbols
        kept = np.ones(len(symbol), bool)
        kept[here + 1] = False
        symbol, at, of = symbol[kept], at[kept], of[kept]
        n += len(made)
    return Grammar(n_symbols, length, _joined(lefts), _joined(rules), _joined(places), at, of)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class Runs(NamedTuple):
    """Words from `start` up to `end` (excluded) that repeat with the smallest period `period`."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def where(self, wanted: np.ndarray) -> Runs:
        return Runs(*[column[wanted] for column in self])


def runs(words: np.ndarray, stretch: np.ndarray, n_symbols: int) -> Runs:
    """All maximal runs within stretches (numbered from 0, in order), by start and then period.

    A run either lies across the middle of a rule's expansion or across the border of two symbols that are left. Those
    of a rule are found at one of its places and translated to the others; a run that is cut off by the rule's ends is
    contained in a longer one of the same period, which is found further up, and goes.
    """
    if not len(words):
        return Runs(*[np.zeros(0, np.int64)] * 3)
    grammar = repair(words, stretch, n_symbols)
    bounds = np.searchsorted(stretch, np.arange(int(stretch[-1]) + 2))
    search = _Search(words, bounds, stretch)

    used, example = np.unique(grammar.rule, return_index=True)
    long = grammar.length[grammar.n_symbols + used] >= SHORTEST
    used, example = used[long], example[long]
    low = grammar.place[example]
    item, found = search.across(low, low + grammar.left[used], low + grammar.length[grammar.n_symbols + used])
    # Each place of a rule has the runs of its example, as far from its beginning.
    by_rule = np.argsort(grammar.rule, kind="stable")
    rule = grammar.rule[by_rule]
    first, last = np.searchsorted(rule, used[item]), np.searchsorted(rule, used[item], side="right")
    n_places = last - first
    which = np.repeat(np.arange(len(item)), n_places)
    place = by_rule[np.arange(len(which)) - np.repeat(np.cumsum(n_places) - n_places - first, n_places)]
    shift = grammar.place[place] - low[item][which]

    border = np.flatnonzero(grammar.top_stretch[1:] == grammar.top_stretch[:-1]) + 1
    of = grammar.top_stretch[border]
    _, top = search.across(bounds[of], grammar.top[border], bounds[of + 1])
    everything = Runs(
        *[np.concatenate([column[which] + moved, own]) for column, own, moved in zip(found, top, (shift, shift, 0))]
    )
    return maximal(everything, stretch)


def maximal(found: Runs, stretch: np.ndarray) -> Runs:
    """The runs that no other of the same stretch and period contains, each once, by start and then period."""
    of = stretch[found.start]
    order = np.lexsort((-found.end, found.start, found.period, of))
    found, of = found.where(order), of[order]
    if not len(order):
        return found
    group = np.cumsum(np.concatenate([[0], (np.diff(of) != 0) | (np.diff(found.period) != 0)]))
    # Ends grow over the groups, so that the greatest end so far is of the same group.
    end = found.end + group * (int(found.end.max()) + 1)
    farthest = np.concatenate([[-1], np.maximum.accumulate(end)[:-1]])
    found = found.where(end > farthest)
    return found.where(np.lexsort((found.period, found.start)))


class _Search:
    """Runs across a place, in the words around it.

    Hashes only say where words may be equal; what is returned has been compared word by word.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray, stretch: np.ndarray):
        self.words = words
        self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(words), _FACTOR)]))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words.astype(np.uint64)) * self.powers[:-1])])
        # Stretches of GRAM words, by hash and then place.
        at = np.flatnonzero(np.arange(len(words)) + GRAM <= bounds[stretch + 1])
        gram = self._hash(at, at + GRAM)
        order = np.argsort(gram, kind="stable")
        self.places, gram = at[order], gram[order]
        group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]]))[: len(gram)]
        self.group = np.full(len(words) + 1, -1)
        self.group[self.places] = group
        self.order = group * (len(words) + 1) + self.places

    def _hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words from `a` to `b`, wherever they stand."""
        # Shifted to the end of the text instead of divided by a power.
        return (self.sums[b] - self.sums[a]) * self.powers[len(self.words) - a]

    def across(self, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, Runs]:
        """Maximal runs in [low, high) with words on both sides of `middle`, and which of the items each is of.

        A run of at least four periods has two of them on one side of the middle, next to it. So its period is among
        those by which a square begins or ends there.
        """
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for after in (True, False):
            room = np.minimum(np.where(after, high - middle, middle - low) // 2, (high - low) // EXPONENT)
            for q in range(1, GRAM):
                item = np.flatnonzero((room >= q) & (high - low >= SHORTEST))
                parts.append(self._squares(item, np.full(len(item), q), middle, after))
            parts += self._by_grams(room, middle, after)
        item, period, after = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.lexsort((period, after, item))
        item, period, after = item[order], period[order], after[order]
        begins = np.flatnonzero(np.concatenate([[True], (np.diff(item) != 0) | (np.diff(after) != 0)])[: len(item)])
        out = []
        for a, b in zip(begins, [*begins[1:], len(item)]):
            i, one_side = int(item[a]), bool(after[a])
            out += self._extended(i, period[a:b], int(low[i]), int(middle[i]), int(high[i]), one_side)
        columns = np.array(sorted(set(out)), np.int64).reshape(-1, 4).T
        return columns[0], Runs(*columns[1:])

    def _squares(self, item, period, middle, after: bool):
        """The items and periods for which the hashes beside the middle agree."""
        kept = []
        for start in range(0, len(item), AT_ONCE):
            i, q = item[start : start + AT_ONCE], period[start : start + AT_ONCE]
            a = middle[i] - (0 if after else 2 * q)
            kept.append(np.flatnonzero(self._hash(a, a + q) == self._hash(a + q, a + 2 * q)) + start)
        kept = _joined(kept).astype(np.int64)
        return item[kept], period[kept], np.full(len(kept), after)

    def _by_grams(self, room: np.ndarray, middle: np.ndarray, after: bool):
        """Longer periods: the places where the words beside the middle come again."""
        item = np.flatnonzero(room >= GRAM)
        near = middle[item] if after else middle[item] - GRAM
        group = self.group[near]
        # Places from a period of GRAM on to the greatest there is room for.
        width, most = len(self.words) + 1, room[item]
        from_, to = (near + GRAM, near + most) if after else (near - most, near - GRAM)
        a = np.searchsorted(self.order, group * width + np.maximum(from_, 0))
        b = np.searchsorted(self.order, group * width + to, side="right")
        n = np.where(group >= 0, np.maximum(b - a, 0), 0)
        parts = []
        ends = np.cumsum(n)
        at = 0
        while at < len(item):
            to_ = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, side="right")))
            some = slice(at, to_)
            which = np.repeat(np.arange(at, to_), n[some])
            place = self.places[np.arange(len(which)) - np.repeat(np.cumsum(n[some]) - n[some] - a[some], n[some])]
            parts.append(self._squares(item[which], np.abs(place - near[which]), middle, after))
            at = to_
        return parts

    def _extended(self, i: int, periods: np.ndarray, low: int, middle: int, high: int, after: bool):
        """The runs of an item by the periods, ascending, of the squares on one side of the middle.

        A square inside a run of a shorter period is a repetition of a repetition, and so is its run.
        """
        out = []
        covered = 0
        for q in periods.tolist():
            if 2 * q <= covered:
                continue
            a, b = (middle, middle + 2 * q) if after else (middle - 2 * q, middle)
            if not np.array_equal(self.words[a : a + q], self.words[a + q : b]):
                continue
            end = b + self._equal(b - q, b, high - b, 1)
            start = a - self._equal(a + q - 1, a - 1, a - low, -1)
            covered = max(covered, end - middle if after else middle - start)
            if start < middle < end and end - start >= max(SHORTEST, EXPONENT * q):
                out.append((i, start, end, q))
        return out

    def _equal(self, a: int, b: int, most: int, step: int) -> int:
        """How many words from `a` and from `b` on, up or down, are equal."""
        n, chunk = 0, 32
        while n < most:
            size = min(chunk, most - n)
            x, y = a + step * n, b + step * n
            if step > 0:
                same = self.words[x : x + size] == self.words[y : y + size]
            else:
                same = (self.words[x - size + 1 : x + 1] == self.words[y - size + 1 : y + 1])[::-1]
            if not same.all():
                return n + int(np.argmin(same))
            n += size
            chunk *= 2
        return n
