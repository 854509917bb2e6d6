"""Quality rules: document statistics, fixed base rules, and gradient-boosted trees on top.

The statistics of a text are counted exactly. What the base rules fail is out. The others are judged by boosted trees
over ratios of the statistics, fitted on a bounded sample of labelled documents. For features where more can only be
worse the trees are held to that: a split that would let quality rise with such a feature is not made, and the values
below a split stay on its two sides. All trees are flattened into numpy arrays of nodes and scored together, one level
at a time for all rows and trees.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.labels import labelled_sample
from vendaria.llm.words import words_of

#: Characters of the texts that are counted together.
BLOCK_CHARS = 2_000_000

#: The fit's bounds: documents of each label, and characters of a document to learn from.
PER_CLASS = 3000
MAX_CHARS = 50_000

SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_distinct", "n_upper", "n_digits", "n_ends", "n_doubled", "n_marks")

#: Features of the trees, with -1 where more may not raise the quality.
FEATURES = {
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "doubled_share": -1,
    "log_words": 0,
    "word_length": 0,
    "line_words": 0,
    "distinct_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "end_share": 0,
    "mark_share": 0,
}


def text_stats(texts) -> pd.DataFrame:
    """`COUNTS` and `MORE` of each text; a null text has none of anything."""
    out, block, size = [], [], 0
    for text in texts:
        block.append(text or "")
        size += len(block[-1])
        if size >= BLOCK_CHARS:
            out.append(_block_stats(block))
            block, size = [], 0
    out.append(_block_stats(block))
    return pd.concat(out, ignore_index=True)


def _block_stats(texts: list[str]) -> pd.DataFrame:
    rows, sequences, known = [], [], 0
    for text in texts:
        number = defaultdict(count(known).__next__)  # numbers of their own for each text, so windows never match across
        words = words_of(text)
        sequences.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        known += len(number)
        lines = [line for line in text.split("\n") if line.strip(SEPARATORS)]
        n_spaces = sum(map(text.count, SEPARATORS))
        rows.append(
            (
                len(words),
                len(text) - n_spaces,
                sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                len(text),
                len(lines),
                len(number),
                sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
                sum(map(text.count, "0123456789")),
                text.count(".") + text.count("?"),
                text.count("!"),
            )
        )
    names = [*COUNTS[:4], *MORE[:6], "n_marks"]
    stats = pd.DataFrame(rows, columns=names).astype("int64") if rows else pd.DataFrame({n: [] for n in names}, dtype="int64")
    stats["n_repeat_words"], stats["n_doubled"] = _repeats(sequences, known)
    return stats[[*COUNTS, *MORE]]


def _repeats(sequences: list[np.ndarray], known: int) -> tuple[np.ndarray, np.ndarray]:
    """Words in windows that their text holds twice or more, and words that equal the one before, for each text."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    owner = np.repeat(np.arange(len(sequences)), lengths)
    if not len(owner):
        return np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    words = np.concatenate(sequences)
    doubled = np.bincount(owner[1:][words[1:] == words[:-1]], minlength=len(lengths))
    at = np.flatnonzero(np.arange(len(words)) + WINDOW <= np.cumsum(lengths)[owner])
    # Windows get exact numbers: two words, two pairs, four words and the fifth.
    pairs = np.unique(words[:-1] * known + words[1:], return_inverse=True)[1]
    fours = np.unique(pairs[at] * len(words) + pairs[at + 2], return_inverse=True)[1]
    _, window, times = np.unique(fours * known + words[at + 4], return_inverse=True, return_counts=True)
    again = at[times[window] > 1]
    cover = np.bincount(again, minlength=len(words) + 1) - np.bincount(again + WINDOW, minlength=len(words) + 1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(owner, inside, len(lengths)).astype(np.int64), doubled


def features_of(stats: pd.DataFrame) -> np.ndarray:
    words, lines = np.maximum(1, stats["n_words"]), np.maximum(1, stats["n_lines"])
    letters = np.maximum(1, stats["word_chars"])
    columns = {
        "symbols_per_word": stats["n_symbols"] / words,
        "dup_line_share": stats["n_dup_lines"] / lines,
        "repeat_share": stats["n_repeat_words"] / words,
        "doubled_share": stats["n_doubled"] / words,
        "log_words": np.log1p(stats["n_words"]),
        "word_length": stats["word_chars"] / words,
        "line_words": stats["n_words"] / lines,
        # Texts repeat words the more the longer they are.
        "distinct_share": np.log1p(stats["n_distinct"]) / np.log1p(words),
        "upper_share": stats["n_upper"] / letters,
        "digit_share": stats["n_digits"] / letters,
        "end_share": stats["n_ends"] / words,
        "mark_share": stats["n_marks"] / words,
    }
    return np.column_stack([np.asarray(columns[name], float) for name in FEATURES])


def base_failed(stats: pd.DataFrame) -> pd.Series:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


class Trees(NamedTuple):
    """All trees' nodes in one array each. A leaf points to itself, so that rows may stay in it."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotone=tuple(FEATURES.values()),
    n_trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    n_bins: int = 64,
    least_rows: int = 8,
    decay: float = 1.0,
) -> Trees:
    """Second-order boosting of the logistic loss on binned features. With one label only, its share is the score."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1 - 1e-3
    start = math.log(share / (1 - share))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) if len(c) else np.zeros(1) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, odds = [], np.full(len(y), start)

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows], hessian[rows]
        own = float(np.clip(-g.sum() / (h.sum() + decay), low, high))
        place = len(nodes)
        nodes.append([0, np.inf, place, place, rate * own])
        best = (1e-6, None)
        for f, cut in enumerate(cuts if level < depth and len(rows) >= 2 * least_rows else ()):
            size = len(cut) + 1
            n = np.cumsum(np.bincount(binned[rows, f], minlength=size))[:-1]
            gl = np.cumsum(np.bincount(binned[rows, f], g, size))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], h, size))[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            vl, vr = np.clip(-gl / (hl + decay), low, high), np.clip(-gr / (hr + decay), low, high)
            gain = _gain(gl, hl, vl, decay) + _gain(gr, hr, vr, decay) - _gain(g.sum(), h.sum(), own, decay)
            allowed = (n >= least_rows) & (len(rows) - n >= least_rows) & (monotone[f] * (vr - vl) >= 0)
            gain = np.where(allowed, gain, -np.inf)
            if len(gain) and gain.max() > best[0]:
                at = int(gain.argmax())
                best = (float(gain[at]), (f, at, float(vl[at]), float(vr[at])))
        if best[1]:
            f, at, vl, vr = best[1]
            goes_left = binned[rows, f] <= at
            middle = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            to_left, to_right = bounds[monotone[f]]
            left = grow(rows[goes_left], level + 1, *to_left)
            right = grow(rows[~goes_left], level + 1, *to_right)
            nodes[place] = [f, cuts[f][at], left, right, 0.0]
        else:
            odds[rows] += rate * own
        return place

    for _ in range(n_trees if len(set(y.tolist())) == 2 else 0):
        p = 1 / (1 + np.exp(-odds))
        gradient, hessian = p - y, p * (1 - p)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    columns = list(zip(*nodes, strict=True)) or [[]] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    flat = [np.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return Trees(np.array(roots, np.int64), *flat, depth, start)


def _gain(g, h, value, decay: float):
    """What a leaf of this value takes off the loss, to second order."""
    return -(g * value + 0.5 * (h + decay) * value**2)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Trees:
    """Fit on the statistics of a bounded sample; they are counted by the executors, no text comes to the driver."""
    short = F.length("text") <= max_chars
    sample = labelled_sample(docs, labels, "quality", per_class, {"stats": stats_of(F.col("text"))}, short)
    stats = pd.DataFrame(list(sample["stats"]), columns=[*COUNTS, *MORE])
    judged = ~base_failed(stats).to_numpy(dtype=bool)
    return fit_trees(features_of(stats[judged]), sample["quality"].to_numpy(dtype=float)[judged])


_STATS = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, *MORE)])
_JUDGED = T.StructType(
    [*_STATS, T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType())]
)


def stats_of(text: Column) -> Column:
    """`COUNTS` and `MORE` as a struct."""

    @F.pandas_udf(_STATS)
    def counted(texts: pd.Series) -> pd.DataFrame:
        return text_stats(texts)

    return counted(text)


def judge(docs: DataFrame, trees: Trees, least: float = 0.5, text_col: str = "text", output: str = "quality") -> DataFrame:
    """Add the struct `output`: all counts, base_failed, the trees' score, and kept.

    A text is kept if it passes the base rules and its score is `least` or more. A null or empty text has no words and
    fails. Every row stays, equal texts are judged alike, and an existing column called `output` is replaced. Nothing
    is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf(_JUDGED)
    def judged(texts: pd.Series) -> pd.DataFrame:
        stats = text_stats(texts)
        return stats.assign(base_failed=base_failed(stats), score=shared.value.score(features_of(stats)))

    found = docs.withColumn(output, judged(F.col(f"`{text_col}`")))
    kept = ~F.col(f"`{output}`.base_failed") & (F.col(f"`{output}`.score") >= least)
    return found.withColumn(output, F.col(f"`{output}`").withField("kept", kept))
