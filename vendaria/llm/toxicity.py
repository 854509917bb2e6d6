"""Toxicity by subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its character 3- to 5-grams and of itself, hashed into buckets; a passage of
`WINDOW` words is the mean of its words; a softmax over two classes turns that into a probability, and a document is
as toxic as its worst passage, so that a long text does not dilute an insult. Vectors and softmax are trained jointly
in numpy; misspelt or inflected words that were never seen share most of their grams with known ones.

Both layers are linear, so after training a bucket is worth one number, and a word the mean of its buckets' numbers.
That table of 2^18 numbers is broadcast; scoring takes one pass without a shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count, groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.llm.labels import labelled_sample
from vendaria.llm.names import unused

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
WINDOW = 24

#: A bucket counts if so many documents of the sample have it.
MIN_DOCUMENTS = 3

#: How strongly the last epoch leans to a document's worst passages, and the pull of the vectors to nothing.
SHARPEST = 2.0
DECAY = 1e-6

#: The fit's bounds: documents of each label, and characters of a document to learn from.
PER_CLASS = 1500
MAX_CHARS = 20_000

#: A document is taken for toxic from this score on.
THRESHOLD = 0.7

#: Characters of the texts whose words are held at a time.
BLOCK_CHARS = 4_000_000

_MARKS = "!\"#$%&'()*+,-./:;<=>?[\\]^_`{|}~¡¿«»“”‘’…—–"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def spoken(text: str | None) -> list[str]:
    """The words of a text in lower case. A word said many times in a row counts once: it insults no more for that."""
    return [word for word, _ in groupby(text.lower().split())] if text else []


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words' grams and of the words themselves, and for each the word it belongs to.

    Marks around a word do not count. Grams are hashed as polynomials of their characters, all words at a time.
    """
    framed = [f"<{w.strip(_MARKS)}>" for w in words]
    sizes = np.array([len(f) for f in framed], np.int64)
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(framed)), sizes)
    first = np.cumsum(sizes) - sizes
    offset = np.arange(len(codes)) - first[owner]
    left = sizes[owner] - offset

    buckets, owners = [], []
    for n in (3, 4, 5):
        at = np.flatnonzero(left >= n)
        value = np.zeros(len(at), np.uint64)
        for k in range(n):
            value = value * _FACTOR + codes[at + k]
        buckets.append(_bucket(value * _FACTOR + np.uint64(n)))
        owners.append(owner[at])
    if len(framed):
        powers = np.multiply.accumulate(np.full(int(sizes.max()), _FACTOR))
        buckets.append(_bucket(np.add.reduceat(codes * powers[offset], first)))
        owners.append(np.arange(len(framed)))
    return np.concatenate(buckets), np.concatenate(owners)


def _bucket(value: np.ndarray) -> np.ndarray:
    mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class ToxicityModel(NamedTuple):
    """`bucket` holds the margin that each bucket adds to a word; a passage's log odds are its words' mean + bias."""

    bucket: np.ndarray
    bias: float

    def margins(self, words: list[str]) -> np.ndarray:
        buckets, owner = grams_of(words)
        sums = np.bincount(owner, self.bucket[buckets], len(words))
        return sums / np.maximum(1, np.bincount(owner, minlength=len(words)))

    def scores(self, texts) -> np.ndarray:
        """The score of each text. Texts are taken in blocks, so that not all words are held at once."""
        out, block, size = [], [], 0
        for text in texts:
            block.append(text)
            size += len(text) if text else 0
            if size >= BLOCK_CHARS:
                out.append(self._scores(block))
                block, size = [], 0
        out.append(self._scores(block))
        return np.concatenate(out)

    def _scores(self, texts: list) -> np.ndarray:
        number = defaultdict(count().__next__)
        docs = [np.fromiter(map(number.__getitem__, spoken(t)), np.int64) for t in texts]
        margins = self.margins(list(number))
        worst = np.array([_window_means(margins[d], _starts(len(d))).max() if len(d) else -np.inf for d in docs])
        return 1 / (1 + np.exp(-np.clip(worst + self.bias, -700, 500))) * np.isfinite(worst)


def _starts(n: int) -> np.ndarray:
    """Where passages begin: every half window, so that no short phrase falls between two."""
    return np.arange(0, max(1, n - WINDOW // 2), WINDOW // 2)


def _window_means(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    through = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.minimum(starts + WINDOW, len(values))
    # Divided by the whole window, so that a few words are no stronger than the same words in a passage.
    return (through[ends] - through[starts]) / WINDOW


def fit(texts: list[str], labels: np.ndarray, epochs: int = 150, rate: float = 0.1, seed: int = 7) -> ToxicityModel:
    """Joint training of bucket vectors and softmax by Adam.

    A document's log odds are a weighted mean of its passages'. The weights start out equal and lean more and more to
    the passages with the highest odds, until the worst one decides, as it does in scoring. Documents of both labels
    weigh the same in all. Buckets that fewer than `MIN_DOCUMENTS` documents have are left at nothing. Without both
    labels there is nothing to tell apart, and every text gets the label that there is (0 without any).
    """
    if len(set(labels.tolist())) < 2:
        known = float(labels[0]) if len(labels) else 0.0
        return ToxicityModel(np.zeros(BUCKETS), 50.0 if known else -50.0)

    number = defaultdict(count().__next__)
    doc_words = [np.fromiter(map(number.__getitem__, spoken(t)), np.int32) for t in texts]
    flat, gram_word = _grams_by_word(list(number))
    divisor = np.maximum(1, np.bincount(gram_word, minlength=len(number)))
    n_words = len(number)
    first = np.searchsorted(gram_word, np.arange(n_words + 1))
    seen = np.zeros(BUCKETS, np.int32)
    for own in doc_words:
        own = np.unique(own)
        seen[np.unique(flat[np.repeat(first[own], divisor[own]) + _within(divisor[own])])] += 1
    used = np.flatnonzero(seen >= MIN_DOCUMENTS)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    known = place[flat] >= 0
    flat, gram_word = place[flat[known]], gram_word[known]

    # Passages of all documents, one after another: where they begin and end among all words, and whose they are.
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in doc_words])])
    words = np.concatenate(doc_words)
    del number
    starts = [_starts(len(d)) if len(d) else np.zeros(0, int) for d in doc_words]
    counts = np.array([len(at) for at in starts])
    owner = np.repeat(np.arange(len(doc_words)), counts)
    begins = np.concatenate(starts) + offsets[owner]
    ends = np.minimum(begins + WINDOW, offsets[owner + 1])
    documents = np.flatnonzero(counts)
    if not len(documents) or not len(used):
        return ToxicityModel(np.zeros(BUCKETS), 0.0)
    group = (np.cumsum(counts) - counts)[documents]
    counts = counts[documents]
    target = labels[documents].astype(np.float64)
    weight = np.where(target == 1, 0.5 / max(target.sum(), 1), 0.5 / max((1 - target).sum(), 1))

    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(used), DIMENSIONS))
    softmax = np.stack([np.full(DIMENSIONS, -1.0), np.full(DIMENSIONS, 1.0)]) * rng.uniform(0.5, 1.5, DIMENSIONS)
    bias = np.zeros(2)
    params = [vectors, softmax, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    for step in range(1, epochs + 1):
        direction = softmax[1] - softmax[0]
        worth = _summed(vectors @ direction, flat, gram_word, n_words) / divisor
        through = np.concatenate([[0.0], np.cumsum(worth[words])])
        odds = (through[ends] - through[begins]) / WINDOW + bias[1] - bias[0]
        lean = np.exp(SHARPEST * step / epochs * (odds - np.repeat(np.maximum.reduceat(odds, group), counts)))
        lean /= np.repeat(np.add.reduceat(lean, group), counts)
        pooled = np.clip(np.add.reduceat(lean * odds, group), -500, 500)
        error = weight * (1 / (1 + np.exp(-pooled)) - target)

        pushed = lean * np.repeat(error, counts) / WINDOW
        change = np.bincount(begins, pushed, len(words) + 1) - np.bincount(ends, pushed, len(words) + 1)
        per_word = np.bincount(words, np.cumsum(change)[:-1], n_words) / divisor
        slope = _summed(per_word, gram_word, flat, len(used))
        pull = slope @ vectors
        gradients = [
            slope[:, None] * direction + DECAY * vectors,
            np.stack([-pull, pull]),
            np.array([-error.sum(), error.sum()]),
        ]
        for p, g, (m, v) in zip(params, gradients, moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    bucket = np.zeros(BUCKETS)
    bucket[used] = vectors @ (softmax[1] - softmax[0])
    return ToxicityModel(bucket, float(bias[1] - bias[0]))


def _grams_by_word(words: list[str], at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """As `grams_of`, in the order of the words, and with no more than so many words' arrays at a time."""
    flat, owners = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for start in range(0, len(words), at_once):
        buckets, owner = grams_of(words[start : start + at_once])
        order = np.argsort(owner, kind="stable")
        flat.append(buckets[order].astype(np.int32))
        owners.append((owner[order] + start).astype(np.int32))
    return np.concatenate(flat), np.concatenate(owners)


def _summed(values: np.ndarray, source: np.ndarray, target: np.ndarray, size: int, at_once: int = 1 << 19) -> np.ndarray:
    """The sum of `values[source]` for each target, without an array as long as these."""
    total = np.zeros(size)
    for start in range(0, len(source), at_once):
        part = slice(start, start + at_once)
        total += np.bincount(target[part], values[source[part]], size)
    return total


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the given lengths, one after another."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> ToxicityModel:
    """Fit on a bounded sample of labelled documents that are not held out; only their text is looked at."""
    text = F.col("text")
    sample = labelled_sample(docs, labels, "toxic", per_class, {"text": text}, F.length(text).between(1, max_chars))
    return fit(sample["text"].tolist(), sample["toxic"].to_numpy(dtype=int))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", output: str = "score") -> DataFrame:
    """Add the score of each whole text, 0 to 1; 0 for a null or empty one or one without words.

    Every row stays and equal texts get equal scores. An existing column called `output` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    return docs.withColumn(output, scored(F.col(f"`{text_col}`")))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, with the columns they came with, whatever they are called.

    A null, empty or wordless text has the score 0 and stays; rows that repeat go or stay together.
    """
    (own,) = unused(docs, "toxicity")
    return score(docs, model, output=own).filter(F.col(own) < threshold).drop(own)
