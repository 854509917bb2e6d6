"""Quality classifier by co-training.

Two classifiers look at a document from different sides. One sees the text: relative frequencies of hashed words and
of word shapes, and how often a word is said twice in a row. The other sees what a crawl knows of the page without
reading it: source, language, length, lines. Both start from the same labelled documents. In each round they score a
fresh pool of unlabelled documents, and each hands those that it is most sure of, with its own verdict as the label,
to the other one's training rows. In the end both are calibrated on labelled documents that neither has learnt from,
and their log odds are added: with independent views and a prior, log odds = text's + page's - prior's.

Both models are logistic regressions, fitted in numpy on bounded samples. Scoring covers all documents in one pass
without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.labels import first_ids, first_rows, labelled_sample

#: The fit's bounds: labelled documents of each class, characters of a document to learn from, and unlabelled
#: documents of a round's pool.
PER_CLASS = 2000
MAX_CHARS = 20_000
POOL = 2000
ROUNDS = 3

#: What a view must be sure of to hand a document over, and how many of the pool it may at most.
CONFIDENT = 0.95
EXCHANGED = 400

WORD_BUCKETS = 1 << 14
SHAPE_BUCKETS = 1 << 10
TEXT_FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + 1
DOUBLED = TEXT_FEATURES - 1
PAGE_FEATURES = 1 << 10

BLOCK_CHARS = 4_000_000


class _Kinds(dict):
    """For `str.translate`: A for upper case, a for other letters, 9 for digits; other characters stay."""

    def __missing__(self, code: int) -> str:
        kind = unicodedata.category(chr(code))
        self[code] = "A" if kind == "Lu" else "a" if kind[0] in "LM" else "9" if kind[0] == "N" else chr(code)
        return self[code]


_KINDS = _Kinds()
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape_of(word: str) -> str:
    return _RUNS.sub(r"\1", word.translate(_KINDS))


def _hash(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


def word_features(words: list[str]) -> np.ndarray:
    """The two features of each word: its own bucket and its shape's."""
    out = np.empty((len(words), 2), np.int64)
    shapes: dict[str, int] = {}
    for i, word in enumerate(words):
        shape = shape_of(word)
        if shape not in shapes:
            shapes[shape] = WORD_BUCKETS + _hash(shape, SHAPE_BUCKETS)
        out[i] = _hash(word.lower(), WORD_BUCKETS), shapes[shape]
    return out


def text_features(text: str | None) -> tuple[list[int], list[float]]:
    """Features of a text and their shares of its words."""
    words = text.split() if text else []
    if not words:
        return [], []
    number = defaultdict(count().__next__)
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    features = word_features(list(number))[at].ravel()
    present, times = np.unique(features, return_counts=True)
    doubled = int((at[1:] == at[:-1]).sum())
    return [*present.tolist(), DOUBLED], [*(times / len(words)).tolist(), doubled / len(words)]


def page_facts() -> Column:
    """What is known of the page, as strings; null columns are a fact of their own."""
    size = F.coalesce(F.length("text"), F.lit(0))
    lines = F.when(size > 0, size - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0)
    source, lang = (F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in ("source", "lang"))
    length = F.floor(F.log2(F.coalesce(F.col("n_chars"), size) + 1)).cast("string")
    per_line = F.floor(2 * F.log2((size + 1) / (lines + 1))).cast("string")
    facts = {
        "source": source,
        "lang": lang,
        "length": length,
        "lines": F.floor(F.log2(lines + 1)).cast("string"),
        "line": per_line,
        "lang+line": F.concat(lang, F.lit("+"), per_line),
    }
    return F.array(*[F.concat(F.lit(f"{k}="), v) for k, v in facts.items()])


class Linear(NamedTuple):
    """A logistic regression, and the line that turns its margins into calibrated log odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def calibrated(self, margins: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * (margins + self.bias) + self.shift, -30, 30)


class Rows(NamedTuple):
    """Sparse rows: features, their values, and the row each belongs to."""

    feature: np.ndarray
    value: np.ndarray
    owner: np.ndarray
    n: int

    @classmethod
    def of(cls, features, values=None) -> Rows:
        sizes = np.array([len(f) for f in features], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *[np.asarray(f, np.int64) for f in features]])
        value = np.ones(len(flat)) if values is None else np.concatenate([np.zeros(0), *[np.asarray(v, float) for v in values]])
        return cls(flat, value, np.repeat(np.arange(len(sizes)), sizes), len(sizes))

    def take(self, rows: np.ndarray) -> Rows:
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        kept = place[self.owner] >= 0
        return Rows(self.feature[kept], self.value[kept], place[self.owner[kept]], len(rows))

    def plus(self, other: Rows) -> Rows:
        joined = (np.concatenate(p) for p in ((self.feature, other.feature), (self.value, other.value)))
        return Rows(*joined, np.concatenate([self.owner, other.owner + self.n]), self.n + other.n)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.feature] * self.value, self.n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_linear(rows: Rows, y: np.ndarray, size: int, steps: int = 150, rate: float = 0.2, decay: float = 1e-5) -> Linear:
    """Both classes weigh the same. Adam on all rows."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, steps + 1):
        error = weight * (sigmoid(rows.margins(w) + b) - y)
        g = np.bincount(rows.feature, error[rows.owner] * rows.value, size) + decay * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Linear(w, float(b))


def calibrate(model: Linear, rows: Rows, y: np.ndarray, prior: float, steps: int = 30) -> Linear:
    """Platt's line, by damped Newton steps, with classes weighed as they occur and targets pulled in from 0 and 1."""
    x = rows.margins(model.weights) + model.bias
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return model
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0) * len(y)
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(line: np.ndarray) -> float:
        z = line[0] * x + line[1]
        return float(weight @ (np.logaddexp(0, z) - target * z) + 5e-4 * line @ line)

    line = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(line[0] * x + line[1])
        g, h = weight * (p - target), weight * p * (1 - p)
        gradient = np.array([g @ x, g.sum()]) + 1e-3 * line
        hessian = np.array([[h @ (x * x), h @ x], [h @ x, h.sum()]]) + 1e-3 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(line - size * step) > loss(line):
            size /= 2
        line = line - size * step
    # A view that tells nothing, or the wrong way round, has a flat line.
    return model._replace(slope=float(max(0.0, line[0])), shift=float(line[1]))


class CoTrained(NamedTuple):
    text: Linear
    page: Linear
    prior: float

    @property
    def prior_odds(self) -> float:
        return float(np.log(self.prior / (1 - self.prior)))

    def text_margins(self, texts) -> np.ndarray:
        """Block by block: the weight of each distinct word of a block is looked up once."""
        out, block, size = [], [], 0
        for text in texts:
            block.append(text)
            size += len(text) if text else 0
            if size >= BLOCK_CHARS:
                out.append(self._block_margins(block))
                block, size = [], 0
        out.append(self._block_margins(block))
        return np.concatenate(out)

    def _block_margins(self, texts: list) -> np.ndarray:
        number = defaultdict(count().__next__)
        docs = [np.fromiter(map(number.__getitem__, t.split() if t else ()), np.int64) for t in texts]
        weights = self.text.weights
        of_word = weights[word_features(list(number))].sum(axis=1) if number else np.zeros(0)
        doubled = weights[DOUBLED]
        return np.array([of_word[d].mean() + doubled * (d[1:] == d[:-1]).mean() * (len(d) - 1) / len(d) if len(d) > 1
                         else of_word[d].sum() for d in docs])

    def page_margins(self, facts) -> np.ndarray:
        return np.array([self.page.weights[[_hash(f, PAGE_FEATURES) for f in row]].sum() for row in facts])

    def scores(self, texts, facts) -> pd.DataFrame:
        by_text = self.text.calibrated(self.text_margins(texts))
        by_page = self.page.calibrated(self.page_margins(facts))
        return pd.DataFrame(
            {"text_score": sigmoid(by_text), "page_score": sigmoid(by_page), "score": sigmoid(by_text + by_page - self.prior_odds)}
        )


def co_train(views: list[tuple[Rows, int]], y: np.ndarray, pools: list[list[Rows]], prior: float, exchanged: int = EXCHANGED) -> list[Linear]:
    """The rounds. `views` and every pool hold the rows of each view; a quarter of the labelled ones calibrates."""
    prior = float(np.clip(prior, 0.01, 0.99))
    held = np.arange(len(y)) % 4 == 3
    learn, check = np.flatnonzero(~held), np.flatnonzero(held)
    training = [(rows.take(learn), y[learn]) for rows, _ in views]

    def fitted() -> list[Linear]:
        return [
            calibrate(fit_linear(seen, labels, size), rows.take(check), y[check], prior)
            for (rows, size), (seen, labels) in zip(views, training, strict=True)
        ]

    models = fitted()
    for pool in pools:
        given = []
        for model, rows in zip(models, pool, strict=True):
            p = sigmoid(model.calibrated(rows.margins(model.weights)))
            sure = [np.flatnonzero(p >= CONFIDENT), np.flatnonzero(p <= 1 - CONFIDENT)]
            sure = [s[np.argsort(-np.abs(p[s] - 0.5), kind="stable")][: exchanged // 2] for s in sure]
            given.append((np.concatenate(sure), np.repeat([1, 0], [len(s) for s in sure])))
        for other, (rows, labels) in enumerate(reversed(given)):
            seen, known = training[other]
            training[other] = seen.plus(pool[other].take(rows)), np.concatenate([known, labels])
        models = fitted()
    return models


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    pool: int = POOL,
    rounds: int = ROUNDS,
    exchanged: int = EXCHANGED,
) -> CoTrained:
    """Co-train on a bounded sample of labelled documents and bounded pools of unlabelled ones.

    The bounds are of the fit alone: `per_class` labelled documents, `pool` unlabelled ones in each of the `rounds`, of
    which each view hands over at most `exchanged`. Documents with null ids or texts beyond MAX_CHARS are not learnt from.
    The executors turn texts into features; only those come to the driver. Without labels of both classes every
    document has the score of the class that there is.
    """
    seen = F.length("text") <= MAX_CHARS
    views = {"text": _text_features("text"), "facts": page_facts()}
    counts = labels.filter(F.col("quality").isin(0, 1)).groupBy("quality").count().collect()
    known = {int(r["quality"]): r["count"] for r in counts}
    total = sum(known.values())
    if len(known) < 2:
        prior = 0.999 if 0 not in known else 0.001
        odds = float(np.log(prior / (1 - prior)))
        flat = [Linear(np.zeros(n), odds) for n in (TEXT_FEATURES, PAGE_FEATURES)]
        return CoTrained(*flat, prior)
    sample = labelled_sample(docs, labels, "quality", per_class, views, seen)
    # Each class comes in the order of a hash; together they are put in one order, so that any fourth is a fair part.
    sample = sample.sort_values("doc_id", key=lambda ids: ids.map(lambda i: zlib.crc32(str(i).encode())), kind="stable")

    every = docs.filter(seen).filter("doc_id IS NOT NULL")
    unlabelled = every.select("doc_id").distinct().join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    fresh = first_rows(every.join(F.broadcast(first_ids(unlabelled, rounds * pool)), "doc_id"), rounds * pool)
    fresh = fresh.select("doc_id", *[c.alias(n) for n, c in views.items()]).toPandas()

    def rows_of(frame: pd.DataFrame) -> list[Rows]:
        text = Rows.of([t["feature"] for t in frame["text"]], [t["share"] for t in frame["text"]])
        return [text, Rows.of([[_hash(f, PAGE_FEATURES) for f in row] for row in frame["facts"]])]

    sizes = [TEXT_FEATURES, PAGE_FEATURES]
    pools = [rows_of(fresh.iloc[at : at + pool]) for at in range(0, len(fresh), pool)]
    prior = known[1] / total
    models = co_train(list(zip(rows_of(sample), sizes, strict=True)), sample["quality"].to_numpy(int), pools, prior, exchanged)
    return CoTrained(*models, float(np.clip(prior, 0.01, 0.99)))


def _text_features(column: str) -> Column:
    schema = T.StructType(
        [T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("share", T.ArrayType(T.DoubleType()))]
    )

    @F.pandas_udf(schema)
    def features(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_features(t) for t in texts], columns=["feature", "share"])

    return features(F.col(column))


def score(docs: DataFrame, model: CoTrained, least: float = 0.5, output: str = "quality") -> DataFrame:
    """Add the struct `output`: text_score, page_score, score (probability of good quality) and kept.

    Every row stays and rows alike are scored alike. A null or empty text has no words and is judged by the bias of
    the text's view; null columns are facts like others. An existing column called `output` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("text_score double, page_score double, score double")
    def scored(texts: pd.Series, facts: pd.Series) -> pd.DataFrame:
        return shared.value.scores(texts, facts)

    found = docs.withColumn(output, scored(F.col("text"), page_facts()))
    return found.withColumn(output, F.col(output).withField("kept", F.col(f"{output}.score") >= least))
