"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns find what has a strict form; they are the base and always stay. The field reads the words that hold a
digit or an @ and gives each a label: email, ip, card, phone or none. Its potentials look at a word's form and context;
neighbouring words share a chain potential; and words of a document that are the same, or have the same digits, share
a skip potential, however far apart, so that a document is labelled consistently. Beliefs come from loopy message
passing. Words that it labels with confidence, next to each other and outside of base spans, become further spans.

The field is trained in numpy on a bounded sample of documents, with the base spans as labels: its features are looser
than the patterns, so it also knows what they miss, such as two numbers that run into each other. Documents without a
digit or an @ never leave the JVM.

Texts are taken in blocks of a number of characters, and edges a piece at a time, so that memory is bounded by the
words of one block or of one longer text: some 400 bytes for each that holds a digit or an @.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)

#: The fit's bounds: documents, and characters of one.
SAMPLE = 3000
MAX_CHARS = 20_000

FEATURES = 1 << 13
ITERATIONS = 8
#: A word is labelled from this belief on.
CONFIDENT = 0.9

#: Characters of the texts that make one graph, if it is more than one text, and edges that are computed at a time.
BLOCK_CHARS = 500_000
EDGES = 1 << 15

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_WORD = re.compile(r"\S+")
_PLAIN = re.compile(r"[0-9A-Za-z]")
_TO_LAST_PLAIN = re.compile(r".*[0-9A-Za-z]", re.DOTALL)
_LETTERS = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From one @ to the next: what can stand before it, back to the last match, and what has to follow."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each dotted row of numbers, the leftmost first."""
    for row in _DOTTED.finditer(text):
        parts = [(m.start(), m.end()) for m in _DIGITS.finditer(text, row.start(), row.end())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(_at_most_255(text[a:b]) for a, b in four):
                yield four[0][0], four[3][1]


def _at_most_255(digits: str) -> bool:
    bare = digits.lstrip("0")
    return len(bare) < 4 and int(bare or "0") <= 255


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                yield m.start(), m.end()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.start(), m.end()


def base_spans(text: str | None) -> list[Span]:
    """All matches that pass their checks, by kind and start, in code points."""
    if not text:
        return []
    finders = zip(KINDS, (_emails, _ips, _cards, _phones), strict=True)
    return [Span(kind, a, b, True) for kind, find in finders for a, b in find(text)]


def _is_unclear(text: str, spans: list[Span]) -> bool:
    """Whether a pattern fits something that then fails its check by too many digits: no label can be had from that."""
    ends = {(s.start, s.end) for s in spans}
    return any(
        (m.start(), m.end()) not in ends and _n_digits(m.group()) >= 16
        for pattern in (_NUMBER, _PHONE)
        for m in pattern.finditer(text)
    )


class Graph(NamedTuple):
    """The words of some documents that may be private, their features, and the edges between them."""

    text: np.ndarray  # whose word it is
    start: np.ndarray
    end: np.ndarray
    feature: np.ndarray
    owner: np.ndarray  # the word that a feature belongs to
    chain: np.ndarray  # pairs of neighbours
    skip: np.ndarray  # pairs of the same word or digits, each with its next one


def _core(word: str) -> tuple[int, int] | None:
    """Where a word begins and ends without the marks around it; those of a number in brackets or with a + stay."""
    first = _PLAIN.search(word)
    if first is None:
        return None
    start, end = first.start(), _TO_LAST_PLAIN.match(word).end()
    while start and word[start - 1] in "+(":
        start -= 1
    return start, end + word.startswith(")", end)


def _form(word: str) -> tuple[str, str]:
    """A word's form with and without the lengths of its numbers."""
    loose = _LETTERS.sub("a", word)
    return _DIGITS.sub(lambda m: f"d{min(len(m.group()), 20)}", loose), _DIGITS.sub("d", loose)


def _word_features(word: str, form: tuple[str, str], digits: str) -> list[str]:
    fine, coarse = form
    out = ["bias", f"fine={fine}", f"coarse={coarse}", f"digits={min(len(digits), 20)}", f"at={word.count('@')}"]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={passes_luhn(digits)}")
    parts = word.split(".")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        out.append(f"bytes={all(_at_most_255(p) for p in parts)}")
    return out


def graph_of(texts: list[str]) -> Graph:
    """Words count whole, however long: their forms and keys are hashed."""
    text, starts, ends, chain = (array("q") for _ in range(4))
    features, owner = array("i"), array("i")
    same_word, same_digits = array("Q"), array("Q")  # keys of the words; those of few digits are 0
    for i, value in enumerate(texts):
        before = (-1, "", "")  # the previous word's place as a node, its text and its form
        for m in _WORD.finditer(value):
            word = m.group()
            core = _core(word) if any(c in "0123456789@" for c in word) else None
            bare = word[core[0] : core[1]] if core else ""
            if not ("@" in bare or _DIGITS.search(bare)):
                before = -1, word.lower(), ""
                continue
            node, form, digits = len(text), _form(bare), "".join(_DIGITS.findall(bare))
            text.append(i)
            starts.append(m.start() + core[0])
            ends.append(m.start() + core[1])
            own = _word_features(bare, form, digits)
            own.append(f"before={before[1] if before[0] < 0 else before[2]}")
            if before[0] >= 0:
                chain.extend((before[0], node))
                features.append(_feature(f"after={form[1]}"))
                owner.append(before[0])
            features.extend(map(_feature, own))
            owner.extend([node] * len(own))
            same_word.append(_key(bare.lower()))
            same_digits.append(_key(digits) if len(digits) >= 4 else 0)
            before = node, word.lower(), form[1]
    of = np.array(text, np.int64)
    skip = [_next_same(of, np.array(k, np.uint64)) for k in (same_word, same_digits)]
    return Graph(
        of,
        np.array(starts, np.int64),
        np.array(ends, np.int64),
        np.array(features, np.int32),
        np.array(owner, np.int32),
        np.array(chain, np.int64).reshape(-1, 2),
        np.unique(np.concatenate(skip), axis=0),
    )


def _key(text: str) -> int:
    """Never 0 by chance worth counting, and equal for unlike words about as seldom."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _next_same(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pairs of each word and the next one in its text that has the same key."""
    order = np.lexsort((key, text))  # stable: words of one key stay in order
    one, two = order[:-1], order[1:]
    same = (text[one] == text[two]) & (key[one] == key[two]) & (key[one] > 0)
    return np.stack([one[same], two[same]], 1)


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


class Field(NamedTuple):
    """Weights of features by label, and the chain's and the skip edges' potentials."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, graph: Graph) -> tuple[np.ndarray, list[np.ndarray]]:
        """Marginals of all words, and of both kinds of edges added up, by loopy sum-product message passing."""
        n, size = len(graph.text), len(LABELS)
        scores = np.zeros((n, size))
        for k in range(size):
            scores[:, k] = np.bincount(graph.owner, self.unary[graph.feature, k], n)
        kinds = [
            # A kind's potential and edges, the messages to the second word of each, and those to the first.
            (p, e, np.zeros((len(e), size)), np.zeros((len(e), size)))
            for p, e in ((self.chain, graph.chain), (self.skip, graph.skip))
        ]

        def gathered() -> np.ndarray:
            total = scores.copy()
            for _, edges, forth, back in kinds:
                for k in range(size):
                    total[:, k] += np.bincount(edges[:, 1], forth[:, k], n)
                    total[:, k] += np.bincount(edges[:, 0], back[:, k], n)
            return total

        for _ in range(ITERATIONS if any(len(e) for _, e, *_ in kinds) else 0):
            total = gathered()
            for potential, edges, forth, back in kinds:
                for at in _pieces(len(edges)):
                    one, two = edges[at].T
                    new_forth = _log_sum((total[one] - back[at])[:, :, None] + potential, 1)
                    new_back = _log_sum((total[two] - forth[at])[:, None, :] + potential, 2)
                    forth[at] = 0.5 * forth[at] + 0.5 * (new_forth - new_forth.max(axis=1, keepdims=True))
                    back[at] = 0.5 * back[at] + 0.5 * (new_back - new_back.max(axis=1, keepdims=True))
        total = gathered()
        pairs = []
        for potential, edges, forth, back in kinds:
            joint = np.zeros(size * size)
            for at in _pieces(len(edges)):
                one, two = edges[at].T
                both = (total[one] - back[at])[:, :, None] + (total[two] - forth[at])[:, None, :] + potential
                joint += _softmax(both.reshape(-1, size * size)).sum(axis=0)
            pairs.append(joint.reshape(size, size))
        return _softmax(total), pairs

    def spans(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """The base spans and what the field adds, by kind and start."""
        out = [list(b) for b in base]
        graph = graph_of(texts)
        if len(graph.text):
            nodes, _ = self.beliefs(graph)
            label = np.where(nodes.max(axis=1) >= CONFIDENT, nodes.argmax(axis=1), 0)
            covered = [_covered(b) for b in base]
            for i, kind, first, last in _runs(graph, label, texts):
                a, b = int(graph.start[first]), int(graph.end[last])
                starts, ends = covered[i]
                near = bisect_left(starts, b) - 1  # the last stretch that begins before the new span ends
                if _plausible(kind, texts[i][a:b]) and (near < 0 or ends[near] <= a):
                    out[i].append(Span(kind, a, b, False))
        return [sorted(s, key=lambda x: (KINDS.index(x.kind), x.start)) for s in out]


def _pieces(n: int) -> Iterator[slice]:
    for i in range(0, n, EDGES):
        yield slice(i, i + EDGES)


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, apart and in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((s.start, s.end) for s in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _runs(graph: Graph, label: np.ndarray, texts: list[str]) -> Iterator[tuple[int, str, int, int]]:
    """Words that make one span: a phone number or a card's groups in a row; others are spans by themselves."""
    joined = np.zeros(len(label), bool)  # words that are followed by a node of their text
    joined[graph.chain[:, 0]] = True
    node = 0
    while node < len(label):
        first, kind = node, LABELS[label[node]]
        text = texts[graph.text[node]]
        while (
            kind in ("card", "phone")
            and joined[node]
            and label[node + 1] == label[first]
            and text[graph.start[node + 1]] not in "+"
            and _n_digits(text[graph.start[first] : graph.end[node + 1]]) <= (19 if kind == "card" else 15)
        ):
            node += 1
        if kind:
            yield int(graph.text[first]), kind, first, node
        node += 1


def _n_digits(text: str) -> int:
    return sum(c in "0123456789" for c in text)


def _plausible(kind: str, text: str) -> bool:
    n = _n_digits(text)
    if kind == "email":
        return "@" in text and "." in text
    return {"ip": text.count(".") == 3 and 4 <= n <= 12, "card": 16 <= n <= 19, "phone": 8 <= n <= 15}[kind]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _softmax(x: np.ndarray) -> np.ndarray:
    if not len(x):
        return x
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], steps: int = 80, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Adam on the likelihood, with the beliefs in place of the exact expectations; base spans are the labels.

    Texts in which two numbers run into each other are left out, as the patterns miss what they hold. Without a word to learn from, nothing is labelled.
    """
    size = len(LABELS)
    params = [np.zeros((FEATURES, size)), np.zeros((size, size)), np.zeros((size, size))]
    labelled = [(t, s) for t in texts if not _is_unclear(t, s := base_spans(t))]
    texts, spans = [t for t, _ in labelled], [s for _, s in labelled]
    graph = graph_of(texts)
    n = len(graph.text)
    if not n:
        return Field(*params)
    truth = np.zeros(n, np.int64)
    for k in range(n):
        for s in spans[graph.text[k]]:
            if s.start < graph.end[k] and graph.start[k] < s.end:
                truth[k] = LABELS.index(s.kind)
                break
    exact = np.eye(size)[truth]
    edges = [graph.chain, graph.skip]
    exact_pairs = [np.einsum("ei,ej->ij", exact[e[:, 0]], exact[e[:, 1]]) for e in edges]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        nodes, joints = Field(*params).beliefs(graph)
        wrong = nodes - exact
        unary = np.zeros_like(params[0])
        np.add.at(unary, graph.feature, wrong[graph.owner])
        gradients = [unary, *[j - e for j, e in zip(joints, exact_pairs, strict=True)]]
        for p, g, (m, v) in zip(params, gradients, moments, strict=True):
            g = g / n + decay / n * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(*params)


def may_be_private(text: Column) -> Column:
    return text.rlike("[0-9@]")


def train(docs: DataFrame, sample: int = SAMPLE, max_chars: int = MAX_CHARS, id_col: str = "doc_id") -> Field:
    """Fit on the first documents, by a hash of the id, that hold a digit or an @ and are not too long."""
    fit_for = docs.filter(may_be_private(F.col("text")) & (F.length("text") <= max_chars) & F.col(id_col).isNotNull())
    order = F.xxhash64(id_col), F.col(id_col)
    ids = fit_for.select(id_col).distinct().orderBy(*order).limit(sample)
    texts = fit_for.join(F.broadcast(ids), id_col).orderBy(*order, "text").limit(sample).select("text").toPandas()
    return fit(texts["text"].tolist())


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def find_private(docs: DataFrame, field: Field, text_col: str = "text", output: str = "private") -> DataFrame:
    """Add an array of spans (kind, start, end, base), in code points, by kind and start.

    Whole texts are searched, every row stays, and equal texts have equal spans. A null or empty text has none. An
    existing column called `output` is replaced; others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        out: list = [[] for _ in texts]
        for some in _blocks(texts):
            block = [texts.iloc[j] for j in some]
            for j, found in zip(some, shared.value.spans(block, [base_spans(t) for t in block]), strict=True):
                out[j] = [s._asdict() for s in found]
        return pd.Series(out)

    text = F.col(f"`{text_col}`").cast("string")
    return docs.withColumn(output, spans(F.when(may_be_private(text), text)))


def _blocks(texts: pd.Series, chars: int = BLOCK_CHARS) -> Iterator[list[int]]:
    """Places of texts that are neither null nor empty, in blocks of so many characters or of one longer text."""
    block, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append(i)
        size += len(text)
    if block:
        yield block


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
