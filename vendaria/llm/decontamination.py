"""Passages of a benchmark in training documents, found by an FM-index of each shard of documents.

A shard is a block of documents in a task. Its words become symbols, the phrases are the benchmark's windows of ten
words, and all of them are searched backwards at once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.arrow_words import blocks_of, bytes_of, split, with_bytes
from vendaria.llm.fm_index import FmIndex
from vendaria.sources.scratch import materialize, scratch_dir

#: Words after A-Z are in lower case, as a regular expression for Python and DuckDB.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_OF_RAW = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10

#: Windows that are broadcast and searched at a time, some 60 bytes each.
BLOCK_WINDOWS = 1 << 19

_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[:128] = 32  # A blank ends a word; bytes from 128 on are of other characters and stay.
_TABLE[48:58] = np.arange(48, 58)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[65:91] = np.arange(97, 123)


class Phrases(NamedTuple):
    """Some of a benchmark's windows, ready to be searched."""

    vocabulary: pa.Array
    #: The words' symbols, from 1; a window shorter than the others fills the end of its row.
    windows: np.ndarray
    lengths: np.ndarray
    #: The items of window `i` are `items[owners[offsets[i]:offsets[i + 1]]]`.
    offsets: np.ndarray
    owners: np.ndarray
    items: np.ndarray
    #: The length of the shortest window that each symbol is in.
    shortest: np.ndarray


class Hits(NamedTuple):
    """By text: number of words, merged spans of hit words (from, to), and the items that occur, as strings in order."""

    n_words: np.ndarray
    span_text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    item_text: np.ndarray
    item: np.ndarray


def words(texts: pa.Array):
    """The words of texts (large strings without nulls), in lower case."""
    return split(with_bytes(texts, _TABLE[bytes_of(texts)]))


def phrases_of(rows: pd.DataFrame) -> Phrases:
    """From rows (window, item): the window's words joined by blanks, and an item it is of, each pair once."""
    of_window, windows = pd.factorize(rows["window"], sort=True)
    of_item, items = pd.factorize(rows["item"], use_na_sentinel=False)
    order = np.argsort(of_window, kind="stable")
    offsets = np.searchsorted(of_window[order], np.arange(len(windows) + 1))
    split_windows = split(pa.array(windows, pa.large_string()))
    encoded = split_windows.words.dictionary_encode()
    lengths = np.diff(split_windows.offsets)
    matrix = np.zeros((len(windows), int(lengths.max(initial=1))), np.int32)
    row = split_windows.owners()
    column = matrix.shape[1] - split_windows.offsets[row + 1] + np.arange(len(row))
    symbols = encoded.indices.to_numpy() + 1
    matrix[row, column] = symbols
    shortest = np.full(len(encoded.dictionary) + 1, WINDOW + 1)
    np.minimum.at(shortest, symbols, lengths[row])
    return Phrases(
        encoded.dictionary, matrix, lengths, offsets, of_item[order], _objects(items), shortest
    )


def _objects(items) -> np.ndarray:
    out = np.empty(len(items), object)
    out[:] = [None if pd.isna(i) else i for i in items]
    return out


def stretches(symbols: np.ndarray, text: np.ndarray, shortest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of words that an occurrence can be at, and the lengths of the stretches they form.

    An occurrence has only words of the benchmark (symbols above 0) and lies in one text. A word that is only in
    longer windows than its stretch has words is left out too, until nothing changes.
    """
    at = np.flatnonzero(symbols)
    while True:
        breaks = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(text[at], prepend=-1) != 0))
        lengths = np.diff(np.append(breaks, len(at)))
        fits = shortest[symbols[at]] <= np.repeat(lengths, lengths)
        if fits.all():
            return at, lengths
        at = at[fits]


def hits(texts: pa.Array, phrases: Phrases) -> Hits:
    """What occurs in a shard of texts (large strings without nulls)."""
    found = words(texts)
    n_words, text = np.diff(found.offsets), found.owners()
    symbols = pc.fill_null(pc.index_in(found.words, value_set=phrases.vocabulary), -1).to_numpy() + 1
    at, lengths = stretches(symbols, text, phrases.shortest)
    nothing = np.zeros(0, np.int64)
    if not len(at):
        return Hits(n_words, nothing, nothing, nothing, nothing, np.zeros(0, object))
    index = FmIndex(symbols[at].astype(np.int64), lengths, len(phrases.shortest))
    low, high = index.search(phrases.windows, phrases.lengths)
    window = np.repeat(np.arange(len(low)), high - low)
    rows = np.arange(len(window)) - np.repeat(np.cumsum(high - low) - high, high - low)
    start = at[index.locate(rows)]

    # A word is hit if more occurrences have begun up to it than have ended.
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + phrases.lengths[window], -1)
    hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    begins = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(text[hit], prepend=-1) != 0))
    ends = np.append(begins[1:], len(hit))[: len(begins)] - 1
    span_text = text[hit[begins]]
    base = found.offsets[span_text]

    pair = np.unique(text[start] * len(low) + window)
    pair_text, pair_window = pair // max(1, len(low)), pair % max(1, len(low))
    n_items = np.diff(phrases.offsets)[pair_window]
    owner = np.arange(n_items.sum()) - np.repeat(np.cumsum(n_items) - n_items - phrases.offsets[pair_window], n_items)
    pair = np.unique(np.repeat(pair_text, n_items) * len(phrases.items) + phrases.owners[owner])
    n = max(1, len(phrases.items))
    return Hits(n_words, span_text, hit[begins] - base, hit[ends] + 1 - base, pair // n, phrases.items[pair % n])


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, item): the distinct windows of every item.

    A null text or one without words has none. Items under one id count as one item. An item without an id still has
    windows, of no item, so that its words are hit and no id is listed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, block in blocks_of(pa.array(batch["text"], pa.large_string())):
                found = words(block)
                items = batch["item"].iloc[start : start + len(block)]
                for item, a, b in zip(items, found.offsets[:-1], found.offsets[1:], strict=True):
                    own = found.words[a:b].to_pylist()
                    last = max(1, len(own) - WINDOW + 1) if own else 0
                    some = {" ".join(own[i : i + WINDOW]) for i in range(last)}
                    yield pd.DataFrame({"window": list(some), "item": [item] * len(some)}, dtype=object)

    rows = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInPandas(run, "window string, item string").distinct()


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    output: str = "passages",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Add a struct of the number of words, the merged spans (start, end) of words hit, and the ids of the items.

    A word is hit if an occurrence of a window covers it: ten consecutive words of an item, or all words of an item
    that has fewer. Every row stays and equal texts have equal results. A null, empty or wordless text has no words;
    an empty benchmark hits nothing. An existing column called `output` is replaced; others stay.

    The windows are broadcast, at most some `block_windows` of them at a time. Those of a larger benchmark go in
    several blocks, one more look at each text in the same job for each, and the spans are merged.
    """
    spark = docs.sparkSession
    table = materialize(windows(benchmark), f"{scratch_dir(spark)}/windows")
    n_blocks = max(1, math.ceil(table.count() / block_windows))
    block = F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks))
    text = F.col(f"`{text_col}`").cast("string")
    found = []
    for number in range(n_blocks):
        shared = spark.sparkContext.broadcast(phrases_of(table.filter(block == number).toPandas()))
        found.append(_finder(shared)(text))
    if n_blocks == 1:
        return docs.withColumn(output, found[0])
    return docs.withColumn(output, _union(F.array(*found)))


def _finder(shared):
    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        parts = [_as_structs(hits(block, shared.value)) for _, block in blocks_of(texts)]
        return pa.concat_arrays(parts) if parts else _as_structs(hits(pa.array([], pa.large_string()), shared.value))

    return find


def _as_structs(found: Hits) -> pa.Array:
    n = len(found.n_words)
    span = pa.StructArray.from_arrays([pa.array(found.start, pa.int64()), pa.array(found.end, pa.int64())], ["start", "end"])
    known = np.array([i is not None for i in found.item], bool)
    of_spans = np.searchsorted(found.span_text, np.arange(n + 1)).astype(np.int32)
    order = np.lexsort((found.item[known].astype(str), found.item_text[known]))
    of_items = np.searchsorted(found.item_text[known], np.arange(n + 1)).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(found.n_words, pa.int64()),
            pa.ListArray.from_arrays(of_spans, span),
            pa.ListArray.from_arrays(of_items, pa.array(found.item[known][order], pa.string())),
        ],
        ["n_words", "spans", "items"],
    )


@F.pandas_udf(_FOUND)
def _union(found: pd.Series) -> pd.DataFrame:
    """What several blocks of windows found in each text, as one."""
    rows = []
    for parts in found:
        spans = []
        for start, end in sorted((s["start"], s["end"]) for part in parts for s in part["spans"]):
            if spans and start <= spans[-1]["end"]:
                spans[-1]["end"] = max(end, spans[-1]["end"])
            else:
                spans.append({"start": start, "end": end})
        items = sorted({i for part in parts for i in part["items"]})
        rows.append((parts[0]["n_words"], spans, items))
    return pd.DataFrame(rows, columns=_FOUND.names)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if s is None else remove(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, spans)])


def remove(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between those of a span."""
    places = [m.span() for m in _WORD_OF_RAW.finditer(text)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*kept, text[at:]])


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with the hit passages cut out of their texts; all rows, columns and other texts stay."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    own = f"c{docs.columns.index(text_col)}"
    found = find_passages(docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")), benchmark)
    dirty = F.size("passages.spans") > 0
    cut = _without(F.when(dirty, F.col("text")), F.when(dirty, F.col("passages.spans")))
    changed = F.when(dirty, cut).otherwise(F.col(f"row.{own}"))
    columns = [changed if f"c{i}" == own else F.col(f"row.c{i}") for i in range(len(docs.columns))]
    return found.select(*[c.alias(name) for c, name in zip(columns, docs.columns, strict=True)])
