"""Runs of words that repeat with a period, in whole documents, and texts with each run cut down to one period."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.arrow_words import blocks_of, split
from vendaria.llm.repair import Runs, runs
from vendaria.llm.words import mixed

#: Every three words in a row that stand in a run stand there so many times.
TIMES = 3
#: Counters for each word of a block.
SPREAD = 8

_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)


def find_runs(docs: DataFrame, text_col: str = "text", output: str = "periodic") -> DataFrame:
    """Add a struct of the number of words, the runs (start, length, period, by start and period) and the text without
    repetitions.

    A run is a stretch of words with the smallest period q and at least max(6, 4q) words that no neighbouring word
    continues. The text without repetitions has the words, joined by blanks, that no run holds after its first period.

    Every row stays and equal texts have equal results; whole texts are read, each by itself. A null, empty or blank
    text has no words, no runs and an empty collapsed text. An existing column called `output` is replaced; others
    stay.
    """

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        parts = [_as_structs(block) for _, block in blocks_of(texts)]
        return pa.concat_arrays(parts) if parts else _as_structs(pa.array([], pa.large_string()))

    return docs.withColumn(output, found(F.col(f"`{text_col}`").cast("string")))


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the collapsed text where a text has a run; all rows, columns and other texts stay."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    own = docs.columns.index(text_col)
    found = find_runs(docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")))
    changed = F.when(F.size("periodic.runs") > 0, F.col("periodic.collapsed")).otherwise(F.col(f"row.c{own}"))
    columns = [changed if i == own else F.col(f"row.c{i}") for i in range(len(docs.columns))]
    return found.select(*[c.alias(name) for c, name in zip(columns, docs.columns, strict=True)])


def _as_structs(texts: pa.Array) -> pa.Array:
    found = split(texts)
    encoded = found.words.dictionary_encode()
    word, text = encoded.indices.to_numpy().astype(np.int64), found.owners()
    per_text = runs_of(word, text, len(encoded.dictionary))
    of = text[per_text.start]
    base = found.offsets[of]
    n = len(texts)
    columns = [per_text.start - base, per_text.end - per_text.start, per_text.period]
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
    offsets = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    # Words after a run's first period go.
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, per_text.start + per_text.period, 1)
    np.add.at(change, per_text.end, -1)
    kept = np.cumsum(change[:-1]) == 0
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(found.offsets), pa.int64()),
            pa.ListArray.from_arrays(offsets, structs),
            _joined(found.words, found.offsets, kept),
        ],
        ["n_words", "runs", "collapsed"],
    )


def _joined(words: pa.Array, offsets: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by blanks."""
    some = words.filter(pa.array(kept)) if not kept.all() else words
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), some)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def runs_of(word: np.ndarray, text: np.ndarray, n_symbols: int) -> Runs:
    """The runs of words (numbers below `n_symbols`) in texts, by place.

    Three words in a row that a run holds come at least three times in it. So a text is cut at the words of which none
    of the three in a row that begin there comes that often, and what is left of it goes through the grammar.
    """
    at, stretch = _repetitive(word, text)
    found = runs(word[at], stretch, n_symbols)
    return Runs(at[found.start], at[found.end - 1] + 1, found.period)


def _repetitive(word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that a run can be at, and the number of the stretch of words each is in.

    Counters are by hash, so that they may be too high and never too low: what is left over has no run, and is only
    looked at in vain.
    """
    begins = np.flatnonzero(text[2:] == text[:-2]) if len(word) > 2 else np.zeros(0, np.int64)
    if not len(begins):
        return begins, begins
    value = mixed(text[begins].astype(np.uint64) * _FACTOR)
    for k in range(3):
        value = mixed((value + word[begins + k].astype(np.uint64)) * _FACTOR)
    size = 1 << int(SPREAD * len(begins)).bit_length()
    slot = (value & np.uint64(size - 1)).astype(np.int64)
    often = begins[np.bincount(slot, minlength=size)[slot] >= TIMES]
    # The shortest run, of six words, has four of them in a row.
    first = np.flatnonzero((np.diff(often, prepend=-2) != 1) | (np.diff(text[often], prepend=-1) != 0))
    length = np.diff(np.append(first, len(often)))
    long = length >= 4
    starts, lengths = often[first[long]], length[long] + 2
    stretch = np.repeat(np.arange(len(starts)), lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[stretch]
    return at, stretch
