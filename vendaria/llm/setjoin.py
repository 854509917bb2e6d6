"""What the set-similarity joins share: token sets of texts, a global order by rarity, and exact verification.

Tokens are 64-bit hashes. Their order is by frequency, rarest first, and then by hash. Frequencies come from a sketch
of `1 << SKETCH_BITS` counters, filled from all documents: a token's counter is never below its frequency. The sketch
has a fixed size, so it can be broadcast; where it is too coarse the joins have more candidates to verify, and the
same result. Equal sets have one 64-bit fingerprint, which names them, and only different sets are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vendaria.llm.words import mixed
from vendaria.sources.scratch import materialize

SKETCH_BITS = 21
#: Counters that travel together.
CHUNK = 1 << 13

#: Sets (at most 2^16, see `sorted_sets`) and characters that a task holds as arrays at a time.
BLOCK_SETS = 1 << 16
BLOCK_CHARS = 1_000_000

#: Bytes of rows that a task sends to Python at once, the last row whole, as all tasks share the executors' memory.
#: Spark's own limit is 64 MB, which a task holds several times.
BATCH_BYTES = 4 << 20

#: Rows that a task decodes of a Parquet file at once. The texts of 4096, Spark's own number, take arrays of 16 MB and
#: more, and each such array needs as much of the heap in one piece.
SCAN_ROWS = 512

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def in_small_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python in batches of BATCH_BYTES, and decodes SCAN_ROWS of them at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


class Items(NamedTuple):
    """The sets of a block of texts: each item's text and number in it, and all tokens with the item they are in.

    Tokens are ordered by item; a token may come several times.
    """

    text: np.ndarray
    number: np.ndarray
    owner: np.ndarray
    token: np.ndarray


Tokenizer = Callable[[list[str]], Items]


def folded(values: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A hash of `width` values in a row from each place on."""
    out = np.full(len(at), width, np.uint64)
    for k in range(width):
        out = mixed(out * _FACTOR + values[at + k])
    return out


def sorted_sets(owner: np.ndarray, token: np.ndarray, rank: np.ndarray | None = None):
    """Owner and token of each set's distinct tokens, by owner, rank (below 64) and token.

    One key holds owner, rank and the upper bits of the token, and is sorted at once. Should two different tokens
    of a set agree in it, all are sorted by all three.
    """
    rank = np.zeros(len(token), np.uint64) if rank is None else rank.astype(np.uint64)
    key = (owner.astype(np.uint64) << np.uint64(48)) | (rank << np.uint64(42)) | (token >> np.uint64(22))
    order = np.argsort(key)
    key, sorted_token = key[order], token[order]
    same = key[1:] == key[:-1]
    if np.any(same & (sorted_token[1:] != sorted_token[:-1])):
        order = np.lexsort((token, rank, owner))
        sorted_token = token[order]
        same = (sorted_token[1:] == sorted_token[:-1]) & (owner[order][1:] == owner[order][:-1])
    first = np.concatenate([[True], ~same])[: len(order)]
    return owner[order[first]], sorted_token[first]


def fingerprints(owner: np.ndarray, token: np.ndarray, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and fingerprint of each set, as a signed number; 0 for empty ones."""
    sizes = np.bincount(owner, minlength=n_sets)
    names = np.zeros(n_sets, np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        sums = np.add.reduceat(mixed(token), (np.cumsum(sizes) - sizes)[full])
        names[full] = mixed(sums * _FACTOR + sizes[full].astype(np.uint64))
    return sizes, names.view(np.int64)


def parity(token: np.ndarray, sizes: np.ndarray, n_longs: int) -> np.ndarray:
    """Rows of 64 bits for each set: whether an odd number of its tokens falls on the bit.

    Sets that differ in d tokens differ in d bits at most, however large they are.
    """
    out = np.zeros((n_longs, len(sizes)), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full) and n_longs:
        starts = (np.cumsum(sizes) - sizes)[full]
        place = mixed(token)
        bit = np.uint64(1) << (place & np.uint64(63))
        row = (place >> np.uint64(6)) % np.uint64(n_longs)
        for k in range(n_longs):
            out[k, full] = np.bitwise_xor.reduceat(np.where(row == k, bit, np.uint64(0)), starts)
    return out.view(np.int64)


def bit_columns(n_longs: int) -> list[str]:
    return [f"bits{k}" for k in range(n_longs)]


def may_be_similar(percent: int, n_longs: int, a: str = "_a", b: str = "_b") -> Column:
    """Filters for two sets that share a token, by the suffixes of their columns n, place and the bits.

    Sizes differ by the threshold at most. Before the token there are at most as many shared ones as the smaller of
    its places, and from it on at most as many as the shorter rest has. And similar sets differ in few bits.
    """
    n_a, n_b, place_a, place_b = (F.col(c) for c in (f"n{a}", f"n{b}", f"place{a}", f"place{b}"))
    both = n_a + n_b
    lengths = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    most = F.least(place_a, place_b) + F.least(n_a - place_a, n_b - place_b)
    passes = lengths & ((100 + percent) * most >= percent * both)
    return passes & bits_may_be_similar(percent, n_longs, a, b) if n_longs else passes


def bits_may_be_similar(percent: int, n_longs: int, a: str = "_a", b: str = "_b") -> Column:
    """The filter by bits alone."""
    both = [(F.col(f"{c}{a}"), F.col(f"{c}{b}")) for c in bit_columns(n_longs)]
    differ = reduce(add, [F.bit_count(one.bitwiseXOR(two)) for one, two in both])
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"n{a}") + F.col(f"n{b}"))


def blocks(batches: Iterator[pa.RecordBatch], *text_cols: str) -> Iterator[tuple]:
    """Rows of at most so many characters, or one row, with their texts by column.

    Only the texts of one block are Python strings at a time.
    """
    for batch in batches:
        length = np.ones(batch.num_rows, np.int64)
        for column in text_cols:
            length += pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(length)
        start = 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = int(np.searchsorted(total, done + BLOCK_CHARS, side="right"))
            end = min(max(end, start + 1), start + BLOCK_SETS)
            rows = batch.slice(start, end - start)
            yield rows, *[[t or "" for t in rows.column(c).to_pylist()] for c in text_cols]
            start = end
    # The worker lives on, and what it keeps counts for the executor.
    pa.default_memory_pool().release_unused()


def parts_of(items: Items) -> Iterator[Items]:
    """At most `BLOCK_SETS` items at a time, numbered from 0."""
    for at in range(0, len(items.text), BLOCK_SETS):
        end = min(at + BLOCK_SETS, len(items.text))
        a, b = np.searchsorted(items.owner, [at, end])
        yield Items(items.text[at:end], items.number[at:end], items.owner[a:b] - at, items.token[a:b])


class Sketch(NamedTuple):
    """Counters of all tokens."""

    counts: np.ndarray

    def count(self, token: np.ndarray) -> np.ndarray:
        return self.counts[(token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]

    @staticmethod
    def rank(count: np.ndarray) -> np.ndarray:
        """Two ranks for each doubling, so that tokens of like frequency are ordered by hash."""
        return np.minimum(63, 2 * np.log2(np.maximum(1, count))).astype(np.uint64)


_SIZES = [
    ("item_key", pa.int64()),
    ("text_key", pa.int64()),
    ("number", pa.int32()),
    ("n", pa.int32()),
    ("set", pa.int64()),
]
_COUNTS = [("chunk", pa.int32()), ("counts", pa.binary())]
_SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and a hash of the text, which tells rows of the same id apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("item_key"), text.alias("text")).withColumn(
        "text_key", F.xxhash64("text")
    )


def measured(docs: DataFrame, tokenize: Tokenizer, path: str, n_longs: int = 0) -> tuple[DataFrame, Sketch]:
    """One pass over all texts: every set's size and fingerprint, as a table, and the sketch of all tokens.

    `docs` is what `keyed` returns. Rows of the table: item_key, text_key, number (of the set in its text), n, set, and
    as many longs of `parity` as are asked for.
    """
    schema = pa.schema([*_SIZES, *[(c, pa.int64()) for c in bit_columns(n_longs)], *_COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch, texts in blocks(batches, "text"):
            for part in parts_of(tokenize(texts)):
                owner, token = sorted_sets(part.owner, part.token)
                slots, found = np.unique(_slots(token), return_counts=True)
                counts[slots] += found  # without a second table of all counters
                sizes, names = fingerprints(owner, token, len(part.text))
                n = len(sizes)
                columns = [
                    batch.column("item_key").take(pa.array(part.text)),
                    batch.column("text_key").take(pa.array(part.text)),
                    pa.array(part.number, pa.int32()),
                    pa.array(sizes, pa.int32()),
                    pa.array(names),
                    *[pa.array(bits) for bits in parity(token, sizes, n_longs)],
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        pieces = counts.reshape(-1, CHUNK)
        filled = np.flatnonzero(pieces.any(axis=1))
        small = np.uint16 if counts.max() < 1 << 16 else np.int64
        columns = [pa.nulls(len(filled), t) for t in schema.types[:-2]]
        columns += [
            pa.array(filled, pa.int32()),
            pa.array([pieces[c].astype(small).tobytes() for c in filled], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    types = ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)
    rows = materialize(docs.select("item_key", "text_key", "text").mapInArrow(run, types), path)
    sizes = rows.filter("chunk IS NULL").drop("chunk", "counts")
    pieces = rows.filter("chunk IS NOT NULL").select("chunk", "counts", F.spark_partition_id().alias("salt"))
    pieces = pieces.withColumn("salt", F.col("salt") % 16)
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in _summed(_summed(pieces, "chunk", "salt"), "chunk").select("chunk", "counts").toLocalIterator():
        counts[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], np.int64)
    # Every worker holds the counters, so they go in half the memory if they fit.
    return sizes, Sketch(counts if counts.max() >> 32 else counts.astype(np.uint32))


def _slots(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _summed(pieces: DataFrame, *by: str) -> DataFrame:
    """Sums of equal chunks, row by row as they come in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for chunk, salt, counts in zip(batch["chunk"], batch["salt"], batch["counts"], strict=True):
                values = np.frombuffer(counts, np.uint16 if len(counts) == 2 * CHUNK else np.int64)
                key = chunk, salt if "salt" in by else 0
                sums[key] = sums[key] + values if key in sums else values.astype(np.int64)
        out = [(chunk, salt, values.tobytes()) for (chunk, salt), values in sums.items()]
        yield pd.DataFrame(out, columns=["chunk", "salt", "counts"])

    return pieces.repartition(*by).mapInPandas(run, "chunk int, salt int, counts binary")


#: Parts of `info`: a set's size, the token's place in it, and a small number of the join's own.
PLACE_BITS, OWN_BITS = 28, 6


def entries(docs: DataFrame, tokenize: Tokenizer, sketch: Sketch, prefix: Callable, n_longs: int = 0) -> DataFrame:
    """token, set (its fingerprint), info and `n_longs` of bits of the tokens in each set's prefix, rarest first.

    `prefix(sizes, owner, place, count)` says for every token whether it belongs and, for every set, its own number.
    A task sends the tokens of each different set once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    schema = pa.schema([(c, pa.int64()) for c in ("token", "set", "info", *bit_columns(n_longs))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent = shared.value, set()
        for _, texts in blocks(batches, "text"):
            for part in parts_of(tokenize(texts)):
                if not len(part.token):
                    continue
                owner, token = sorted_sets(part.owner, part.token, known.rank(known.count(part.token)))
                sizes, names = fingerprints(owner, token, len(part.text))
                fresh = np.array([f not in sent and not sent.add(f) for f in names.tolist()], bool) & (sizes > 0)
                place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
                inside, own = prefix(sizes, owner, place, known.count(token))
                at = np.flatnonzero(inside & fresh[owner])
                info = (sizes[owner[at]] << (PLACE_BITS + OWN_BITS)) | (place[at] << OWN_BITS) | own[owner[at]]
                columns = [token[at].view(np.int64), names[owner[at]], info, *parity(token, sizes, n_longs)[:, owner[at]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return docs.select("text").mapInArrow(run, ", ".join(f"{c} long" for c in schema.names))


def shared_entries(found: DataFrame, percent: int, path: str) -> DataFrame:
    """The entries that may have a partner, once for each set: token, set, n, place, own.

    A token's sets are sorted by size. A set may have a partner if the next smaller or larger one is similar in size.
    """
    info = F.col("info")
    parts = {"n": n_of(info), "place": place_of(info), "own": own_of(info)}
    by_size = Window.partitionBy("token").orderBy("n", "set")
    found = found.withColumns({k: c.cast("int") for k, c in parts.items()}).drop("info")
    found = found.withColumns({"before": F.lag("set").over(by_size), "smaller": F.lag("n").over(by_size)})
    found = found.withColumns({"after": F.lead("set").over(by_size), "larger": F.lead("n").over(by_size)})
    # The same set, sent by several tasks, comes several times in a row: the first one stays and looks beyond.
    first = F.col("before").isNull() | (F.col("before") != F.col("set"))
    alike = (100 * F.col("smaller") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("larger"))
    repeated = F.col("after") == F.col("set")
    found = found.filter(first & F.coalesce(alike | repeated, F.lit(False)))
    return materialize(found.select("token", "set", "n", "place", "own"), path)


#: A table of so many rows, of a few numbers each, is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 250_000


def within_bound(table: DataFrame, length: Column | None = None) -> DataFrame:
    """`table`, a written one, marked for a broadcast if it has few enough rows.

    `length` is the length of an array in each row: its numbers count as rows too.
    """
    size = F.count(F.lit(1)) if length is None else F.coalesce(F.sum(length + 1), F.lit(0))
    return F.broadcast(table) if table.agg(size).first()[0] <= BROADCAST_ROWS else table


def position() -> Column:
    """The order of items: by id, rows without one last, then by the text's hash and the item's number in it."""
    return F.struct(F.col("item_key").isNull().alias("no_id"), "item_key", "text_key", "number")


def distinct_sets(sizes: DataFrame, path: str, n_longs: int = 0) -> DataFrame:
    """Every set once: where it comes first (`at`), how many times, its size and bits.

    It is made once, before any join, so that a set that much of the corpus has is counted by each task before the
    shuffle; what follows finds each set in one row.
    """
    columns = [F.first(c).alias(c) for c in ("n", *bit_columns(n_longs))]
    rows = sizes.filter("n > 0").groupBy("set")
    return materialize(rows.agg(F.min(position()).alias("at"), F.count(F.lit(1)).alias("times"), *columns), path)


def texts_of(docs: DataFrame, sets: DataFrame, wanted: DataFrame, path: str, part=None) -> DataFrame:
    """set and text, from the first document that has it, of the `wanted` sets (column `set`).

    `sets` is what `distinct_sets` returns. `part` picks the item's own text. A document may have no id, so ids are
    compared with nulls.
    """
    places = sets.join(wanted.distinct(), "set", "left_semi").select(
        "set", F.col("at.item_key").alias("at_item"), F.col("at.text_key").alias("at_text"), "at.number"
    )
    places = materialize(places, f"{path}-places")
    text = F.col("text") if part is None else part(F.col("text"), F.col("number"))
    on = (F.col("text_key") == F.col("at_text")) & F.col("item_key").eqNullSafe(F.col("at_item"))
    found = docs.join(within_bound(places), on).select("set", text.alias("text"))
    # Rows that repeat in the input give their text twice.
    return materialize(found.groupBy("set").agg(F.first("text").alias("text")), path)


def n_of(info: Column) -> Column:
    return F.shiftright(info, PLACE_BITS + OWN_BITS)


def place_of(info: Column) -> Column:
    return F.shiftright(info, OWN_BITS).bitwiseAND((1 << PLACE_BITS) - 1)


def own_of(info: Column) -> Column:
    return info.bitwiseAND((1 << OWN_BITS) - 1)


def verified(pairs: DataFrame, texts: DataFrame, tokenize: Tokenizer, percent: int) -> DataFrame:
    """Those `pairs` (a, b) whose sets have 100 * intersection >= percent * union.

    `texts` holds the text of each set, with one item in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text_a, text_b in blocks(batches, "text_a", "text_b"):
            yield rows.select(["a", "b"]).filter(pa.array(_similar(text_a, text_b, tokenize, percent)))

    of_b = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    of_a = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _similar(text_a: list[str], text_b: list[str], tokenize: Tokenizer, percent: int) -> np.ndarray:
    """The sets of both sides by pair; a token that comes twice is in both."""
    n, sides = len(text_a), []
    for texts in (text_a, text_b):
        items = tokenize(texts)
        sides.append(sorted_sets(items.owner, items.token))
    sizes = sum(np.bincount(owner, minlength=n) for owner, _ in sides)
    owner, token = (np.concatenate(x) for x in zip(*sides, strict=True))
    order = np.lexsort((token, owner))
    owner, token = owner[order], token[order]
    twice = (owner[1:] == owner[:-1]) & (token[1:] == token[:-1])
    both = np.bincount(owner[1:][twice], minlength=n)
    return 100 * both >= percent * (sizes - both)
