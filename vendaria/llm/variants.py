"""Words of a corpus and their spelling variants: words one edit apart, found by an index of grams of variable length.

Grams have two to four code points. The dictionary holds the frequent ones of two and three: a gram is as long as it
needs to be to be rare, so that lists of the words with a gram, at a place, stay short.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.llm.arrow_words import blocks_of, bytes_of, split, with_bytes
from vendaria.sources.scratch import materialize, scratch_dir

#: As a regular expression, before A-Z are put in lower case.
WORD = r"[A-Za-zÀ-ÿ]+"

MIN_LENGTH, MIN_COUNT = 5, 3

SHORT, LONG = 2, 4
#: Neither stands in a word.
BEGIN, END = "^" * (LONG - 1), "$" * (LONG - 1)
#: A gram of the dictionary makes up more than this share of all grams of its length, so there are at most as many.
SHARE = 1 << 16

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)

#: Bytes of a word up to which checksums are put together from those of the id and of the word.
CHECKED = 64
#: What a zero byte does to the lowest byte of a sum.
_CRC = np.array([zlib.crc32(b"\0", b) ^ zlib.crc32(b"\0", 0) for b in range(256)], np.uint32)


def words(texts: pa.Array):
    """The words of texts (large strings without nulls), in lower case."""
    data = bytes_of(texts)
    after = np.concatenate([[False], data[:-1] == 0xC3])  # U+00C0 to U+00FF are 0xC3 and any byte that may follow it
    return split(with_bytes(texts, np.where((data == 0xC3) | after, data, np.maximum(_LETTERS[data], 32))))


def checksums(prefix: np.ndarray, length: np.ndarray, own: np.ndarray) -> np.ndarray:
    """CRC-32 of texts of which the first part has the sum `prefix` and the rest, of at most CHECKED bytes, `own`.

    The sum of the first part goes through as many zero bytes as the rest has, and the two are added.
    """
    steps = int(length.max(initial=0))
    moved = prefix.astype(np.uint32)
    out = np.where(length == 0, moved, np.uint32(0))
    for n in range(1, steps + 1):
        moved = _CRC[moved & np.uint32(255)] ^ (moved >> np.uint32(8))
        out = np.where(length == n, moved, out)
    return out ^ own


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    typo_every: int | None = None,
) -> DataFrame:
    """(word, n): the words of at least `min_length` code points that come at least `min_count` times in all texts.

    `typo_every` plants typing errors: a word loses a code point in the documents where the CRC-32 of `id:word` is
    divisible by it, at the place that the sum names. A null id reads as an empty one. Null, empty and wordless texts
    have no words; repeated rows count again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, texts in blocks_of(batch.column(1)):
                counts = _counted(texts, ids[start : start + len(texts)], min_length, typo_every)
                yield pa.RecordBatch.from_arrays([*counts], names=["word", "n"])

    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`").cast("string")
    )
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _counted(texts: pa.Array, ids: list[str], min_length: int, typo_every: int | None) -> tuple[pa.Array, pa.Array]:
    """The words of some texts and how often each comes; a word may be listed twice."""
    found = words(texts)
    encoded = found.words.dictionary_encode()
    names, word = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
    changed: Counter = Counter()
    if typo_every and len(word):
        text, length = found.owners(), pc.binary_length(names).to_numpy()
        spelt = [w.encode() for w in names.to_pylist()]
        own = np.array([zlib.crc32(w) for w in spelt], np.uint32)
        prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        sums = np.zeros(len(word), np.uint32)
        # By length, as most words are short.
        for low, high in ((0, 8), (8, 16), (16, CHECKED)):
            some = np.flatnonzero((length[word] > low) & (length[word] <= high))
            sums[some] = checksums(prefix[text[some]], length[word[some]], own[word[some]])
        for i in np.flatnonzero(length[word] > CHECKED):
            sums[i] = zlib.crc32(spelt[word[i]], int(prefix[text[i]]))
        hit = sums % np.uint32(typo_every) == 0
        for w, s in zip(word[hit].tolist(), sums[hit].tolist(), strict=True):
            full = spelt[w].decode()
            at = s % len(full)
            changed[full[:at] + full[at + 1 :]] += 1
        word = word[~hit]
    n = np.bincount(word, minlength=len(names))
    typos = [w for w in changed if len(w) >= min_length]
    names = pa.concat_arrays([names.cast(pa.string()), pa.array(typos, pa.string())])
    n = np.concatenate([n, np.array([changed[w] for w in typos], np.int64)])
    kept = pa.array((n > 0) & (pc.utf8_length(names).to_numpy() >= min_length))
    return names.filter(kept), pa.array(n, pa.int64()).filter(kept)


def grams(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """The places (from, to) of the grams of a word between its marks.

    At each place a gram is as short as it can be without being frequent, and at most LONG; one that lies within an
    earlier one is left out. Whether a gram ends depends on its own characters only.
    """
    out = []
    farthest, n = 0, len(word)
    for start in range(n - SHORT + 1):
        end = start + SHORT
        while end < n and end - start < LONG and word[start:end] in frequent:
            end += 1
        if end > farthest:
            out.append((start, end))
            farthest = end
    return out


def cost(gram: str, frequent: dict[str, int], least: int) -> float:
    """About how many words have the gram: its parts' counts, as if its ends did not depend on each other."""
    if len(gram) < LONG:
        return frequent.get(gram, least)
    middle = frequent.get(gram[1:-1], least)
    return frequent.get(gram[:-1], least) * frequent.get(gram[1:], least) / middle


def chosen(word: str, places: list[tuple[int, int]], frequent: dict[str, int], least: int, inserted: int):
    """Two grams, one of which is in every word that one edit makes: (from, to) before and after the edit.

    The edit replaces a character (`inserted` is 0) or puts one in (1). A gram that ends before it is not affected.
    One behind it is not affected if it ends too far behind for a gram that holds the edit to swallow it; those up to
    there, and the ones that hold the edit, may go. So a gram before serves all edits from its end on, and one behind
    all up to some place: the cheapest two are taken that serve all between them.
    """
    priced = [(cost(word[a:b], frequent, least), a, b) for a, b in places]
    best = None
    for price, a, b in priced:
        # Grams end in the order in which they begin.
        limit = min(a, b - LONG) + inserted
        before = [p for p in priced if p[2] <= limit]
        if before:
            one = min(before)
            if best is None or one[0] + price < best[0]:
                best = (one[0] + price, one[1:], (a, b))
    return best[1], best[2]


def group_variants(counted: DataFrame, path: str | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of `counted` (word, n; words once, of MIN_LENGTH or more).

    Two words are near if one inserted, deleted or replaced code point makes the one of the other. The form of a word
    is the near word with the greatest n (the smallest of several) if that is at least twice its own, else null. The
    root is where the forms lead. `path` is a folder for the steps.
    """
    spark = counted.sparkSession
    path = path or scratch_dir(spark)
    counted = materialize(counted.select("word", F.col("n").cast("long").alias("n")), f"{path}/words")
    near = materialize(near_words(counted, path), f"{path}/near")
    both = near.unionByName(near.select(F.col("a").alias("b"), F.col("n_a").alias("n_b"), F.col("b").alias("a"), F.col("n_b").alias("n_a")))
    first = F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")))
    summed = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    best_n = -F.col("best.n")
    strong = best_n >= 2 * F.col("n")
    formed = counted.join(summed, counted["word"] == summed["a"], "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.word")).alias("form"),
        F.when(strong, best_n).alias("form_n"),
    )
    formed = materialize(formed, f"{path}/formed")
    roots = _roots(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), path)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame, path: str) -> DataFrame:
    """Where the forms lead from each word that has one. Counts at least double, so no way is long, or a circle."""
    step = 0
    roots = materialize(forms, f"{path}/roots-0")
    while True:
        step += 1
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = roots.join(next_, "root", "left").select("word", F.coalesce("end", "root").alias("root"), "end")
        moved = materialize(moved, f"{path}/roots-{step}")
        roots = moved.select("word", "root")
        if moved.filter(F.col("end").isNotNull()).isEmpty():
            return roots


def near_words(counted: DataFrame, path: str) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words one edit apart once; `a` is the shorter or smaller one."""
    spark = counted.sparkSession
    frequent, least = dictionary(counted)
    shared = spark.sparkContext.broadcast((frequent, least))

    def run(batches: Iterator[pd.DataFrame], lists: Callable) -> Iterator[pd.DataFrame]:
        common, few = shared.value
        for batch in batches:
            rows = [
                (key, word, n)
                for word, n in zip(batch["word"], batch["n"], strict=True)
                for key in lists(f"{BEGIN}{word}{END}", common, few)
            ]
            yield pd.DataFrame(rows, columns=["key", "word", "n"])

    schema = "key string, word string, n long"
    index = counted.mapInPandas(lambda batches: run(batches, _index_keys), schema)
    probes = counted.mapInPandas(lambda batches: run(batches, _probe_keys), schema)
    b, a = index.toDF("key", "b", "n_b"), probes.toDF("key", "a", "n_a")
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    found = a.join(b, "key").filter(ordered & (F.levenshtein("a", "b", 1) == 1))
    return found.select("a", "n_a", "b", "n_b").distinct()


def _index_keys(word: str, frequent: dict[str, int], least: int) -> Iterator[str]:
    """The lists that a word is in: each gram with its place, and the word's length."""
    for a, b in grams(word, frequent):
        yield f"{len(word)} {a} {word[a:b]}"


def _probe_keys(word: str, frequent: dict[str, int], least: int) -> Iterator[str]:
    """The lists of the words of the same length, and one longer, that can be near."""
    places = grams(word, frequent)
    for inserted in (0, 1):
        before, after = chosen(word, places, frequent, least, inserted)
        yield f"{len(word) + inserted} {before[0]} {word[slice(*before)]}"
        yield f"{len(word) + inserted} {after[0] + inserted} {word[slice(*after)]}"


def dictionary(counted: DataFrame) -> tuple[dict[str, int], int]:
    """The frequent grams shorter than LONG with their counts, and the count up to which a gram is not frequent.

    The count grows with the number of grams, so the dictionary has at most SHARE of each length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter(
                word[i : i + length]
                for word in (BEGIN + batch["word"] + END)
                for length in range(SHORT, LONG)
                for i in range(len(word) - length + 1)
            )
            yield pd.DataFrame({"gram": list(counts), "n": list(counts.values())})

    places = F.sum(F.length("word") + 2 * len(BEGIN) - SHORT + 1)
    least = max(1, (counted.agg(places.alias("n")).first()["n"] or 0) // SHARE)
    all_grams = counted.select("word").mapInPandas(run, "gram string, n long")
    found = all_grams.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    return {row["gram"]: row["n"] for row in found.collect()}, least
