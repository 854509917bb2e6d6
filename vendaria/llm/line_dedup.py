"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity; two lines whose Jaccard similarity is at least t share a
word among the first n - ceil(t n) + 1 of either (prefix filter). A shared word at places i and j leaves room for at
most min(i, j) shared words before and as many after as the shorter rest has (positional filter), and sizes may differ
by the factor t (length filter). What passes is verified on the whole lines.

A line is removed if an earlier line is similar to it: earlier by document id, then by its number in the document.
Equal sets are joined by their fingerprint. Most words' lists are short, and their lines are compared one by one. In
a long list lines are first only compared with one of them, the earliest, then the most frequent, then any. A line
that is known to be removed needs no more partners, so what is left to compare pair by pair are the lines that stay
and the few that such hubs did not find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaria.llm.names import unused
from vendaria.llm.ngram_join import first_prefix
from vendaria.llm.setjoin import (
    Items,
    distinct_sets,
    entries,
    in_small_batches,
    keyed,
    may_be_similar,
    measured,
    n_of,
    place_of,
    position,
    texts_of,
    verified,
    within_bound,
)
from vendaria.llm.words import hashed_words
from vendaria.sources.scratch import discard, materialize, scratch_dir

#: Two lines of 40 words are similar if they differ in two.
PERCENT = 90

#: Rounds of hubs go on while the pairs left are more than so many for each entry, and get fewer by a tenth at least.
PAIRS_PER_ENTRY = 4
MOST_ROUNDS = 6

#: Lists of so many lines or fewer are compared line by line.
SHORT = 128

#: Stands for the one item of a text without any line of words.
NO_LINE = -1


def lines(texts: list[str]) -> Items:
    """The hashed words of each line that has any; a text without such a line is one empty item."""
    words = hashed_words(texts)
    new = np.ones(len(words.line), bool)
    new[1:] = words.line[1:] != words.line[:-1]
    text, number = words.text[new], (words.line - words.first_line[words.text])[new]
    without = np.setdiff1d(np.arange(len(texts)), text)
    place = np.argsort(np.concatenate([text, without]), kind="stable")
    moved = np.empty(len(place), np.int64)
    moved[place] = np.arange(len(place))
    owner = moved[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
    numbers = np.concatenate([number, np.full(len(without), NO_LINE)])
    return Items(np.concatenate([text, without])[place], numbers[place], owner, words.token)


def plain_prefix(percent: int):
    def prefix(sizes, owner, place, count):
        # A different set of at least its size and of enough similarity has to be possible.
        large = 100 * sizes >= percent * (sizes + 1)
        return (place < first_prefix(sizes, percent)[owner]) & large[owner], np.zeros(len(sizes), np.int64)

    return prefix


_PAIRS_ARROW = pa.schema([(c, pa.int64()) for c in ("a", "b", "token", "set", "n", "place", "bits0")])


def short_lists(found: DataFrame, percent: int, path: str) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that pass the filters in words' lists of at most `SHORT` lines; the entries of longer lists.

    Entries come sorted by word and size, in Arrow batches. Each is held against the next one of its list, the one
    after that, and so on, all lists at a time. No more than one short list is carried from batch to batch.
    """

    def pairs_of(rows: np.ndarray) -> pa.RecordBatch | None:
        token = rows[0]
        group = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]]))
        ends = np.searchsorted(group, group, side="right")
        one, two = [], []
        left = np.flatnonzero(ends - np.searchsorted(group, group) <= SHORT)
        for step in range(1, SHORT):
            left = left[left + step < ends[left]]
            # Sorted by size: whoever is too large for a line is followed by larger ones.
            left = left[100 * rows[2, left] >= percent * rows[2, left + step]]
            if not len(left):
                break
            a, b = rows[:, left], rows[:, left + step]
            good = _passes(a[2], a[3], a[4], b[2], b[3], b[4], percent)
            one.append(a[1][good])
            two.append(b[1][good])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (one, two))
        return _record({"a": np.minimum(a, b), "b": np.maximum(a, b)}) if len(a) else None

    def long_rows(rows: np.ndarray) -> pa.RecordBatch:
        return _record(dict(zip(("token", "set", "n", "place", "bits0"), rows, strict=True)))

    def split(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole lists: the long ones as entries, the others as pairs."""
        if not rows.shape[1]:
            return
        _, place, times = np.unique(rows[0], return_inverse=True, return_counts=True)
        long = times[place] > SHORT
        if long.any():
            yield long_rows(rows[:, long])
        if (found := pairs_of(rows[:, ~long]) if (~long).any() else None) is not None:
            yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, long_token, last = np.zeros((5, 0), np.int64), None, None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if not rows.shape[1]:
                continue
            key = rows[:2]
            fresh = np.ones(rows.shape[1], bool)  # several tasks may have sent the same set
            fresh[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            fresh[0] = last is None or tuple(key[:, 0]) != last
            last = tuple(key[:, -1])
            rows = rows[:, fresh]
            if long_token is not None:
                same = rows[0] == long_token
                if same.any():
                    yield long_rows(rows[:, same])
                    rows = rows[:, ~same]
            if not rows.shape[1]:
                continue
            rows = np.concatenate([carry, rows], axis=1)
            open_ = rows[0] == rows[0, -1]
            yield from split(rows[:, ~open_])
            carry = rows[:, open_]
            if carry.shape[1] > SHORT:
                long_token = carry[0, 0]
                yield long_rows(carry)
                carry = carry[:, :0]
        yield from split(carry)

    ordered = found.select("token", "set", n_of(F.col("info")).alias("n"), place_of(F.col("info")).alias("place"), "bits0")
    ordered = ordered.repartition("token").sortWithinPartitions("token", "n", "set")
    rows = ordered.mapInArrow(run, ", ".join(f"{c} long" for c in _PAIRS_ARROW.names))
    rows = materialize(rows, path)
    return rows.filter("a IS NOT NULL").select("a", "b").distinct(), rows.filter("token IS NOT NULL").drop("a", "b")


def _record(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[c]) if c in columns else pa.nulls(n, pa.int64()) for c in _PAIRS_ARROW.names]
    return pa.RecordBatch.from_arrays(arrays, schema=_PAIRS_ARROW)


def _passes(n_a, place_a, bits_a, n_b, place_b, bits_b, percent: int) -> np.ndarray:
    """Length, prefix, positional and bit filters, as in `may_be_similar` and `_other_pairs`."""
    both = n_a + n_b
    least = -(-percent * both // (100 + percent))
    lengths = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    first = (place_a <= n_a - least) & (place_b <= n_b - least)
    most = np.minimum(place_a, place_b) + np.minimum(n_a - place_a, n_b - place_b)
    differ = np.bitwise_count((bits_a ^ bits_b).view(np.uint64)).astype(np.int64)
    return lengths & first & (most >= least) & ((100 + percent) * differ <= (100 - percent) * both)


def repeated_sets(docs: DataFrame, sets: DataFrame, sketch, base: str, percent: int) -> DataFrame:
    """The sets (column `set`) for which a similar, different set comes earlier. `sets` holds each set once."""
    found = entries(docs, lines, sketch, plain_prefix(percent), n_longs=1)
    pairs, shared = short_lists(found, percent, f"{base}/lists")
    none = shared.select("set").filter("false")
    pairs = materialize(pairs, f"{base}/pairs-0")
    gone = materialize(none, f"{base}/gone-none")
    gone = _gone(docs, sets, pairs, gone, f"{base}/round-0", percent)
    if shared.isEmpty():
        return gone
    tried = pairs
    names = materialize(shared.select("set").distinct(), f"{base}/names")
    firsts = materialize(_firsts(sets, names), f"{base}/firsts")
    shared = materialize(shared.join(within_bound(firsts), "set"), f"{base}/placed")
    total, before = shared.count(), float("inf")
    left = _pairs_left(_with_state(shared, gone))
    hubs = [["at"], ["-times", "at"]]
    for step in range(1, MOST_ROUNDS + 1):
        if left <= PAIRS_PER_ENTRY * total or left > 0.9 * before:
            break
        by = hubs[step - 1] if step <= len(hubs) else [step]
        state = materialize(_with_state(shared, gone), f"{base}/state-{step}")
        pairs = materialize(_hub_pairs(state, by, percent).join(tried, ["a", "b"], "left_anti"), f"{base}/pairs-{step}")
        gone = _gone(docs, sets, pairs, gone, f"{base}/round-{step}", percent)
        tried = materialize(tried.unionByName(pairs), f"{base}/tried-{step}")
        before, left = left, _pairs_left(_with_state(shared, gone))
    state = materialize(_with_state(shared, gone), f"{base}/state-rest")
    rest = materialize(_other_pairs(state, percent).join(tried, ["a", "b"], "left_anti"), f"{base}/pairs-rest")
    return _gone(docs, sets, rest, gone, f"{base}/rest", percent)


def _firsts(sets: DataFrame, names: DataFrame) -> DataFrame:
    """Where each of the named sets comes first, and how often it comes."""
    return sets.join(within_bound(names), "set", "left_semi").select("set", "at", "times")


def _with_state(shared: DataFrame, gone: DataFrame) -> DataFrame:
    marked = gone.withColumn("gone", F.lit(True))
    return shared.join(within_bound(marked), "set", "left").withColumn("gone", F.coalesce("gone", F.lit(False)))


def _hub_pairs(state: DataFrame, by: list, percent: int) -> DataFrame:
    """Every entry with its word's hub, unless the later line of the two is known to go."""
    names = {"at": F.col("at"), "-times": (-F.col("times")).alias("often")}
    keys = [names[k] if k in names else F.xxhash64("set", F.lit(k)).alias("any") for k in by]
    columns = ["set", "n", "place", "bits0", "at", "gone"]
    hub = F.min(F.struct(*keys, F.struct(*columns).alias("hub"))).over(Window.partitionBy("token"))
    rows = state.withColumn("hub", hub["hub"])
    rows = rows.select(*[F.col(c).alias(f"{c}_a") for c in columns], *[F.col(f"hub.{c}").alias(f"{c}_b") for c in columns])
    later_goes = F.when(F.col("at_a") > F.col("at_b"), F.col("gone_a")).otherwise(F.col("gone_b"))
    return _distinct_pairs(rows.filter((F.col("set_a") != F.col("set_b")) & ~later_goes & may_be_similar(percent, 1)))


def _distinct_pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("set_a", "set_b").alias("a"), F.greatest("set_a", "set_b").alias("b")).distinct()


def _pairs_left(state: DataFrame) -> int:
    each = state.groupBy("token").agg(F.count_if(~F.col("gone")).alias("open"), F.count(F.lit(1)).alias("all"))
    return int(each.agg(F.sum(F.col("open") * F.col("all").cast("double"))).first()[0] or 0)


def _other_pairs(state: DataFrame, percent: int) -> DataFrame:
    """Every line that may still stay with all earlier ones that share a prefix word, by the filters.

    The first word that two similar lines share is at place n - a at most in either, if they have to share a words.
    """
    open_tokens = state.filter(~F.col("gone")).groupBy("token").agg(F.max("at").alias("last"))
    columns = ["set", "n", "place", "bits0", "at"]
    rows = state.join(open_tokens, "token").filter(F.col("at") <= F.col("last"))
    one = rows.select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    two = state.filter(~F.col("gone")).select("token", *[F.col(c).alias(f"{c}_b") for c in columns])
    least = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    first = (F.col("place_a") <= F.col("n_a") - least) & (F.col("place_b") <= F.col("n_b") - least)
    both = one.join(two, "token").filter((F.col("at_a") < F.col("at_b")) & first & may_be_similar(percent, 1))
    return _distinct_pairs(both)


def _gone(docs, sets, pairs, gone, base: str, percent: int) -> DataFrame:
    """Verify pairs; the later set of a similar pair goes."""
    if pairs.isEmpty():
        return gone
    wanted = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set")))
    texts = texts_of(docs, sets, wanted, f"{base}-texts", lambda text, number: F.get(F.split(text, "\n"), number))
    links = materialize(verified(pairs, texts, lines, percent), f"{base}-verified")
    discard(docs.sparkSession, f"{base}-texts")  # the links are written
    both = links.select(F.col("a").alias("set")).unionByName(links.select(F.col("b").alias("set"))).distinct()
    firsts = materialize(_firsts(sets, materialize(both, f"{base}-linked")), f"{base}-places")
    of_a = firsts.select(F.col("set").alias("a"), F.col("at").alias("at_a"))
    of_b = firsts.select(F.col("set").alias("b"), F.col("at").alias("at_b"))
    ends = links.join(within_bound(of_a), "a").join(within_bound(of_b), "b")
    later = ends.select(F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("set"))
    return materialize(gone.unionByName(later).distinct(), f"{base}-gone")


def repeated_lines(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_key, n_lines and the numbers of the removed lines (from 0, in order) of each document.

    Lines are what lies between line feeds; only lines with a word count or go. A null or blank text has none.
    Repeated rows of an id and text are one document; rows of an id with different texts are different ones, ordered
    by the texts' hash. Documents without an id come after all others. An empty table gives no rows. Other columns are
    ignored.
    """
    in_small_batches(docs.sparkSession)
    base = scratch_dir(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    sizes, sketch = measured(rows, lines, f"{base}/sizes")
    sets = distinct_sets(sizes, f"{base}/distinct")
    gone = repeated_sets(rows, sets, sketch, base, percent).withColumn("gone", F.lit(True))
    often = sets.filter("times > 1").select("set", F.col("at").alias("first"))
    often = materialize(often, f"{base}/often")
    marked = sizes.join(within_bound(often), "set", "left").join(within_bound(gone), "set", "left")
    removed = (F.col("n") > 0) & (F.coalesce(position() > F.col("first"), F.lit(False)) | F.col("gone").isNotNull())
    per_doc = marked.groupBy(F.col("item_key").alias("doc_id"), "text_key").agg(
        # Sets: each line once, also where a document's row is repeated.
        F.collect_set(F.when(F.col("n") > 0, F.col("number"))).alias("lines"),
        F.collect_set(F.when(removed, F.col("number"))).alias("removed"),
    )
    return per_doc.select(
        "doc_id",
        "text_key",
        F.size("lines").cast("long").alias("n_lines"),
        F.sort_array("removed").alias("removed"),
    )


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All documents, without the lines that come earlier in another place. A text may become empty, never null.

    `n_chars`, if there is such a column, is the new text's length. Other columns stay as they are.
    """
    base = scratch_dir(docs.sparkSession)
    own_key, id_, key, removed = unused(docs, "own_key", "id", "key", "removed")
    found = repeated_lines(docs, percent).filter(F.size("removed") > 0).toDF(id_, key, "n_lines", removed)
    found = materialize(found.drop("n_lines"), f"{base}/lines")

    @F.pandas_udf("string")
    def without(texts: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([_without(t, r) for t, r in zip(texts, removed, strict=True)], dtype=object)

    rows = docs.withColumn(own_key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    on = (F.col(own_key) == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
    rows = rows.join(within_bound(found, F.size(removed)), on, "left")
    changed = F.col(removed).isNotNull()
    text = F.when(changed, without(F.when(changed, F.col("text")), F.col(removed))).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(text: str | None, removed) -> str | None:
    if text is None or removed is None:
        return text
    numbers = set(removed)
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in numbers)
