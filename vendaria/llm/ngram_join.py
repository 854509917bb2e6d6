"""N-gram Jaccard join of documents with adaptive multi-match prefixes.

A document is the set of its word 5-grams. If two sets have a Jaccard similarity of at least t, then for any l their
l-prefixes, the first n - ceil(t n) + l tokens in a common order, share at least l tokens. A longer prefix finds more
documents that share a token and lets fewer of them pass. Each document has the l that makes its estimated cost least:
the tokens' frequencies add up to what a prefix finds, and l of them are needed for a candidate. Of a pair, the larger
set's l counts, and the other's prefix is read up to that level. What is left is filtered by size and by the tokens
that can still follow, and verified on the whole texts.

Groups of near copies would make all pairs within the group candidates. So where many sets share a token, they are
first only compared with one of them, the hub, and what is found similar is joined to components; this is repeated
with other hubs while it saves pairs. Then all pairs that share a prefix token and are not yet in one component go through the filters. No
similar pair is passed over: it is either verified, or both are already known to be reachable from each other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaria.llm.components import components
from vendaria.llm.names import unused
from vendaria.llm.setjoin import (
    PLACE_BITS,
    Items,
    bit_columns,
    bits_may_be_similar,
    distinct_sets,
    entries,
    folded,
    in_small_batches,
    keyed,
    may_be_similar,
    measured,
    shared_entries,
    texts_of,
    verified,
    within_bound,
)
from vendaria.llm.words import hashed_words
from vendaria.sources.scratch import discard, materialize, scratch_dir

WIDTH = 5
PERCENT = 75

#: The largest l, and what verifying a candidate costs compared with finding it once.
MOST_MATCHES = 4
VERIFY_COST = 16

#: Bits that tell sets apart before their texts are read, in longs: two sets of some hundred shingles that are just
#: not similar enough differ in more of 512 bits than similar ones can.
N_LONGS = 8

#: Lists of more sets than this have hubs.
SHORT = 32

#: Rounds of hubs go on while they join components and more pairs across components are left than entries.
MOST_ROUNDS = 4


def shingles(texts: list[str]) -> Items:
    """The hashed word 5-grams of each text in lower case (A-Z); a shorter text is one shingle."""
    words = hashed_words(texts, lower=True)
    values, owner = words.token, words.text
    lengths = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(lengths) - lengths
    offset = np.arange(len(values)) - first[owner]
    at = np.flatnonzero(offset + WIDTH <= lengths[owner])
    owners, tokens = [owner[at]], [folded(values, at, WIDTH)]
    for width in range(1, WIDTH):
        short = np.flatnonzero(lengths == width)
        owners.append(short)
        tokens.append(folded(values, first[short], width))
    owners, tokens = np.concatenate(owners), np.concatenate(tokens)
    order = np.argsort(owners, kind="stable")
    return Items(np.arange(len(texts)), np.zeros(len(texts), np.int64), owners[order], tokens[order])


def first_prefix(n, percent: int):
    """Length of the prefix in which similar sets share a token."""
    return n - (percent * n + 99) // 100 + 1


def adaptive_prefix(percent: int):
    """Which tokens a document sends, and its number of matches."""

    def prefix(sizes, owner, place, count):
        # What a token finds besides the set itself, without the counters' noise.
        partners = np.maximum(0.0, count - 1.0)
        through = np.cumsum(partners)
        end = np.cumsum(sizes)
        before = np.concatenate([[0.0], through])[end - sizes]
        length = first_prefix(sizes, percent)
        best = np.full(len(sizes), np.inf)
        matches = np.ones(len(sizes), np.int64)
        for level in range(1, MOST_MATCHES + 1):
            last = end - sizes + np.minimum(length + level - 1, sizes) - 1
            found = through[np.maximum(last, 0)] - before
            cost = found * (1 + VERIFY_COST / level)
            better = (cost < best) & (level <= (percent * sizes + 99) // 100)
            best, matches = np.where(better, cost, best), np.where(better, level, matches)
        # A different set of at least its size and of enough similarity has to be possible.
        large = 100 * sizes >= percent * (sizes + 1)
        return (place < (length + MOST_MATCHES - 1)[owner]) & large[owner], matches

    return prefix


def similar_sets(docs: DataFrame, sizes: DataFrame, sketch, base: str, percent: int = PERCENT) -> DataFrame:
    """`node` and `root` of all sets that are similar to another. `docs` and `sizes` as in `setjoin`."""
    shared = shared_entries(entries(docs, shingles, sketch, adaptive_prefix(percent)), percent, f"{base}/shared")
    names = materialize(shared.select("set").distinct(), f"{base}/sets")
    sets = distinct_sets(sizes, f"{base}/distinct", N_LONGS)
    bits = sets.join(within_bound(names), "set", "left_semi").select("set", "n", *bit_columns(N_LONGS))
    bits = materialize(bits, f"{base}/bits")
    found = materialize(_no_links(shared), f"{base}/links-0")
    tried = materialize(_no_links(shared), f"{base}/tried-0")
    # Hubs are for long lists; a short one has few pairs.
    lengths = shared.groupBy("token").count().filter(F.col("count") > SHORT)
    long = materialize(shared.join(lengths.select("token"), "token", "left_semi"), f"{base}/long")
    total, n_found, labelled = long.count(), 0, long.withColumn("c", F.col("set"))
    for step in range(1, MOST_ROUNDS + 1):
        pairs, size = _hub_pairs(labelled, bits, tried, f"{base}/pairs-{step}", step, percent)
        if not size:
            break
        found = _verified_links(docs, sets, pairs, found, f"{base}/round-{step}", percent)
        labelled = _labelled(long, found, f"{base}/round-{step}")
        tried = materialize(tried.unionByName(pairs), f"{base}/tried-{step}")
        before, n_found = n_found, found.count()
        if n_found == before or _pairs_across(labelled, percent) <= total:
            break
    labelled = _labelled(shared, found, f"{base}/all")
    apart = materialize(_apart(labelled), f"{base}/apart")
    for done in ("shared", "long", "all-labelled", *[f"round-{k}-labelled" for k in range(1, MOST_ROUNDS + 1)]):
        discard(docs.sparkSession, f"{base}/{done}")  # what follows reads only the rows apart
    rest = materialize(_multi_match(apart, bits, percent).join(tried, ["a", "b"], "left_anti"), f"{base}/pairs-rest")
    found = _verified_links(docs, sets, rest, found, f"{base}/rest", percent)
    return components(found, f"{base}/components")


def _no_links(shared: DataFrame) -> DataFrame:
    return shared.filter("false").select(F.col("set").alias("a"), F.col("set").alias("b"))


def _pair(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _hub_pairs(
    labelled: DataFrame, bits: DataFrame, tried: DataFrame, path: str, step: int, percent: int
) -> tuple[DataFrame, int]:
    """Every entry with its token's hub, unless both are in one component or have been compared."""
    columns = ["set", "n", "place"]
    order = F.struct(F.xxhash64("set", F.lit(step)).alias("order"), *columns, "c")
    pairs = labelled.withColumn("hub", F.min(order).over(Window.partitionBy("token"))).filter("c <> hub.c")
    pairs = pairs.select(*[F.col(c).alias(f"{c}_a") for c in columns], *[F.col(f"hub.{c}").alias(f"{c}_b") for c in columns])
    pairs = pairs.filter(may_be_similar(percent, 0)).select(*_pair(F.col("set_a"), F.col("set_b"))).distinct()
    for side in ("a", "b"):
        own = bits.select(F.col("set").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", *bit_columns(N_LONGS))])
        pairs = pairs.join(own, side)
    pairs = pairs.filter(bits_may_be_similar(percent, N_LONGS)).select("a", "b")
    pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), path)
    return pairs, pairs.count()


def _is_indexed(percent: int) -> Column:
    """Whether a token is in the part of the prefix that a set needs for those of its own size or larger."""
    needed = F.ceil(2 * percent * F.col("n") / (100 + percent))
    return F.col("place") <= F.col("n") - needed + MOST_MATCHES - 1


def _pairs_across(labelled: DataFrame, percent: int) -> int:
    """How many pairs of entries share a token, are in different components, and hold one that is indexed."""
    each = labelled.groupBy("token", "c").agg(
        F.count(F.lit(1)).cast("double").alias("every"), F.count_if(_is_indexed(percent)).cast("double").alias("indexed")
    )
    across = F.sum("every") * F.sum("indexed") - F.sum(F.col("every") * F.col("indexed"))
    return int(each.groupBy("token").agg(across.alias("pairs")).agg(F.sum("pairs")).first()[0] or 0)


def _verified_links(docs, sets, pairs, found, base: str, percent: int) -> DataFrame:
    """All links so far and those among the pairs."""
    wanted = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set")))
    texts = texts_of(docs, sets, wanted, f"{base}-texts")
    links = materialize(verified(pairs, texts, shingles, percent), f"{base}-verified")
    discard(docs.sparkSession, f"{base}-texts")  # the links are written
    return materialize(found.unionByName(links), f"{base}-links")


def _labelled(rows: DataFrame, found: DataFrame, base: str) -> DataFrame:
    """The entries with the components that the links make."""
    roots = components(found, f"{base}-components").withColumnsRenamed({"node": "set", "root": "c"})
    labelled = rows.join(within_bound(roots), "set", "left").withColumn("c", F.coalesce("c", "set"))
    return materialize(labelled, f"{base}-labelled")


def _apart(labelled: DataFrame) -> DataFrame:
    """The entries whose token is in different components.

    They are written before they are joined: each sort and each hash table of a task holds a page of memory of its own,
    and so much the more at a time the more of them one stage has.
    """
    apart = labelled.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
    return labelled.join(apart.select("token"), "token", "left_semi")


def _multi_match(apart: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that share enough prefix tokens to be similar. `apart` is what `_apart` returns.

    The larger set of a pair asks for its number of matches l. If both have a tokens in common, the l-th of them is at
    place n - a + l - 1 at most in either set, so only tokens up to there count, with the least a that makes the sets
    similar. For the smaller set that is the indexed part of its prefix. Shared tokens up to the last one that was
    found, and the fewer of what follows in either set, bound the intersection.
    """
    rows = apart.join(within_bound(bits.drop("n")), "set")
    columns = ["set", "n", "place", "own", "c", *bit_columns(N_LONGS)]
    small = rows.filter(_is_indexed(percent)).select("token", *[F.col(c).alias(f"{c}_a") for c in columns])
    large = rows.select("token", *[F.col(c).alias(f"{c}_b") for c in columns])
    least = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    matched = (
        (F.struct("n_a", "set_a") < F.struct("n_b", "set_b"))
        & (F.col("c_a") != F.col("c_b"))
        & may_be_similar(percent, N_LONGS)
        & (F.col("place_a") <= F.col("n_a") - least + F.col("own_b") - 1)
        & (F.col("place_b") <= F.col("n_b") - least + F.col("own_b") - 1)
    )
    both = small.join(large, "token").filter(matched)
    # Both places in one number, which a hash table can hold; a struct would be sorted.
    last = F.shiftleft(F.col("place_a").cast("long"), PLACE_BITS).bitwiseOR(F.col("place_b").cast("long"))
    pairs = both.groupBy("set_a", "set_b").agg(
        F.count(F.lit(1)).alias("common"),
        F.max(last).alias("last"),
        *[F.first(c).alias(c) for c in ("n_a", "n_b", "own_b")],
    )
    last_a, last_b = F.shiftright("last", PLACE_BITS), F.col("last").bitwiseAND((1 << PLACE_BITS) - 1)
    follow = F.least(F.col("n_a") - last_a, F.col("n_b") - last_b) - 1
    enough = (100 + percent) * (F.col("common") + follow) >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = pairs.filter((F.col("common") >= F.col("own_b")) & enough)
    return pairs.select(*_pair(F.col("set_a"), F.col("set_b")))


def ngram_components(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that links lead to, for every row of `docs`.

    Two documents link if 100 * intersection >= `percent` * union of their shingle sets; equal sets always do. A null,
    empty or blank text has no shingles and no links, so its component is its own id. Repeated rows are documents of
    their own that link with each other. A row without an id has its component's smallest id, or none. An empty table
    gives no rows. Other columns are ignored.
    """
    base = scratch_dir(docs.sparkSession)
    placed = _placed(docs, percent, id_col, text_col, base).drop("text_key")
    smallest = placed.filter("n_shingles > 0").groupBy("c").agg(
        F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("rows")
    )
    # Most components are one document; only the others have to be looked up.
    smallest = materialize(smallest.filter("rows > 1").drop("rows"), f"{base}/smallest")
    result = placed.join(within_bound(smallest), "c", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("smallest"))
    return result.select("doc_id", "n_shingles", F.coalesce(own, "doc_id").alias("component_id"))


def _placed(docs: DataFrame, percent: int, id_col: str, text_col: str, base: str) -> DataFrame:
    """doc_id, text_key, n_shingles and c, which names the component, for every row of `docs`."""
    in_small_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    sizes, sketch = measured(rows, shingles, f"{base}/sizes", N_LONGS)
    roots = similar_sets(rows, sizes, sketch, base, percent).withColumnsRenamed({"node": "set", "root": "c"})
    placed = sizes.join(within_bound(roots), "set", "left").withColumn("c", F.coalesce("c", "set"))
    placed = placed.select(F.col("item_key").alias("doc_id"), "text_key", F.col("n").cast("long").alias("n_shingles"), "c")
    return materialize(placed, f"{base}/placed")


def without_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id, as it came.

    Rows of an id with different texts are different documents, ordered by the texts' hash, and rows without an id come
    last, as in line dedup. Documents without shingles are no copies and all stay. Of rows that repeat the id and text
    of the one that stays, one is kept.
    """
    base = scratch_dir(docs.sparkSession)
    placed = _placed(docs, percent, "doc_id", "text", base).filter("n_shingles > 0")
    position = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    # Most components are one document; only the others have to be looked up.
    firsts = placed.groupBy("c").agg(F.min(position).alias("first"), F.count(F.lit(1)).alias("rows"))
    firsts = materialize(firsts.filter("rows > 1").drop("rows"), f"{base}/firsts")
    linked = placed.join(within_bound(firsts), "c").withColumn("later", position > F.col("first"))
    own_key, id_, key = unused(docs, "own_key", "id", "key")
    linked = linked.groupBy("doc_id", "text_key", "later").count()
    linked = materialize(linked.filter("later OR count > 1"), f"{base}/copies")
    copies, again = (linked.filter(c).select("doc_id", "text_key").toDF(id_, key) for c in ("later", "NOT later"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(own_key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    on = (F.col(own_key) == F.col(key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
    stay = rows.join(within_bound(copies), on, "left_anti")
    if again.isEmpty():
        return stay.select(*own)
    once = stay.join(within_bound(again), on, "left_semi").dropDuplicates(["doc_id", own_key]).select(*own)
    return stay.join(within_bound(again), on, "left_anti").select(*own).unionByName(once)
