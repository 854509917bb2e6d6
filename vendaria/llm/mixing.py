"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. Within a source, documents fall into classes of equal importance, and the
source's target is shared among its classes in the same way as the whole is shared among the sources: by weight, up to
a cap. A document of a class that is to give 1.4 times its words is taken once for certain, and once more with a
probability of 0.4. Which documents are taken once more is a sample of unequal probabilities and fixed size: documents
are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and the first ones are taken until
their words reach what the source still lacks. The size is fixed in words, as targets are: a document belongs to the
sample if at least half of it lies below that mark, so a source misses its target by half a document at most.

No step sorts a source. Ranks are cut into bins; words per source and bin show in which bin the mark lies, and only
that bin's documents are sorted. Tables of sources, classes and bins have a row per source, at most 64 per source and
at most `BINS` per source; they are written to the shared folder, and what is small by its file size is broadcast by
Spark itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaria.llm.names import unused
from vendaria.llm.words import n_words
from vendaria.sources.scratch import materialize, scratch_dir

#: Ranks are cut into so many bins for each source. One of them is sorted, for its source's mark.
BINS = 1 << 14

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)


def reshare(rows: DataFrame, total: Column, size: str, weight: str, cap: float, by: Sequence[str], order: Sequence[str]):
    """Add `target`: `total` shared among the rows of each `by` by `weight`, at most `cap` times a row's `size`.

    What is above a cap is reshared by weight until nothing is. Rows reach their caps in the order of size over
    weight, so a running sum in that order tells which do: a row is capped if its cap is not above its share of what
    the rows before it leave.
    """
    most = F.col(size) * F.lit(cap)
    first_full = Window.partitionBy(*by).orderBy(F.col(size) / F.col(weight), *order)
    whole = Window.partitionBy(*by)
    before = F.sum(most).over(first_full.rowsBetween(Window.unboundedPreceding, -1))
    rest = total - F.coalesce(before, F.lit(0.0))
    open_weight = F.sum(weight).over(first_full.rowsBetween(0, Window.unboundedFollowing))
    marked = (
        rows.withColumn("__level", rest / open_weight)
        .withColumn("__full", most <= F.col("__level") * F.col(weight))
        # The first row that isn't full has the level of all the others.
        .withColumn("__level", F.min(F.when(~F.col("__full"), F.struct(F.col(size) / F.col(weight), "__level"))).over(whole))
    )
    target = F.when(F.col("__full"), most).otherwise(F.col("__level.__level") * F.col(weight))
    return marked.withColumn("target", target).drop("__level", "__full")


def random_of(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone, so reruns agree and SQL can repeat it."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digits, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def n_digits(number: Column) -> Column:
    """Binary digits of a whole number: 0 for 0, 1 for 1, 2 for 2 and 3."""
    return F.when(number > 0, F.length(F.bin(number))).otherwise(0).cast("long")


def mix(
    docs: DataFrame,
    size: Column | None = None,
    share: float = 1.5,
    weights: Sequence[int] = WEIGHTS,
    cap: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    output: str = "mix",
) -> DataFrame:
    """Every row of `docs` with the struct `output`: size, source_size, target of its source, copies to take of it.

    `size` is by default the number of words in `text`. Sources are ordered by code point, null last, and weigh as in
    `weights`, repeating. Together they are to give `share` of all words, none more than `cap` times its own. A
    document's importance is the number of binary digits of its size, so that longer texts are rather taken again.

    A null or empty text has no words and no copies. Rows of the same id have the same random number; where the mark
    falls between rows alike in id and size, it is left open which of them is taken. An empty table gives no rows.
    An existing column called `output` is replaced; any other column stays, whatever its name.
    """
    if not 0 <= share <= cap:
        raise ValueError("the share lies between 0 and the cap")
    base = scratch_dir(docs.sparkSession)
    (first,) = unused(docs, "first")  # makes a struct of no columns possible
    rows = docs.drop(output).select(
        F.struct(F.lit(0).alias(first), *[F.col(f"`{c}`") for c in docs.columns if c != output]).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(n_words(F.col("text")) if size is None else size, F.lit(0)).cast("long").alias("size"),
    )
    rows = rows.withColumn("class", n_digits(F.col("size")))

    classes = materialize(rows.groupBy("source", "class").agg(F.sum("size").alias("class_size")), f"{base}/sizes")
    sources = classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    # Windows over one row per source, and over at most 64 for each source.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    sources = sources.withColumn("weight", weight).withColumn("total", total)
    sources = reshare(sources, F.col("total"), "source_size", "weight", cap, [], ["weight", "source"])
    sources = materialize(sources.select("source", "source_size", "target"), f"{base}/sources")

    classes = _joined(classes, sources, "source").withColumn("share", F.col("target"))
    classes = classes.withColumn("importance", F.col("class") * F.col("class_size"))
    some = reshare(classes.filter("class_size > 0"), F.col("share"), "class_size", "importance", cap, ["source"], ["class"])
    ratio = F.col("target") / F.col("class_size")
    plan = some.withColumn("whole", F.floor(ratio)).withColumn("chance", ratio - F.col("whole"))
    plan = plan.drop("target").unionByName(
        classes.filter("class_size = 0").drop("target").withColumns({"whole": F.lit(0).cast("long"), "chance": F.lit(0.0)})
    )
    lacks = F.col("share") - F.sum(F.col("whole") * F.col("class_size")).over(Window.partitionBy("source"))
    plan = plan.select("source", "class", "source_size", F.col("share").alias("target"), "whole", "chance", lacks.alias("lacks"))
    plan = materialize(plan, f"{base}/plan")

    u = random_of(F.col("id"), seed)
    odds = (u / (1 - u)) / (F.col("chance") / (1 - F.col("chance")))
    ranked = _joined(rows, plan, "source", "class")
    ranked = ranked.withColumn("odds", F.when(F.col("chance") > 0, odds))
    ranked = ranked.withColumn("bin", F.floor(F.col("odds") / (1 + F.col("odds")) * BINS))

    # The bin in which each source's mark lies, and the words in the bins before it.
    bins = ranked.filter("bin IS NOT NULL").groupBy("source", "bin")
    bins = bins.agg(F.sum("size").alias("words"), F.first("lacks").alias("lacks"))
    through = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    marks = bins.withColumn("before", through - F.col("words")).filter("before <= lacks")
    marks = marks.groupBy("source").agg(F.max_by(F.struct("bin", "before"), "bin").alias("mark"))
    marks = materialize(marks.select("source", "mark.*").withColumnRenamed("bin", "cut"), f"{base}/marks")

    placed = _joined(ranked, marks, "source")
    at_mark = F.coalesce(F.col("bin") == F.col("cut"), F.lit(False))
    by_odds = Window.partitionBy("source").orderBy("odds", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(by_odds) - F.col("size") / 2
    before_mark = F.coalesce(F.col("bin") < F.col("cut"), F.lit(False))
    done = placed.filter(~at_mark).withColumn("again", before_mark)
    done = done.unionByName(placed.filter(at_mark).withColumn("again", middle <= F.col("lacks")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("again").cast("long")).otherwise(0)
    return done.select(
        "row.*", F.struct("size", "source_size", "target", copies.cast("long").alias("copies")).alias(output)
    ).drop(first)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs` as often as `mix` says, with its columns, whatever they are called.

    Rows without a word are not in the mix; rows that repeat are documents of their own. An empty table gives no rows.
    """
    own, copy = unused(docs, "mix", "copy")
    taken = mix(docs, output=own, **options).filter(F.col(f"{own}.copies") > 0)
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"{own}.copies").cast("int"))).alias(copy)
    return taken.select("*", copies).drop(own, copy)


def _joined(rows: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys that may be null."""
    right = table.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [rows[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    return rows.join(right, on, "left").drop(*[f"__{k}" for k in keys])
