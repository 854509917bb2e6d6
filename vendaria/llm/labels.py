"""Bounded samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.llm.names import unused


def held_out(doc_id) -> F.Column:
    """Documents whose labels no model sees: a third, by the checksum of the id. A null id is not held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, columns: dict[str, F.Column], keep=None
) -> pd.DataFrame:
    """At most `per_class` documents of each class, with `columns` of the document and its `label`.

    Only labels of 0 and 1 count. An id that is labelled twice has the larger label; an id that several documents
    share brings the label to each of them, so the rows are bounded once more after the join. The sample is the
    first ones by a hash of the id, whatever the size of the tables, and comes in that order. `keep` filters the
    documents that are fit to learn from. `columns` are computed for the sample alone.
    """
    wanted = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    (own,) = unused(docs, "label")
    wanted = wanted.groupBy("doc_id").agg(F.max(label).cast("int").alias(own))
    fit = docs.filter(keep) if keep is not None else docs
    parts = []
    for value in (0, 1):
        # Twice as many as are wanted, as some may have no document that is fit.
        ids = first_ids(wanted.filter(F.col(own) == value), 2 * per_class)
        found = first_rows(fit.join(F.broadcast(ids), "doc_id"), per_class)
        parts.append(found.select("doc_id", F.col(own).alias(label), *[c.alias(name) for name, c in columns.items()]).toPandas())
    return pd.concat(parts, ignore_index=True)


def first_ids(rows: DataFrame, n: int) -> DataFrame:
    """The first `n` rows of a table without texts, by a hash of the id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def first_rows(docs: DataFrame, n: int) -> DataFrame:
    """The first `n` documents by a hash of the id, and of the text where several share an id."""
    return docs.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(n)
