"""A training corpus from raw documents: stages that take and give documents, each written before the next reads it.

Every stage takes an empty table, and other columns of any name, which it hands on.

A stage's rows are computed when they are written, so its session keeps the setting on the size of batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaria.llm import setjoin, toxicity
from vendaria.llm.bpe import MEMO_SIZE, encode, load_tokenizer
from vendaria.llm.line_dedup import without_repeated_lines
from vendaria.llm.mixing import mixed
from vendaria.llm.ngram_join import without_copies
from vendaria.llm.setjoin import BATCH_BYTES  # noqa: F401
from vendaria.sources.scratch import materialize, scratch_dir


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with rows sent to Python in batches of BATCH_BYTES."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        setjoin.in_small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that are not held out, does not take for toxic.

    Null, empty and wordless texts stay, repeated rows go or stay together, and whole texts are scored.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


@in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one.

    A text may become empty, never null; null and blank ones stay as they are. Rows that repeat are one document.
    """
    return without_repeated_lines(docs)


@in_small_batches
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id, rows without one last.

    Null, empty and blank texts are no copies and stay; of rows equal in id and text one stays.
    """
    return without_copies(docs)


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' targets ask for; without a word, not at all. A null source is one too."""
    return mixed(docs)


@in_small_batches
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their tokens; a null or empty text has none. Every row stays."""
    bpe = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return encode(docs, bpe, memo_size=MEMO_SIZE // 2).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Trained scores and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus made of `documents`: its columns, the token ids and their number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_dir(spark)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"{base}/{name}")
    return docs
