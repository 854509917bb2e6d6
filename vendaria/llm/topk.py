"""Exact search for the largest inner products, with norm-sorted candidates and Cauchy-Schwarz bounds.

Vectors are whole numbers, floor(scale * x). Candidates are stored by descending length. A rotation, the eigenvectors
of the Gram matrix of all vectors (the right singular vectors of the table), moves most of the length into the first
dimensions. For a query q and a candidate x with heads and tails of the rotated vectors,

    q . x  =  head(q) . head(x) + tail(q) . tail(x)  <=  head(q) . head(x) + |tail(q)| |tail(x)|

so a candidate whose bound is below the query's k-th best score so far is out, first by lengths alone, then by heads
of growing size. What is left gets its whole-number product, so results are exact.

Queries are taken in blocks of bounded size: a block is broadcast and every task runs its share of all candidates
against it, keeping k for each query. No vector is shuffled after the sort, and no pair but the k best of a task leaves
it. The first thresholds of a block come from the longest candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaria.sources.scratch import materialize, scratch_dir

#: Queries that are broadcast at a time, candidates that give them their first thresholds, and how many of either are
#: held against each other at a time: some MB of queries, and matrices of 4 MB.
QUERY_BLOCK = 8192
SEEDS = 2048
CANDIDATE_BLOCK = 2048
QUERY_ROWS = 256


def whole_vector(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double; null if the vector or a component is null or not finite."""
    fits = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fits, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `k` largest products for each row that `is_query` marks.

    Candidates are all rows but those with the query's id; with fewer than `k`, all are returned. Ties go to the
    smaller id. Vectors that are null or hold null, infinite or NaN components take no part, nor do rows without an id
    or a component; shorter vectors count as filled up with zeros. Repeated rows of an id are one candidate with the
    best of their scores, and one query that asks with each of its vectors. Products have to fit a long. An empty
    table, or one without queries, gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    base = scratch_dir(spark)
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        whole_vector(F.col(f"`{vector_col}`"), scale).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter("vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = rows.withColumn("norm", F.sqrt(squares))
    rows = rows.repartitionByRange(F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id")
    rows = materialize(rows, f"{base}/vectors")

    known = rows.agg(F.max(F.size("vector")), F.count_if("is_query")).first()
    dims, n_queries = known[0] or 1, known[1]
    rotation = _rotation(rows, dims)
    seeds = _matrix(rows.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).toPandas(), dims)

    n_blocks = -(-n_queries // query_block)
    found = f"{base}/found"
    schema = "query_id long, vec_id long, score long"
    for block in range(n_blocks):
        queries = rows.filter("is_query")
        if n_blocks > 1:
            queries = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block)
        asked = _Queries(*_matrix(queries.orderBy("vec_id").toPandas(), dims), rotation, k)
        asked.meet(*seeds)
        thresholds = asked.least.copy()
        asked.forget()
        shared = spark.sparkContext.broadcast((asked, thresholds))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            asked, thresholds = shared.value
            own = asked.with_least(thresholds)
            for batch in batches:
                own.meet(*_matrix(batch, dims))
            yield own.best()

        best = rows.select("vec_id", "vector").mapInPandas(search, schema)
        best.write.mode("overwrite").parquet(f"{found}/block={block}")
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    merged = spark.read.schema(schema).parquet(*[f"{found}/block={b}" for b in range(n_blocks)])
    merged = merged.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _rotation(rows: DataFrame, dims: int) -> np.ndarray:
    """Eigenvectors of the sum of all outer products, largest eigenvalue first. Every row counts."""

    def outer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for batch in batches:
            _, x = _matrix(batch, dims)
            total += x.T.astype(float) @ x
        i, j = np.triu_indices(dims)
        yield pd.DataFrame({"i": i, "j": j, "value": total[i, j]})

    sums = rows.select("vec_id", "vector").mapInPandas(outer, "i int, j int, value double")
    sums = sums.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()  # one row per pair of dimensions
    gram = np.zeros((dims, dims))
    gram[sums["i"], sums["j"]] = gram[sums["j"], sums["i"]] = sums["value"]
    return np.linalg.eigh(gram)[1][:, ::-1]


def _matrix(rows: pd.DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and whole-number vectors, filled up with zeros."""
    x = np.zeros((len(rows), dims), np.int64)
    for i, v in enumerate(rows["vector"]):
        x[i, : len(v)] = v
    return rows["vec_id"].to_numpy(np.int64), x


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


class _Queries:
    """A block of queries and the best that each has met so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray, k: int):
        self.ids, self.x, self.rotation, self.k = ids, x, rotation, k
        self.rotated = x @ rotation
        self.norm = _lengths(self.rotated)
        self.forget()

    def forget(self) -> None:
        self.least = np.full(len(self.ids), -np.inf)
        self.kept = [np.zeros(0, np.int64)] * 3  # query's row, candidate's id, score

    def with_least(self, thresholds: np.ndarray) -> _Queries:
        own = object.__new__(_Queries)
        own.__dict__.update(self.__dict__)
        own.forget()
        own.least = thresholds.copy()
        return own

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        for at in range(0, len(ids), CANDIDATE_BLOCK):
            self._meet(ids[at : at + CANDIDATE_BLOCK], x[at : at + CANDIDATE_BLOCK])

    def _meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        rotated = x @ self.rotation
        norm = _lengths(rotated)
        longest = float(norm.max())
        distinct = len(np.unique(ids)) == len(ids)
        # Products are exact in floating point as long as no partial sum can reach 2^53.
        exact = float(self.norm.max(initial=0)) * longest < 2**52
        for at in range(0, len(self.ids), QUERY_ROWS if exact and distinct else QUERY_ROWS // 16):
            size = QUERY_ROWS if exact and distinct else QUERY_ROWS // 16
            # Room for rounding: a bound may be too large, never too small.
            reach = self.norm[at : at + size] * longest * (1 + 1e-9) + 1
            rows = at + np.flatnonzero(reach >= self.least[at : at + size])
            if not len(rows):
                continue
            alive = self._alive(rows, rotated, norm) & (self.ids[rows][:, None] != ids)
            if exact and distinct and alive.sum() > 4 * self.k * len(rows):
                scores = np.where(alive, self.x[rows].astype(float) @ x.T.astype(float), -np.inf)
                if len(ids) > self.k:  # a candidate below k others of its block is out
                    alive &= scores >= np.partition(scores, -self.k, axis=1)[:, -self.k :].min(axis=1)[:, None]
                q, c = np.nonzero(alive)
                scores = scores[q, c].astype(np.int64)
            else:
                q, c = np.nonzero(alive)
                scores = np.einsum("ij,ij->i", self.x[rows[q]], x[c])
            self._keep(rows[q], ids[c], scores)

    def _alive(self, rows: np.ndarray, rotated: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Which candidates' bounds reach the queries' thresholds, by heads of an eighth, a quarter, half the dimensions."""
        own, dims = self.rotated[rows], rotated.shape[1]
        slack = 1e-9 * np.outer(self.norm[rows], norm) + 1
        least = self.least[rows][:, None]
        partial = np.zeros((len(rows), len(norm)))
        alive = np.outer(self.norm[rows], norm) + slack >= least
        done = 0
        for head in sorted({max(1, dims // 8), max(1, dims // 4), max(1, dims // 2)}):
            if alive.mean() < 0.05:
                break
            partial += own[:, done:head] @ rotated[:, done:head].T
            done = head
            tails = np.outer(_lengths(own[:, head:]), _lengths(rotated[:, head:]))
            alive &= partial + tails + slack >= least
        return alive

    def _keep(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least[q]
        q, ids, scores = (np.concatenate(pair) for pair in zip(self.kept, (q[good], ids[good], scores[good]), strict=True))
        order = np.lexsort((-scores, ids, q))  # of an id's repeated rows, the best
        q, ids, scores = q[order], ids[order], scores[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, ids, scores = q[new], ids[new], scores[new]
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == self.k - 1
        self.least[q[last]] = np.maximum(self.least[q[last]], scores[last])
        top = place < self.k
        self.kept = [q[top], ids[top], scores[top]]

    def best(self) -> pd.DataFrame:
        q, ids, scores = self.kept
        return pd.DataFrame({"query_id": self.ids[q], "vec_id": ids, "score": scores})
