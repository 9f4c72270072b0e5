"""Exact top-k inner products by pivot-table elimination.

Every vector's Euclidean distances to a set of pivots are computed once and stored. For a query q and a
candidate x, the largest |d(q, p) - d(x, p)| over all pivots is a lower bound of d(q, x), hence
(|q|^2 + |x|^2 - bound^2) / 2 an upper bound of their inner product. Candidates are evaluated in the
order of that bound, and a query stops at the first whose bound is below its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import arrow_map
from clearshelf.sources.tables import stage

#: Products and sums below this are exact in doubles.
EXACT = 1 << 53
_LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Params:
    """``scale`` turns components into integers. ``pivots`` are chosen among ``sample`` vectors, which
    bound what the driver sees besides one block of queries; ``block`` bounds that block, ``rows``
    the candidates that are weighed at once, ``step`` the first evaluations of a query."""

    k: int = 5
    every: int = 50
    scale: int = 256
    pivots: int = 16
    sample: int = 256
    block: int = 4096
    rows: int = 16384
    step: int = 128


def _matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of integers as rows, the shorter ones filled with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(lengths.max(initial=0)), width or 0)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == len(lengths) * width:
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), flat.dtype)
    starts = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out


def _widen(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


def whole_vectors(vectors: DataFrame, *, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(``_at``, ``_id``, ``_v``) of the vectors that take part: floor(scale * x) of every component.

    Vectors that are null or hold a null, a NaN or an infinite component stay out.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("_at"), F.col(id_col).alias("_id"), v.alias("_v")
    )
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("_v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return rows.where(F.col("_v").isNotNull() & ~bad).withColumn("_v", whole)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows of the sample, each the farthest from those chosen before."""
    if not len(sample):
        return sample[:0]
    values = sample.astype(np.float64)
    chosen = [0]
    least = ((values - values[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((values - values[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every row to every pivot."""
    width = max(rows.shape[1], pivots.shape[1])
    a, p = _widen(rows, width).astype(np.float64), _widen(pivots, width).astype(np.float64)
    return np.stack([np.sqrt(((a - one) ** 2).sum(axis=1)) for one in p], axis=1)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``_d``, the distances to the pivots."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _distances(_matrix(batch.column(2)), pivots)
            ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "_d"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_d", T.ArrayType(T.DoubleType()))])
    return arrow_map(rows, measured, schema)


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products with one query, exact; what exceeds a long ends at the largest or least long."""
    a, b = rows.astype(np.float64), query.astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(len(b), 1) < EXACT:
        return (a @ b).astype(np.int64)
    found = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), _LONG.min), _LONG.max) for s in found], np.int64)


class Search:
    """The k best candidates of every query of a block so far."""

    def __init__(self, at: np.ndarray, vectors: np.ndarray, distances: np.ndarray, params: Params):
        self.at, self.vectors, self.distances, self.params = at, vectors, distances, params
        self.norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none) for _ in at]
        self.evaluated = 0

    def least(self, q: int) -> float:
        """The score below which a candidate can no longer enter."""
        scores = self.best[q][0]
        return float(scores[-1]) if len(scores) >= self.params.k else -np.inf

    def _add(self, q: int, scores: np.ndarray, last: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.least(q)
        s, n, i = (np.concatenate((a, b[keep])) for a, b in zip(self.best[q], (scores, last, ids)))
        order = np.lexsort((i, n, -s))[: self.params.k]
        self.best[q] = (s[order], n[order], i[order])

    def meet(self, at: np.ndarray, last: np.ndarray, ids: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
        """Weigh a block of candidates; ``last`` marks those without an id, ``far`` is their part of the
        pivot table."""
        width = max(rows.shape[1], self.vectors.shape[1])
        rows, queries = _widen(rows, width), _widen(self.vectors, width)
        norms, by_pivot = (rows.astype(np.float64) ** 2).sum(axis=1), np.ascontiguousarray(far.T)
        for q, query in enumerate(queries):
            bound = np.zeros(len(rows))
            # the stored distances are rounded: what is taken off covers their errors
            for own, others in zip(self.distances[q], by_pivot):
                np.maximum(bound, np.abs(others - own) - 1e-12 * (others + own), out=bound)
            size = self.norms[q] + norms
            most = (size - bound * bound) / 2 + 1 + 1e-9 * size
            most[at == self.at[q]] = -np.inf
            self._evaluate(q, query, most, last, ids, rows)

    def _evaluate(self, q, query, most, last, ids, rows) -> None:
        """Candidates in the order of their bounds, in growing steps, until none can enter."""
        step = self.params.step
        open_ = np.flatnonzero((most >= self.least(q)) & (most > -np.inf))
        while len(open_):
            first = open_ if len(open_) <= step else open_[np.argpartition(-most[open_], step - 1)[:step]]
            self.evaluated += len(first)
            self._add(q, _scores(rows[first], query), last[first], ids[first])
            most[first] = -np.inf
            open_ = open_[most[open_] >= self.least(q)]
            open_ = open_[most[open_] > -np.inf]
            step *= 2


def _meet_all(table: DataFrame, queries: list, params: Params) -> DataFrame:
    """(``q``, ``none``, ``id``, ``score``): the k best of every task for every query of a block."""
    at = np.array([r["_at"] for r in queries], np.int64)
    vectors = _matrix(pa.array([r["_v"] for r in queries], pa.list_(pa.int64())))
    distances = _matrix(pa.array([r["_d"] for r in queries], pa.list_(pa.float64())))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(at, vectors, distances, params)
        for whole in batches:
            for start in range(0, whole.num_rows, params.rows):
                batch = whole.slice(start, params.rows)
                ids = batch.column(1)
                last = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                search.meet(
                    batch.column(0).to_numpy(), last, ids.fill_null(0).to_numpy(),
                    _matrix(batch.column(2)), _matrix(batch.column(3)),
                )
        sizes = [len(s) for s, _, _ in search.best]
        scores, none, ids = (np.concatenate([b[i] for b in search.best]) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, sizes)), pa.array(none), pa.array(ids), pa.array(scores)],
            names=["q", "none", "id", "score"],
        )

    return arrow_map(table, best, "q long, none long, id long, score long")


def _best(met: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks, with their rank."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "none", "id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _page(asked: DataFrame, after: int, block: int) -> list:
    """The next block of queries by their place."""
    return asked.where(F.col("_at") > after).orderBy("_at").limit(block).collect()


def top_inner_products(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    params: Params = Params(),
) -> DataFrame:
    """(``query_id``, ``rank``, id, ``score``): the k highest inner products of every query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the query's
    own, another row of the same id included. Equal scores go by id, a null id last. Vectors that are
    null or hold a null or non-finite component take no part. Vectors of unequal length meet over
    the components they share, an empty one scores 0. Repeated query rows repeat their results. An
    empty table gives no rows. Other columns play no part.

    Queries are taken in blocks: each block, bounded by ``block``, reaches every task, and the table
    is read once a block. A task hands on k rows a query.
    """
    spark: SparkSession = vectors.sparkSession
    rows = stage(whole_vectors(vectors, id_col=id_col, vector_col=vector_col, scale=params.scale), "vectors")
    picked = rows.orderBy(F.xxhash64("_at", "_id"), "_at").limit(params.sample).select("_v").collect()
    sample = _matrix(pa.array([r[0] for r in picked], pa.list_(pa.int64())))
    table = stage(pivot_table(rows, choose_pivots(sample, params.pivots)), "pivot_table")

    asked = table.where(F.col("_id") % params.every == 0)
    found = spark.createDataFrame([], "q long, none long, id long, score long, rank int")
    queries = _page(asked, -1, params.block)
    while queries:
        found = found.union(stage(_best(_meet_all(table, queries, params), params.k), "best"))
        queries = _page(asked, queries[-1]["_at"], params.block)
    ids = asked.select(F.col("_at").alias("q"), F.col("_id").alias("query_id"))
    return found.join(ids, "q").select(
        "query_id", "rank", F.when(F.col("none") == 0, F.col("id")).alias(id_col), "score"
    )
