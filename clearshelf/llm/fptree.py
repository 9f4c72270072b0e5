"""Ranked lexical search over FP-trees of documents.

A document is a vector of the query terms it holds, ordered by how many documents hold them. Vectors
that begin alike share a path of a tree. Every node knows the largest frequency of each term and the
least length factor below it, hence an upper bound of any item's score there; each item goes
depth-first into the children of the highest bounds and leaves those that cannot reach its k-th best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import alnum_words, arrow_map, utf8
from clearshelf.sources.tables import stage


@dataclass(frozen=True)
class Params:
    """``b`` is the weight of the length in hundredths, ``k1`` the saturation in thousandths.

    ``items`` and ``terms`` bound a block of items: their number, and their distinct terms beyond the
    first item's. ``cells`` bounds the documents of one tree times these terms, ``leaf`` the documents
    of a node that is not split further."""

    k: int = 10
    b: int = 75
    k1: int = 8
    items: int = 1024
    terms: int = 8192
    cells: int = 1 << 22
    leaf: int = 64


class Tree:
    """The FP-tree of a block of documents, kept in the order of their paths.

    A node is a range of that order; ``peaks`` holds its largest frequency of each term and
    ``lows`` its least length factor. ``children`` names its parts by the next term of their paths.
    """

    def __init__(self, freq: np.ndarray, factor: np.ndarray, leaf: int):
        """``freq`` has a row per document and a column per term, the terms of most documents first."""
        held = freq > 0
        paths = [np.flatnonzero(row).astype(np.int32) for row in held]
        self.order = np.array(sorted(range(len(paths)), key=lambda i: paths[i].tolist()), np.int64)
        self.freq, self.factor = freq[self.order], factor[self.order]
        paths = [paths[i] for i in self.order]
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow(paths, leaf)
        self._gather()

    def _grow(self, paths: list[np.ndarray], leaf: int) -> None:
        """Split ranges by the term at their depth; a path of one continuation is one node."""
        todo = [(0, len(paths), 0, -1)]
        while todo:
            start, stop, depth, parent = todo.pop()
            node = len(self.spans)
            self.spans.append((start, stop))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if stop - start <= leaf:
                continue
            first, last = paths[start], paths[stop - 1]
            # the order is that of the paths, so what both ends share all between them share
            while depth < min(len(first), len(last)) and first[depth] == last[depth]:
                depth += 1
            if depth >= len(last):
                continue
            at = np.array([p[depth] if len(p) > depth else -1 for p in paths[start:stop]])
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), stop - start]
            todo += [(start + a, start + b, depth + 1, node) for a, b in zip(cuts, cuts[1:])]

    def _gather(self) -> None:
        """Peaks and lows of the leaves from their documents, of the others from their children."""
        n, terms = len(self.spans), self.freq.shape[1]
        self.peaks, self.lows = np.zeros((n, terms), self.freq.dtype), np.zeros(n, np.int64)
        for node in range(n - 1, -1, -1):  # a child comes after its parent
            start, stop = self.spans[node]
            if below := self.children[node]:
                self.peaks[node], self.lows[node] = self.peaks[below].max(axis=0), self.lows[below].min()
            elif stop > start:
                self.peaks[node] = self.freq[start:stop].max(axis=0)
                self.lows[node] = self.factor[start:stop].min()


def partial_scores(freq: np.ndarray, factor: np.ndarray, k1: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + k1 m) of each document (row) and term; 0 without the term."""
    tf = freq.astype(np.int64)
    return (1_000_000_000 * tf) // np.maximum(1000 * tf + k1 * factor[:, None], 1)


class Ranking:
    """The k best documents of every item so far."""

    def __init__(self, items: Sequence[tuple[np.ndarray, np.ndarray]], params: Params):
        """``items``: of each the columns of its terms and their weights times repeats."""
        self.items, self.params = items, params
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none) for _ in items]
        self.scored = 0

    def least(self, item: int) -> int:
        """The score that a document has to reach; above 0 in any case."""
        scores = self.best[item][0]
        return max(int(scores[-1]), 1) if len(scores) >= self.params.k else 1

    def search(self, tree: Tree, last: np.ndarray, ids: np.ndarray) -> None:
        """Search one tree for every item; ``last`` marks documents without an id."""
        last, ids = last[tree.order], ids[tree.order]
        for item, (columns, weights) in enumerate(self.items):
            if not len(columns):
                continue
            bounds = partial_scores(tree.peaks[:, columns], tree.lows, self.params.k1) @ weights
            todo = [0]
            while todo:
                node = todo.pop()
                if bounds[node] < self.least(item):
                    continue
                if below := tree.children[node]:
                    todo += sorted(below, key=bounds.__getitem__)
                else:
                    self._score(item, tree, *tree.spans[node], last, ids)

    def _score(self, item: int, tree: Tree, start: int, stop: int, last, ids) -> None:
        columns, weights = self.items[item]
        self.scored += stop - start
        freq = tree.freq[start:stop][:, columns]
        scores = partial_scores(freq, tree.factor[start:stop], self.params.k1) @ weights
        keep = np.flatnonzero(scores >= self.least(item))
        if len(keep):
            found = (scores[keep], last[start:stop][keep], ids[start:stop][keep])
            s, n, i = (np.concatenate(x) for x in zip(self.best[item], found))
            order = np.lexsort((i, n, -s))[: self.params.k]
            self.best[item] = (s[order], n[order], i[order])


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(``_id``, ``n``, ``terms``, ``tfs``) of ``docs`` (``_id``, ``_text``): the number of all its
    terms, and the numbers and frequencies of those in the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            sizes, ends, terms, tfs = [], [0], [], []
            for text in utf8(batch, "_text"):
                words = alnum_words(text)
                held = Counter(map(number, words))
                held.pop(None, None)
                sizes.append(len(words))
                terms.extend(held)
                tfs.extend(held.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                names=["_id", "n", "terms", "tfs"],
            )

    return arrow_map(docs, counted, "_id long, n long, terms array<int>, tfs array<int>")


def _item_blocks(items: DataFrame, params: Params) -> Iterator[list[tuple[int, Counter]]]:
    """Items with their terms, block by block; the driver holds one block and one partition."""
    block, seen = [], set()
    for at, text in items.toLocalIterator():
        terms = Counter(alnum_words(text.encode() if text else None))
        if block and (len(block) >= params.items or len(seen | terms.keys()) > params.terms):
            yield block
            block, seen = [], set()
        block.append((at, terms))
        seen |= terms.keys()
    if block:
        yield block


def _search_block(vectors: DataFrame, block: list, number: dict[bytes, int], params: Params) -> DataFrame:
    """(``item``, ``none``, ``id``, ``score``): the k best of every task for each item of a block."""
    totals = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, length = totals
    held = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    df = np.zeros(len(number), np.int64)
    for t, count in held.collect():
        df[t] = count
    # column of each term: those of most documents first
    column = np.empty(len(df), np.int64)
    column[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df]
    items = []
    for _, terms in block:
        known = [(number[t], c) for t, c in terms.items() if df[number[t]] > 0]
        of = np.array([column[t] for t, _ in known], np.int64)
        items.append((of, np.array([weight[t] * c for t, c in known], np.int64)))
    at = np.array([a for a, _ in block], np.int64)
    size = max(params.leaf, params.cells // max(len(df), 1))
    b, width = params.b, len(df)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = Ranking(items, params)
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                batch = whole.slice(start, size)
                terms, ids = batch.column(2), batch.column(0)
                freq = np.zeros((batch.num_rows, width), np.int32)
                rows = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy())
                freq[rows, column[terms.flatten().to_numpy()]] = batch.column(3).flatten().to_numpy()
                factor = np.array(
                    [100 - b + b * n * n_docs // length for n in batch.column(1).to_pylist()], np.int64
                )
                last = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ranking.search(Tree(freq, factor, params.leaf), last, ids.fill_null(0).to_numpy())
        sizes = [len(s) for s, _, _ in ranking.best]
        scores, none, found = (np.concatenate([x[i] for x in ranking.best]) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, sizes)), pa.array(none), pa.array(found), pa.array(scores)],
            names=["item", "none", "id", "score"],
        )

    matching = vectors.where(F.size("terms") > 0)
    return arrow_map(matching, best, "item long, none long, id long, score long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    params: Params = Params(),
) -> DataFrame:
    """(item id, ``rank``, document id, ``score``): the k best documents of every item.

    Document ids are integers; equal scores go by id, a null id last. Null and empty texts have no
    terms and match nothing; items without a matching document give no rows. Repeated items repeat
    their results, repeated documents are ranked each. Either table empty gives no rows. Other
    columns play no part.

    Items are taken in blocks; a block reads all documents once, and a task hands on k rows an
    item. Trees are those of bounded blocks of documents, with the thresholds carried over.
    """
    spark = docs.sparkSession
    keyed = stage(
        items.select(
            F.monotonically_increasing_id().alias("_at"), F.col(item_col).alias("_item"),
            F.col(item_text_col).alias("_text"),
        ),
        "items",
    )
    narrow = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "none", "id")
    found = spark.createDataFrame([], "item long, none long, id long, score long, rank int")
    for block in _item_blocks(keyed.select("_at", "_text"), params):
        terms = sorted({t for _, held in block for t in held})
        number = {t: i for i, t in enumerate(terms)}
        vectors = stage(restricted(narrow, number), "restricted")
        met = _search_block(vectors, block, number, params)
        ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.k)
        found = found.union(stage(ranked, "ranked"))
    of = keyed.select(F.col("_at").alias("item"), F.col("_item").alias(item_col))
    return found.join(of, "item").select(
        item_col, "rank", F.when(F.col("none") == 0, F.col("id")).alias(id_col), "score"
    )
