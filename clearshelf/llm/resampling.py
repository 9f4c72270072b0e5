"""Importance resampling towards a target distribution over hashed n-gram features.

An untrained regular-expression split of the ``tokenizers`` library cuts each ASCII-lowered text into
words with offsets. A window over these offset pairs is a feature, whose CRC-32 names its bucket. The
bucket histograms of all documents and of the target texts give every bucket a gain; a document's
weight is the sum over its features, and Gumbel noise turns the highest scores into a weighted draw
without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from clearshelf.llm.common import arrow_map, as_row, utf8
from clearshelf.sources.tables import stage

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Params:
    """``words`` is the longest feature, ``least_words`` the shortest document that can be drawn and
    ``percent`` the share of those that is drawn."""

    words: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


def splitter() -> pre_tokenizers.Split:
    """The split that keeps the matches of ``PATTERN``."""
    return pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)


def windows(found: list[tuple[str, tuple[int, int]]], lowered: str, longest: int) -> Iterator[bytes]:
    """The UTF-8 bytes of all runs of 1 to ``longest`` words.

    A run spans the text from its first to its last offset; where its words stand one space apart
    it is that slice, else its words are joined.
    """
    for word, _ in found:
        yield word.encode()
    for n in range(2, longest + 1):
        for i in range(len(found) - n + 1):
            run = found[i : i + n]
            start, stop = run[0][1][0], run[-1][1][1]
            joined = lowered[start:stop]
            if len(joined) != sum(len(w) for w, _ in run) + n - 1 or joined.count(" ") != n - 1:
                joined = " ".join(w for w, _ in run)
            yield joined.encode()


def with_buckets(rows: DataFrame, params: Params) -> DataFrame:
    """``rows`` (last column ``_text``) with the text replaced by ``_words``, ``_features`` (their
    numbers), and the distinct ``_buckets`` with their ``_counts``."""
    words, buckets = params.words, params.buckets

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            n_words, n_features, ends, ids, counts = [], [], [0], [], []
            for text in utf8(batch, "_text"):
                lowered = (text or b"").lower().decode()
                found = split.pre_tokenize_str(lowered) if lowered else []
                hashes = map(zlib.crc32, windows(found, lowered, words))
                of = np.fromiter(hashes, np.int64) % buckets
                distinct, times = np.unique(of, return_counts=True)
                n_words.append(len(found))
                n_features.append(len(of))
                ids.append(distinct.astype(np.int32))
                counts.append(times.astype(np.int64))
                ends.append(ends[-1] + len(distinct))
            offsets = pa.array(ends, pa.int32())
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (ids, counts)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            added = [
                pa.array(n_words, pa.int64()),
                pa.array(n_features, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(flat[0], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(flat[1], pa.int64())),
            ]
            names = [*batch.schema.names[:-1], "_words", "_features", "_buckets", "_counts"]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=names)

    schema = T.StructType([
        *rows.schema.fields[:-1],
        T.StructField("_words", T.LongType()),
        T.StructField("_features", T.LongType()),
        T.StructField("_buckets", T.ArrayType(T.IntegerType())),
        T.StructField("_counts", T.ArrayType(T.LongType())),
    ])
    return arrow_map(rows, marked, schema)


def histogram(marked: DataFrame, name: str) -> DataFrame:
    """(``bucket``, ``name``): features of all rows in each bucket that has any."""
    pairs = marked.select(F.explode(F.arrays_zip("_buckets", "_counts")).alias("p"))
    return pairs.groupBy(F.col("p._buckets").alias("bucket")).agg(F.sum("p._counts").alias(name))


def gains(source: DataFrame, target: DataFrame, params: Params) -> np.ndarray:
    """The gain of every bucket in thousandths: of its smoothed share in the target over that in the
    source. What reaches the driver is one row a bucket at most."""
    s, t = (
        {r[0]: r[1] for r in histogram(x, "n").collect()} for x in (source, target)
    )
    all_s, all_t = sum(s.values()), sum(t.values())
    n = params.buckets
    return np.array(
        [
            math.floor(
                1000 * math.log((t.get(b, 0) + 1) * (all_s + n) / ((s.get(b, 0) + 1) * (all_t + n)))
            )
            for b in range(n)
        ],
        np.int64,
    )


def _weighed(marked: DataFrame, gain: np.ndarray) -> DataFrame:
    """``marked`` with its two lists replaced by ``weight``, the sum of gains over all features."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            running = np.concatenate((
                [0], np.cumsum(gain[ids.flatten().to_numpy()] * counts.flatten().to_numpy())
            ))
            ends = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy())))
            total = pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64())
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            names = [*batch.schema.names[:-2], "weight"]
            yield pa.RecordBatch.from_arrays([*kept, total], names=names)

    schema = T.StructType([*marked.schema.fields[:-2], T.StructField("weight", T.LongType())])
    return arrow_map(marked, summed, schema)


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the id alone, rounded down; a null id counts as no text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def ranked(rows: DataFrame, order: list[Column], *, percent: int) -> DataFrame:
    """``rows`` with ``rank``, from 1 in ``order``, of the given share of them (rounded down); null
    for the others.

    Rows are sorted over ranges and written; a row's place in its range plus the rows of the ranges
    before it is its rank, so that only one count a range meets in one task.
    """
    placed = F.monotonically_increasing_id()
    sorted_ = stage(rows.orderBy(*order).withColumn("_place", placed), "sorted")
    part = F.shiftright("_place", 33)
    parts = sorted_.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.expr(f"{percent} * sum(_n) over () div 100").alias("_drawn"),
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    found = sorted_.withColumn("_part", part).join(F.broadcast(ranges), "_part")
    rank = F.col("_before") + inside + 1
    return found.select(
        *[sorted_[c] for c in rows.columns], F.when(rank <= F.col("_drawn"), rank).alias("rank")
    )


def _scored(rows: DataFrame, targets: DataFrame, params: Params) -> DataFrame:
    """``rows`` (``_id``, ``_at``, last column ``_text``) with words, features, weight and score."""
    marked = stage(with_buckets(rows, params), "features")
    gain = gains(marked, stage(with_buckets(targets, params), "target_features"), params)
    score = F.col("weight") + noise(F.col("_id"), params.seed)
    return _weighed(marked, gain).withColumn("score", score)


def resampling_scores(
    docs: DataFrame,
    targets: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    params: Params = Params(),
) -> DataFrame:
    """(id, ``n_features``, ``weight``, ``score``, ``rank``) of every document.

    Null and empty texts have no features, weight 0 and no rank. A null id draws the noise of an
    empty text and comes last among equal scores. Repeated rows keep a rank each; equal rows are
    told apart by their place only, and then give equal results. Without target texts all gains
    rest on the documents alone. An empty table gives no rows. Other columns play no part.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    scored = _scored(rows, targets.select(F.col(target_col).alias("_text")), params)
    return _drawn_from(scored, params).select(
        F.col("_id").alias(id_col), F.col("_features").alias("n_features"), "weight", "score", "rank"
    )


def _drawn_from(scored: DataFrame, params: Params) -> DataFrame:
    long_ = F.col("_words") >= params.least_words
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_features")]
    drawn = ranked(scored.where(long_), order, percent=params.percent)
    rest = scored.where(~long_).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)


def resample(
    docs: DataFrame,
    targets: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    params: Params = Params(),
) -> DataFrame:
    """The drawn documents with the columns of ``docs``, of any names, and no more.

    Nulls, ties and repeated rows are those of ``resampling_scores``.
    """
    whole = as_row(docs).select(
        "row",
        F.monotonically_increasing_id().alias("_at"),
        F.col(f"row.`{id_col}`").alias("_id"),
        F.col(f"row.`{text_col}`").alias("_text"),
    )
    kept = stage(whole.drop("_text", "_id"), "rows")
    texts = kept.select("_at", F.col(f"row.`{id_col}`").alias("_id"), F.col(f"row.`{text_col}`").alias("_text"))
    scored = _scored(texts, targets.select(F.col(target_col).alias("_text")), params)
    chosen = _drawn_from(scored, params).where("rank is not null").select("_at")
    return kept.join(chosen, "_at", "left_semi").select("row.*")
