"""SimHash near-duplicates by an inverted index over positional bytes with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits share at
least six of them, so the index lists every fingerprint under each choice of six positional bytes:
whoever shares a posting list has reached the least number of matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm import byte_index, similar
from clearshelf.llm.byte_index import BYTES
from clearshelf.llm.common import arrow_map, as_row, spaced_words, utf8
from clearshelf.llm.components import components
from clearshelf.sources.tables import stage

SHINGLE, SEED, MOST_BITS = 3, 42, 2
#: Posting lists up to this length are paired; longer ones are linked over shared neighbours.
PAIRED = 24


def simhash(words: list[bytes], *, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a word sequence; 0 without words.

    A bit is 1 if it is set in over half of the shingles' XXH64, repeats included. Fewer words than
    a shingle holds count as one shingle.
    """
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    return byte_index.majority(np.array(hashes, np.uint64))


def with_simhash(rows: DataFrame, *, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``rows`` (last column ``_text``) with the text replaced by ``_fp``, its SimHash as a long."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(spaced_words(t), shingle=shingle, seed=seed) for t in utf8(batch, "_text")]
            signed = np.array(found, np.uint64).view(np.int64)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "_fp"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(signed, pa.int64())], names=names)

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_fp", T.LongType())])
    return arrow_map(rows, marked, schema)


def links(fingerprints: DataFrame, *, most_bits: int = MOST_BITS) -> DataFrame:
    """Edges (``a``, ``b``) whose components are those of all pairs within two differing bits.

    ``fingerprints`` has the distinct ``fp``. A posting list holds distinct fingerprints that agree
    in six bytes, so 65,536 at most. Lists up to ``PAIRED`` give their pairs: the tally of shared
    positional bytes must reach six and the differing bits must verify. Longer lists, as a large
    group of near copies makes them, tie each fingerprint to those one bit away from it within the
    two free bytes: two fingerprints within two bits meet in one of these, and two that meet are
    within two bits. Such a meeting point need not be a fingerprint itself.
    """
    if most_bits != 2:
        raise ValueError("the index is built for two differing bits")
    least = BYTES - most_bits
    postings = byte_index.postings(F.col("fp"), least)
    index = fingerprints.select("fp", F.explode(postings).alias("p")).select("fp", "p.c", "p.k")
    lists = index.groupBy("c", "k").agg(F.collect_list("fp").alias("fps"))
    shared = stage(lists.where(F.size("fps") > 1), "postings")

    short = shared.where(F.size("fps") <= PAIRED)
    firsts = short.select("fps", F.posexplode("fps").alias("i", "a"))
    pairs = firsts.select("a", F.explode(F.expr("slice(fps, i + 2, size(fps))")).alias("b"))
    a, b = F.col("a"), F.col("b")
    close = pairs.where(byte_index.reached(a, b, least=least, most_bits=most_bits))

    flips = []
    for c in byte_index.choices(least):
        free = [p for p in range(BYTES) if p not in c]
        bits = [1 << (8 * p + bit) for p in free for bit in range(8)]
        flips.append(
            F.array(*[F.lit(x - (1 << 64) if x >> 63 else x).cast("long") for x in bits])
        )
    long_ = shared.where(F.size("fps") > PAIRED).select("c", F.explode("fps").alias("a"))
    flip = F.array(*flips)[F.col("c").cast("int")]
    meeting = long_.select("a", F.explode(flip).alias("f")).select(
        "a", F.col("a").bitwiseXOR(F.col("f")).alias("b")
    )
    return close.union(meeting)


def near_duplicates(rows: DataFrame) -> DataFrame:
    """(``fp``, ``first``) of every distinct fingerprint in ``rows``.

    ``rows`` is a stored table with the fingerprint ``_fp`` and an orderable struct ``_order``.
    ``first`` is the smallest ``_order`` of the component of the fingerprint, where fingerprints
    that differ in two bits or fewer are linked. Copies meet in a partial aggregate; only distinct
    fingerprints are indexed and linked.
    """
    reps = stage(
        rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_order").alias("first")), "reps"
    )
    roots = components(links(reps.select("fp")))
    rooted = stage(
        reps.join(roots, reps["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(lowest, "root").select("fp", "first")


def _order(id_col: str) -> Column:
    """Rows by id, nulls last, then by their place in the stored table."""
    id_ = F.col(f"row.`{id_col}`")
    return F.struct(id_.isNull().alias("none"), id_.alias("id"), F.col("_at").alias("at"))


def simhash_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ``fingerprint``, ``component_id``) of every document.

    ``component_id`` is the smallest id reachable over links, the document's own included; null
    only if all ids of the component are null. Null and empty texts have the fingerprint 0 and are
    linked like any other. Repeated rows stay. An empty table gives no rows.
    """
    narrow = docs.select(F.struct(F.col(id_col)).alias("row"), F.col(text_col).alias("_text"))
    # pairing a document with its place needs no place here: equal ids give equal results
    marked = with_simhash(narrow.select("row", F.lit(0).cast("long").alias("_at"), "_text"))
    rows = stage(marked, "simhash").withColumn("_order", _order(id_col))
    found = near_duplicates(rows)
    return rows.join(found, rows["_fp"] == found["fp"]).select(
        F.col(f"row.`{id_col}`").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group of near copies, that of the smallest id, with the columns of ``docs``.

    Near copies share four fifths of their five-word shingles; groups are the components of such
    pairs. Candidates come from the byte index of SimHash fingerprints, at more bits than the two of
    ``simhash_components``, and from MinHash bands for what it does not reach (``similar``). Of rows with that id the first in the stored table stays; null ids come last. Columns of
    any name pass through.
    """
    whole = as_row(docs).select(
        "row",
        F.monotonically_increasing_id().alias("_at"),
        F.col(f"row.`{text_col}`").alias("_text"),
    )
    rows = stage(similar.with_bands(whole), "shingles").withColumn("_order", _order(id_col))
    reps = stage(
        rows.groupBy(F.col("_set").alias("node")).agg(
            F.min("_order").alias("first"), F.any_value("_size").alias("size"),
            F.any_value("_fp").alias("fp"), F.any_value("_bands").alias("bands"),
        ),
        "sets",
    )
    texts = rows.select("_at", F.col(f"row.`{text_col}`").alias("_text"))
    roots = similar.near_copies(reps, texts).withColumnRenamed("node", "_node")
    rooted = reps.join(roots, reps["node"] == roots["_node"], "left").select(
        "first", F.coalesce("root", "node").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    found = lowest.select(F.col("first.at").alias("_kept"))
    return rows.join(found, F.col("_at") == F.col("_kept"), "left_semi").select("row.*")
