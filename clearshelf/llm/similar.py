"""Near copies by exact similarity of five-word shingles, candidates from the SimHash byte index and
from MinHash bands.

Two texts are near copies if their sets of shingles have a Jaccard similarity of 0.8 or more. The
index lists the SimHash of each set under three of its eight positional bytes: it reaches all pairs within
five bits and those up to ``MOST_BITS`` that share three bytes. Near copies may differ in more: at 0.8
their fingerprints differ in ten bits of 64 on average, and some share no byte at all. The bands reach these; a pair
at 0.8 shares none of 32 bands of four minima with a chance of (1 - 0.8^4)^32 = 5e-8 at most. Every
candidate pair is verified on its shingles, is in one component already by verified links, or cannot be
near copies by its shingles that nobody else has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm import byte_index
from clearshelf.llm.common import arrow_map, spaced_words, utf8
from clearshelf.llm.components import components
from clearshelf.sources.tables import stage

SHINGLE, SEED = 5, 42
#: Least similarity, as a fraction: 4 of 5.
LEAST = (4, 5)
BANDS, ROWS = 32, 4
#: Least number of positional bytes and most differing bits of a pair that the byte index gives.
LEAST_BYTES, MOST_BITS = 3, 12
#: Lists up to this length give all pairs at once; longer ones a star, then what it leaves open.
PAIRED = 24
#: Parts of the shingles for which a set's shared ones are counted.
PARTS = 128
_BLOCK = 2048
_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)[:, None]


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; fewer words than one holds are one shingle."""
    words = spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-SHINGLE])).tolist()
    stops = (ends[SHINGLE - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], SEED) for a, b in zip(starts, stops))
    return np.unique(np.fromiter(found, np.uint64, len(starts)))


def bands(found: np.ndarray) -> list[int]:
    """The band keys of a set of shingles; none of an empty set."""
    if not len(found):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _BLOCK):
        mixed = found[None, at : at + _BLOCK] * _FACTORS + _OFFSETS
        np.minimum(least, mixed.min(axis=1), out=least)
    raw, width = least.tobytes(), 8 * ROWS
    keys = [xxhash.xxh64_intdigest(raw[i * width : (i + 1) * width], i) for i in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Is the similarity of two sets the least one or more?"""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * shared >= LEAST[0] * (len(a) + len(b) - shared)


def with_bands(rows: DataFrame) -> DataFrame:
    """``rows`` (last column ``_text``) with the text replaced by ``_set``, a hash of its set of
    shingles, ``_size``, their number, ``_fp``, their SimHash, and ``_bands``."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, sizes, fps, keys = [], [], [], []
            for text in utf8(batch, "_text"):
                found = shingles(text)
                sets.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(len(found))
                fps.append(byte_index.majority(found))
                keys.append(bands(found))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            added = [pa.array(np.array(sets, np.uint64).view(np.int64), pa.int64()),
                     pa.array(sizes, pa.int64()),
                     pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))]
            names = [*batch.schema.names[:-1], "_set", "_size", "_fp", "_bands"]
            yield pa.RecordBatch.from_arrays([*kept, *added], names=names)

    schema = T.StructType([
        *rows.schema.fields[:-1],
        T.StructField("_set", T.LongType()),
        T.StructField("_size", T.LongType()),
        T.StructField("_fp", T.LongType()),
        T.StructField("_bands", T.ArrayType(T.LongType())),
    ])
    return arrow_map(rows, marked, schema)


def _shingle_sets(nodes: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(``_node``, ``_shingles``) of the distinct ``nodes``; ``texts`` has ``_at`` and ``_text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text).tobytes() for text in utf8(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["_node", "_shingles"]
            )

    places = reps.select(F.col("node").alias("_node"), F.col("first.at").alias("_at"))
    own = texts.join(nodes.join(places, "_node"), "_at").select("_node", "_text")
    return arrow_map(own, cut, "_node long, _shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that are near copies. The side that many pairs may share, ``a``, is
    joined last, so that its shingles are not shuffled once a pair."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, first, other in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != held:
                    held, own = a, np.frombuffer(first.as_buffer(), np.uint64)
                keep.append(alike(own, np.frombuffer(other.as_buffer(), np.uint64)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    b = sets.select(F.col("_node").alias("b"), F.col("_shingles").alias("_b"))
    a = sets.select(F.col("_node").alias("a"), F.col("_shingles").alias("_a"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "_a", "_b")
    return arrow_map(both, checked, "a long, b long")


def _alone(sets: DataFrame, crowd: DataFrame) -> DataFrame:
    """(``_node``, ``alone``, ``held``) of the nodes of ``crowd``: how many shingles no other of them has,
    and how many it shares in each of ``PARTS`` parts, which the shingles' hashes name."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(flat)], names=["_node", "_one"])

    pairs = arrow_map(sets.join(crowd, "_node", "left_semi"), spread, "_node long, _one long")
    met = pairs.groupBy("_one").agg(F.count(F.lit(1)).alias("n"), F.min("_node").alias("_node"))
    part = F.pmod("_one", F.lit(PARTS)).cast("int").alias("part")
    sums = pairs.groupBy("_node", part).agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("alone"))
    once = met.where("n = 1").groupBy("_node", part).agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("alone"))
    both = sums.union(once.select("_node", "part", "n", "alone")).groupBy("_node", "part").agg(
        F.sum("alone").alias("alone"), (F.sum("n") - F.sum("alone")).alias("shared")
    )
    of = both.groupBy("_node").agg(
        F.sum("alone").alias("alone"), F.map_from_entries(F.collect_list(F.struct("part", "shared"))).alias("parts")
    )
    held = F.transform(
        F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.coalesce(F.element_at("parts", i), F.lit(0)).cast("int")
    )
    return of.select("_node", "alone", held.alias("held"))


def _may_be_alike(x: Column, y: Column) -> Column:
    """Can two sets be near copies? They share at most what neither has alone, and in each part of the
    shingles at most what the one with less of it shares with anyone; their union is at least the rest."""

    def enough(shared: Column) -> Column:
        return LEAST[1] * shared >= LEAST[0] * (x["size"] + y["size"] - shared)

    by_part = F.aggregate(
        F.zip_with(x["held"], y["held"], lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda n, m: n + m
    )
    return enough(F.least(x["size"] - x["alone"], y["size"] - y["alone"])) & enough(by_part)


def _unsettled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs of a crowded list that the verified ``edges`` leave in different components and that may
    be alike. Members of the list's largest component meet only those of the others.

    ``members`` has ``list``, ``m`` and ``of``, a struct of ``size``, ``alone`` and ``held``. A member that has
    more than a fifth of its shingles alone is like no other and meets nobody.
    """
    roots = components(edges)
    rooted = members.join(roots, members["m"] == roots["node"], "left").select(
        "list", "m", "of", F.coalesce("root", "m").alias("root")
    )
    size, alone = F.col("of.size"), F.col("of.alone")
    open_ = stage(rooted.where(LEAST[1] * (size - alone) >= LEAST[0] * size), "open")
    sizes = open_.groupBy("list", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("list").agg(
        F.max(F.struct("n", "root"))["root"].alias("largest"), F.count(F.lit(1)).alias("roots")
    )
    split = stage(largest.where("roots > 1").select("list", "largest"), "split")
    small = open_.join(split, "list").where("root <> largest")
    x = small.select("list", F.col("m").alias("x"), F.col("root").alias("rx"), F.col("of").alias("ox"))
    y = open_.select("list", F.col("m").alias("y"), F.col("root").alias("ry"), F.col("of").alias("oy"))
    met = x.join(y, (x["list"] == y["list"]) & (x["rx"] != y["ry"]) & _may_be_alike(x["ox"], y["oy"]))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _index(reps: DataFrame) -> DataFrame:
    """(``node``, ``c``, ``k``): the list of every band, then, from ``BANDS`` on, those of the byte index."""
    bands = reps.select("node", F.posexplode("bands").alias("c", "k"))
    postings = byte_index.postings(F.col("fp"), LEAST_BYTES, first=BANDS)
    listed = reps.where("size > 0").select("node", F.explode(postings).alias("p"))
    return bands.select("node", F.col("c").cast("byte").alias("c"), "k").union(listed.select("node", "p.c", "p.k"))


def _lists(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (``a``, ``b``) of the short lists that may be alike, and crowded lists as rows (``list``, ``m``).

    Copies share many lists, so lists of equal members count once, as that of a band if there is one.
    A list is counted before its members are gathered: no crowded list becomes one row. A pair of a
    posting list must pass the count filter; no pair meets whose sizes alone are too far apart.
    """
    index = _index(reps)
    counted = index.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = stage(index.join(stage(counted, "lists"), ["c", "k"]).select("c", "k", "node", "n"), "listed")
    mix = F.bit_xor(F.xxhash64("node"))
    told = listed.groupBy("c", "k", "n").agg(F.min("node").alias("least"), mix.alias("mix"))
    keys = told.groupBy("n", "least", "mix").agg(F.min(F.struct("c", "k")).alias("list"))
    rows = stage(listed.join(keys.select("list.c", "list.k"), ["c", "k"]), "told")

    one = F.struct("node", "size", "fp").alias("one")
    short = rows.where(F.col("n") <= PAIRED).join(reps.select("node", "size", "fp"), "node").select("c", "k", one)
    lists = short.groupBy("c", "k").agg(F.sort_array(F.collect_list("one")).alias("nodes"))
    firsts = lists.select("c", "nodes", F.posexplode("nodes").alias("i", "x"))
    pairs = firsts.select("c", "x", F.explode(F.expr("slice(nodes, i + 2, size(nodes))")).alias("y"))
    x, y = F.col("x"), F.col("y")
    close = byte_index.reached(x["fp"], y["fp"], least=LEAST_BYTES, most_bits=MOST_BITS)
    sizes = LEAST[1] * F.least("x.size", "y.size") >= LEAST[0] * F.greatest("x.size", "y.size")
    few = pairs.where(sizes & ((F.col("c") < BANDS) | close)).select(x["node"].alias("a"), y["node"].alias("b"))
    crowded = rows.where(F.col("n") > PAIRED).select(F.struct("c", "k").alias("list"), F.col("node").alias("m"))
    return few.distinct(), crowded


def near_copies(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every set that has a near copy: the components of all near copies.

    ``reps`` is a stored table of distinct sets (``node``, ``first``, ``size``, ``fp``, ``bands``), ``texts`` one
    of texts by their place ``_at``, that of ``first`` included.

    In a crowded list every member is verified against the one that has the fewest shingles alone,
    the nearest to what all share. What remains in other components meets the rest of its band lists only
    if sizes and lonely shingles allow; crowded posting lists leave that to the bands, which list every set.
    """
    pairs, crowded = _lists(reps)
    few = stage(pairs, "few")
    crowd = stage(crowded.select(F.col("m").alias("_node")).distinct(), "crowd")
    nodes = few.select(F.explode(F.array("a", "b")).alias("_node")).union(crowd).distinct()
    sets = stage(_shingle_sets(nodes, reps, texts), "shingle_sets")

    sizes = crowd.join(reps.select(F.col("node").alias("_node"), "size"), "_node")
    of = F.struct("size", "alone", "held").alias("of")
    known = stage(sizes.join(_alone(sets, crowd), "_node").select(F.col("_node").alias("m"), of), "alone")
    members = stage(crowded.join(known, "m").select("list", "m", "of"), "members")
    centres = stage(members.groupBy("list").agg(F.min(F.struct("of.alone", "m"))["m"].alias("a")), "centres")
    star = members.join(centres, "list").where("a <> m").select("a", F.col("m").alias("b"))
    edges = stage(_verified(few.union(star.distinct()), sets), "alike")
    rest = stage(_unsettled(members.where(F.col("list.c") < BANDS), edges), "unsettled")
    if rest.isEmpty():
        return components(edges)
    return components(edges.union(stage(_verified(rest, sets), "alike")))
