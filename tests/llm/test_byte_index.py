"""The SimHash byte index: what it reaches, and near copies that it links without any band."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from clearshelf.llm import byte_index, similar
from clearshelf.sources.tables import stage
from test_similar import brute_kept, family


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_majority_equals_a_count_of_bits():
    rng = random.Random(11)
    for n in (0, 1, 2, 7, 500):
        hashes = [rng.getrandbits(64) for _ in range(n)]
        expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)
        assert byte_index.majority(np.array(hashes, np.uint64)) == expected


def test_all_fingerprints_within_five_bits_share_a_list(spark):
    rng = random.Random(12)
    values = []
    for _ in range(40):
        v = rng.getrandbits(64)
        values += [v] + [v ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (3, 5, 7, 9)]
    df = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "i int, fp long")
    lists = df.select("i", "fp", F.explode(byte_index.postings(F.col("fp"), 3)).alias("p"))
    x, y = lists.alias("x"), lists.alias("y")
    met = x.join(y, (F.col("x.p") == F.col("y.p")) & (F.col("x.i") < F.col("y.i")))
    close = byte_index.reached(F.col("x.fp"), F.col("y.fp"), least=3, most_bits=12)
    found = {(r.a, r.b) for r in met.where(close).select(F.col("x.i").alias("a"), F.col("y.i").alias("b")).collect()}

    def shared(a, b):
        return sum((a ^ b) >> (8 * p) & 0xFF == 0 for p in range(8))

    pairs = list(combinations(range(len(values)), 2))
    bits = {p: (values[p[0]] ^ values[p[1]]).bit_count() for p in pairs}
    assert found == {p for p in pairs if bits[p] <= 12 and shared(*(values[i] for i in p)) >= 3}
    assert {p for p in pairs if bits[p] <= 5} <= found


def without_bands(spark, texts):
    """Ids that stay if the byte index alone gives the candidates."""
    df = spark.createDataFrame(list(texts.items()), "i long, _text string")
    marked = stage(similar.with_bands(df), "marked")
    reps = stage(
        marked.groupBy(F.col("_set").alias("node")).agg(
            F.min(F.struct(F.col("i").alias("at"))).alias("first"), F.any_value("_size").alias("size"),
            F.any_value("_fp").alias("fp"), F.array().cast("array<long>").alias("bands"),
        ),
        "sets",
    )
    roots = similar.near_copies(reps, df.withColumnRenamed("i", "_at")).withColumnRenamed("node", "_node")
    rooted = reps.join(roots, reps["node"] == roots["_node"], "left")
    lowest = rooted.groupBy(F.coalesce("root", "node")).agg(F.min("first.at").alias("i"))
    return {r.i for r in lowest.collect()}


def test_the_index_alone_links_near_copies(spark):
    """One changed word in 300 and more: the fingerprints share at least three bytes."""
    rng = random.Random(13)
    texts = [t for _ in range(12) for t in family(rng, 4, 400, 1)] + family(rng, 60, 1500, 1) + ["", " ", "a b"]
    rng.shuffle(texts)
    by_id = dict(enumerate(texts))
    assert without_bands(spark, by_id) == brute_kept(by_id)


def test_the_index_gives_only_verified_links(spark):
    """Nothing is linked that the similarity of shingles does not link."""
    rng = random.Random(14)
    texts = [t for _ in range(10) for t in family(rng, 6, 60, 6)]
    by_id = dict(enumerate(texts))
    whole, alone = brute_kept(by_id), without_bands(spark, by_id)
    assert whole <= alone < set(by_id)
