"""SimHash: fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from clearshelf.llm import simhash
from clearshelf.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(values):
    values = list(dict.fromkeys(values))
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i, v in enumerate(values):
        groups.setdefault(find(i), set()).add(v)
    return {frozenset(g) for g in groups.values()}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def linked(spark, values):
    """Components over given fingerprints; a node that is no fingerprint is left out."""
    df = spark.createDataFrame([(signed(v),) for v in set(values)], "fp long")
    rows = df.select(F.col("fp").alias("_fp"), F.struct(F.col("fp").alias("id")).alias("_order"))
    found = simhash.near_duplicates(rows)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["first"]["id"], set()).add(r["fp"] % (1 << 64))
    return {frozenset(g) for g in groups.values()}


def test_links_equal_brute_force_on_random_neighbours(spark):
    rng = random.Random(5)
    values = []
    for _ in range(60):
        v = rng.getrandbits(64)
        values.append(v)
        for _ in range(rng.randrange(6)):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
            values.append(v)
    assert linked(spark, values) == brute_components(values)


def test_a_crowded_posting_list_is_linked_without_pairs(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(16), k)) for k in (2, 4, 6) for _ in range(150)}
    values |= {centre ^ (1 << 40) ^ (1 << 50) ^ (1 << 3), centre ^ (7 << 60)}
    assert len(values) > 4 * simhash.PAIRED
    assert linked(spark, values) == brute_components(values)


def test_three_bits_apart_is_no_link_but_a_chain_is(spark):
    a = 0x0123456789ABCDEF
    assert linked(spark, [a, a ^ 0b111]) == brute_components([a, a ^ 0b111])
    assert len(linked(spark, [a, a ^ 0b111, a ^ 0b1])) == 1


def test_query_rows(spark, docs_of):
    long_ = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(5, None), (3, ""), (9, " \n\t"), (4, "One two"), (8, "one TWO"), (7, long_), (2, long_),
            (2, long_), (None, "alone here now"), (6, "É two three four é")]
    found = simhash.simhash_components(docs_of(rows)).collect()
    assert len(found) == len(rows)
    expected = {i: f"{brute_fingerprint(t):016x}" for i, t in rows}
    component = {}
    for r in found:
        assert r.fingerprint == expected[r.doc_id]
        component[r.doc_id] = r.component_id
    assert component == {5: 3, 3: 3, 9: 3, 4: 4, 8: 4, 7: 2, 2: 2, None: None, 6: 6}


def test_one_document_stays_and_columns_pass(spark, docs_of):
    rows = [(3, "a b c d"), (1, "A b c d"), (1, "a b c d"), (2, "x y z"), (None, "x y z"), (None, None)]
    docs = docs_of(rows, extra="doc_id as _fp")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (True, 0)]


def test_empty_table(spark, docs_of):
    assert simhash.simhash_components(docs_of([])).count() == 0
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert all(roots[i] == 0 for i in range(41))
    assert all(roots[1000 + i] == 1000 for i in range(50))
    assert len(roots) == 91
