"""Systematic mixing: targets, copies and the same result in every run."""

import random

import pytest
from pyspark.sql import functions as F

from clearshelf.llm import mixing


def water_filling(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing and resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, free, target = sum(sizes.values()), set(names), {}
    while free:
        share = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        target |= {s: float(cap * sizes[s]) for s in over}
        free -= over
    return target


def corpus(docs_of, seed=1, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["b", "b", "b", "a", "é", "Z", None])
        rows.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), source))
    return rows, docs_of(rows)


def test_targets_equal_repeated_sharing(spark, docs_of):
    rows, docs = corpus(docs_of)
    rows.append((9999, "one", "tiny"))
    found = mixing.mix_sources(docs_of(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    expected = water_filling(sizes)
    for r in found:
        assert r.source_size == sizes[r.row.source]
        assert r.target == pytest.approx(expected[r.row.source])
    assert expected["tiny"] == 3.0


def test_taken_words_come_near_the_target(spark, docs_of):
    rows, docs = corpus(docs_of, n=2000)
    taken, target = {}, {}
    for r in mixing.mix_sources(docs).collect():
        assert 0 <= r.copies <= 3
        taken[r.row.source] = taken.get(r.row.source, 0) + r.copies * r.size
        target[r.row.source] = r.target
    for source, words in target.items():
        assert taken[source] == pytest.approx(words, rel=0.05)


def test_copies_of_a_source_differ_by_one_at_most_and_reruns_agree(spark, docs_of):
    rows, docs = corpus(docs_of, n=300)
    first = sorted((r.row.doc_id, r.copies) for r in mixing.mix_sources(docs).collect())
    again = mixing.mix_sources(docs_of(rows[::-1]).repartition(7)).collect()
    assert first == sorted((r.row.doc_id, r.copies) for r in again)


def test_size_bucket_is_monotone(spark):
    sizes = [*range(300), 1000, 1001, 1023, 1024, 10**6, 2**40, 2**40 + 2**37]
    df = spark.createDataFrame([(s,) for s in sizes], "_size long")
    buckets = [r.b for r in df.select("_size", mixing.size_bucket("_size").alias("b")).orderBy("_size").collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) > 30


def test_nulls_repeated_rows_and_clashing_columns(spark, docs_of):
    rows = [(1, None, None), (1, None, None), (None, "a b", "x"), (2, "", "x"), (2, " \t\n", "y")]
    docs = docs_of(rows, extra="1 as copies").withColumn("_size", F.lit("k"))
    found = mixing.mix_sources(docs).collect()
    assert len(found) == 5
    assert sorted(r.size for r in found) == [0, 0, 0, 0, 2]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {r.text for r in mixed.collect()} <= {"a b", None, "", " \t\n"}


def test_empty_table(spark, docs_of):
    assert mixing.mix_sources(docs_of([])).count() == 0
    assert mixing.mixed_documents(docs_of([])).count() == 0


def test_no_python_in_the_plan(spark, docs_of):
    plan = mixing.mixed_documents(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
