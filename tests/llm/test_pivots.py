"""Exact top-k inner products equal brute force, with every candidate a bound may save."""

import math
import random

import numpy as np
import pytest

from clearshelf.llm import pivots


def plain(rows, k=5, every=50):
    """Every query against every other row."""
    whole = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for a, (query, q) in enumerate(whole):
        if query is None or query % every:
            continue
        met = []
        for b, (i, x) in enumerate(whole):
            if a != b:
                score = min(max(sum(m * n for m, n in zip(q, x)), -(1 << 63)), (1 << 63) - 1)
                met.append((-score, i is None, i or 0, i))
        met.sort()
        found += [(query, at + 1, x[3], -x[0]) for at, x in enumerate(met[:k])]
    return sorted(found, key=str)


def searched(spark, vecs, kind="float", **params):
    df = spark.createDataFrame(vecs, f"vec_id long, embedding array<{kind}>")
    found = pivots.top_inner_products(df, params=pivots.Params(**params))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def vectors(seed, n, dim, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    found = centres[rng.integers(0, clusters, n)] + 0.2 * rng.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(found)]


@pytest.mark.parametrize("params", [{}, {"block": 3, "rows": 64, "step": 4}, {"pivots": 1, "k": 9, "step": 1}])
def test_equals_brute_force(spark, params):
    rows = vectors(1, 700, 16)
    assert searched(spark, rows, **params) == plain(rows, k=params.get("k", 5))


def test_ties_repeats_and_null_ids(spark):
    rows = [(i, [0.5, 0.25]) for i in range(120)] + [(50, [0.5, 0.25]), (None, [0.5, 0.25]), (None, [9.0, 9.0])]
    random.Random(2).shuffle(rows)
    assert searched(spark, rows, rows=16, step=2) == plain(rows)


def test_unfit_vectors_stay_out_and_lengths_may_differ(spark):
    rows = [
        (0, [1.0, 2.0, 3.0]), (1, None), (2, [1.0, None, 1.0]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 0.0]), (5, []), (6, [4.0]), (7, [1.0, -1.0, 0.001, 7.0]), (50, []),
        (100, None), (-50, [-0.001, 0.5]),
    ]
    assert searched(spark, rows) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e13, -3.0]), (1, [1e13, 2.0]), (2, [1e13 + 1, 2.0]), (3, [-1e15, 0.5]), (50, [1e15, 1e15]), (4, [3.0, 1.0])]
    assert searched(spark, rows, kind="double") == plain(rows)


def test_empty_table_and_no_query(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(1, [1.0])]) == []
    assert searched(spark, [(0, [1.0])]) == []


def test_columns_of_clashing_names_play_no_part(spark):
    df = spark.createDataFrame(
        [(0, [1.0], 3, "a"), (1, [2.0], 4, "b")], "vec_id long, embedding array<float>, score int, _at string"
    )
    assert [tuple(r) for r in pivots.top_inner_products(df).collect()] == [(0, 1, 1, 131072)]


def test_bounds_spare_most_evaluations():
    rows = np.array([[math.floor(256 * x) for x in v] for _, v in vectors(4, 4000, 8, clusters=40)])
    chosen = pivots.choose_pivots(rows[:256], 16)
    far = pivots._distances(rows, chosen)
    asked = np.arange(0, 4000, 50)
    search = pivots.Search(asked, rows[asked], far[asked], pivots.Params(step=32))
    search.meet(np.arange(4000), np.zeros(4000, np.int64), np.arange(4000), rows, far)
    for q, at in enumerate(asked):
        scores = rows @ rows[at]
        best = sorted((i for i in range(4000) if i != at), key=lambda i: (-scores[i], i))[:5]
        assert search.best[q][2].tolist() == best
    assert search.evaluated < 0.5 * 4000 * len(asked)
