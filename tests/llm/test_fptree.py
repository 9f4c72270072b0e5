"""Lexical ranking: equal to scoring every document, whatever the trees look like."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from clearshelf.llm import fptree
from clearshelf.llm.common import alnum_words


def plain(docs, items, k=10):
    """Score every document for every item."""
    counts = [(i, Counter(alnum_words(t.encode() if t else None))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // length
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in alnum_words(text.encode() if text else None) if c[t]
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        scores.sort()
        found += [(item, at + 1, x[3], -x[0]) for at, x in enumerate(scores[:k])]
    return sorted(found, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    shares = [1 / (i + 1) for i in range(80)]
    texts = [" ".join(rng.choices(words, shares, k=int(rng.lognormvariate(3, 1)) + 1)) for _ in range(n)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 15)))) for i in range(25)]
    return [(i * 3, t) for i, t in enumerate(texts)], items


def ranked(spark, docs, wanted, **params):
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(wanted, "item_id long, text string")
    found = fptree.rank_documents(a, b, params=fptree.Params(**params))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("params", [{}, {"leaf": 2, "cells": 2000}, {"items": 4, "terms": 20, "leaf": 5}])
def test_equals_scoring_every_document(spark, params):
    docs, items = corpus(3, 500)
    assert ranked(spark, docs, items, **params) == plain(docs, items)


def test_copies_tie_by_id_and_nulls_come_last(spark):
    docs = [(i, "apple pear") for i in range(40, 0, -1)] + [(None, "apple pear"), (7, "plum"), (8, None), (9, "")]
    docs += [(100 + i, "fig") for i in range(100)]
    items = [(1, "Apple, apple"), (2, "pear plum"), (None, "plum"), (4, "nowhere"), (5, None), (6, ""), (1, "fig")]
    assert ranked(spark, docs, items, leaf=4) == plain(docs, items)
    few = [(None, "apple"), (3, "apple"), (None, "pear"), (1, "x"), (2, "y"), (5, "z")]
    assert ranked(spark, few, [(1, "apple")]) == plain(few, [(1, "apple")])


def test_long_texts_long_items_and_repeated_rows(spark):
    docs = [(1, "a b " * 40_000), (2, "a " + "c " * 30_000), (2, "a " + "c " * 30_000), (3, "é 漢字 a")]
    docs += [(10 + i, "d") for i in range(10)]
    items = [(1, "a b c É é 漢字 " * 500), (1, "a b c É é 漢字 " * 500)]
    assert ranked(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None), (2, " ")], [(1, "a")]) == []


def test_columns_of_clashing_names_play_no_part(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 9, "x"), (2, "c", 8, "y"), (3, "c", 8, "y")], "doc_id long, text string, score int, _id string"
    )
    items = spark.createDataFrame([(5, "a", 1, "q")], "item_id long, text string, rank int, item string")
    found = [tuple(r) for r in fptree.rank_documents(docs, items).collect()]
    assert found == plain([(1, "a b"), (2, "c"), (3, "c")], [(5, "a")])


def test_bounds_hold_and_most_documents_are_never_scored():
    rng = np.random.default_rng(5)
    freq = (rng.random((2000, 40)) < 0.6 / np.arange(1, 41)).astype(np.int32) * rng.integers(1, 5, (2000, 40), np.int32)
    freq[:, 30:] = 0
    freq[1000:1012, 30:] = 3
    factor = rng.integers(30, 200, 2000)
    tree = fptree.Tree(freq, factor, 32)
    for node, (start, stop) in enumerate(tree.spans):
        assert (tree.peaks[node] >= tree.freq[start:stop]).all()
        assert (tree.lows[node] <= tree.factor[start:stop]).all()
    leaves = [tree.spans[i] for i, below in enumerate(tree.children) if not below]
    assert sorted(x for a, b in leaves for x in range(a, b)) == list(range(2000))
    ranking = fptree.Ranking([(np.arange(28, 40), np.full(12, 5000))], fptree.Params())
    ranking.search(tree, np.zeros(2000, np.int64), np.arange(2000))
    scores = fptree.partial_scores(freq[:, 28:], factor, 8).sum(axis=1) * 5000
    best = sorted(range(2000), key=lambda i: (-scores[i], i))[:10]
    assert ranking.best[0][2].tolist() == best
    assert ranking.scored < 1000
