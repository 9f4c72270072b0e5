"""The sequential search on known surfaces, and one search with real fits."""

import random

from pyspark.sql import functions as F

from clearshelf.operators import boosting as bo
from clearshelf.operators import tuning as tu

BEST = {"rate": 0.041, "depth": 20, "columns": 0.8, "rows": 0.7, "l2": 4.1}


def surface(setting):
    """A bowl with its lowest point at ``BEST``; each parameter counts by its place in its range."""
    loss = 0.0
    for name, values in tu.SEARCHED.items():
        gap = (values.index(setting[name]) - values.index(BEST[name])) / (len(values) - 1)
        loss += gap * gap
    return loss


def searched(seed, trials=50):
    sampler = tu.ParzenSampler(tu.SEARCHED, seed)
    return tu.search(lambda s, _: (surface(s), 1, None), sampler, tu.Halving(()), trials=trials)


def test_ranges_hold_the_searched_values():
    assert tu.SEARCHED["rate"] == (0.001, 0.011, 0.021, 0.031, 0.041, 0.051)
    assert tu.SEARCHED["depth"][0] == 14 and tu.SEARCHED["depth"][-1] == 38
    assert tu.SEARCHED["l2"][0] == 3.1 and tu.SEARCHED["l2"][-1] == 10.1


def test_a_seed_repeats_and_seeds_differ():
    assert searched(1) == searched(1)
    assert searched(1) != searched(2)


def test_the_sampler_beats_random_search():
    parzen, uniform = [], []
    for seed in range(20):
        parzen.append(min(t[2] for t in searched(seed)))
        rng = random.Random(seed)
        drawn = [{n: rng.choice(v) for n, v in tu.SEARCHED.items()} for _ in range(50)]
        uniform.append(min(map(surface, drawn)))
    assert sum(parzen) < 0.5 * sum(uniform)
    assert sum(a <= b for a, b in zip(parzen, uniform)) >= 15


def test_no_setting_is_tried_twice_while_others_are_left():
    settings = [tuple(t[1].items()) for t in searched(3)]
    assert len(set(settings)) == len(settings)


def test_halving_ends_the_worse_half_at_rungs_only():
    rule = tu.Halving([2, 4], least=4)
    assert not any(rule.stops(1, e) for e in (9, 1, 5, 7, 8))
    assert [rule.stops(2, e) for e in (4.0, 3.0, 2.0, 9.0, 1.0, 2.5, 3.5)] == [False, False, False, True, False, False, True]
    assert not rule.stops(4, 100.0)


def test_search_with_fits_lists_where_trials_were_stopped(spark):
    rows = spark.range(120).select(
        (F.col("id") % 8).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        ((F.col("id") % 8) * 3.0 + F.col("id") % 5).alias("target"),
    )
    space = {"rate": (0.001, 0.3), "depth": (1, 2), "l2": (3.1, 10.1)}
    found = tu.tune_boosted(
        rows, rows, covariates=("a", "b"), space=space, trials=6, start=3, base=bo.BoostParams(trees=3, rows=1.0, columns=1.0, store=9, bins=8)
    ).collect()
    assert sorted(r.trial for r in found) == list(range(6))
    assert [r.val_mae for r in found] == sorted(r.val_mae for r in found)
    assert found[0].learning_rate == 0.3
    assert {r.l2 for r in found} <= {3.1, 10.1}
    for r in found:
        assert (r.n_trees == r.stopped_at == 1) if r.stopped_at else r.n_trees == 3
    assert any(r.stopped_at for r in found)
