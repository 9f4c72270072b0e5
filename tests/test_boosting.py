"""Constrained boosting against a plain single-process version, and what its constraints promise."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearshelf.operators import boosting as bo

NAMES = ("a", "weeks", "c", "discount")
SCALE = 1 << 16


def table(spark, n, seed, noise=3.0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, w, c, d = rng.randrange(6), rng.randrange(1, 9), round(rng.gauss(0, 5), 2), rng.choice((0.0, 0.1, 0.3, 0.5))
        y = a * 2 + w * (1 + 2 * d) - (c > 1) * 4 + rng.gauss(0, noise) - (10 if w == 5 else 0) - (8 if d == 0.3 else 0)
        rows.append((float(a), float(w), c, d, round(y, 2)))
    return rows, spark.createDataFrame(rows, "a double, weeks double, c double, discount double, target double")


class Plain:
    """The same trees, one row after the other."""

    def __init__(self, rows, val, params, rising=()):
        p = self.p = params
        x, y = [r[:-1] for r in rows], [r[-1] for r in rows]
        self.cuts = []
        for f in range(len(NAMES)):
            ordered, cuts = sorted(r[f] for r in x), set()
            for i in range(1, p.bins):
                spot = i / p.bins * (len(ordered) - 1)
                low, high = ordered[int(spot // 1)], ordered[int(-(-spot // 1))]
                cuts.add(low + (high - low) * (spot - spot // 1))
            self.cuts.append(sorted(cuts))
        self.rising = [n in rising for n in NAMES]
        self.base = sum(np.floor(v * SCALE + 0.5) for v in y) / SCALE / len(y)
        self.trees, self.errors = [], []
        bins, val_bins = [self.binned(r) for r in x], [self.binned(r[:-1]) for r in val]
        pred, val_pred = [self.base] * len(x), [self.base] * len(val)
        best, kept = float("inf"), 0
        for t in range(p.trees):
            share = max(1, round(p.columns * len(NAMES)))
            taken = sorted(random.Random(f"{p.seed}/{t}").sample(range(len(NAMES)), share))
            g = [int(np.floor((a - b) * SCALE + 0.5)) for a, b in zip(pred, y)]
            tree = self.grow(bins, g, taken, list(range(len(x))), -float("inf"), float("inf"), 0)
            if not isinstance(tree, tuple):
                break
            self.trees.append(tree)
            pred = [v + self.leaf(tree, b) for v, b in zip(pred, bins)]
            val_pred = [v + self.leaf(tree, b) for v, b in zip(val_pred, val_bins)]
            self.errors.append(sum(np.floor(abs(a - r[-1]) * 1e6 + 0.5) for a, r in zip(val_pred, val)) / 1e6 / len(val))
            if self.errors[-1] < best - p.tolerance:
                best, kept = self.errors[-1], len(self.trees)
            if len(self.trees) - kept >= p.patience:
                break
        self.trees = self.trees[:kept]

    def binned(self, x):
        return [bisect.bisect_left(c, v) for c, v in zip(self.cuts, x)]

    def weight(self, g, n, low, high):
        return max(min(-(g / SCALE) / (n + self.p.l2), high), low)

    def grow(self, bins, g, taken, at, low, high, depth, value=0.0):
        """A leaf's value, or (covariate, bin, left, right)."""
        if depth == self.p.depth:
            return value

        def score(w, total, n):
            return -(2 * (total / SCALE) * w + (n + self.p.l2) * w * w)

        ga, na, best = sum(g[i] for i in at), len(at), None
        wa = self.weight(ga, na, low, high)
        for f in taken:
            sums = {}
            for i in at:
                s = sums.setdefault(bins[i][f], [0, 0])
                s[0] += g[i]
                s[1] += 1
            gl = nl = 0
            for k in sorted(sums)[:-1]:
                gl, nl = gl + sums[k][0], nl + sums[k][1]
                wl, wr = self.weight(gl, nl, low, high), self.weight(ga - gl, na - nl, low, high)
                if self.rising[f] and wl > wr:
                    continue
                gain = score(wl, gl, nl) + score(wr, ga - gl, na - nl) - score(wa, ga, na)
                if gain > 1e-6 and (best is None or gain > best[0]):
                    best = (gain, f, k, wl, wr)
        if best is None:
            return value
        _, f, k, wl, wr = best
        middle = (wl + wr) / 2
        bounds = ((low, min(high, middle)), (max(low, middle), high)) if self.rising[f] else ((low, high),) * 2
        parts = [i for i in at if bins[i][f] <= k], [i for i in at if bins[i][f] > k]
        left, right = (
            self.grow(bins, g, taken, part, *bound, depth + 1, w * self.p.rate)
            for part, bound, w in zip(parts, bounds, (wl, wr))
        )
        return f, k, left, right

    def leaf(self, tree, bins):
        while isinstance(tree, tuple):
            f, k, left, right = tree
            tree = right if bins[f] > k else left
        return tree

    def predict(self, x):
        return self.base + sum(self.leaf(t, self.binned(x)) for t in self.trees) if self.trees else self.base


RISING = ("weeks", "discount")


@pytest.mark.parametrize("rising", [(), RISING])
def test_equals_the_plain_version(spark, rising):
    rows, train = table(spark, 300, 1)
    held, val = table(spark, 100, 2)
    params = bo.BoostParams(trees=5, depth=4, rate=0.3, rows=1.0, columns=0.75, bins=8, store=3, tolerance=0.0)
    model = bo.fit_boosted(train, val, covariates=NAMES, rising=rising, params=params)
    plain = Plain(rows, held, params, rising)
    assert len(model.roots) == len(plain.trees) > 3
    assert model.errors == pytest.approx(plain.errors, abs=1e-9)
    found = [r.prediction for r in model.transform(val).collect()]
    assert found == pytest.approx([plain.predict(r[:-1]) for r in held], abs=1e-9)


def falls(model, spark, probes, name):
    """Probes whose prediction falls when one covariate alone rises."""
    grid = [i / 8 for i in range(9)] if name == "discount" else [float(i) for i in range(10)]
    rows = [
        (i, *[x if n != name else v for n, x in zip(NAMES, probe)]) for i, probe in enumerate(probes) for v in grid
    ]
    schema = "probe int, " + ", ".join(f"{n} double" for n in NAMES)
    found = {}
    for r in model.transform(spark.createDataFrame(rows, schema)).orderBy("probe", name).collect():
        found.setdefault(r.probe, []).append(r.prediction)
    return sum(any(b < a for a, b in zip(v, v[1:])) for v in found.values())


def test_predictions_rise_with_constrained_covariates_only(spark):
    _, train = table(spark, 800, 3, noise=1.0)
    held, val = table(spark, 200, 4, noise=1.0)
    params = bo.BoostParams(trees=6, depth=5, rate=0.4, bins=16)
    rng = random.Random(5)
    probes = [r[:-1] for r in held[:60]]
    probes += [(rng.uniform(-9, 20), rng.uniform(-9, 20), rng.uniform(-99, 99), rng.uniform(-1, 2)) for _ in range(60)]
    bound = bo.fit_boosted(train, val, covariates=NAMES, rising=RISING, params=params)
    free = bo.fit_boosted(train, val, covariates=NAMES, params=params)
    for name in RISING:
        assert falls(bound, spark, probes, name) == 0
        assert falls(free, spark, probes, name) > 0
    assert 0 < free.errors[-1] < bound.errors[-1] < bound.errors[0]


def test_a_fit_repeats_on_any_partitioning(spark):
    _, train = table(spark, 200, 6)
    params = bo.BoostParams(trees=4, depth=3, rate=0.5)
    one, other = (
        bo.fit_boosted(df, train, covariates=NAMES, params=params) for df in (train, train.repartition(7))
    )
    assert one == other


def test_boosting_stops_when_the_error_no_longer_falls(spark):
    _, train = table(spark, 100, 7)
    params = bo.BoostParams(trees=30, depth=2, rate=0.3, patience=2, tolerance=0.5)
    model = bo.fit_boosted(train, train, covariates=NAMES, params=params)
    assert len(model.errors) == len(model.roots) + 2 < 30
    seen = []
    ended = bo.fit_boosted(
        train, train, covariates=NAMES, params=params, watch=lambda n, e: seen.append((n, e)) or n == 1
    )
    assert ended.stopped == 1 and seen == [(1, ended.errors[0])]


def test_odd_training_tables(spark):
    _, train = table(spark, 40, 8)
    empty = train.limit(0)
    params = bo.BoostParams(trees=2, depth=2)
    none = bo.fit_boosted(empty, empty, covariates=NAMES, params=params)
    assert [r.prediction for r in none.transform(train.limit(1)).collect()] == [0.0]
    flat = train.withColumn("target", F.lit(4.0))
    same = bo.fit_boosted(flat, flat, covariates=NAMES, params=params)
    assert same.roots == () and {r.prediction for r in same.transform(train).collect()} == {4.0}
    some = train.withColumn("target", F.when(F.col("a") > 2, F.col("target")))
    model = bo.fit_boosted(some, empty, covariates=NAMES, params=params)
    assert len(model.roots) == 2 and model.errors == ()
    clashing = train.withColumns({"_x": F.lit(1), "n": F.lit(2), "_left": F.lit(3), "_own": F.lit(4)})
    assert model.transform(clashing).columns == [*clashing.columns, "prediction"]
