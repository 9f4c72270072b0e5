"""Order statistics against numpy, with null groups and values of either sign."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearshelf.functions import ordered


def _values(kind, n, rng):
    if kind == "ties":
        return [float(rng.choice((0, 1, 1, 1, 2))) for _ in range(n)]
    if kind == "ratios":
        return [rng.randrange(50) / rng.randrange(1, 60) for _ in range(n)]
    if kind == "signed":
        return [rng.gauss(0, 10) for _ in range(n)]
    return [rng.lognormvariate(0, 3) for _ in range(n)] + [1e300]


@pytest.mark.parametrize("kind", ["ties", "ratios", "spread", "signed"])
def test_quantiles(spark, kind):
    rng = random.Random(3)
    groups = {"a": _values(kind, 4001, rng), None: _values(kind, 900, rng), "c": [1.5], "d": [1.0, 2.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probabilities = [0.1, 0.25, 0.5, 0.8]
    got = {r.g: r for r in ordered.quantiles(df, ["g"], F.col("v"), probabilities).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for i, p in enumerate(probabilities):
            assert got[g][f"q{i}"] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12)
    everything = [v for vs in groups.values() for v in vs]
    one = ordered.quantiles(df, [], F.col("v"), [0.5]).first()
    assert one.q0 == pytest.approx(float(np.median(everything)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert ordered.quantiles(empty, [], F.col("v"), [0.5]).collect() == []


def test_an_overall_quantile_brings_only_bucket_totals_together(spark):
    """One task sees a row per value bucket, however many rows there are."""
    df = spark.range(200_000).select((F.col("id") % 50_000 / 50_000 + 1).alias("v"))
    plan = ordered.quantiles(df, [], F.col("v"), [0.5])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "hashpartitioning(_bucket" in physical
    buckets = df.select(ordered._bucket(F.col("v"))).distinct().count()
    assert buckets < 1500
    assert ordered.quantiles(df, [], F.col("v"), [0.5]).first().q0 == pytest.approx(1.49999, abs=1e-12)


def test_in_order(spark):
    rng = random.Random(5)
    groups = {
        1: sorted({rng.uniform(0, 10**7) for _ in range(800)} | {0.0}),
        2: sorted({rng.randrange(40) / 8 - 2 for _ in range(60)}),
        None: [2.5, 1e200],
    }
    rows = [(g, v, int(abs(v)) % 5 + 1) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g int, v double, w int").repartition(5)
    got = {(r.g, r.v): r for r in ordered.in_order(df, ["g"], "v", weight=F.col("w")).collect()}
    assert len(got) == len(rows)
    for g, vs in groups.items():
        running = 0
        for i, v in enumerate(vs):
            running += int(abs(v)) % 5 + 1
            r = got[g, v]
            following = vs[i + 1] if i + 1 < len(vs) else None
            assert (r._position, r._count, r._next, r._running) == (i + 1, len(vs), following, running)
