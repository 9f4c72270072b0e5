"""Weights, scenarios and their invariants, also for one very large group."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clearshelf.operators import disaggregation as dg

INPUT = "parent_item_nbr int, child_item_nbr int, club_nbr int, inventory_qty int, unit_qty_1w decimal(18,2)"


def _children(spark, stock, sold, parent=1):
    rows = [(parent, i, 1, s, Decimal(u)) for i, (s, u) in enumerate(zip(stock, sold, strict=True))]
    return spark.createDataFrame(rows, INPUT)


def test_zero_totals_share_equally_and_make_no_scenario(spark):
    weights = dg.disagg_raw_weights(_children(spark, (0, 0), (0, 0)))
    assert [(r.inv_weights, r.sales_weights, r.inv_cap) for r in weights.collect()] == [(0.5, 0.5, 0.0)] * 2
    scenarios = dg.disagg_scenarios(weights)
    assert scenarios.count() == 0
    assert dg.disagg_final(weights, scenarios).count() == 0


def test_three_caps_make_two_scenarios(spark):
    rows = [(1, i, 1, 0.1 * i, float(cap)) for i, cap in ((1, 10), (2, 20), (3, 30), (4, 30))]
    weights = spark.createDataFrame(
        rows, "parent_item_nbr int, child_item_nbr int, club_nbr int, weights double, inv_cap double"
    )
    scenarios = dg.disagg_scenarios(weights)
    assert sorted((r.inv_min, r.inv_max, r.scenario) for r in scenarios.collect()) == [
        (10, 20, 1), (20, 30, 2),
    ]
    flags = {(r.child_item_nbr, r.scenario): r.scenario_flag for r in dg.disagg_flags(weights, scenarios).collect()}
    assert flags == {
        (1, 1): 1, (2, 1): 0, (3, 1): 0, (4, 1): 0, (1, 2): 1, (2, 2): 1, (3, 2): 0, (4, 2): 0,
    }


def _brute_force(rows):
    caps = sorted({r.inv_cap for r in rows})
    out = set()
    for n, (low, high) in enumerate(zip(caps, caps[1:]), start=1):
        total = sum(r.weights for r in rows if r.inv_cap >= high)
        for r in rows:
            weight = r.weights / total if r.inv_cap >= high else 0.0
            out.add((r.child_item_nbr, n, low, high, round(weight, 9)))
    return out


def test_one_large_group_against_brute_force(spark):
    rng = random.Random(7)
    stock = [rng.choice((0, 1, 5, 50, 5000, rng.randrange(10**6))) for _ in range(150)]
    sold = [rng.choice((0, 0, 1, 3, 20)) for _ in range(150)]
    weights = dg.disagg_raw_weights(_children(spark, stock, sold))
    expected = _brute_force(weights.collect())
    final = dg.disagg_final(weights, dg.disagg_scenarios(weights))
    got = {
        (r.child_item_nbr, r.scenario, r.inv_min, r.inv_max, round(r.final_weights, 9))
        for r in final.collect()
    }
    assert got == expected


def test_final_weights_sum_to_one(ws):
    weights = ws.disagg_weights
    final = dg.disagg_final(weights, dg.disagg_scenarios(weights))
    sums = final.groupBy("parent_item_nbr", "club_nbr", "scenario").agg(F.sum("final_weights").alias("s"))
    assert sums.count() > 0
    for row in sums.collect():
        assert row.s == pytest.approx(1.0)
