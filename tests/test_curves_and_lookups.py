"""Isotonic curves, densities, whole-unit lookups and stored member bitmaps, against plain Python."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clearshelf.operators import cart
from clearshelf.operators import disaggregation as dg
from clearshelf.operators import evaluation as ev
from clearshelf.operators import scoring as so


def nearest_rising(points):
    """Max of min of the means of all spans around a point: the least-squares fit by its closed form."""
    def mean(j, k):
        part = points[j : k + 1]
        return sum(x * w for x, w in part) / sum(w for _, w in part)

    n = len(points)
    return [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]


def test_isotonic_fit_is_the_nearest_rising_curve(spark):
    rng = random.Random(5)
    curves = {
        c: [(float(rng.randrange(-9, 9)), float(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 9))]
        for c in range(60)
    }
    rows = [(c, i, x, w) for c, points in curves.items() for i, (x, w) in enumerate(points)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "c int, at int, x double, w double").repartition(3)
    got = so.isotonic_fit(df, by=["c"], order_by="at", value="x", weight="w", out="fit").collect()
    assert len(got) == len(rows)
    fits = {(r.c, r.at): r.fit for r in got}
    for c, points in curves.items():
        found = [fits[c, i] for i in range(len(points))]
        assert found == pytest.approx(nearest_rising(points), abs=1e-9)
        assert found == sorted(found)
        total = sum(x * w for x, w in points)
        assert sum(f * w for f, (_, w) in zip(found, points)) == pytest.approx(total, abs=1e-9)


def test_isotonic_fit_of_nulls_ties_and_nothing(spark):
    schema = "c int, at int, x double, w double, _points int"
    rows = [(1, 0, 4.0, 1.0, 0), (1, 1, None, 1.0, 0), (1, 2, 2.0, 1.0, 0), (1, 3, 9.0, 0.0, 0), (None, 0, 1.0, 1.0, 0)]
    rows += [(2, 0, 5.0, 1.0, 0), (2, 0, 1.0, 1.0, 0)]
    got = so.isotonic_fit(spark.createDataFrame(rows, schema), by=["c"], order_by="at", value="x", weight="w")
    assert {(r.c, r.at, r.x): r.isotonic_x for r in got.collect()} == {
        (1, 0, 4.0): 3.0, (1, 1, None): None, (1, 2, 2.0): 3.0, (1, 3, 9.0): None, (None, 0, 1.0): 1.0,
        (2, 0, 5.0): 5.0, (2, 0, 1.0): 1.0,
    }
    none = spark.createDataFrame([], schema)
    assert so.isotonic_fit(none, by=["c"], order_by="at", value="x").count() == 0


def _pred(spark, pairs):
    return spark.createDataFrame(pairs, "target double, predicted_sales double")


def _width(values):
    n, mean = len(values), sum(values) / len(values)
    sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1))
    ordered = sorted(values)

    def quantile(p):
        at = p * (n - 1)
        low = math.floor(at)
        return ordered[low] + (ordered[min(low + 1, n - 1)] - ordered[low]) * (at - low)

    apart = (quantile(0.75) - quantile(0.25)) / 1.34
    return 0.9 * n**-0.2 * min(x for x in (sd, apart) if x > 0)


def _gauss(x, h):
    return math.exp(-0.5 * (x / h) ** 2) / (h * math.sqrt(2 * math.pi))


def test_error_density_equals_the_direct_sum(spark):
    rng = random.Random(2)
    errors = [rng.randrange(-30, 30) / 2 for _ in range(200)] + [400.0, -51.0]  # on grid points, or outside
    got = ev.error_density(_pred(spark, [(10.0, 10.0 + e) for e in errors] + [(None, 1.0)])).collect()
    h = _width(errors)
    assert len(got) > 60
    for r in got:
        assert r.density == pytest.approx(sum(_gauss(r.x - e, h) for e in errors) / len(errors), abs=1e-9)


def test_error_density_between_grid_points_and_of_equal_errors(spark):
    halves = ev.error_density(_pred(spark, [(0.0, 0.25)] * 4)).collect()
    assert {r.x: r.density for r in halves}[0.0] == pytest.approx({r.x: r.density for r in halves}[0.5])
    assert sum(r.density for r in halves) * 0.5 == pytest.approx(1.0, abs=1e-6)
    assert ev.error_density(_pred(spark, [(None, 1.0)])).count() == 0


def test_joint_density_equals_the_direct_sum(spark):
    rng = random.Random(4)
    pairs = [(2.0 * rng.randrange(0, 40), 2.0 * rng.randrange(0, 40)) for _ in range(150)]
    widths = []
    for values in zip(*pairs):
        mean = sum(values) / len(values)
        sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        widths.append(sd * len(values) ** (-1 / 6))
    got = ev.joint_density(_pred(spark, pairs)).collect()
    assert len(got) == 51 * 51
    for r in rng.sample(got, 100):
        direct = sum(_gauss(r.actual - t, widths[0]) * _gauss(r.predicted - f, widths[1]) for t, f in pairs)
        assert r.n_rows == pytest.approx(4 * direct, abs=1e-9)
    assert ev.joint_density(_pred(spark, [])).count() == 0


CHILD = "parent_item_nbr int, club_nbr int, child_item_nbr int, inventory_qty int, unit_qty_1w int"
ASK = "parent_item_nbr int, club_nbr int, quantity long"


def test_lookup_equals_the_scenario_table_in_whole_units(spark):
    rng = random.Random(8)
    rows = [(p, 1, c, rng.randrange(0, 40), rng.randrange(0, 9)) for p in range(6) for c in range(7)]
    weights = dg.disagg_raw_weights(spark.createDataFrame(rows, CHILD))
    scenarios = dg.disagg_scenarios(weights)
    asks = [(p, 1, q) for p in range(6) for q in range(0, 160, 3)]
    got = {}
    for r in dg.disagg_lookup(spark.createDataFrame(asks + asks[:5], ASK), weights).collect():
        got.setdefault((r.parent_item_nbr, r.quantity), {})[r.child_item_nbr] = r.units
    table = {}
    for r in dg.disagg_final(weights, scenarios).collect():
        table.setdefault((r.parent_item_nbr, r.inv_min, r.inv_max), []).append(r)
    hits = 0
    for (parent, low, high), children in table.items():
        for _, _, q in (a for a in asks if a[0] == parent and low <= a[2] < high):
            live = {r.child_item_nbr: q * r.final_weights for r in children if r.scenario_flag == 0}
            units = got[parent, q]
            assert units.keys() == live.keys()
            assert sum(units.values()) == q
            assert all(abs(units[c] - x) < 1 for c, x in live.items())
            hits += 1
    assert hits > 20
    largest = {p: max(r.inv_cap for r in weights.where(F.col("parent_item_nbr") == p).collect()) for p in range(6)}
    for p, _, q in asks:
        assert ((p, q) in got) == (q < largest[p])


def test_lookup_rounds_to_the_largest_remainders(spark):
    weights = spark.createDataFrame(
        [(1, 1, c, w, 100.0) for c, w in ((1, 0.5), (2, 0.3), (3, 0.2), (4, 0.0))],
        "parent_item_nbr int, club_nbr int, child_item_nbr int, weights double, inv_cap double",
    )
    got = dg.disagg_lookup(spark.createDataFrame([(1, 1, 7), (2, 1, 7), (1, 1, None), (1, 1, -3)], ASK), weights)
    assert {r.child_item_nbr: r.units for r in got.collect()} == {1: 4, 2: 2, 3: 1, 4: 0}  # 3.5, 2.1, 1.4


def test_lookup_in_a_parent_of_a_hundred_thousand_children(spark):
    children = spark.range(100_000).selectExpr(
        "1 AS parent_item_nbr", "1 AS club_nbr", "CAST(id AS int) AS child_item_nbr",
        "CAST(1 + id % 997 AS int) AS inventory_qty", "CAST(id % 13 AS int) AS unit_qty_1w",
    )
    weights = dg.disagg_raw_weights(children)
    got = dg.disagg_lookup(spark.createDataFrame([(1, 1, 1_000_000), (1, 1, 7)], ASK), weights)
    sums = {r.quantity: r.units for r in got.groupBy("quantity").agg(F.sum("units").alias("units")).collect()}
    assert sums == {1_000_000: 1_000_000, 7: 7}


EVENTS = "event_id long, member_id long, date date, channel string, fulfilment string, item_nbr int"


def _events(spark, seed, days, n=400):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice((rng.randrange(40), rng.randrange(40), 10**6 + rng.randrange(5), None)), rng.choice(days),
         rng.choice(cart.CHANNELS), rng.choice(cart.FULFILMENTS), rng.choice((1, 2, None)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, EVENTS)


def test_weeks_from_stored_days_equal_the_count_from_events(spark, tmp_path):
    as_of, path = date(2024, 2, 1), str(tmp_path / "days")
    days = [as_of - timedelta(days=k) for k in range(0, 32)]
    events = _events(spark, 3, days)
    cart.store_member_days(events, path, first=days[-1], last=days[2])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    for _ in range(2):  # the night's day, and the same again
        cart.store_member_days(events.where(F.col("date") == days[1]), path, first=days[1], last=days[1])
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    known = events.where("member_id IS NOT NULL")
    expected = cart.cart_members_week_back(known, as_of=as_of)
    got = cart.cart_members_stored(spark.read.parquet(path), as_of=as_of)
    assert sorted(got.collect()) == sorted(expected.collect())


def test_a_night_reads_the_stored_days_of_four_weeks(spark, tmp_path):
    as_of, path = date(2024, 2, 1), str(tmp_path / "days")
    days = [as_of - timedelta(days=k) for k in range(0, 60)]
    cart.store_member_days(_events(spark, 4, days), path, first=days[-1], last=days[0])
    got = cart.cart_members_stored(spark.read.parquet(path), as_of=as_of)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
