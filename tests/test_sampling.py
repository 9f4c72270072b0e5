"""Horizon expansion, splits and their invariants."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clearshelf.operators import sampling as sa
from clearshelf.operators import scans as sc
from clearshelf.operators.second_level import DISCOUNTS, MAX_DISCOUNT, UNITS_NEXT
from clearshelf.params import RunDates

D = date(2001, 6, 15)


def _row(spark, units=(5, 5, 6, 6, 6, 9, 9, 9), discounts=(0.1,) * 8, greatest=0.5):
    values = {
        "mds_fam_id": 1, "club_nbr": 1, "item_nbr": 1, "date": D, "item_on_shelf_date_dt": D,
        MAX_DISCOUNT: greatest,
        **dict(zip(UNITS_NEXT, map(float, units), strict=True)),
        **dict(zip(DISCOUNTS, discounts, strict=True)),
    }
    kinds = {int: "int", float: "double", date: "date", type(None): "double"}
    schema = ", ".join(f"{n} {kinds[type(v)]}" for n, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema)


def test_expansion_keeps_the_first_week_of_each_target(spark):
    rows = sa.expand_horizons(_row(spark))
    assert rows.count() == 8
    kept = sa.first_week_of_target(rows).collect()
    assert sorted((r.num_weeks, r.target) for r in kept) == [(1, 5), (3, 6), (6, 9)]


def test_discounts_beyond_the_horizon_are_marked(spark):
    rows = {r.num_weeks: r for r in sa.expand_horizons(_row(spark)).collect()}
    assert [rows[1][d] for d in DISCOUNTS] == [0.1] + [-1.0] * 7
    assert [rows[8][d] for d in DISCOUNTS] == [0.1] * 8


def test_last_week_target(spark):
    rows = {r.num_weeks: r for r in sa._week_target(sa.expand_horizons(_row(spark))).collect()}
    assert [rows[n].week_target for n in range(1, 9)] == [5, 0, 1, 0, 0, 3, 0, 0]


def test_missing_discounts_take_the_greatest(spark):
    row = sa.discount_fill_filter(_row(spark, discounts=(None,) + (0.2,) * 7)).first()
    assert row[DISCOUNTS[0]] == 0.5


@pytest.mark.parametrize("discounts, greatest", [((-0.1,) + (0.2,) * 7, 0.5), ((None,) * 8, float("-inf"))])
def test_negative_or_unknown_discounts_go(spark, discounts, greatest):
    assert sa.discount_fill_filter(_row(spark, discounts=discounts, greatest=greatest)).count() == 0


def test_rows_without_future_sales_go(spark):
    assert sa.any_future_sales(_row(spark, units=(0,) * 8)).count() == 0
    assert sa.any_future_sales(_row(spark, units=(0,) * 7 + (1,))).count() == 1


def test_run_dates():
    dates = RunDates(date(2001, 11, 5))
    assert dates.today == date(2001, 11, 4)
    assert (dates.train[1] - dates.train[0]).days == 450
    assert dates.train[1] < dates.val[0] <= dates.val[1] < dates.test[0]


def test_splits_are_disjoint_and_deduplicated(ws):
    keys = ["mds_fam_id", "club_nbr", "date", "target"]
    assert ws.splits.groupBy(*keys).count().where("count > 1").count() == 0
    seen = ws.splits.select("split", "date").distinct()
    assert seen.groupBy("date").count().where("count > 1").count() == 0


def test_targets_fit_the_stock(ws):
    assert ws.samples.where("target > inventory_qty or inventory_qty <= 3").count() == 0


def test_only_one_sample_per_item_club_month(ws):
    kept = sa.initial_filter(ws.second)
    groups = kept.groupBy("mds_fam_id", "club_nbr", "month", "year").count()
    assert groups.where("count > 1").count() == 0


@pytest.mark.parametrize(
    "run, frequency, start",
    [
        (date(2001, 11, 5), "weekly", date(2001, 4, 23)),
        (date(2001, 11, 5), "monthly", date(2001, 8, 23)),
        (date(2001, 11, 20), "monthly", date(2001, 9, 6)),
        (date(2001, 11, 20), None, date(2022, 10, 1)),
    ],
)
def test_period_split_starts(spark, run, frequency, start):
    days = spark.sql(
        f"select explode(sequence(date'{start}' - interval 3 days, date'{start}' + interval 3 days)) as date"
    )
    got = sc.period_split(days, run_date=run, frequency=frequency)
    first_test = got.where(F.col("split") == "test").agg(F.min("date")).first()[0]
    assert first_test == start
    assert got.where(F.col("split") == "train").count() == 3


def test_unknown_frequency_is_refused(spark):
    with pytest.raises(ValueError):
        sc.period_split(spark.range(1), run_date=D, frequency="daily")
