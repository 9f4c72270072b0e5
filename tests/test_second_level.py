"""Imputation, calendar and schema rules on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clearshelf.functions.calendar import us_week, us_week_year
from clearshelf.functions.numeric import finite, half_up
from clearshelf.operators import second_level as sl

INF = float("inf")


def _wide(spark, **given):
    names = [*sl.UNITS_BACK, *sl.UNITS_NEXT, *sl.PRICE_BACK, *sl.PRICE_NEXT, sl.UNITS_52]
    values = {n: None for n in names} | given
    schema = ", ".join(f"{n} double" for n in values)
    return spark.createDataFrame([tuple(values.values())], schema)


def test_no_past_price_leaves_infinity(spark):
    row = sl.impute_features(sl.row_extremes(sl.weekly_discount(_wide(spark)))).first()
    assert row[sl.MIN_PRICE] == INF and row[sl.PRICE_BACK[0]] == INF
    assert row[sl.MAX_DISCOUNT] == -INF and row[sl.MIN_UNITS] == INF
    assert row[sl.UNITS_BACK[0]] == 0 and row[sl.UNITS_NEXT[7]] == 0 and row[sl.UNITS_52] == 0


def test_price_gap_takes_the_lowest_week(spark):
    given = {sl.PRICE_BACK[1]: 8.0, sl.PRICE_BACK[2]: 6.0, sl.UNITS_BACK[1]: 3.0}
    row = sl.impute_features(sl.row_extremes(sl.weekly_discount(_wide(spark, **given)))).first()
    assert [row[c] for c in sl.PRICE_BACK] == [6.0, 8.0, 6.0, 6.0]
    assert row[sl.MIN_UNITS] == 3.0


def test_weekly_mean_has_a_floor(spark):
    df = _wide(spark, **{c: 0.0 for c in sl.UNITS_BACK}, inventory_qty=2.0, median_price_6_month_last_amt=4.0)
    row = sl.price_units_ratio(df).first()
    assert row[sl.WEEKLY_UNITS] == 0.1
    assert row.inventory_unit_1_week_back_pct == pytest.approx(80)
    assert row.inventory_1_month_last_weekly_sale_nbr == pytest.approx(20)


def test_change_is_null_without_sales(spark):
    given = dict(zip(sl.UNITS_BACK, (0.0, 2.0, 1.0, 4.0), strict=True))
    row = sl.units_wow_change(_wide(spark, **given)).first()
    assert row.change_unit_sold_1_2_week_back_cnt is None
    assert row.change_unit_sold_2_3_week_back_cnt == 0.5
    assert row.change_unit_sold_3_4_week_back_cnt == -3


@pytest.mark.parametrize(
    "day, week, year",
    [(date(2024, 12, 29), 1, 2025), (date(2024, 12, 28), 52, 2024), (date(2023, 1, 1), 1, 2023),
     (date(2021, 12, 31), 1, 2022), (date(2022, 1, 2), 2, 2022)],
)
def test_us_week(spark, day, week, year):
    d = F.col("d")
    row = spark.createDataFrame([(day,)], "d date").select(us_week(d), us_week_year(d)).first()
    assert tuple(row) == (week, year)


def test_rounding_is_half_up_and_keeps_infinity(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (INF,), (None,), (1e300,)], "x double")
    got = [r[0] for r in df.select(half_up(F.col("x"))).collect()]
    assert got == [0.13, -0.12, INF, None, 1e300]
    assert [r[0] for r in df.select(finite(F.col("x"))).collect()][2] is None


def test_change_compares_with_the_week_one_year_later(spark):
    rows = [
        (1, 1, 1, 1, 1, date(2000, 3, 1), 10.0),
        (1, 1, 1, 1, 1, date(2001, 3, 1), 4.0),
    ]
    panel = spark.createDataFrame(
        rows,
        "mds_fam_id int, club_nbr int, department_nbr int, subclass_nbr int, item_nbr int, date date, "
        "unit_sold_52_week_back_cnt double",
    )
    got = {r.date.year: r for r in sl.yoy_item(panel).collect()}
    assert got[2000].change_unit_sold_same_week_1_year_back_cnt == 10 / 4 - 1
    assert got[2001].change_unit_sold_same_week_1_year_back_cnt is None
    assert got[2001].avg_unit_sold_52_week_back_cnt == 4


def test_all_rollups_at_once_equal_one_by_one(ws):
    names = [
        "avg_unit_sold_subcategory_52_week_back_cnt",
        "change_unit_sold_subcategory_same_week_1_year_back_cnt",
        "avg_unit_sold_dept_club_52_week_back_cnt",
        "avg_unit_sold_dept_52_week_back_cnt",
        "avg_unit_sold_52_week_back_cnt",
        "change_unit_sold_same_week_1_year_back_cnt",
        "subclass_unit_sold_same_week_1_year_back_nbr",
    ]
    ids = ["mds_fam_id", "club_nbr", "date"]
    whole = sl.year_over_year(ws.panel)
    assert whole.count() == ws.panel.count()
    for name, one in (
        (names[1], sl.yoy_subclass_club), (names[2], sl.avg_dept_club_52w),
        (names[3], sl.avg_dept_52w), (names[5], sl.yoy_item), (names[6], sl.subclass_month_share),
    ):
        left = whole.select(*ids, F.col(name).alias("v"))
        right = one(ws.panel).select(*ids, F.col(name).alias("v"))
        assert left.exceptAll(right).count() == 0


def test_conform_orders_casts_and_drops(spark):
    df = spark.createDataFrame([("x", 1.239, "7", 1)], "extra string, b double, a string, year int")
    got = sl.conform_schema(df, schema={"a": "int", "b": "double", "gone": "int"}, drop=["year"])
    assert got.dtypes == [("a", "int"), ("b", "double"), ("extra", "string")]
    assert tuple(got.first()) == (7, 1.24, "x")
