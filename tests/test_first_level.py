"""Hand-made panels: frame bounds, interval fan-out, scaffold rows."""

import random
from datetime import date, timedelta
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import functions as F

from clearshelf.operators import first_level as fl
from clearshelf.operators import second_level as sl
from clearshelf.session import prefer_small_methods

D = date(2001, 6, 15)
SALES = "mds_fam_id int, club_nbr int, date date, unit_sold_cnt decimal(18,2), unit_price_amt double"


def _panel(spark, offsets):
    rows = [(1, 1, D + timedelta(days=o), Decimal(u), float(p)) for o, u, p in offsets]
    return spark.createDataFrame(rows, SALES)


def _row_at(df, day=D):
    return df.where(F.col("date") == F.lit(day)).first()


def test_unit_frames_include_their_bounds(spark):
    offsets = [(-28, 1, 5), (-22, 2, 5), (-21, 4, 5), (-7, 8, 5), (-1, 16, 5), (0, 32, 5),
               (1, 64, 5), (7, 128, 5), (8, 256, 5)]
    panel = _panel(spark, offsets)
    back = _row_at(fl.units_week_back(panel))
    assert back.unit_sold_4_week_back_cnt == 1 + 2
    assert back.unit_sold_3_week_back_cnt == 4
    assert back.unit_sold_2_week_back_cnt is None
    assert back.unit_sold_1_week_back_cnt == 8 + 16
    ahead = _row_at(fl.units_week_next(panel))
    assert ahead.unit_sold_1_week_next_cnt == 64 + 128
    assert ahead.unit_sold_2_week_next_cnt == 64 + 128 + 256
    assert ahead.unit_sold_8_week_next_cnt == 64 + 128 + 256


def test_cumulative_units_stay_null_until_the_first_sale(spark):
    row = _row_at(fl.units_week_next(_panel(spark, [(0, 1, 5), (15, 7, 5)])))
    assert row.unit_sold_1_week_next_cnt is None
    assert row.unit_sold_2_week_next_cnt is None
    assert row.unit_sold_3_week_next_cnt == 7
    assert row.unit_sold_8_week_next_cnt == 7


def test_next_price_starts_today_and_is_not_cumulative(spark):
    row = _row_at(fl.price_week_next(_panel(spark, [(0, 1, 10), (6, 1, 20), (7, 1, 40), (56, 1, 80)])))
    assert row.avg_price_charged_1_week_next_amt == 15
    assert row.avg_price_charged_2_week_next_amt == 40
    assert row.avg_price_charged_8_week_next_amt is None


def test_year_back_frame(spark):
    offsets = [(-365, 1, 5), (-364, 2, 5), (-358, 4, 5), (-357, 8, 5), (0, 1, 5)]
    assert _row_at(fl.units_52_week_back(_panel(spark, offsets))).unit_sold_52_week_back_cnt == 6


def test_half_year_uses_the_lower_median(spark):
    offsets = [(-168, 100, 100), (-167, 1, 4), (-100, 2, 3), (-50, 3, 2), (0, 4, 1)]
    row = _row_at(sl.half_year_stats(_panel(spark, offsets)))
    assert (row.min_unit_6_month_last_nbr, row.max_unit_6_month_last_nbr) == (1, 4)
    assert row.median_unit_6_month_last_nbr == 2
    assert row.median_price_6_month_last_amt == 2


def test_half_year_of_missing_prices_is_null(spark):
    panel = _panel(spark, [(0, 1, 5)]).withColumn("unit_price_amt", F.lit(None).cast("double"))
    row = _row_at(sl.half_year_stats(panel))
    assert row.median_price_6_month_last_amt is None
    assert row.max_price_6_month_last_amt is None


def test_overlapping_sessions_fan_rows_out(spark):
    daily = _panel(spark, [(0, 1, 5), (20, 1, 5)])
    sessions = spark.createDataFrame(
        [(1, 1, D, D + timedelta(days=3)), (1, 1, D - timedelta(days=9), D),
         (1, 2, D, D + timedelta(days=30))],
        "mds_fam_id int, club_nbr int, item_on_shelf_date_dt date, max_snapshot_date date",
    )
    rows = fl.shelf_interval_join(daily, sessions).collect()
    assert sorted((r.date, r.item_on_shelf_date_dt is None) for r in rows) == [
        (D, False), (D, False), (D + timedelta(days=20), True),
    ]


SESSIONS = "mds_fam_id int, club_nbr int, item_on_shelf_date_dt date, max_snapshot_date date"


def test_shelf_sessions_equal_a_comparison_of_all(spark):
    rng = random.Random(11)

    def day(n):
        return D + timedelta(days=n)

    entities = [(i, c) for i in (1, 2, 3, None) for c in (1, None)]
    sessions = [(*rng.choice(entities), day(a), day(a + rng.randrange(-2, 12))) for a in rng.choices(range(90), k=60)]
    sessions += [(1, 1, None, D), (1, 1, D, None), (3, 1, day(0), day(80)), (3, 1, day(0), day(80))]
    days = [(*rng.choice(entities), day(a), Decimal(i), 1.0) for i, a in enumerate(rng.choices(range(-5, 99), k=200))]
    days += [(1, 1, None, Decimal(999), 1.0)]
    expected = []
    for row in days:
        item, club, d = row[:3]
        met = [
            s[2:] for s in sessions
            if None not in (item, club, d, *s) and s[:2] == (item, club) and s[2] <= d <= s[3]
        ]
        expected += [(*row, *s) for s in met or [(None, None)]]
    joined = fl.shelf_interval_join(spark.createDataFrame(days, SALES), spark.createDataFrame(sessions, SESSIONS))
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(expected, key=str)


def test_ten_years_of_sessions_make_no_pairs(spark):
    """Each day looks at the sessions around it alone."""
    weeks = [(1, 1, D + timedelta(days=7 * k), D + timedelta(days=7 * k + 8)) for k in range(520)]
    islands = fl.session_islands(spark.createDataFrame([(*w[:3], w[2] + timedelta(days=5)) for w in weeks], SESSIONS))
    assert {len(r._sessions) for r in islands.collect()} == {1} and islands.count() == 520
    panel = _panel(spark, [(d, 1, 5) for d in range(3640)])
    joined = fl.shelf_interval_join(panel, spark.createDataFrame(weeks, SESSIONS))
    assert joined.count() == 3640 + 2 * 519
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window") >= 1


def test_half_year_equals_sorting_every_range(spark):
    rng = random.Random(12)
    offsets = [(rng.randrange(900), rng.randrange(50), rng.randrange(1, 30) / 4) for _ in range(400)]
    panel = _panel(spark, offsets).withColumn("unit_price_amt", F.when(F.col("unit_sold_cnt") > 3, F.col("unit_price_amt")))
    for r in sl.half_year_stats(panel).collect():
        near = [(u, p) for o, u, p in offsets if 0 <= (r.date - D).days - o <= 167]
        units, prices = sorted(u for u, _ in near), sorted(p for u, p in near if u > 3)
        assert (r.min_unit_6_month_last_nbr, r.max_unit_6_month_last_nbr) == (units[0], units[-1])
        assert r.median_unit_6_month_last_nbr == units[(len(units) - 1) // 2]
        middle = prices[(len(prices) - 1) // 2] if prices else None
        assert r.median_price_6_month_last_amt == middle


def test_half_year_of_odd_panels(spark):
    empty = sl.half_year_stats(_panel(spark, []).withColumn("_day", F.lit("own")))
    assert empty.count() == 0
    rows = [(None, 1, D, Decimal(1), 2.0), (None, 1, D, Decimal(3), 4.0), (1, None, None, None, None), (1, None, D, Decimal(7), None)]
    found = sl.half_year_stats(spark.createDataFrame(rows, SALES)).collect()
    assert sorted(str(r.max_unit_6_month_last_nbr) for r in found) == ["3.0", "3.0", "7.0", "None"]
    assert len(found) == 4


def test_half_year_streams_small_entities_in_common_batches(spark):
    rng = random.Random(3)
    days = [(i, c, D + timedelta(days=rng.randrange(400))) for i in range(150) for c in (1, 2) for _ in range(rng.randrange(1, 5))]
    rows = [(i, c, d, Decimal(rng.randrange(90)), rng.choice((None, 1.25, 2.5, 7.0))) for i, c, d in days for _ in range(rng.choice((1, 1, 9)))]
    panel = spark.createDataFrame(rows, SALES).repartition(3)
    found = {}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for batch in (3, 10_000):
            spark.conf.set(key, batch)
            stats = sl.half_year_stats(panel)
            found[batch] = sorted(map(repr, stats.collect()))
    finally:
        spark.conf.set(key, before)
    assert found[3] == found[10_000] and len(found[3]) == len(rows)
    for r in stats.collect():
        near = [(u, p) for i, c, d, u, p in rows if (i, c) == (r.mds_fam_id, r.club_nbr) and 0 <= (r.date - d).days <= 167]
        units, prices = sorted(u for u, _ in near), sorted(p for _, p in near if p is not None)
        assert (r.min_unit_6_month_last_nbr, r.max_unit_6_month_last_nbr) == (units[0], units[-1])
        assert r.median_unit_6_month_last_nbr == units[(len(units) - 1) // 2]
        assert r.median_price_6_month_last_amt == (prices[(len(prices) - 1) // 2] if prices else None)
    plan = sl.half_year_stats(panel)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


BASE = (
    "mds_fam_id int, club_nbr int, department_nbr int, subclass_nbr int, item_nbr int, date date, "
    "unit_sold_cnt decimal(18,2), inventory_qty int"
)


def test_scaffold_equals_the_full_outer_join(spark):
    today, since = D, D - timedelta(days=485)
    rows = [
        (1, 1, 1, 1, 1, D - timedelta(days=3), Decimal(5), 7),    # active: gets a row
        (1, 1, 1, 1, 1, D + timedelta(days=1), Decimal(5), 7),    # newest row is after today
        (2, 1, 1, 1, 2, D, Decimal(6), 8),                        # already has today, twice
        (2, 1, 1, 1, 2, D, Decimal(6), 9),
        (3, 1, 1, 1, 3, D - timedelta(days=486), Decimal(6), 8),  # too old
        (4, 1, 1, None, 4, since, Decimal(6), 8),                 # oldest active day, null attribute
    ]
    base = spark.createDataFrame(rows, BASE)
    got = fl.active_pair_scaffold(base, today=today, active_start=since).collect()
    added = [r for r in got if r.inventory_qty is None]
    assert len(got) == len(rows) + 2
    assert sorted((r.mds_fam_id, r.date, r.unit_sold_cnt) for r in added) == [
        (1, D, Decimal(0)), (4, D, Decimal(0)),
    ]


def test_horizon_units_never_fall(ws):
    falling = " or ".join(
        f"unit_sold_{k + 1}_week_next_cnt < unit_sold_{k}_week_next_cnt" for k in range(1, 8)
    )
    assert ws.panel.where(falling).count() == 0


def test_without_an_item_map_the_scanned_id_is_the_item(spark):
    scan = spark.createDataFrame(
        [(1, 9, D, Decimal("2.00"), Decimal("3.0000")), (1, 9, D, Decimal("1.00"), Decimal("3.0000")),
         (1, 9, D, Decimal("-1.00"), Decimal("3.0000"))],
        "club_nbr int, scan_id int, visit_date date, unit_qty decimal(12,2), retail_price decimal(18,4)",
    )
    row = fl.daily_sales(scan).first()
    assert (row.mds_fam_id, row.unit_sold_cnt, row.sale_amt) == (9, Decimal(3), Decimal(6))
    assert row.unit_price_amt == Decimal(2)


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


def test_methods_stay_small_unless_the_session_has_a_limit(ws):
    key = "spark.sql.codegen.hugeMethodLimit"
    bare, own = SimpleNamespace(conf=_Conf()), SimpleNamespace(conf=_Conf({key: "12345"}))
    prefer_small_methods(bare)
    prefer_small_methods(own)
    assert (bare.conf[key], own.conf[key]) == ("8000", "12345")
    assert ws.spark.conf.get(key) == "8000"
