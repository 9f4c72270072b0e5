"""Metrics and checks on hand-made predictions, against plain Python."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from clearshelf.functions.metrics import MAPE_EPSILON, mape
from clearshelf.operators import elasticity as el
from clearshelf.operators import evaluation as ev
from clearshelf.operators import scoring as so

D = date(2001, 6, 15)


def _pred(spark, pairs):
    rows = [(1, 1, D, 1, 1, float(t), float(f)) for t, f in pairs]
    return spark.createDataFrame(
        rows,
        "mds_fam_id int, club_nbr int, date date, num_weeks int, dept_nbr int, target double, predicted_sales double",
    )


def test_over_and_under(spark):
    row = ev.metrics_over_under(_pred(spark, [(10, 12), (10, 7)])).first()
    assert row.overestimation_sample_pct == 0.5
    assert row.overestimation_total_units == 2
    assert row.overestimation_units_pct == 0.1
    assert row.overestimation_mean_pct == 0.1
    assert row.underestimation_total_units == -3
    assert row.underestimation_units_pct == -0.15


def test_no_over_rows_give_zero(spark):
    row = ev.metrics_over_under(_pred(spark, [(10, 7)])).first()
    assert (row.overestimation_sample_pct, row.overestimation_mean_pct) == (0, 0)


def test_overall(spark):
    pairs = [(10, 12), (10, 7), (4, 4), (0, 1)]
    row = ev.metrics_overall(_pred(spark, pairs)).first()
    errors = [f - t for t, f in pairs]
    assert row.bias == pytest.approx(sum(errors) / 24, abs=1e-4)
    assert row.mae == 1.5
    assert row.rmse == pytest.approx(math.sqrt(sum(e * e for e in errors) / 4), abs=1e-4)
    assert row.weighted_mape == 0.25
    assert row.median_ape == 0.2
    assert row.mape == pytest.approx((0.2 + 0.3 + 0) / 3, abs=1e-4)
    assert (row.n_samples, row.n_zero_actuals) == (4, 1)


def test_epsilon_form_of_mape(spark):
    df = _pred(spark, [(0, 1), (10, 5)])
    value = df.agg(mape(F.col("target"), F.col("predicted_sales"), epsilon=True)).first()[0]
    assert value == pytest.approx((1 / MAPE_EPSILON + 0.5) / 2)


def test_weekly_values_are_differences(spark):
    rows = [(1, 1, D, n, float(t), float(f)) for n, t, f in ((1, 5, 4), (3, 9, 10), (8, 12, 10))]
    df = spark.createDataFrame(
        rows, "mds_fam_id int, club_nbr int, date date, num_weeks int, target double, predicted_sales double"
    )
    got = {r.num_weeks: (r.target_weekly, r.predicted_sales_weekly) for r in ev.weekly_decumulate(df).collect()}
    assert got == {1: (5, 4), 3: (4, 6), 8: (3, 0)}


def test_later_metrics_win_and_sources_are_named(spark):
    first = spark.createDataFrame([("mae", 1.0), ("eval_mae", 2.0)], "metric string, value double")
    second = spark.createDataFrame([("mae", 3.0), ("eval_mae", 4.0)], "metric string, value double")
    got = {r.metric: r.value for r in ev.combine_metrics(first, second, suffixes=["_a", "_b"]).collect()}
    assert got == {"mae": 3.0, "eval_mae_a": 2.0, "eval_mae_b": 4.0}


def test_first_rows(spark):
    rows = [(1, 1, 1, 9.0, date(2001, 1, 8)), (1, 1, 1, 8.0, date(2001, 1, 1)), (1, 1, 1, 9.0, date(2001, 1, 9)),
            (1, 1, 2, 9.0, date(2001, 2, 1))]
    df = spark.createDataFrame(rows, "club_nbr int, mds_fam_id int, n_md int, selling_price double, date date")
    assert sorted((r.n_md, r.date.day) for r in ev.first_markdown_week(df).collect()) == [(1, 1), (2, 1)]
    assert sorted((r.n_md, r.selling_price, r.date.day) for r in ev.first_session_week(df).collect()) == [
        (1, 8.0, 1), (1, 9.0, 8), (2, 9.0, 1),
    ]


def test_predictions_are_whole_capped_and_not_negative(spark):
    df = spark.createDataFrame([(2.5, 9.0, 1.0), (-3.0, 9.0, 1.0), (20.4, 9.0, 1.0)], "p double, inv double, inventory_qty double")
    scored = so.score_sales(df, lambda d: d.withColumn("prediction", F.col("p")))
    assert [r.predicted_sales for r in scored.collect()] == [2.0, 0.0, 9.0]


def test_bucket_caps(spark):
    pred = spark.createDataFrame([(1, 2, 50.0), (1, 1, 3.0), (9, 2, 50.0)], "bucket int, num_weeks int, predicted_sales double")
    caps = spark.createDataFrame([(1, 10.3)], "bucket int, quantile80 double")
    got = so.cap_by_bucket(pred, caps, bucket="bucket", weeks="num_weeks").collect()
    assert sorted(r.predicted_sales for r in got) == [3.0, 21.0, 50.0]


def _mark(values):
    lowest = math.inf
    for v in values:
        if v >= lowest:
            return 1
        lowest = v
    return 0


def test_monotonicity_flags(spark):
    rng = random.Random(2)
    series = {i: [rng.randrange(6) for _ in range(rng.randrange(1, 5))] for i in range(60)}
    series[60], series[61] = [5, 4, 3], [3, 3, 4]
    rows = [(i, k, float(v)) for i, vs in series.items() for k, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "id int, discount int, p double")
    flags = el.monotonicity_flags(df, keys=["id"], order_by="discount", value="p").collect()
    assert {r.id: r.monotonic for r in flags} == {i: _mark(vs) for i, vs in series.items()}
    rising = {i: int(all(a <= b for a, b in zip(vs, vs[1:]))) for i, vs in series.items()}
    assert {r.id: r.non_decreasing for r in flags} == rising


def _grid(spark, sales, stock):
    rows = [(1, 1, D, 1, d, float(s), float(stock), 10.0, 1.0) for d, s in sales.items()]
    return spark.createDataFrame(
        rows,
        "club_nbr int, item_nbr int, date date, num_weeks int, discount double, predicted_sale double, "
        "inventory_qty double, median_price_6_month_last_amt double, "
        "price_1_week_back_median_price_6_month_last_nbr double",
    )


@pytest.mark.parametrize(
    "sales, stock, inelastic",
    [({0.1: 10, 0.6: 10, 0.9: 10}, 100, 1), ({0.1: 10, 0.6: 30, 0.9: 40}, 100, 0), ({0.1: 10, 0.6: 10, 0.9: 10}, 12, 0)],
)
def test_arc_elasticity(spark, sales, stock, inelastic):
    row = el.arc_elasticity(_grid(spark, sales, stock)).first()
    assert row.inelastic == inelastic
    expected = ((sales[0.6] - sales[0.1]) / (sales[0.6] + sales[0.1])) / ((9 - 4) / (9 + 4))
    assert row.elasticity == pytest.approx(expected)


def test_recovery_and_best_markdown(spark):
    grid = _grid(spark, {0.0: 10, 0.5: 40}, 100)
    recovery = el.recovery_rate(
        grid, price=10 * (1 - F.col("discount")), cost=F.lit(8.0), liquidation=F.lit(1.0), sold="predicted_sale"
    )
    got = {r.discount: (r.recovery_rate, r.sell_through_rate) for r in recovery.collect()}
    assert got[0.0] == ((100 + 90) / 800, 0.1)
    assert got[0.5] == ((200 + 60) / 800, 0.4)
    assert el.best_markdown(recovery).first().discount == 0.5


def test_envelope_never_falls(spark):
    grid = _grid(spark, {0.0: 3, 0.1: 2, 0.2: 5}, 100)
    got = so.monotone_envelope(grid, by=el.SAMPLE, order_by="discount")
    assert [r.monotone_predicted_sale for r in got.orderBy("discount").collect()] == [3, 3, 5]
