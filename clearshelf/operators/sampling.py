"""Samples for training and evaluation: filters, horizon expansion, splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.calendar import us_week, us_week_year
from clearshelf.functions.numeric import half_up, ratio
from clearshelf.operators.second_level import (
    DISCOUNTS,
    MAX_DISCOUNT,
    PRICE_BACK,
    PRICE_NEXT,
    UNITS_BACK,
    UNITS_NEXT,
    WEEKLY_UNITS,
)
from clearshelf.params import HORIZONS, MIN_SAMPLE_INVENTORY, RunDates

STOCK_WEEKS = "week_inventory_expected_to_last_cnt"
IDS = ("mds_fam_id", "item_nbr", "club_nbr", "date")

# The model's covariates, in model order.
COVARIATES = (
    *DISCOUNTS,
    "club_nbr",
    "department_nbr",
    "subclass_nbr",
    "median_price_6_month_last_amt",
    "price_1_week_back_median_price_6_month_last_nbr",
    "price_2_week_back_median_price_6_month_last_nbr",
    "price_3_week_back_median_price_6_month_last_nbr",
    "price_4_week_back_median_price_6_month_last_nbr",
    WEEKLY_UNITS,
    STOCK_WEEKS,
    "day_on_shelf_cnt",
    "num_weeks",
    *UNITS_BACK,
    "month",
    "week",
    "avg_unit_sold_subcategory_52_week_back_cnt",
    "change_unit_sold_subcategory_same_week_1_year_back_cnt",
    "avg_unit_sold_dept_52_week_back_cnt",
    "avg_unit_sold_52_week_back_cnt",
    "change_unit_sold_1_2_week_back_cnt",
    "change_unit_sold_2_3_week_back_cnt",
    "change_unit_sold_3_4_week_back_cnt",
    "subclass_unit_sold_same_week_1_year_back_nbr",
)


def _day(d: date) -> Column:
    return F.lit(d).cast("date")


def sample_calendar(panel: DataFrame) -> DataFrame:
    """US week, week-year and calendar month of the row's date."""
    day = F.col("date")
    return panel.withColumns({"week": us_week(day), "year": us_week_year(day), "month": F.month(day)})


def discount_fill_filter(panel: DataFrame) -> DataFrame:
    """Missing discounts take the row's greatest one; rows with a negative discount go."""
    filled = {d: F.coalesce(d, MAX_DISCOUNT) for d in DISCOUNTS}
    return panel.where(F.least(*filled.values()) >= 0).withColumns(filled)


def any_future_sales(panel: DataFrame) -> DataFrame:
    """Rows with sales in at least one of the coming weeks."""
    return panel.where(F.greatest(*[F.abs(F.coalesce(c, F.lit(0.0))) for c in UNITS_NEXT]) != 0)


def discount_weight(panel: DataFrame) -> DataFrame:
    """Sum of the eight discounts plus one, as the sampling weight."""
    total = sum((F.col(d) for d in DISCOUNTS[1:]), F.col(DISCOUNTS[0]))
    return panel.where(total >= 0).withColumn("weights", half_up(F.abs(total) + 1))


def top1_item_club_month(panel: DataFrame) -> DataFrame:
    """The heaviest row of each item, club and month; the earliest one among equals."""
    heaviest = Window.partitionBy("mds_fam_id", "club_nbr", "month", "year").orderBy(
        F.col("weights").desc(), "date", F.col("item_on_shelf_date_dt").asc_nulls_last()
    )
    return (
        panel.withColumn("_row", F.row_number().over(heaviest)).where(F.col("_row") == 1).drop("_row")
    )


def initial_filter(panel: DataFrame) -> DataFrame:
    kept = any_future_sales(discount_fill_filter(sample_calendar(panel)))
    return top1_item_club_month(discount_weight(kept))


def expand_horizons(panel: DataFrame) -> DataFrame:
    """One row per horizon: its cumulative units as target, discounts beyond it set to -1."""
    rows = panel.withColumn("num_weeks", F.explode(F.sequence(F.lit(1), F.lit(HORIZONS))))
    n = F.col("num_weeks")
    beyond = {
        d: F.when(n < k, F.lit(-1.0)).otherwise(F.col(d))
        for k, d in enumerate(DISCOUNTS, start=1)
        if k > 1
    }
    target = F.element_at(F.array(*UNITS_NEXT), n)
    return rows.withColumns({"target": target, **beyond})


def sample_ratios(samples: DataFrame) -> DataFrame:
    """Weeks of stock per horizon week, sell-through target, over- and under-sell against the past."""
    n, target, weekly = F.col("num_weeks"), F.col("target"), F.col(WEEKLY_UNITS)
    return samples.withColumns(
        {
            STOCK_WEEKS: ratio(F.col("inventory_1_month_last_weekly_sale_nbr"), n),
            "ratio_target": ratio(target, F.col("inventory_qty")),
            "over_sell_ratio": ratio(ratio(target, n), weekly),
            "under_sell_ratio": ratio(weekly, target) * n,
        }
    )


def sample_filters(
    samples: DataFrame, *, after: date, min_inventory: int = MIN_SAMPLE_INVENTORY
) -> DataFrame:
    """Stock above the minimum and not below the target, dated after the warm-up."""
    stock = F.col("inventory_qty")
    return samples.where(
        (stock > min_inventory) & (stock >= F.col("target")) & (F.col("date") > _day(after))
    )


def data_samples(panel: DataFrame, *, after: date) -> DataFrame:
    """Filtered panel -> one row per horizon with its ratios."""
    return sample_ratios(sample_filters(expand_horizons(panel), after=after))


def horizon_matured(samples: DataFrame, *, end: date | Column) -> DataFrame:
    """Horizons that had fully passed by ``end``."""
    end = end if isinstance(end, Column) else _day(end)
    return samples.where(F.datediff(end, "date") / 7 >= F.col("num_weeks"))


def first_week_of_target(samples: DataFrame) -> DataFrame:
    """For each item, club, date and target the shortest horizon that reaches it."""
    ties = [
        F.col(c).asc_nulls_last()
        for c in ("item_on_shelf_date_dt", "oos_date", "plan_id", "current_retail_price")
        if c in samples.columns
    ]
    shortest = Window.partitionBy("mds_fam_id", "club_nbr", "date", "target").orderBy(
        "num_weeks", *ties
    )
    return (
        samples.withColumn("_row", F.row_number().over(shortest))
        .where(F.col("_row") == 1)
        .drop("_row")
    )


def train_val_test(samples: DataFrame, *, dates: RunDates) -> DataFrame:
    """Tag the three date ranges in one pass, keep matured horizons and first target weeks.

    Train horizons mature by the end of train; val and test horizons by the end of test, so val
    keeps its long horizons.
    """
    day = F.col("date")
    inside = {
        "train": (dates.train, dates.train[1]),
        "val": (dates.val, dates.test[1]),
        "test": (dates.test, dates.test[1]),
    }
    split, matured_by = F.lit(None), F.lit(None)
    for name, ((start, end), mature) in inside.items():
        here = day.between(_day(start), _day(end))
        split = F.when(here, name).otherwise(split)
        matured_by = F.when(here, _day(mature)).otherwise(matured_by)
    tagged = samples.withColumn("split", split).where(F.col("split").isNotNull())
    return first_week_of_target(horizon_matured(tagged, end=matured_by))


def select_covariates(
    samples: DataFrame, *, covariates: Sequence[str] = COVARIATES, extra: Sequence[str] = ()
) -> DataFrame:
    return samples.select(
        *covariates, "target", "inventory_qty", "item_nbr", "mds_fam_id", "date", *extra
    )


def _recomputed_discounts(panel: DataFrame) -> DataFrame:
    base = F.col(PRICE_BACK[0])
    return panel.withColumns(
        {d: 1 - ratio(F.col(p), base) for d, p in zip(DISCOUNTS, PRICE_NEXT, strict=True)}
    )


def _week_target(samples: DataFrame) -> DataFrame:
    """Units of the horizon's last week alone."""
    n = F.col("num_weeks")
    before = F.element_at(F.array(F.lit(0.0), *UNITS_NEXT[:-1]), n)
    return samples.withColumn("week_target", F.col("target") - before)


def _evaluated(samples: DataFrame, *, end: date) -> DataFrame:
    """Horizons that end before the out-of-stock date and had passed by ``end``."""
    open_horizon = samples.where(
        (F.datediff("oos_date", "date") / 7 >= F.col("num_weeks"))
        & (F.col("date") < F.col("oos_date"))
    )
    return first_week_of_target(horizon_matured(open_horizon, end=end))


def planned_samples(panel: DataFrame, plan_logs: DataFrame, *, dates: RunDates) -> DataFrame:
    """Samples of planned markdowns over the last year; both planned sets are cut from them."""
    recent = sample_calendar(panel.where(F.col("date") >= _day(dates.max_eval_start)))
    priced = (
        recent.join(plan_logs, ["item_nbr", "club_nbr", "date"])
        .where(F.col("markdown_start_date_dt").isNotNull() & (F.col(PRICE_BACK[0]) != 0))
        .withColumn(PRICE_BACK[0], F.least(PRICE_BACK[0], "current_retail_price"))
    )
    last_plan = Window.partitionBy("item_nbr", "club_nbr")
    planned = (
        _recomputed_discounts(priced)
        .withColumn("max_oos_date", F.max("oos_date").over(last_plan))
        .where(F.col("date") <= F.col("max_oos_date"))
    )
    samples = sample_ratios(_week_target(expand_horizons(planned)))
    return any_future_sales(_evaluated(samples, end=dates.test[1]))


def eval_planned(samples: DataFrame, *, dates: RunDates) -> DataFrame:
    """The planned samples of the recent window, for evaluation."""
    return samples.where(F.col("date").between(_day(dates.eval_start), _day(dates.test[1])))


def eval_planned_complete(samples: DataFrame, *, dates: RunDates) -> DataFrame:
    """Targets of all planned samples."""
    year = F.col("date").between(_day(dates.max_eval_start), _day(dates.test[1]))
    return samples.where(year).select(
        "mds_fam_id", "item_nbr", "club_nbr", "date", "num_weeks", "markdown_start_date_dt",
        "oos_date", "target", "week_target",
    )


def eval_manual(panel: DataFrame, manual: DataFrame, *, dates: RunDates) -> DataFrame:
    """Evaluation samples of manual markdowns; an item is out of stock at its last markdown end.

    The last end is an aggregate joined back: a window over the item alone would put all clubs
    and days of a popular item into one task.
    """
    recent = sample_calendar(panel.where(F.col("date") >= _day(dates.max_eval_start)))
    starts = manual.withColumn("date", F.col("markdown_start_date_dt"))
    keys = ["item_nbr", "club_nbr", "date"]
    last_end = (
        recent.select(*keys)
        .join(starts, keys)
        .groupBy("item_nbr")
        .agg(F.max("markdown_end_date_dt").alias("oos_date"))
    )
    marked = (
        recent.where(F.col("date").between(_day(dates.eval_start), _day(dates.test[1])))
        .join(starts, keys)
        .join(last_end, "item_nbr")
    )
    samples = sample_ratios(expand_horizons(marked))
    return any_future_sales(_evaluated(samples, end=dates.test[1]))
