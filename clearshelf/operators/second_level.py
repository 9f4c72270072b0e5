"""Second-level features: discounts, half-year statistics, imputation, ratios, year-over-year."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.functions.calendar import with_us_calendar
from clearshelf.functions.frames import PANEL_KEYS, day_number
from clearshelf.functions.numeric import INF, half_up_sql, hundredths, ratio
from clearshelf.functions.sliding import SlidingExtremes, open_rows
from clearshelf.operators.first_level import ENTITY
from clearshelf.params import (
    BACK_WEEKS,
    HALF_YEAR_DAYS,
    HORIZONS,
    WEEK_UNITS_FLOOR,
    WEEKLY_UNITS_FLOOR,
)
from clearshelf.session import ship_package

BACK = range(1, BACK_WEEKS + 1)
NEXT = range(1, HORIZONS + 1)

UNITS_BACK = [f"unit_sold_{k}_week_back_cnt" for k in BACK]
UNITS_NEXT = [f"unit_sold_{k}_week_next_cnt" for k in NEXT]
PRICE_BACK = [f"avg_price_{k}_week_back_amt" for k in BACK]
PRICE_NEXT = [f"avg_price_charged_{k}_week_next_amt" for k in NEXT]
DISCOUNTS = [f"discount_{k}_week_next_nbr" for k in NEXT]
UNITS_52 = "unit_sold_52_week_back_cnt"
MIN_UNITS = "min_weekly_unit_sold_4_week_back_val"
MAX_DISCOUNT = "max_weekly_discount_4_week_back_amt"
MIN_PRICE = "min_weekly_price_4_week_back_amt"
WEEKLY_UNITS = "avg_weekly_unit_sold_1_month_back_cnt"
MEDIAN_PRICE = "median_price_6_month_last_amt"


def audit_columns(panel: DataFrame, *, run_ts: datetime) -> DataFrame:
    """``event_timestamp`` from the date and the processing time as ``created_timestamp``."""
    return panel.withColumns(
        {
            "event_timestamp": F.col("date").cast("timestamp"),
            "created_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    )


def weekly_discount(panel: DataFrame) -> DataFrame:
    """Discount of each coming week against last week's price; negative when the price rises."""
    base = F.col(PRICE_BACK[0])
    return panel.withColumns(
        {d: 1 - ratio(F.col(p), base) for d, p in zip(DISCOUNTS, PRICE_NEXT, strict=True)}
    )


def calendar_iso(panel: DataFrame) -> DataFrame:
    """Calendar year, ISO week and ISO day of week (Monday is 1)."""
    return panel.withColumns(
        {
            "year": F.year("date"),
            "week": F.weekofyear("date"),
            "week_day": F.weekday("date") + 1,
        }
    )


def half_year_stats(
    panel: DataFrame, *, days: int = HALF_YEAR_DAYS, keys: Sequence[str] = PANEL_KEYS
) -> DataFrame:
    """Largest, smallest and lower-median daily price and units of the last half year.

    One pass over the rows in the order of entity and day keeps the values of the moving range in
    order; a window that numbers the rows of an entity takes over the partitioning of windows that
    came before. Entities of any number and size stream through in common batches: none is a call,
    or a table, of its own. Prices and units are whole hundredths on the way.
    """
    ship_package(panel.sparkSession)
    by_day = Window.partitionBy(*keys).orderBy("_half_year_day")
    sources = {
        "_half_year_day": F.coalesce(day_number(), F.lit(-(1 << 30))),
        "_half_year_price": hundredths(F.col("unit_price_amt")),
        "_half_year_unit": hundredths(F.col("unit_sold_cnt")),
    }
    names = [
        f"{stat}_{what}_6_month_last_{suffix}"
        for what, suffix in (("price", "amt"), ("unit", "nbr"))
        for stat in ("max", "min", "median")
    ]
    rows = panel.withColumns(sources).withColumn("_half_year_opens", F.row_number().over(by_day) == 1)
    width = len(panel.columns)
    schema = T.StructType([*panel.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = [SlidingExtremes(days) for _ in range(2)]

        def done(ready: pa.RecordBatch, opens: list[bool], day: list[int]) -> pa.RecordBatch:
            found = []
            for i, moving in enumerate(ranges, start=1):
                found += moving.take(opens, day, ready.column(width + i).to_pylist())
            cents = [pa.array([None if v is None else v / 100.0 for v in vs], pa.float64()) for vs in found]
            kept = [ready.column(i) for i in range(width)]
            return pa.RecordBatch.from_arrays([*kept, *cents], names=schema.names)

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            opens, day = batch.column(width + 3).to_pylist(), batch.column(width).to_pylist()
            if not day:
                continue
            if waiting:
                # rows of the last day wait until that day has ended
                same = batch.num_rows if not opens[0] else 0
                last = waiting[0].column(width)[0].as_py()
                ends = next((i for i in range(same) if opens[i] or day[i] != last), same)
                waiting.append(batch.slice(0, ends))
                if ends == batch.num_rows:
                    continue
                whole = pa.concat_batches(waiting)
                yield done(whole, whole.column(width + 3).to_pylist(), whole.column(width).to_pylist())
                batch, opens, day = batch.slice(ends), opens[ends:], day[ends:]
            ready = len(day) - open_rows(opens, day)
            if ready:
                yield done(batch.slice(0, ready), opens[:ready], day[:ready])
            waiting = [batch.slice(ready)]
        if waiting:
            whole = pa.concat_batches(waiting)
            yield done(whole, whole.column(width + 3).to_pylist(), whole.column(width).to_pylist())

    ordered = rows.sortWithinPartitions(*keys, "_half_year_day")
    return ordered.mapInArrow(swept, schema)


def row_extremes(panel: DataFrame) -> DataFrame:
    """Across columns: least units, greatest discount, least price; infinities stand for no value."""

    def known(names: Sequence[str], missing: float) -> list[Column]:
        return [F.coalesce(F.col(c).cast("double"), F.lit(missing)) for c in names]

    return panel.withColumns(
        {
            MIN_UNITS: F.least(*known(UNITS_BACK, INF)),
            MAX_DISCOUNT: F.greatest(*known(DISCOUNTS, -INF)),
            MIN_PRICE: F.least(*known(PRICE_BACK, INF)),
        }
    )


def impute_features(panel: DataFrame) -> DataFrame:
    """Unit gaps become 0 and price gaps the least price of the four weeks (infinite if none)."""
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in [*UNITS_BACK, *UNITS_NEXT, UNITS_52]}
    price = {c: F.coalesce(c, F.col(MIN_PRICE)) for c in PRICE_BACK}
    return panel.withColumns({**zero, **price})


def price_units_ratio(
    panel: DataFrame,
    *,
    units_floor: float = WEEKLY_UNITS_FLOOR,
    week_floor: float = WEEK_UNITS_FLOOR,
) -> DataFrame:
    """Mean weekly units, price against the half-year median, stock against weekly sales."""
    mean = sum((F.col(c) for c in UNITS_BACK[1:]), F.col(UNITS_BACK[0])) / 4
    panel = panel.withColumn(WEEKLY_UNITS, F.greatest(mean, F.lit(units_floor)))
    stock = F.col("inventory_qty")
    ratios = {}
    for k in BACK:
        ratios[f"price_{k}_week_back_median_price_6_month_last_nbr"] = ratio(
            F.col(PRICE_BACK[k - 1]), F.col(MEDIAN_PRICE)
        )
        ratios[f"inventory_unit_{k}_week_back_pct"] = ratio(
            stock, F.greatest(F.col(UNITS_BACK[k - 1]), F.lit(week_floor))
        )
    ratios["inventory_1_month_last_weekly_sale_nbr"] = ratio(stock, F.col(WEEKLY_UNITS))
    return panel.withColumns(ratios)


def calendar_us_week(panel: DataFrame) -> DataFrame:
    """US week, week-year and month of the date and of the day 365 days before."""
    return with_us_calendar(panel)


def units_wow_change(panel: DataFrame) -> DataFrame:
    """Week-over-week change of units, null where the later week had none."""
    return panel.withColumns(
        {
            f"change_unit_sold_{k}_{k + 1}_week_back_cnt": ratio(
                F.col(UNITS_BACK[k - 1]) - F.col(UNITS_BACK[k]), F.col(UNITS_BACK[k - 1])
            )
            for k in BACK[:-1]
        }
    )


# --- rollups of last year's units -----------------------------------------------------------
#
# All five rollups are sums and counts of one column, so they are built from one weekly summary
# (entity x week x last-year week) instead of from the panel. Every step is a partial aggregate:
# a department or subclass that holds most of the rows is reduced before it is shuffled.

WEEK = ("year", "week")


def weekly_summary(panel: DataFrame) -> DataFrame:
    """Sum and count of last year's units per entity, week and last-year week."""
    units = F.coalesce(F.col(UNITS_52), F.lit(0.0)).cast("decimal(18,2)")
    return (
        with_us_calendar(panel.select(*ENTITY, "date", UNITS_52))
        .withColumn("ly_key", F.col("year_ly") * 100 + F.col("week_ly"))
        .groupBy(*ENTITY, *WEEK, "month", "ly_key")
        .agg(F.sum(units).alias("units"), F.count("*").alias("n"))
    )


def _mean(sums: str = "units", counts: str = "n") -> Column:
    return F.sum(sums).cast("double") / F.sum(counts).cast("double")


def _yoy(summary: DataFrame, keys: Sequence[str], this: str, change: str) -> DataFrame:
    """Mean of last-year-week means per key and week, and its change.

    The change compares a week with the week whose *last-year* week it is, that is the week one
    year later: (units a year before this week) / (units a year before the later week) - 1.
    A week may straddle two last-year weeks; the earlier one is its key.
    """
    by_ly = summary.groupBy(*keys, *WEEK, "ly_key").agg(_mean().alias("mean"))
    weekly = by_ly.groupBy(*keys, *WEEK).agg(
        F.avg("mean").alias(this), F.min("ly_key").alias("ly_key")
    )
    later = (
        weekly.groupBy(*keys, "ly_key")
        .agg(F.avg(this).alias("_later"))
        .withColumns(
            {
                "year": F.floor(F.col("ly_key") / 100).cast("int"),
                "week": (F.col("ly_key") % 100).cast("int"),
            }
        )
        .drop("ly_key")
    )
    return (
        weekly.drop("ly_key")
        .join(later, [*keys, *WEEK], "left")
        .withColumn(change, ratio(F.col(this), F.col("_later")) - 1)
        .drop("_later")
    )


SUBCLASS_CLUB = ("subclass_nbr", "club_nbr")
DEPT_CLUB = ("department_nbr", "club_nbr")
DEPT = ("department_nbr",)
ITEM = ("mds_fam_id",)


def subclass_club_rollup(summary: DataFrame) -> DataFrame:
    return _yoy(
        summary,
        SUBCLASS_CLUB,
        "avg_unit_sold_subcategory_52_week_back_cnt",
        "change_unit_sold_subcategory_same_week_1_year_back_cnt",
    )


def item_rollup(summary: DataFrame) -> DataFrame:
    return _yoy(
        summary,
        ITEM,
        "avg_unit_sold_52_week_back_cnt",
        "change_unit_sold_same_week_1_year_back_cnt",
    )


def dept_club_rollup(summary: DataFrame) -> DataFrame:
    return summary.groupBy(*DEPT_CLUB, *WEEK).agg(
        _mean().alias("avg_unit_sold_dept_club_52_week_back_cnt")
    )


def dept_rollup(summary: DataFrame) -> DataFrame:
    return summary.groupBy(*DEPT, *WEEK).agg(_mean().alias("avg_unit_sold_dept_52_week_back_cnt"))


def month_share_rollup(summary: DataFrame) -> DataFrame:
    """Share of a subclass in all of last year's units of the month."""
    per_subclass = summary.groupBy("subclass_nbr", "year", "month").agg(
        F.sum("units").alias("units")
    )
    total = per_subclass.groupBy("year", "month").agg(F.sum("units").alias("total"))
    return per_subclass.join(total, ["year", "month"]).select(
        "subclass_nbr",
        "year",
        "month",
        ratio(F.col("units"), F.col("total")).alias("subclass_unit_sold_same_week_1_year_back_nbr"),
    )


def _attach(panel: DataFrame, rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    return panel.join(rollup, list(keys), "left")


def yoy_subclass_club(panel: DataFrame) -> DataFrame:
    """Last year's units per subclass and club with their year-over-year change."""
    rollup = subclass_club_rollup(weekly_summary(panel))
    return _attach(with_us_calendar(panel), rollup, (*SUBCLASS_CLUB, *WEEK))


def avg_dept_club_52w(panel: DataFrame) -> DataFrame:
    """Mean of last year's units per department, club and week."""
    rollup = dept_club_rollup(weekly_summary(panel))
    return _attach(with_us_calendar(panel), rollup, (*DEPT_CLUB, *WEEK))


def avg_dept_52w(panel: DataFrame) -> DataFrame:
    """Mean of last year's units per department and week."""
    rollup = dept_rollup(weekly_summary(panel))
    return _attach(with_us_calendar(panel), rollup, (*DEPT, *WEEK))


def yoy_item(panel: DataFrame) -> DataFrame:
    """Last year's units per item with their year-over-year change."""
    rollup = item_rollup(weekly_summary(panel))
    return _attach(with_us_calendar(panel), rollup, (*ITEM, *WEEK))


def subclass_month_share(panel: DataFrame) -> DataFrame:
    rollup = month_share_rollup(weekly_summary(panel))
    return _attach(with_us_calendar(panel), rollup, ("subclass_nbr", "year", "month"))


def year_over_year(panel: DataFrame, *, summary: DataFrame | None = None) -> DataFrame:
    """All five rollups at once.

    They are joined to the narrow weekly summary first, so the wide panel takes part in a single
    join on the entity and its week however large the rollups are. ``summary`` is the stored
    ``weekly_summary`` of the panel, if there is one.
    """
    summary = weekly_summary(panel) if summary is None else summary
    lookup = summary.select(*ENTITY, *WEEK, "month").distinct()
    for rollup, keys in (
        (subclass_club_rollup(summary), (*SUBCLASS_CLUB, *WEEK)),
        (dept_club_rollup(summary), (*DEPT_CLUB, *WEEK)),
        (dept_rollup(summary), (*DEPT, *WEEK)),
        (item_rollup(summary), (*ITEM, *WEEK)),
        (month_share_rollup(summary), ("subclass_nbr", "year", "month")),
    ):
        lookup = _attach(lookup, rollup, keys)
    keys = (*ENTITY, *WEEK, "month")
    dated = with_us_calendar(panel)
    same = reduce(and_, [dated[k].eqNullSafe(lookup[k]) for k in keys])
    return dated.join(lookup, same, "left").drop(*[lookup[k] for k in keys])


# --- output schema --------------------------------------------------------------------------


def second_level_types() -> dict[str, str]:
    """Column -> type of the second-level table; the names are fixed values."""
    integers = [
        "club_nbr", "day_on_shelf_cnt", "department_nbr", "item_nbr", "mds_fam_id", "subclass_nbr",
    ]
    dates = ["date", "item_on_shelf_date_dt"]
    doubles = [
        *PRICE_BACK,
        *PRICE_NEXT,
        "avg_unit_sold_52_week_back_cnt",
        "avg_unit_sold_dept_52_week_back_cnt",
        "avg_unit_sold_dept_club_52_week_back_cnt",
        "avg_unit_sold_subcategory_52_week_back_cnt",
        WEEKLY_UNITS,
        *[f"change_unit_sold_{k}_{k + 1}_week_back_cnt" for k in BACK[:-1]],
        "change_unit_sold_same_week_1_year_back_cnt",
        "change_unit_sold_subcategory_same_week_1_year_back_cnt",
        *DISCOUNTS,
        "inventory_1_month_last_weekly_sale_nbr",
        "inventory_on_order_qty",
        "inventory_on_site_qty",
        "inventory_qty",
        *[f"inventory_unit_{k}_week_back_pct" for k in BACK],
        *[f"{stat}_price_6_month_last_amt" for stat in ("max", "median", "min")],
        *[f"{stat}_unit_6_month_last_nbr" for stat in ("max", "median", "min")],
        MAX_DISCOUNT,
        MIN_PRICE,
        MIN_UNITS,
        *[f"price_{k}_week_back_median_price_6_month_last_nbr" for k in BACK],
        "sale_amt",
        "subclass_unit_sold_same_week_1_year_back_nbr",
        "unit_price_amt",
        *UNITS_BACK,
        *UNITS_NEXT,
        UNITS_52,
        "unit_sold_cnt",
    ]
    return {
        **dict.fromkeys(integers, "int"),
        **dict.fromkeys(dates, "date"),
        **dict.fromkeys(doubles, "double"),
    }


WORK_COLUMNS = (
    "week_ly", "year_ly", "month_ly", "year", "month", "week", "week_day", "on_shelf_date",
    "max_snapshot_date",
)


def conform_schema(
    df: DataFrame, *, schema: Mapping[str, str], drop: Sequence[str] = ()
) -> DataFrame:
    """Cast the known columns (doubles to two decimals), put them first, drop the listed ones."""
    df = df.drop(*[c for c in drop if c in df.columns])

    def conformed(name: str, dtype: str) -> str:
        return half_up_sql(name) if dtype == "double" else f"cast({name} AS {dtype})"

    known = {name: conformed(name, dtype) for name, dtype in schema.items() if name in df.columns}
    others = [c for c in df.columns if c not in schema]
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in known.items()], *others)


def second_level_features(
    first_level: DataFrame,
    *,
    run_ts: datetime,
    with_half_year: bool = True,
    summary: DataFrame | None = None,
) -> DataFrame:
    """The whole second level. ``with_half_year`` is off when the panel already has those columns;
    ``summary`` is the stored weekly summary, if there is one."""
    panel = weekly_discount(audit_columns(first_level, run_ts=run_ts))
    if with_half_year:
        panel = half_year_stats(panel)
    panel = price_units_ratio(impute_features(row_extremes(panel)))
    panel = units_wow_change(year_over_year(panel, summary=summary))
    return conform_schema(panel, schema=second_level_types(), drop=WORK_COLUMNS)


def latest_features(panel: DataFrame, *, as_of: date, lookback_days: int = 2) -> DataFrame:
    """Newest row of each entity among the last ``lookback_days`` days up to ``as_of``."""
    newest = Window.partitionBy("mds_fam_id", "club_nbr").orderBy(
        F.col("date").desc(), F.col("item_on_shelf_date_dt").desc_nulls_last()
    )
    day = F.lit(as_of).cast("date")
    return (
        panel.where(F.col("date").between(F.date_sub(day, lookback_days), day))
        .withColumn("_row", F.row_number().over(newest))
        .where(F.col("_row") == 1)
        .drop("_row")
    )
