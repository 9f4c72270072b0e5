"""Online-channel features: add-to-cart activity and item-level units."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearshelf.operators.first_level import units_week_back
from clearshelf.params import BACK_WEEKS
from clearshelf.sources.tables import replace_partitions

CHANNELS = ("app", "web")
FULFILMENTS = ("delivery", "pickup", "shipping")


def _recent(events: DataFrame, as_of: date) -> DataFrame:
    """Events of the trailing weeks with their week number, 1 being the last seven days."""
    age = F.datediff(F.lit(as_of).cast("date"), "date")
    return (
        events.where(F.col("item_nbr").isNotNull())
        .withColumn("weeks_back", (F.floor((age - 1) / 7) + 1).cast("int"))
        .where(F.col("weeks_back").between(1, BACK_WEEKS))
    )


def _wide_counts(what: str) -> list[Column]:
    return [
        F.count_if(
            (F.col("channel") == channel)
            & (F.col("fulfilment") == fulfilment)
            & (F.col("weeks_back") == k)
        ).alias(f"{channel}_{fulfilment}_add2cart_{what}_{k}_week_back_cnt")
        for channel in CHANNELS
        for fulfilment in FULFILMENTS
        for k in range(1, BACK_WEEKS + 1)
    ]


def cart_clicks_week_back(events: DataFrame, *, as_of: date) -> DataFrame:
    """Add-to-cart clicks per item for each channel, fulfilment and trailing week."""
    return _recent(events, as_of).groupBy("item_nbr").agg(*_wide_counts("click"))


def cart_members_week_back(events: DataFrame, *, as_of: date) -> DataFrame:
    """Distinct members of the same cells.

    Duplicates go first on the full key, so a popular item is spread over its members; 24
    distinct counts in one aggregate would multiply the rows by 24.
    """
    return (
        _recent(events, as_of)
        .select("item_nbr", "channel", "fulfilment", "weeks_back", "member_id")
        .distinct()
        .groupBy("item_nbr")
        .agg(*_wide_counts("member"))
    )


_CELL = ("item_nbr", "channel", "fulfilment")


def member_days(events: DataFrame) -> DataFrame:
    """Members of each item, channel, fulfilment and day as bitmaps, one row per 32,768 member numbers.

    Members must be whole numbers from 0, as dense as can be; null members are none. A popular item
    spreads over its numbers, and tasks build their part of a bitmap before the shuffle.
    """
    known = events.where(F.col("item_nbr").isNotNull() & F.col("member_id").isNotNull())
    return (
        known.groupBy(*_CELL, F.bitmap_bucket_number("member_id").alias("member_block"), "date")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("member_id")).alias("members"))
        .select(*_CELL, "member_block", "members", "date")
    )


def store_member_days(events: DataFrame, path: str, *, first: date, last: date) -> None:
    """Store the bitmaps of the days ``first`` to ``last``; a night stores one day, again if repeated.

    Days in the range without events keep what was stored. Other days are neither read nor written.
    """
    days = events.where(F.col("date").between(F.lit(first), F.lit(last)))
    replace_partitions(member_days(days), path, by=["date"])


def cart_members_stored(days: DataFrame, *, as_of: date) -> DataFrame:
    """``cart_members_week_back`` from the stored days of ``member_days``: a week is the union of its bitmaps.

    Equal to the count from events but for items whose events all lack a member, which have no row.
    """
    weeks = (
        _recent(days, as_of)
        .groupBy(*_CELL, "weeks_back", "member_block")
        .agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("n"))
    )
    return weeks.groupBy("item_nbr").agg(
        *[
            F.coalesce(
                F.sum(
                    F.when(
                        (F.col("channel") == channel)
                        & (F.col("fulfilment") == fulfilment)
                        & (F.col("weeks_back") == k),
                        F.col("n"),
                    )
                ),
                F.lit(0),
            ).alias(f"{channel}_{fulfilment}_add2cart_member_{k}_week_back_cnt")
            for channel in CHANNELS
            for fulfilment in FULFILMENTS
            for k in range(1, BACK_WEEKS + 1)
        ]
    )


def online_units_week_back(sales: DataFrame) -> DataFrame:
    """Units per online item (no club) in each trailing week.

    ``sales`` is the daily panel with its categories; clubs are summed before the windows, so an
    item's window holds one row per day.
    """
    item = ["mds_fam_id", "category_nbr", "sub_category_nbr", "date"]
    daily = sales.groupBy(*item).agg(F.sum("unit_sold_cnt").cast("decimal(18,2)").alias("unit_sold_cnt"))
    features = units_week_back(daily, keys=("mds_fam_id",))
    renamed = {
        f"unit_sold_{k}_week_back_cnt": f"units_sold_{k}_week_back_cnt"
        for k in range(1, BACK_WEEKS + 1)
    }
    return features.withColumnsRenamed(renamed)


def cart_ratios(events: DataFrame) -> DataFrame:
    """Share of the app in an item's add-to-cart clicks."""
    counts = events.where(F.col("item_nbr").isNotNull()).groupBy("item_nbr").agg(
        F.count_if(F.col("channel") == "app").alias("app_clicks"),
        F.count_if(F.col("channel") == "web").alias("web_clicks"),
    )
    both = F.col("app_clicks") + F.col("web_clicks")
    return counts.withColumn(
        "app_share", F.try_divide(F.col("app_clicks").cast("double"), both.cast("double"))
    )
