"""Filtered scans and small joins that feed the feature jobs.

No join carries a broadcast hint: dimension tables go broadcast when their measured size is
below the session threshold, and fall back to a shuffled join with skew splitting beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_COLUMNS = ("mds_fam_id", "item_nbr", "dept_nbr", "subclass_nbr")


def _day(d: date) -> Column:
    return F.lit(d).cast("date")


def scan_sales(
    scan: DataFrame,
    store_info: DataFrame,
    visit: DataFrame,
    *,
    start: date,
    end: date,
    excluded_store_types: Sequence[str],
    excluded_subtypes: Sequence[int],
    visit_keys: Sequence[str] = ("visit_nbr",),
) -> DataFrame:
    """Regular till scans of retail stores in a closed date range, without booked pick-ups.

    With ``visit_date`` among ``visit_keys`` (a visit number may start anew by store and day) the
    date range bounds the scan of the visits too.
    """
    stores = store_info.where(~F.col("store_type").isin(*excluded_store_types))
    visits = visit.where(~F.col("visit_subtype_code").isin(*excluded_subtypes))
    in_range = F.col("visit_date").between(_day(start), _day(end))
    if "visit_date" in visit_keys:
        visits = visits.where(in_range)
    return (
        scan.where(F.col("scan_type") == 0)
        .where(in_range)
        .join(stores.select("store_nbr", "club_nbr"), "store_nbr")
        .join(visits.select(*visit_keys), list(visit_keys))
        .select("club_nbr", "store_nbr", "scan_id", "visit_date", "unit_qty", "retail_price")
    )


def item_dim(item: DataFrame, *, depts: Sequence[int]) -> DataFrame:
    return item.where(F.col("dept_nbr").isin(*depts)).select(*ITEM_COLUMNS).distinct()


def current_items(
    item: DataFrame, *, country: str, division: int, excluded_subclasses: Sequence[int]
) -> DataFrame:
    """Current items of one country and division, outside the excluded subclasses."""
    return (
        item.where(F.col("current_ind") == "Y")
        .where(F.col("country_code") == country)
        .where(F.col("base_div_nbr") == division)
        .where(~F.col("subclass_nbr").isin(*excluded_subclasses))
    )


def item_dim_current(
    item: DataFrame, *, country: str, division: int, excluded_subclasses: Sequence[int]
) -> DataFrame:
    """Distinct item attributes of the current items."""
    current = current_items(
        item, country=country, division=division, excluded_subclasses=excluded_subclasses
    )
    return current.select(*ITEM_COLUMNS).distinct()


def inventory_enriched(
    inventory: DataFrame,
    item_dim: DataFrame,
    *,
    start: date,
    end: date,
    excluded_status: Sequence[str],
) -> DataFrame:
    """Usable inventory snapshots in a closed date range with their item attributes."""
    return (
        inventory.where(F.col("snapshot_date").between(_day(start), _day(end)))
        .where(~F.col("status").isin(*excluded_status))
        .drop("status")
        .join(item_dim, "mds_fam_id")
    )


def inventory_effective(inv: DataFrame, *, on_order_depts: Sequence[int]) -> DataFrame:
    """``inventory_qty``: stock on site, plus stock on order in slow-moving departments."""
    on_site = F.col("onsite_onhand_qty")
    quantity = F.when(
        F.col("dept_nbr").isin(*on_order_depts), on_site + F.col("on_order_qty")
    ).otherwise(on_site)
    return inv.withColumn("inventory_qty", quantity.cast("int"))


def manual_markdowns(
    md: DataFrame,
    *,
    since: date,
    excluded_clubs: Sequence[int],
    include_like: str = "%EOL%",
    exclude_like: str = "%DS%",
) -> DataFrame:
    """Manually decided markdowns started on or after ``since``."""
    reason = F.col("retail_reason_code")
    return (
        md.withColumns(
            {
                "markdown_start_date_dt": F.col("md_start_date").cast("date"),
                "markdown_end_date_dt": F.col("md_end_date").cast("date"),
            }
        )
        .where(~F.col("club_nbr").isin(*excluded_clubs))
        .where(F.col("markdown_start_date_dt") >= _day(since))
        .where(reason.like(include_like) & ~reason.like(exclude_like))
        .select(
            "item_nbr",
            "club_nbr",
            "markdown_start_date_dt",
            "markdown_end_date_dt",
            F.col("sp").alias("markdown_price_amt"),
        )
    )


def plan_logs(
    details: DataFrame,
    header: DataFrame,
    *,
    status: Sequence[int],
    since: date,
    reason_like: str = "%Data%",
) -> DataFrame:
    """Distinct planned markdowns of active plans, created on or after ``since``."""
    active = header.where(F.col("plan_status_code").isin(*status)).select("plan_id")
    return (
        details.where(F.col("markdown_reason_code").like(reason_like))
        .withColumn("date", F.col("created_date").cast("timestamp").cast("date"))
        .where(F.col("date") >= _day(since))
        .join(active, "plan_id")
        .select(
            "item_nbr",
            "club_nbr",
            F.col("liquidation_value").alias("liquidation_price"),
            F.col("predicted_md_units").alias("expected_sale_units"),
            F.col("current_retail").alias("current_retail_price"),
            F.col("current_units").alias("current_inventory"),
            F.col("markdown_retail").alias("recommended_markdown_price"),
            F.col("oos_date").cast("timestamp").cast("date").alias("oos_date"),
            F.col("markdown_start_date").cast("timestamp").cast("date").alias("markdown_start_date_dt"),
            "date",
            F.col("plan_id").cast("int").alias("plan_id"),
        )
        .distinct()
    )


def child_inventory(inv: DataFrame, *, day: date) -> DataFrame:
    """Largest non-negative effective inventory per child item and club on one day."""
    return (
        inv.where(F.col("snapshot_date") == _day(day))
        .where((F.col("inventory_qty") >= 0) & F.col("mds_fam_id").isNotNull())
        .groupBy("item_nbr", "club_nbr", "snapshot_date")
        .agg(F.max("inventory_qty").alias("inventory_qty"))
    )


def child_sales_1w(sales: DataFrame, *, start: date, end: date) -> DataFrame:
    """Units per child item and club over a closed range of days."""
    return (
        sales.where(F.col("visit_date").between(_day(start), _day(end)))
        .where(F.col("unit_qty") > 0)
        .groupBy("item_nbr", "club_nbr")
        .agg(F.sum("unit_qty").alias("unit_qty_1w"))
    )


def parent_child_map(panel: DataFrame, xref: DataFrame) -> DataFrame:
    """Children of every parent item that has a panel row on the day before the newest one."""
    newest = panel.agg(F.date_sub(F.max("date"), 1).alias("date"))
    return (
        panel.select("item_nbr", "club_nbr", "date", "unit_sold_cnt")
        .join(newest, "date")
        .withColumnRenamed("item_nbr", "parent_item_nbr")
        .join(xref, "parent_item_nbr")
        .select("parent_item_nbr", "child_item_nbr", "club_nbr", "date", "unit_sold_cnt")
        .distinct()
    )


def disagg_input(mapping: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Children with their inventory and last-week units, zero where there is none."""
    stock = inventory.select(F.col("item_nbr").alias("child_item_nbr"), "club_nbr", "inventory_qty")
    sold = sales.select(F.col("item_nbr").alias("child_item_nbr"), "club_nbr", "unit_qty_1w")
    keys = ["child_item_nbr", "club_nbr"]
    return (
        mapping.join(stock, keys, "left")
        .join(sold, keys, "left")
        .select(
            "parent_item_nbr",
            "child_item_nbr",
            "club_nbr",
            F.coalesce("inventory_qty", F.lit(0)).alias("inventory_qty"),
            F.coalesce("unit_qty_1w", F.lit(0)).alias("unit_qty_1w"),
        )
    )


def dataset_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """First date, last date and row count of each named frame."""
    parts = [
        df.agg(
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
            F.count("*").alias("n_rows"),
        ).select(F.lit(name).alias("dataset"), "min_date", "max_date", "n_rows")
        for name, df in frames.items()
    ]
    profile = parts[0]
    for part in parts[1:]:
        profile = profile.unionByName(part)
    return profile


def fill_sentinel(df: DataFrame, *, column: str, value: int = -1) -> DataFrame:
    return df.fillna(value, [column])


def category_description(df: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Left join the category text on ``dept_nbr``."""
    renamed = descriptions.select(F.col("category_nbr").alias("dept_nbr"), "description")
    return df.join(renamed, "dept_nbr", "left")


def category_universe(df: DataFrame, *, csv_list: str) -> DataFrame:
    """Rows whose department is in a comma-separated list."""
    wanted = sorted({int(text) for text in csv_list.replace(" ", "").split(",")})
    return df.where(F.col("dept_nbr").isin(*wanted))


def period_split(df: DataFrame, *, run_date: date, frequency: str | None) -> DataFrame:
    """Tag rows ``train`` or ``test`` by the run frequency; rows outside both are dropped.

    ``weekly`` tests on the 26 weeks that end a fortnight before the last Monday, ``monthly`` on
    the 10 weeks before the 1st or the 15th of that Monday's month; ``None`` is the fixed split.
    """
    last_monday = run_date - timedelta(days=run_date.weekday())
    if frequency is None:
        train_weeks, test_weeks = 26, 8
        test_start = date(2022, 10, 1)
    elif frequency == "weekly":
        train_weeks, test_weeks = 78, 26
        test_start = last_monday - timedelta(days=14, weeks=test_weeks)
    elif frequency == "monthly":
        train_weeks, test_weeks = 78, 10
        anchor = last_monday.replace(day=1 if last_monday.day < 15 else 15)
        test_start = anchor - timedelta(weeks=test_weeks)
    else:
        raise ValueError(f"unknown run frequency: {frequency}")
    train_start = test_start - timedelta(weeks=train_weeks)
    test_end = test_start + timedelta(weeks=test_weeks, days=-1)
    split = F.when(F.col("date") < _day(test_start), "train").otherwise("test")
    return df.where(F.col("date").between(_day(train_start), _day(test_end))).withColumn(
        "split", split
    )
