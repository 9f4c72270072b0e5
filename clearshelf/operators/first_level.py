"""First-level features: daily sales joined with stock, then one pass of day-range windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.frames import PANEL_KEYS, day_number
from clearshelf.functions.numeric import half_up, hundredths
from clearshelf.params import BACK_WEEKS, HORIZONS

ENTITY = ("mds_fam_id", "club_nbr", "department_nbr", "subclass_nbr", "item_nbr")


def daily_sales(scan: DataFrame, item: DataFrame | None = None) -> DataFrame:
    """Units, amount and unit price per item, club and day.

    ``item`` maps ``scan_id`` to ``mds_fam_id``; without it the scanned id is the item id.
    """
    sold = scan.where(F.col("unit_qty") > 0)
    if item is None:
        sold = sold.withColumnRenamed("scan_id", "mds_fam_id")
    else:
        sold = sold.join(item.select("scan_id", "mds_fam_id"), "scan_id")
    units, amount = F.sum("unit_qty"), F.sum("retail_price")
    price = half_up(amount.cast("double") / units.cast("double"))
    return sold.groupBy("club_nbr", "mds_fam_id", F.col("visit_date").alias("date")).agg(
        units.cast("decimal(18,2)").alias("unit_sold_cnt"),
        amount.cast("decimal(18,2)").alias("sale_amt"),
        price.cast("decimal(18,2)").alias("unit_price_amt"),
    )


def daily_sales_catalog(daily: DataFrame, item_dim: DataFrame) -> DataFrame:
    """Attach item attributes; items outside the dimension are dropped."""
    return daily.join(item_dim, "mds_fam_id").withColumnRenamed("dept_nbr", "department_nbr")


def daily_sales_inventory(daily: DataFrame, inv: DataFrame) -> DataFrame:
    """Attach the day's stock; a day without a snapshot has zero effective inventory."""
    stock = inv.select(
        "mds_fam_id",
        "club_nbr",
        F.col("snapshot_date").alias("date"),
        F.col("onsite_onhand_qty").alias("inventory_on_site_qty"),
        F.col("on_order_qty").alias("inventory_on_order_qty"),
        "inventory_qty",
    )
    return daily.join(stock, ["mds_fam_id", "date", "club_nbr"], "left").withColumn(
        "inventory_qty", F.coalesce("inventory_qty", F.lit(0))
    )


def shelf_sessions(inv: DataFrame) -> DataFrame:
    """Last snapshot day of each (item, club, on-shelf date)."""
    return inv.groupBy(
        "mds_fam_id", "club_nbr", F.col("item_on_shelf_date").alias("item_on_shelf_date_dt")
    ).agg(F.max("snapshot_date").alias("max_snapshot_date"))


def session_islands(sessions: DataFrame) -> DataFrame:
    """Sessions of an item and club joined into stretches of days that do not meet: ``_first`` and
    ``_last`` day, and the ``_sessions`` in it (one, unless sessions overlap).

    Sessions without a key or of no day cover nothing and are left out.
    """
    start, end = F.col("item_on_shelf_date_dt"), F.col("max_snapshot_date")
    real = sessions.where(F.col("mds_fam_id").isNotNull() & F.col("club_nbr").isNotNull() & (start <= end))
    by_start = Window.partitionBy("mds_fam_id", "club_nbr").orderBy(start, end)
    before = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (start > before)).cast("int")
    numbered = real.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(by_start))
    return numbered.groupBy("mds_fam_id", "club_nbr", "_island").agg(
        F.min(start).alias("_first"),
        F.max(end).alias("_last"),
        F.collect_list(F.struct("item_on_shelf_date_dt", "max_snapshot_date")).alias("_sessions"),
    )


def shelf_interval_join(daily: DataFrame, sessions: DataFrame) -> DataFrame:
    """Left join each day to every shelf session that covers it, by one sweep over an item and club.

    Days and stretches of sessions are put in order of their days. A day looks back to the newest
    stretch, the only one that can cover it, and takes its covering sessions: a row meets the
    sessions that overlap around its day, never all of its entity. The rows stay partitioned by item
    and club. Days without a key match nothing.
    """
    islands = session_islands(sessions).select(
        "mds_fam_id", "club_nbr", F.col("_first").alias("date"), F.struct("_last", "_sessions").alias("_island")
    )
    order = Window.partitionBy("mds_fam_id", "club_nbr").orderBy("date", F.col("_own").asc())
    newest = F.last("_island", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = (
        daily.withColumn("_own", F.lit(True))
        .unionByName(islands.withColumn("_own", F.lit(False)), allowMissingColumns=True)
        .withColumn("_newest", newest)
        .where("_own")
    )
    keyed = F.col("mds_fam_id").isNotNull() & F.col("club_nbr").isNotNull()
    day = F.when(keyed, F.col("date"))
    covering = F.filter(
        "_newest._sessions",
        lambda s: (s["item_on_shelf_date_dt"] <= day) & (s["max_snapshot_date"] >= day),
    )
    found = swept.withColumn("_covering", covering).select(*daily.columns, F.explode_outer("_covering").alias("_s"))
    return found.select(*daily.columns, "_s.item_on_shelf_date_dt", "_s.max_snapshot_date")


def active_pair_scaffold(panel: DataFrame, *, today: date, active_start: date) -> DataFrame:
    """Give every recently active entity a row for ``today``; the new rows carry no sales.

    Equal to a full outer join with the distinct active entities, but the panel is read once:
    the newest row of an entity without a row for today is emitted a second time, blanked. Only
    a flag is exploded, so the keys keep their partitioning for the feature windows.
    """
    entity = Window.partitionBy(*ENTITY)
    day = F.lit(today).cast("date")
    marks = panel.withColumns(
        {
            "_row": F.row_number().over(entity.orderBy(F.col("date").desc())),
            "_has_today": F.max(F.when(F.col("date") == day, 1)).over(entity),
        }
    )
    needs_row = (
        (F.col("_row") == 1)
        & (F.col("date") >= F.lit(active_start).cast("date"))
        & F.col("_has_today").isNull()
    )
    copies = F.when(needs_row, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    added = F.col("_added")
    blank = {
        c: F.when(~added, F.col(c)) for c in panel.columns if c not in (*ENTITY, "date")
    }
    blank["date"] = F.when(added, day).otherwise(F.col("date"))
    blank["unit_sold_cnt"] = F.when(added, F.lit(0).cast("decimal(18,2)")).otherwise(
        F.coalesce("unit_sold_cnt", F.lit(0).cast("decimal(18,2)"))
    )
    return (
        marks.withColumn("_added", F.explode(copies))
        .withColumns(blank)
        .drop("_row", "_has_today", "_added")
    )


def days_on_shelf(panel: DataFrame) -> DataFrame:
    """On-shelf date as text and the days since."""
    return panel.withColumns(
        {
            "on_shelf_date": F.date_format("item_on_shelf_date_dt", "yyyy-MM-dd"),
            "day_on_shelf_cnt": F.datediff("date", "item_on_shelf_date_dt"),
        }
    )


Spans = dict[str, tuple[int, int]]

UNITS_BACK_SPANS: Spans = {
    f"unit_sold_{k}_week_back_cnt": (-7 * k, -7 * k + 6) for k in range(1, BACK_WEEKS + 1)
}
UNITS_NEXT_SPANS: Spans = {
    f"unit_sold_{k}_week_next_cnt": (1, 7 * k) for k in range(1, HORIZONS + 1)
}
PRICE_BACK_SPANS: Spans = {
    f"avg_price_{k}_week_back_amt": (-7 * k, -7 * k + 6) for k in range(1, BACK_WEEKS + 1)
}
PRICE_NEXT_SPANS: Spans = {
    f"avg_price_charged_{k}_week_next_amt": (7 * k - 7, 7 * k - 1) for k in range(1, HORIZONS + 1)
}
YEAR_BACK_SPANS: Spans = {"unit_sold_52_week_back_cnt": (-364, -358)}


def _with_spans(
    panel: DataFrame, *, units: Spans | None = None, prices: Spans | None = None, keys: Sequence[str]
) -> DataFrame:
    """Sum of units and mean price over spans of days relative to each row.

    A span is the difference of two running totals. Running totals move forward one row at a
    time, where a sliding frame starts over for every row, and spans share their end points. All
    totals are longs, so the difference is exact; a span without rows is null.
    """
    units, prices = units or {}, prices or {}
    entity = ", ".join(keys)
    sources = {"_day": day_number()}
    totals: dict[str, str] = {}
    features: dict[str, str] = {}

    def span(what: str, total: str, first: int, last: int) -> str:
        ends = []
        for day in (last, first - 1):
            name = f"_{what}_{'m' if day < 0 else ''}{abs(day)}"
            bound = f"{-day} PRECEDING" if day < 0 else f"{day} FOLLOWING"
            totals[name] = (
                f"coalesce({total} OVER (PARTITION BY {entity} ORDER BY _day "
                f"RANGE BETWEEN UNBOUNDED PRECEDING AND {bound}), 0)"
            )
            ends.append(name)
        return f"({ends[0]} - {ends[1]})"

    if units:
        sources["_sold"] = hundredths(F.col("unit_sold_cnt"))
    for name, (first, last) in units.items():
        rows, sold = span("rows", "count(1)", first, last), span("units", "sum(_sold)", first, last)
        features[name] = f"CASE WHEN {rows} > 0 THEN {sold} / 100.0D END"
    if prices:
        sources["_cents"] = hundredths(F.col("unit_price_amt"))
    for name, (first, last) in prices.items():
        priced = span("priced", "count(_cents)", first, last)
        cents = span("price", "sum(_cents)", first, last)
        features[name] = f"CASE WHEN {priced} > 0 THEN {cents} / 100.0D / {priced} END"
    return (
        panel.withColumns(sources)
        .selectExpr("*", *[f"{sql} AS {name}" for name, sql in totals.items()])
        .selectExpr(*panel.columns, *[f"{sql} AS {name}" for name, sql in features.items()])
    )


def units_week_back(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Units sold in each of the last four weeks, days ``[-7k, -7k+6]``."""
    return _with_spans(panel, units=UNITS_BACK_SPANS, keys=keys)


def units_week_next(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Units sold over the next ``k`` weeks, cumulative, days ``[1, 7k]``."""
    return _with_spans(panel, units=UNITS_NEXT_SPANS, keys=keys)


def price_week_back(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Mean daily unit price of each of the last four weeks, days ``[-7k, -7k+6]``."""
    return _with_spans(panel, prices=PRICE_BACK_SPANS, keys=keys)


def price_week_next(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Mean daily unit price of the ``k``-th coming week, days ``[7(k-1), 7k-1]`` (k=1 has today)."""
    return _with_spans(panel, prices=PRICE_NEXT_SPANS, keys=keys)


def units_52_week_back(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Units sold in the same week a year ago, days ``[-364, -358]``."""
    return _with_spans(panel, units=YEAR_BACK_SPANS, keys=keys)


def window_features(panel: DataFrame, *, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Every first-level span in one projection: one sort, one window pass."""
    return _with_spans(
        panel,
        units={**UNITS_BACK_SPANS, **UNITS_NEXT_SPANS, **YEAR_BACK_SPANS},
        prices={**PRICE_BACK_SPANS, **PRICE_NEXT_SPANS},
        keys=keys,
    )


def base_panel(
    scan: DataFrame, item: DataFrame, item_dim: DataFrame, inv: DataFrame
) -> DataFrame:
    """Daily sales with attributes, stock and shelf session, before the scaffold rows."""
    daily = daily_sales_catalog(daily_sales(scan, item), item_dim)
    return shelf_interval_join(daily_sales_inventory(daily, inv), shelf_sessions(inv))


def scaffolded_panel(base: DataFrame, *, today: date, active_start: date) -> DataFrame:
    panel = active_pair_scaffold(base, today=today, active_start=active_start)
    return days_on_shelf(panel).withColumn("unit_price_amt", F.col("unit_price_amt").cast("double"))


def first_level_features(
    scan: DataFrame,
    item: DataFrame,
    item_dim: DataFrame,
    inv: DataFrame,
    *,
    today: date,
    active_start: date,
) -> DataFrame:
    base = base_panel(scan, item, item_dim, inv)
    return window_features(scaffolded_panel(base, today=today, active_start=active_start))
