"""Retail tables derived from the driver tables (see FIXTURES.md for the mapping)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearshelf.params import Params

RUN_DATE = date(2001, 11, 5)
CART_AS_OF = date(2024, 1, 29)

PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

# The derived tables keep the whole ship-date range as history, and five departments, one of
# which is outside the list; one club is left out of manual markdowns, so that its filter acts.
PARAMS = Params(
    run_date=RUN_DATE,
    history_days=2520,
    departments=(0, 1, 2, 3),
    on_order_departments=(2,),
    excluded_subclasses=(9,),
    excluded_clubs=(4,),
)


def _hundredths(column: str) -> Column:
    """A two-decimal double as a whole number of hundredths; far cheaper than a decimal cast."""
    return F.rint(F.col(column) * 100).cast("long")


def _exact(units: Column, unit: str) -> Column:
    return units.cast("decimal(18,0)") * F.lit(unit).cast("decimal(4,4)")


class RetailTables:
    """Lazy views over one driver folder; nothing is read until an action needs it.

    With ``fine`` keys an item is a part and a club is a nation, so items grow with the data;
    otherwise an item is a brand and a club is a region.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, *, fine: bool = False) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.fine = fine
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One reader per table: its schema is inferred once, however often it is used."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def item_master(self) -> DataFrame:
        """One row per scanned id, with the attributes the current-item filter needs."""
        brand = F.expr("cast(replace(p_brand, 'Brand#', '') as int)")
        family = F.col("p_partkey").cast("int") if self.fine else brand
        kind = F.array_position(F.array(*map(F.lit, PART_TYPES)), F.col("p_type"))
        return self.raw("part").select(
            F.col("p_partkey").alias("scan_id"),
            family.alias("mds_fam_id"),
            (1000 + family).alias("item_nbr"),
            (brand % 5).alias("dept_nbr"),
            (brand % 10).alias("subclass_nbr"),
            F.when(F.col("p_type") == "ECONOMY", "N").otherwise("Y").alias("current_ind"),
            F.lit("US").alias("country_code"),
            F.when(F.col("p_size") > 45, 17).otherwise(18).alias("base_div_nbr"),
            (kind.cast("int") * 100 + F.col("p_size")).alias("variant_nbr"),
        )

    def child_master(self) -> DataFrame:
        """The item master one level down: a child is a type and size of its parent item.

        A parent has at most 300 children whatever the number of scanned ids.
        """
        child = F.col("item_nbr") * 1000 + F.col("variant_nbr")
        return self.item_master().select(
            "scan_id",
            child.alias("mds_fam_id"),
            child.alias("item_nbr"),
            F.col("item_nbr").alias("parent_item_nbr"),
            "dept_nbr",
            "subclass_nbr",
            "current_ind",
            "country_code",
            "base_div_nbr",
        )

    def item_xref(self) -> DataFrame:
        return (
            self.child_master()
            .select("parent_item_nbr", F.col("item_nbr").alias("child_item_nbr"))
            .distinct()
        )

    def store_info(self) -> DataFrame:
        return (
            self.raw("supplier")
            .join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("store_nbr"),
                F.col("n_nationkey" if self.fine else "n_regionkey").alias("club_nbr"),
                F.when(F.col("s_suppkey") % 20 == 0, "W").otherwise("S").alias("store_type"),
            )
        )

    def visit(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("visit_nbr"),
            F.when(F.col("o_orderstatus") == "P", 198).otherwise(1).alias("visit_subtype_code"),
        )

    def scan(self) -> DataFrame:
        quantity = _exact(_hundredths("l_quantity"), "0.01").cast("decimal(12,2)")
        price = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("visit_nbr"),
            F.col("l_suppkey").alias("store_nbr"),
            F.col("l_partkey").alias("scan_id"),
            F.col("l_shipdate").cast("date").alias("visit_date"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("scan_type"),
            quantity.alias("unit_qty"),
            _exact(price, "0.0001").cast("decimal(18,4)").alias("retail_price"),
            F.col("l_linenumber").alias("line_nbr"),
        )

    def _scan_by_club(self, items: DataFrame) -> DataFrame:
        return (
            self.scan()
            .join(items, "scan_id")
            .join(self.store_info().select("store_nbr", "club_nbr"), "store_nbr")
        )

    def _inventory(self, items: DataFrame) -> DataFrame:
        return (
            self._scan_by_club(items.select("scan_id", "mds_fam_id"))
            .groupBy("mds_fam_id", "club_nbr", F.col("visit_date").alias("snapshot_date"))
            .agg(
                (F.sum("unit_qty") * 12).cast("int").alias("onsite_onhand_qty"),
                (F.count("*") * 5).cast("int").alias("on_order_qty"),
                F.when(F.min("line_nbr") >= 7, "D").otherwise("A").alias("status"),
            )
            .withColumn("item_on_shelf_date", F.trunc("snapshot_date", "month"))
        )

    def inventory_daily(self) -> DataFrame:
        return self._inventory(self.item_master())

    def child_inventory_daily(self) -> DataFrame:
        return self._inventory(self.child_master())

    def plan_details(self) -> DataFrame:
        """Planned markdowns by item, club, day and scan type."""
        brand, club = F.col("mds_fam_id"), F.col("club_nbr")
        items = self.item_master().select("scan_id", "mds_fam_id", "item_nbr")
        unit_price = F.try_divide(
            F.col("retail_price").cast("double"), F.col("unit_qty").cast("double")
        )
        return (
            self._scan_by_club(items)
            .groupBy("mds_fam_id", "item_nbr", "club_nbr", "visit_date", "scan_type")
            .agg(
                F.max(unit_price).alias("current_retail"),
                F.sum("unit_qty").cast("double").alias("units"),
            )
            .select(
                "item_nbr",
                "club_nbr",
                F.col("visit_date").alias("created_date"),
                F.col("visit_date").alias("markdown_start_date"),
                F.date_add("visit_date", 28 + (brand % 5) * 7).alias("oos_date"),
                "current_retail",
                (F.col("current_retail") * 0.25).alias("liquidation_value"),
                (F.col("current_retail") * 0.75).alias("markdown_retail"),
                F.col("units").alias("predicted_md_units"),
                (F.col("units") * 12).alias("current_units"),
                (brand * 10 + club).alias("plan_id"),
                F.when(F.col("scan_type") == 1, "Data science")
                .otherwise("Manual")
                .alias("markdown_reason_code"),
            )
        )

    def plan_header(self) -> DataFrame:
        """One row per plan; a plan belongs to one item family and club that has scans."""
        items = self.item_master().select("scan_id", "mds_fam_id")
        pairs = self._scan_by_club(items).select("mds_fam_id", "club_nbr").distinct()
        return pairs.select(
            (F.col("mds_fam_id") * 10 + F.col("club_nbr")).alias("plan_id"),
            (10 + (F.col("mds_fam_id") + F.col("club_nbr")) % 3).alias("plan_status_code"),
        )

    def manual_executions(self) -> DataFrame:
        """Manually executed markdowns by item, club and day."""
        items = self.item_master().select("scan_id", "mds_fam_id", "item_nbr")
        return (
            self._scan_by_club(items)
            .groupBy("mds_fam_id", "item_nbr", "club_nbr", "visit_date")
            .agg(F.sum("retail_price").cast("double").alias("amount"))
            .select(
                "item_nbr",
                "club_nbr",
                F.col("visit_date").alias("md_start_date"),
                F.date_add("visit_date", 35).alias("md_end_date"),
                (F.col("amount") * 0.5).alias("sp"),
                F.when(F.col("mds_fam_id") % 3 == 0, "DS-1")
                .otherwise("EOL-1")
                .alias("retail_reason_code"),
            )
        )

    def cart_event(self) -> DataFrame:
        """Add-to-cart clicks by channel and fulfilment."""
        k = F.get_json_object("props", "$.k").cast("int")
        by_three = F.col("event_id") % 3
        return (
            self.raw("events")
            .where(F.col("event_type") == "click")
            .select(
                "event_id",
                F.col("user_id").alias("member_id"),
                F.col("ts").cast("date").alias("date"),
                F.when(F.col("event_id") % 2 == 0, "app").otherwise("web").alias("channel"),
                F.when(by_three == 0, "delivery")
                .when(by_three == 1, "pickup")
                .otherwise("shipping")
                .alias("fulfilment"),
                (1001 + k % 25).alias("item_nbr"),
            )
        )
