"""Spread a parent item's quantity over its children, per inventory scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.ordered import in_order
from clearshelf.params import INVENTORY_WEIGHT, SALES_WEIGHT

GROUP = ("parent_item_nbr", "club_nbr")


def disagg_raw_weights(
    df: DataFrame, *, w_inv: float = INVENTORY_WEIGHT, w_sales: float = SALES_WEIGHT
) -> DataFrame:
    """Inventory and sales share of each child, their blend, and the inventory it is capped at."""
    totals = df.groupBy(*GROUP).agg(
        F.count("*").alias("num_child"),
        F.sum("inventory_qty").alias("inventory"),
        F.sum("unit_qty_1w").alias("units_1w"),
    )

    def share(part: str, whole: str):
        equal = F.lit(1.0) / F.col("num_child")
        return F.when(F.col(whole) == 0, equal).otherwise(
            F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))
        )

    blend = w_inv * F.col("inv_weights") + w_sales * F.col("sales_weights")
    cap = F.when(F.col("weights") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("inventory_qty").cast("double"), F.col("weights"))
    )
    return (
        df.join(totals, list(GROUP))
        .withColumn("inv_weights", share("inventory_qty", "inventory"))
        .withColumn("sales_weights", share("unit_qty_1w", "units_1w"))
        .withColumn("weights", blend)
        .withColumn("inv_cap", cap)
    )


def ordered_caps(weights: DataFrame) -> DataFrame:
    """Distinct caps of a group with their weight, position, next cap and running weight.

    The steps below take this table as ``caps``; a caller that runs several of them stores it once.
    """
    per_cap = weights.groupBy(*GROUP, "inv_cap").agg(
        F.sum(F.col("weights").cast("decimal(38,18)")).alias("cap_weight")
    )
    return in_order(per_cap, GROUP, "inv_cap", weight=F.col("cap_weight"))


def disagg_scenarios(weights: DataFrame, *, caps: DataFrame | None = None) -> DataFrame:
    """Consecutive pairs of distinct caps, numbered upwards; the largest cap starts no scenario."""
    caps = ordered_caps(weights) if caps is None else caps
    return (
        caps.where(F.col("_next").isNotNull())
        .select(
            *GROUP,
            F.col("inv_cap").alias("inv_min"),
            F.col("_next").alias("inv_max"),
            F.col("_position").alias("scenario"),
        )
    )


def disagg_flags(
    weights: DataFrame, scenarios: DataFrame, *, caps: DataFrame | None = None
) -> DataFrame:
    """Each child in each scenario of its group; flag 0 when its cap reaches the scenario.

    The table has children x scenarios rows by definition. A child reaches exactly the scenarios
    before its cap's position, so its rows are counted out from that position; the only join is
    on the single scenario, which spreads a large group over all tasks.
    """
    caps = ordered_caps(weights) if caps is None else caps
    place = caps.select(*GROUP, "inv_cap", "_position", "_count")
    every = F.explode(F.sequence(F.lit(1), F.col("_count") - 1))
    return (
        weights.join(place, [*GROUP, "inv_cap"])
        .where(F.col("_count") > 1)
        .withColumn("scenario", every)
        .withColumn("scenario_flag", F.when(F.col("scenario") < F.col("_position"), 0).otherwise(1))
        .drop("_position", "_count")
        .join(scenarios, [*GROUP, "scenario"])
    )


def _scenario_totals(caps: DataFrame) -> DataFrame:
    """Weight reached in each scenario: all weight but that of the caps up to its lower end.

    Taken over the distinct caps, so its cost follows the number of children and not the number
    of child-scenario rows.
    """
    whole = caps.groupBy(*GROUP).agg(F.sum("cap_weight").alias("all_weight"))
    reached = (F.col("all_weight") - F.col("_running")).cast("double")
    return caps.join(whole, list(GROUP)).select(
        *GROUP, F.col("_position").alias("scenario"), reached.alias("total_scenario_weights")
    )


def disagg_final(
    weights: DataFrame, scenarios: DataFrame, *, caps: DataFrame | None = None
) -> DataFrame:
    """Weights of the reached children, normalised within the scenario."""
    caps = ordered_caps(weights) if caps is None else caps
    totals = scenarios.join(_scenario_totals(caps), [*GROUP, "scenario"])
    reached = F.col("scenario_flag") == 0
    return disagg_flags(weights, totals, caps=caps).withColumn(
        "final_weights",
        F.when(
            reached, F.try_divide(F.col("weights"), F.col("total_scenario_weights"))
        ).otherwise(0.0),
    )


def disagg_lookup(
    requests: DataFrame, weights: DataFrame, *, caps: DataFrame | None = None
) -> DataFrame:
    """Whole units of each live child for each request (parent, club, whole ``quantity``).

    A child is live while the quantity is below its cap, which are the reached children of the
    scenario that holds the quantity (and all children below the first scenario); so one row per
    child is enough and no table of children x scenarios is made. The weight that is live comes from
    the running weights of the caps, where requests and caps are put in one order per group. Units
    are shares rounded down, and what is left goes to the largest remainders, equal ones by child
    number; they add up to the request. Repeated requests count once, and a quantity that no cap exceeds has no rows.
    """
    caps = ordered_caps(weights) if caps is None else caps
    points = caps.select(
        *GROUP, F.col("inv_cap").alias("at"), F.lit(0).alias("asks"), F.col("_running").alias("spent"),
        F.lit(None).cast("long").alias("quantity"),
    )
    asked = requests.select(
        *GROUP, F.col("quantity").cast("double").alias("at"), F.lit(1).alias("asks"),
        F.lit(None).cast("decimal(38,18)").alias("spent"), F.col("quantity").cast("long").alias("quantity"),
    ).where(F.col("quantity") >= 0).distinct()
    inside = Window.partitionBy(*GROUP).orderBy("at", "asks")
    before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spent = F.coalesce(F.last("spent", ignorenulls=True).over(before), F.lit(0).cast("decimal(38,18)"))
    met = points.unionByName(asked).withColumns(
        {"spent": spent, "whole": F.max("spent").over(Window.partitionBy(*GROUP))}
    )
    live = met.where("asks = 1").select(
        *GROUP, "quantity", (F.col("whole") - F.col("spent")).cast("double").alias("live_weight")
    )
    children = weights.select(*GROUP, "child_item_nbr", "weights", "inv_cap")
    joined = children.join(live, list(GROUP)).where(F.col("inv_cap") > F.col("quantity"))
    share = F.col("quantity") * F.col("weights") / F.col("live_weight")
    parts = joined.withColumn("share", share).withColumn("floor", F.floor(F.col("share") + 1e-9))
    rest = F.floor((F.col("share") - F.col("floor")) * 1e6 + 0.5)
    request = Window.partitionBy(*GROUP, "quantity")
    over = F.col("quantity") - F.sum("floor").over(request)
    place = F.row_number().over(request.orderBy(rest.desc(), "child_item_nbr"))
    units = F.col("floor") + F.when(place <= over, 1).otherwise(0)
    return parts.select(*GROUP, "quantity", "child_item_nbr", units.cast("long").alias("units"))
