"""Price response: the discount grid, sale lift, checks and the best markdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.metrics import bias, smape, wmape
from clearshelf.functions.numeric import half_up, ratio
from clearshelf.functions.ordered import quantiles
from clearshelf.operators.scoring import isotonic_fit, monotone_envelope
from clearshelf.operators.second_level import DISCOUNTS, MEDIAN_PRICE
from clearshelf.params import DISCOUNT_GRID

QUARTILES = ("q1", "median", "q3")
SAMPLE = ("club_nbr", "item_nbr", "date", "num_weeks")

# The two statements of the check.
ALL_MONOTONIC = "All Item Clubs Show Monotonic Behavior"
NOT_MONOTONIC = "Item Clubs Do Not Show Monotonic Behavior"


def discount_grid(
    samples: DataFrame,
    *,
    horizon: int,
    discounts: Sequence[float] = DISCOUNT_GRID,
    inventory_modifier: float = 1.0,
) -> DataFrame:
    """Samples of one horizon at every grid discount; discounts beyond the horizon are -1."""
    grid = F.explode(F.array(*[F.lit(round(d, 2)) for d in discounts]))
    rows = (
        samples.where(F.col("num_weeks") == horizon)
        .withColumn("inventory_qty", F.col("inventory_qty") * inventory_modifier)
        .withColumn("discount", grid)
    )
    return rows.withColumns(
        {
            d: F.col("discount") if k <= horizon else F.lit(-1.0)
            for k, d in enumerate(DISCOUNTS, start=1)
        }
    )


def sale_lift(pred: DataFrame) -> DataFrame:
    """Lift of each grid prediction over the sample's lowest, and the sample's largest lift."""
    sample = Window.partitionBy(*SAMPLE)
    lowest, highest = F.min("predicted_sale").over(sample), F.max("predicted_sale").over(sample)
    return pred.withColumns(
        {"min_predicted_sale": lowest, "max_predicted_sale": highest}
    ).withColumns(
        {
            "max_sale_lift": (F.col("max_predicted_sale") + 1) / (F.col("min_predicted_sale") + 1),
            "sale_lift": (F.col("predicted_sale") + 1) / (F.col("min_predicted_sale") + 1),
        }
    )


def elasticity_curve(lift: DataFrame) -> DataFrame:
    """Quartiles of the sale lift at each discount."""
    box = quantiles(lift, ["discount"], F.col("sale_lift"), [0.25, 0.5, 0.75])
    return box.select("discount", *[F.col(q).alias(n) for q, n in zip(("q0", "q1", "q2"), QUARTILES)])


def elasticity_metrics(pred: DataFrame, *, horizon: int) -> DataFrame:
    """wmape, smape and bias of the stock-capped predictions at one horizon."""
    t, f = F.col("target").cast("double"), F.col("cap_predicted_sale")
    return pred.where(F.col("num_weeks") == horizon).agg(
        F.count("*").alias("n_samples"),
        wmape(t, f).alias("wmape"),
        smape(t, f).alias("smape"),
        bias(t, f).alias("bias"),
    )


def monotonicity_flags(
    pred: DataFrame, *, keys: Sequence[str], order_by: str, value: str
) -> DataFrame:
    """Per entity: 1 unless predictions strictly fall along the discounts; 1 if they never fall."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order_by))
    steps = pred.select(*keys, F.col(value).alias("_v"), before.alias("_before"))
    not_falling = (F.col("_v") >= F.col("_before")).cast("int")
    return steps.groupBy(*keys).agg(
        F.coalesce(F.max(not_falling), F.lit(0)).alias("monotonic"),
        F.coalesce(F.min(not_falling), F.lit(1)).alias("non_decreasing"),
    )


def monotonicity_check(
    pred: DataFrame,
    *,
    keys: Sequence[str] = ("club_nbr", "mds_fam_id"),
    order_by: str = "discount",
    value: str = "predicted_sale",
) -> DataFrame:
    """Overall statement with the counts behind it."""
    flags = monotonicity_flags(pred, keys=keys, order_by=order_by, value=value)
    return flags.agg(
        F.count("*").alias("n_entities"),
        F.sum("monotonic").alias("n_monotonic"),
        F.sum("non_decreasing").alias("n_non_decreasing"),
    ).withColumn(
        "statement",
        F.when(F.col("n_monotonic") == F.col("n_entities"), ALL_MONOTONIC).otherwise(NOT_MONOTONIC),
    )


def arc_elasticity(
    pred: DataFrame,
    *,
    keys: Sequence[str] = SAMPLE,
    low: float = 0.1,
    high: float = 0.6,
    deep: float = 0.9,
    threshold: float = 0.10,
    sold_out_share: float = 0.75,
    value: str = "predicted_sale",
) -> DataFrame:
    """Arc elasticity of sales between two discounts, and whether the entity is inelastic.

    An entity whose sales at the deep discount reach the sold-out share of its stock is not.
    """
    base = F.col(MEDIAN_PRICE) * F.col("price_1_week_back_median_price_6_month_last_nbr")
    price = half_up(base * (1 - F.col("discount")))

    def at(discount: float, what: Column) -> Column:
        return F.max(F.when(F.col("discount") == discount, what))

    points = pred.groupBy(*keys).agg(
        at(low, F.col(value)).alias("sales_low"),
        at(high, F.col(value)).alias("sales_high"),
        at(deep, F.col(value)).alias("sales_deep"),
        at(low, price).alias("price_low"),
        at(high, price).alias("price_high"),
        F.max("inventory_qty").alias("inventory_qty"),
    )

    def arc(first: str, second: str) -> Column:
        return ratio(F.col(first) - F.col(second), F.col(first) + F.col(second))

    elasticity = ratio(arc("sales_high", "sales_low"), arc("price_low", "price_high"))
    inelastic = (F.col("elasticity") < threshold) & (
        F.col("sales_deep") < F.col("inventory_qty") * sold_out_share
    )
    return (
        points.where(F.col("sales_low").isNotNull() & F.col("sales_deep").isNotNull())
        .withColumn("elasticity", elasticity)
        .withColumn("inelastic", F.when(inelastic, 1).otherwise(0))
    )


def elasticity_check(pred: DataFrame, **options) -> DataFrame:
    """Number and share of inelastic entities."""
    return arc_elasticity(pred, **options).agg(
        F.count("*").alias("n_entities"),
        F.sum("inelastic").alias("n_inelastic"),
        ratio(F.sum("inelastic"), F.count("*")).alias("inelastic_share"),
    )


def response_curve(
    samples: DataFrame, *, by: Sequence[str], discount: Column, units: Column, steps: int = 10
) -> DataFrame:
    """Observed mean units at each discount step, and two never-falling curves through them.

    ``envelope_units`` is the running maximum, which only raises; ``isotonic_units`` is the nearest
    curve in squares weighted by samples, which keeps the total. A negative discount counts as none.
    """
    step = F.floor(F.greatest(discount, F.lit(0.0)) * steps + 1e-9).cast("int")
    means = samples.groupBy(*by, step.alias("discount_step")).agg(
        F.count("*").alias("n_samples"), F.avg(units.cast("double")).alias("mean_units")
    )
    raised = monotone_envelope(means, by=by, order_by="discount_step", value="mean_units")
    fitted = isotonic_fit(
        raised, by=by, order_by="discount_step", value="mean_units", weight="n_samples", out="isotonic_units"
    )
    return fitted.withColumnRenamed("monotone_mean_units", "envelope_units")


def recovery_rate(
    pred: DataFrame, *, price: Column, cost: Column, liquidation: Column, sold: str
) -> DataFrame:
    """Revenue recovered by a markdown and the liquidation of the rest, against the stock's cost."""
    units, stock = F.col(sold), F.col("inventory_qty").cast("double")
    revenue = price * units + (stock - units) * liquidation
    return pred.withColumns(
        {
            "recovery_rate": ratio(revenue, cost * stock),
            "sell_through_rate": ratio(units, stock),
        }
    )


def best_markdown(recovery: DataFrame, *, keys: Sequence[str] = SAMPLE) -> DataFrame:
    """The grid point with the highest recovery; the smaller discount among equals."""
    best = Window.partitionBy(*keys).orderBy(F.col("recovery_rate").desc(), "discount")
    return (
        recovery.where(F.col("recovery_rate").isNotNull())
        .withColumn("_row", F.row_number().over(best))
        .where(F.col("_row") == 1)
        .drop("_row")
    )
