"""Predicted sales and their caps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.numeric import half_up
from clearshelf.functions.ordered import null_safe_join, quantiles
from clearshelf.operators.second_level import DISCOUNTS, WEEKLY_UNITS

Scorer = Callable[[DataFrame], DataFrame]
INVENTORY_NAMES = ("inventory", "inv", "fc_inventory", "inventory_qty")


def closed_form_scorer(samples: DataFrame) -> DataFrame:
    """Demand grows with the horizon and with the first discount. Stands in for a fitted model
    wherever a prediction must be reproducible to the last digit."""
    lift = 1 + 1.5 * F.greatest(F.col(DISCOUNTS[0]), F.lit(0.0))
    return samples.withColumn("prediction", F.col(WEEKLY_UNITS) * F.col("num_weeks") * lift)


def score_sales(
    samples: DataFrame, scorer: Scorer, *, inventory_col: str | None = None
) -> DataFrame:
    """Whole, non-negative predictions, capped by the first inventory column there is."""
    scored = scorer(samples)
    units = F.greatest(F.rint("prediction"), F.lit(0.0))
    stock = inventory_col or next((c for c in INVENTORY_NAMES if c in scored.columns), None)
    if stock is not None:
        units = F.least(units, F.col(stock).cast("double"))
    return scored.withColumn("predicted_sales", units).drop("prediction")


def grid_score(grid: DataFrame, scorer: Scorer) -> DataFrame:
    """Non-negative predictions on the discount grid, with a stock-capped copy."""
    scored = scorer(grid)
    sale = F.greatest(F.col("prediction"), F.lit(0.0))
    return scored.withColumns(
        {
            "predicted_sale": sale,
            "cap_predicted_sale": half_up(F.least(sale, F.col("inventory_qty").cast("double"))),
        }
    ).drop("prediction")


def monotone_envelope(
    grid_pred: DataFrame, *, by: Sequence[str], order_by: str, value: str = "predicted_sale"
) -> DataFrame:
    """Raise predictions to the running maximum along the discount grid.

    Tree ensembles here cannot be constrained, so the non-decreasing response is imposed on the
    few grid points of each sample instead. Ordered by the horizon, it does the same for ``num_weeks``.
    """
    rising = (
        Window.partitionBy(*by)
        .orderBy(order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return grid_pred.withColumn(f"monotone_{value}", F.max(value).over(rising))


def isotonic_fit(
    curves: DataFrame,
    *,
    by: Sequence[str],
    order_by: str,
    value: str,
    weight: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """The never-falling curve nearest to ``value`` in weighted squares, as column ``out``.

    Neighbours that fall are pooled to their weighted mean, so unlike the running maximum the total
    of a curve stays as it is. A curve's points, those of a discount grid or of the weeks, meet in
    one array. Points with a null value or a weight of zero or null take no part and get null. Points of
    equal ``order_by`` go by their value.
    """
    share = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    x = F.when(F.col(value).isNotNull() & (share > 0), F.col(value).cast("double"))
    point = F.struct(
        F.col(order_by).alias("o"), x.alias("x"), share.alias("w"), F.struct(*curves.columns).alias("row")
    )
    listed = curves.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.collect_list(point).alias("_all"))
    pooled = listed.select(
        F.expr("filter(_all, p -> p.x IS NULL)").alias("_none"),
        F.expr(
            "array_sort(filter(_all, p -> p.x IS NOT NULL), (a, b) -> CASE "
            "WHEN a.o < b.o OR (a.o IS NULL AND b.o IS NOT NULL) THEN -1 "
            "WHEN a.o > b.o OR (b.o IS NULL AND a.o IS NOT NULL) THEN 1 "
            "WHEN a.x < b.x THEN -1 WHEN a.x > b.x THEN 1 ELSE 0 END)"
        ).alias("_points"),
    ).withColumn("_pools", F.expr(_POOLS))
    fits = "flatten(transform(_pools, b -> array_repeat(b.s / b.w, b.n)))"
    fitted = pooled.select(
        F.explode(
            F.concat(
                F.expr(f"zip_with(_points, {fits}, (p, y) -> struct(p.row AS row, y AS y))"),
                F.expr("transform(_none, p -> struct(p.row AS row, CAST(NULL AS DOUBLE) AS y))"),
            )
        ).alias("_p")
    )
    return fitted.select("_p.row.*", F.col("_p.y").alias(out or f"isotonic_{value}"))


#: Left to right; a new point takes in the pools before it as long as their mean is not below its own.
_POOLS = """
aggregate(_points, CAST(array() AS ARRAY<STRUCT<s: DOUBLE, w: DOUBLE, n: INT>>), (pools, p) ->
  aggregate(
    reverse(pools),
    CAST(struct(p.x * p.w AS s, p.w AS w, 1 AS n, array() AS kept)
      AS STRUCT<s: DOUBLE, w: DOUBLE, n: INT, kept: ARRAY<STRUCT<s: DOUBLE, w: DOUBLE, n: INT>>>),
    (last, b) -> CASE
      WHEN size(last.kept) = 0 AND b.s / b.w >= last.s / last.w
      THEN struct(last.s + b.s AS s, last.w + b.w AS w, last.n + b.n AS n, last.kept AS kept)
      ELSE struct(last.s AS s, last.w AS w, last.n AS n, array_append(last.kept, b) AS kept) END,
    last -> array_append(reverse(last.kept), struct(last.s AS s, last.w AS w, last.n AS n))))"""


def bucket_caps(samples: DataFrame, *, bucket: str, weekly_units: Column) -> DataFrame:
    """80th percentile of weekly units in each bucket."""
    return quantiles(samples, [bucket], weekly_units, [0.8]).withColumnRenamed("q0", "quantile80")


def cap_by_bucket(
    pred: DataFrame, caps: DataFrame, *, bucket: str, weeks: str, value: str = "predicted_sales"
) -> DataFrame:
    """Cap predictions at the bucket's quantile times the weeks; unknown buckets stay uncapped."""
    cap = F.rint(F.col("quantile80") * F.col(weeks))
    return null_safe_join(pred, caps, [bucket], "left").withColumn(
        value, F.when(F.col(value) > cap, cap).otherwise(F.col(value))
    )
