"""Forecast-error aggregates over a target ``t`` and a forecast ``f``, with ``e = f - t``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearshelf.functions.numeric import ratio

# Fixed value: the smallest denominator of the epsilon form of mape.
MAPE_EPSILON = 2.220446049250313e-16


def ape(t: Column, f: Column) -> Column:
    """Absolute percentage error, null for a zero actual."""
    return ratio(F.abs(f - t), F.nullif(F.abs(t), F.lit(0.0)))


def bias(t: Column, f: Column) -> Column:
    return ratio(F.sum(f - t), F.sum(t))


def wmape(t: Column, f: Column) -> Column:
    return ratio(F.sum(F.abs(f - t)), F.sum(t))


def smape(t: Column, f: Column) -> Column:
    return F.avg(2 * F.abs(f - t) / (F.abs(t) + F.abs(f) + 1) * 100)


def rmse(t: Column, f: Column) -> Column:
    return F.sqrt(F.avg((f - t) * (f - t)))


def mape(t: Column, f: Column, *, epsilon: bool = False) -> Column:
    """Mean absolute percentage error over non-zero actuals.

    With ``epsilon`` zero actuals count with a denominator of 2.2e-16 instead, which lets a
    single one dominate the mean.
    """
    if epsilon:
        return F.avg(F.abs(f - t) / F.greatest(F.abs(t), F.lit(MAPE_EPSILON)))
    return F.avg(ape(t, f))


def accuracy_columns(t: Column, f: Column, *, epsilon: bool = False) -> dict[str, Column]:
    """Single-pass accuracy metrics; the median is added by ``ordered.quantiles``.

    ``epsilon`` chooses the form of the mape.
    """
    return {
        "bias": bias(t, f),
        "mae": F.avg(F.abs(f - t)),
        "rmse": rmse(t, f),
        "mape": mape(t, f, epsilon=epsilon),
        "smape": smape(t, f),
        "weighted_mape": wmape(t, f),
    }


def _one_sided(t: Column, f: Column, side: Column, name: str) -> dict[str, Column]:
    """Share of rows, units, units against all actuals, and share-weighted units of one side."""
    share = ratio(F.count_if(side), F.count("*"))
    units = F.coalesce(F.sum(F.when(side, f - t)), F.lit(0.0))
    own = ratio(units, F.sum(F.when(side, t)))
    return {
        f"{name}_sample_pct": share,
        f"{name}_total_units": units,
        f"{name}_units_pct": ratio(units, F.sum(t)),
        f"{name}_mean_pct": F.when(F.count_if(side) == 0, 0.0).otherwise(own * share),
    }


def over_columns(t: Column, f: Column) -> dict[str, Column]:
    return _one_sided(t, f, f > t, "overestimation")


def under_columns(t: Column, f: Column) -> dict[str, Column]:
    return _one_sided(t, f, f < t, "underestimation")
