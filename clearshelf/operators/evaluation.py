"""Forecast-error reports.

``pred`` holds ``target`` and ``predicted_sales`` per item, club, date and ``num_weeks``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.functions.metrics import (
    accuracy_columns,
    ape,
    bias,
    over_columns,
    smape,
    rmse,
    under_columns,
    wmape,
)
from clearshelf.functions.numeric import half_up, half_up_sql
from clearshelf.functions.ordered import in_order, null_safe_join, quantiles
from clearshelf.params import HORIZONS

TARGET, FORECAST = "target", "predicted_sales"


def _pair(target: str, forecast: str) -> tuple[Column, Column]:
    return F.col(target).cast("double"), F.col(forecast).cast("double")


def _report(pred: DataFrame, by: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return pred.groupBy(*by).agg(*[c.alias(name) for name, c in columns.items()])


def _rounded(report: DataFrame, by: Sequence[str], digits: int) -> DataFrame:
    """Round the double columns of a report."""
    return report.selectExpr(
        *[
            f"{half_up_sql(f.name, digits)} AS {f.name}"
            if f.name not in by and isinstance(f.dataType, T.DoubleType)
            else f.name
            for f in report.schema
        ]
    )


def _with_median(
    report: DataFrame, pred: DataFrame, by: Sequence[str], t: Column, f: Column
) -> DataFrame:
    median = quantiles(pred, by, ape(t, f), [0.5])
    if by:
        return null_safe_join(report, median.withColumnRenamed("q0", "median_ape"), by, "left")
    return report.withColumn("median_ape", median.select("q0").scalar())


def metrics_overall(
    pred: DataFrame,
    *,
    by: Sequence[str] = (),
    target: str = TARGET,
    forecast: str = FORECAST,
    digits: int = 4,
    mape_epsilon: bool = False,
) -> DataFrame:
    """bias, mae, rmse, mape, smape, wmape and median ape, with the rows and zero actuals behind them.

    With ``mape_epsilon`` zero actuals count in the mape with the smallest denominator.
    """
    t, f = _pair(target, forecast)
    columns = {"n_samples": F.count("*"), "n_zero_actuals": F.count_if(t == 0)}
    report = _report(pred, by, {**columns, **accuracy_columns(t, f, epsilon=mape_epsilon)})
    return _rounded(_with_median(report, pred, by, t, f), by, digits)


def metrics_over_under(
    pred: DataFrame,
    *,
    by: Sequence[str] = (),
    target: str = TARGET,
    forecast: str = FORECAST,
    digits: int = 4,
) -> DataFrame:
    """Share and size of over- and under-estimation."""
    t, f = _pair(target, forecast)
    return _rounded(_report(pred, by, {**over_columns(t, f), **under_columns(t, f)}), by, digits)


def _model_metrics(
    pred: DataFrame, by: Sequence[str], digits: int, mape_epsilon: bool
) -> DataFrame:
    t, f = _pair(TARGET, FORECAST)
    accuracy = accuracy_columns(t, f, epsilon=mape_epsilon)
    columns = {"n_samples": F.count("*"), **accuracy, **over_columns(t, f)}
    columns.pop("bias")
    return _rounded(_with_median(_report(pred, by, columns), pred, by, t, f), by, digits)


def metrics_train_val_test(
    pred: DataFrame, *, digits: int = 4, mape_epsilon: bool = False
) -> DataFrame:
    """Accuracy and over-estimation per split."""
    return _model_metrics(pred, ["split"], digits, mape_epsilon)


def metrics_test(pred: DataFrame, *, digits: int = 2, mape_epsilon: bool = False) -> DataFrame:
    """The same of a single test set, rounded for the metric map of a model."""
    return _model_metrics(pred, [], digits, mape_epsilon)


def _per_horizon(name: str, metric, t: Column, f: Column) -> dict[str, Column]:
    columns = {}
    for k in range(1, HORIZONS + 1):
        here = F.col("num_weeks") == k
        columns[f"{name}_nw_{k}"] = metric(F.when(here, t), F.when(here, f))
    return columns


def metrics_by_horizon(pred: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """wmape of each horizon, one column per horizon; null where a horizon has no rows."""
    t, f = _pair(TARGET, FORECAST)
    return _rounded(_report(pred, by, _per_horizon("cumul_eval_wmape", wmape, t, f)), by, 4)


def weekly_decumulate(pred: DataFrame) -> DataFrame:
    """Weekly target and prediction: the cumulative value minus that of the shorter horizon."""
    sample = Window.partitionBy("mds_fam_id", "club_nbr", "date").orderBy("num_weeks")

    def last_week(column: str) -> Column:
        return F.coalesce(F.lag(column).over(sample), F.lit(0.0))

    return pred.withColumns(
        {
            "target_weekly": F.col(TARGET) - last_week(TARGET),
            "predicted_sales_weekly": F.col(FORECAST) - last_week(FORECAST),
        }
    )


def metrics_weekly(
    weekly: DataFrame, *, by: Sequence[str] = (), mape_epsilon: bool = False
) -> DataFrame:
    """The full metric set on weekly values, with wmape, bias and row count per horizon."""
    t, f = _pair("target_weekly", "predicted_sales_weekly")
    counts = {
        f"weekly_eval_sample_count_nw_{k}": F.count_if(F.col("num_weeks") == k)
        for k in range(1, HORIZONS + 1)
    }
    columns = {
        **accuracy_columns(t, f, epsilon=mape_epsilon),
        **over_columns(t, f),
        **under_columns(t, f),
        **_per_horizon("weekly_eval_wmape", wmape, t, f),
        **_per_horizon("weekly_eval_bias", bias, t, f),
        **counts,
    }
    report = _with_median(_report(pred=weekly, by=by, columns=columns), weekly, by, t, f)
    return _rounded(report, by, 4)


def _category_columns(t: Column, f: Column) -> dict[str, Column]:
    over = over_columns(t, f)
    return {
        "n_samples": F.count("*"),
        "mae": F.avg(F.abs(f - t)),
        "rmse": rmse(t, f),
        "wmape": wmape(t, f),
        "smape": smape(t, f),
        "oep_sample": over["overestimation_sample_pct"],
        "oe_value": over["overestimation_total_units"],
        "oep_total": over["overestimation_units_pct"],
        "oep_weighted": over["overestimation_mean_pct"],
        "_first_date": F.min("date"),
    }


def _labelled(report: DataFrame) -> DataFrame:
    """Unit label and first date of the whole evaluation set, from the few report rows."""
    everything = Window.partitionBy(F.lit(1))
    return report.withColumns(
        {
            "metric_target": F.lit("units"),
            "eval_set_start_date": F.min("_first_date").over(everything),
        }
    ).drop("_first_date")


def error_by_category(pred: DataFrame) -> DataFrame:
    """Ten metrics per department."""
    t, f = _pair(TARGET, FORECAST)
    by = ["dept_nbr"]
    report = _with_median(_report(pred, by, _category_columns(t, f)), pred, by, t, f)
    return _rounded(_labelled(report), by, 6)


def error_overall(pred: DataFrame) -> DataFrame:
    """The category report with all rows in one group."""
    t, f = _pair(TARGET, FORECAST)
    report = _with_median(_report(pred, [], _category_columns(t, f)), pred, [], t, f)
    return _rounded(_labelled(report), [], 6)


def error_by_horizon(weekly: DataFrame) -> DataFrame:
    """Rows, wmape, weekly wmape and bias per horizon; ``weekly_bias`` is the cumulative bias."""
    t, f = _pair(TARGET, FORECAST)
    wt, wf = _pair("target_weekly", "predicted_sales_weekly")
    columns = {
        "n_samples": F.count("*"),
        "wmape": wmape(t, f),
        "wmape_weekly": wmape(wt, wf),
        "weekly_bias": bias(t, f),
        "_first_date": F.min("date"),
    }
    return _rounded(_labelled(_report(weekly, ["num_weeks"], columns)), ["num_weeks"], 4)


def _first_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row by date of each group, as an aggregate: partial minima before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != "date"]
    first = F.min(F.struct("date", *rest)).alias("r")
    return df.groupBy(*keys).agg(first).select(*keys, "r.*").select(*df.columns)


def first_markdown_week(df: DataFrame) -> DataFrame:
    """First row of each markdown of an item in a club."""
    return _first_row(df, ["club_nbr", "mds_fam_id", "n_md"])


def first_session_week(df: DataFrame) -> DataFrame:
    """First row of each price session of a markdown."""
    return _first_row(df, ["club_nbr", "mds_fam_id", "n_md", "selling_price"])


def long_metrics(report: DataFrame, *, prefix: str) -> DataFrame:
    """One (metric, value) row per column of a one-row report."""
    pairs = [
        F.struct(F.lit(f"{prefix}{c}").alias("metric"), F.col(c).cast("double").alias("value"))
        for c in report.columns
    ]
    return report.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def combine_metrics(
    *long_reports: DataFrame, suffixes: Sequence[str] | None = None
) -> DataFrame:
    """Merge metric maps; a metric present twice takes its value from the later map.

    A suffix names the source of a map and goes on its evaluation metrics only.
    """
    suffixes = suffixes or [""] * len(long_reports)
    metric = F.col("metric")
    ranked = [
        report.select(
            F.when(metric.contains("eval"), F.concat(metric, F.lit(suffix)))
            .otherwise(metric)
            .alias("metric"),
            F.struct(F.lit(rank).alias("rank"), F.col("value")).alias("ranked"),
        )
        for rank, (report, suffix) in enumerate(zip(long_reports, suffixes, strict=True))
    ]
    merged = ranked[0]
    for other in ranked[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("metric").agg(F.max("ranked").alias("last")).select("metric", "last.value")


def error_quantiles(
    pred: DataFrame,
    *,
    by: str = "dept_nbr",
    limit: float | None = None,
    unit_range: tuple[float, float] = (-50.0, 50.0),
    bins: int = 20,
) -> DataFrame:
    """Data behind the error plots, in long form.

    ``ape_cdf`` overall (category -1) and per category: share of rows with an ape up to ``x``,
    for each distinct ape, up to ``limit`` if one is given (a plot may want it).
    ``unit_error``: rows per bin of the unit error.
    """
    t, f = _pair(TARGET, FORECAST)
    known = (
        pred.select(F.col(by).alias("category"), ape(t, f).alias("x"))
        .where(F.col("x").isNotNull())
        .groupBy("category", "x")
        .agg(F.count("*").alias("n"))
    )
    both = F.explode(F.array(F.col("category"), F.lit(-1))).alias("category")
    counted = known.select(both, "x", "n").groupBy("category", "x").agg(F.sum("n").alias("n"))
    total = counted.groupBy("category").agg(F.sum("n").alias("total"))
    cdf = (
        null_safe_join(
            in_order(counted, ["category"], "x", weight=F.col("n")), total, ["category"], "inner"
        )
        .where(F.lit(True) if limit is None else F.col("x") <= limit)
        .select(
            F.lit("ape_cdf").alias("kind"),
            "category",
            half_up(F.col("x"), 6).alias("x"),
            half_up(F.col("_running") / F.col("total"), 6).alias("y"),
        )
    )
    low, high = unit_range
    width = (high - low) / bins
    spot = F.width_bucket(f - t, F.lit(low), F.lit(high), F.lit(bins))
    density = (
        pred.groupBy(spot.alias("bin"))
        .agg(F.count("*").cast("double").alias("y"))
        .select(
            F.lit("unit_error").alias("kind"),
            F.lit(-1).alias("category"),
            (F.lit(low) + (F.col("bin") - 1) * width).alias("x"),
            "y",
        )
    )
    return cdf.unionByName(density)


def _axis(rows: DataFrame, value: Column, low: float, high: float, bins: int, factor: Column) -> dict:
    """Grid of one axis: its first point, step and kernel width in steps, the last from one aggregate."""
    found = rows.agg(F.count(value).alias("n"), F.stddev_samp(value).alias("sd"), factor.alias("factor")).first()
    step = (high - low) / bins
    width = found["sd"] * found["factor"] / step if found["sd"] else 0.0  # none of under two rows
    return {"n": found["n"], "low": low, "step": step, "bins": bins, "width": width or 1.0}


def _split(value: Column, axis: dict) -> Column:
    """The two grid points around a value with their shares of it."""
    at = (value - axis["low"]) / axis["step"]
    left = F.floor(at)
    return F.array(
        F.struct(left.cast("long").alias("i"), (1 - (at - left)).alias("w")),
        F.struct((left + 1).cast("long").alias("i"), (at - left).alias("w")),
    )


#: Widths of the kernel after which it is nothing: exp(-32).
_REACH = 8


def _near(bin_: Column, axis: dict) -> Column:
    reach = math.ceil(_REACH * axis["width"])
    return bin_.between(-reach, axis["bins"] + reach)


def _smoothed(rows: DataFrame, bin_: str, axis: dict, keep: Sequence[str] = ()) -> DataFrame:
    """Spread the weight ``w`` of each bin over the grid points its kernel reaches."""
    reach = math.ceil(_REACH * axis["width"])
    first, last = F.greatest(F.col(bin_) - reach, F.lit(0)), F.least(F.col(bin_) + reach, F.lit(axis["bins"]))
    spread = rows.where(_near(F.col(bin_), axis)).withColumn("_to", F.explode(F.sequence(first, last)))
    away = (F.col(bin_) - F.col("_to")) / axis["width"]
    kernel = F.exp(-0.5 * away * away) / (axis["width"] * math.sqrt(2 * math.pi))
    return spread.groupBy(*keep, F.col("_to").alias(bin_)).agg(F.sum(F.col("w") * kernel).alias("w"))


def error_density(
    pred: DataFrame, *, unit_range: tuple[float, float] = (-50.0, 50.0), bins: int = 200
) -> DataFrame:
    """Kernel density of the unit error at ``bins`` + 1 points of ``unit_range``, as (``x``, ``density``).

    Each error is shared between the two grid points around it, and a Gaussian kernel goes over the
    points, so rows are read once and everything after it is of the size of the grid. The kernel's
    width is 0.9 n^(-1/5) times the smaller of the deviation and the quartile distance / 1.34 (of the other, if
    one is zero; of one step, if both are). Errors outside the range count in n. Points no
    kernel reaches have no row; without known errors there are none.
    """
    t, f = _pair(TARGET, FORECAST)
    errors = pred.select((f - t).alias("e")).where(F.col("e").isNotNull())
    e = F.col("e")
    quartiles = quantiles(errors, [], e, [0.25, 0.75]).first()
    if quartiles is None:
        return errors.select(F.lit(0.0).alias("x"), F.lit(0.0).alias("density")).limit(0)
    axis = _axis(errors, e, *unit_range, bins, 0.9 * F.pow(F.count(e), F.lit(-0.2)))
    apart = (quartiles["q1"] - quartiles["q0"]) / 1.34
    if apart > 0:
        robust = apart * 0.9 * axis["n"] ** -0.2 / axis["step"]
        deviates = errors.agg(F.stddev_samp(e)).first()[0] or 0.0
        axis["width"] = min(axis["width"], robust) if deviates > 0 else robust
    shared = errors.select(F.explode(_split(e, axis)).alias("s")).select("s.i", "s.w")
    counted = shared.where(_near(F.col("i"), axis)).groupBy("i").agg(F.sum("w").alias("w"))
    return _smoothed(counted, "i", axis).select(
        (F.lit(axis["low"]) + F.col("i") * axis["step"]).alias("x"),
        (F.col("w") / (axis["n"] * axis["step"])).alias("density"),
    )


def joint_density(
    pred: DataFrame, *, unit_range: tuple[float, float] = (0.0, 100.0), bins: int = 50
) -> DataFrame:
    """Smoothed rows per grid cell of true against predicted units: (``actual``, ``predicted``, ``n_rows``).

    Rows are shared among the four grid points around them; a Gaussian kernel of n^(-1/6) deviations
    goes over one axis, then over the other. Cells no kernel reaches have no row.
    """
    t, f = _pair(TARGET, FORECAST)
    known = pred.select(t.alias("t"), f.alias("f")).where(F.col("t").isNotNull() & F.col("f").isNotNull())
    axes = {c: _axis(known, F.col(c), *unit_range, bins, F.pow(F.count(F.col(c)), F.lit(-1 / 6))) for c in ("t", "f")}
    halves = known.select(
        F.explode(_split(F.col("t"), axes["t"])).alias("a"), _split(F.col("f"), axes["f"]).alias("ps")
    ).select("a", F.explode("ps").alias("p"))
    corners = halves.where(_near(F.col("a.i"), axes["t"]) & _near(F.col("p.i"), axes["f"]))
    counted = corners.groupBy(F.col("a.i").alias("t"), F.col("p.i").alias("f")).agg(
        F.sum(F.col("a.w") * F.col("p.w")).alias("w")
    )
    both = _smoothed(_smoothed(counted, "t", axes["t"], ["f"]), "f", axes["f"], ["t"])
    low, step = unit_range[0], axes["t"]["step"]
    return both.select(
        (F.lit(low) + F.col("t") * step).alias("actual"),
        (F.lit(low) + F.col("f") * step).alias("predicted"),
        F.col("w").alias("n_rows"),
    )
