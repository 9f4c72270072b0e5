"""Order statistics that never sort a whole group in one task.

A plain window or ``percentile`` keeps one group in one task, and the group here can be the whole
table (an overall median) or most of it (one large department). Both helpers aggregate equal values
first, order only inside value buckets, and order the bucket totals of a group among themselves.
There is one path for groups of every size, and groups may be null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets to a factor of e: about 0.05 percent of a value each.
_FINENESS = 2048


def _bucket(value: Column) -> Column:
    """Monotone bucket of a value, fine near zero; a double has at most three million of them.

    Spark takes logarithms with strict arithmetic, so every task agrees on the bucket.
    """
    size = F.floor(F.log1p(F.abs(value)) * _FINENESS)
    return F.when(value < 0, -size - 1).otherwise(size).cast("int")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on columns of one name where null equals null; the columns of the left side stay."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(
        lambda a, b: a & b,
        [left[c].eqNullSafe(renamed[f"_right_{c}"]) for c in on],
        F.lit(True),
    )
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in on])


def _totals(rows: DataFrame, by: Sequence[str], weight: str) -> DataFrame:
    """Weight and rows of each bucket of a group, and of the buckets before it."""
    across = Window.partitionBy(*by).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    return (
        rows.groupBy(*by, "_bucket")
        .agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"), F.min("_value").alias("_first"))
        .select(
            *by,
            "_bucket",
            "_w",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w_before"),
            F.lead("_first").over(across).alias("_next_first"),
            F.sum("_n").over(whole).cast("int").alias("_count"),
            F.sum("_w").over(whole).alias("_all"),
        )
    )


def in_order(
    df: DataFrame, by: Sequence[str], value: str, *, weight: Column | None = None
) -> DataFrame:
    """Position, next value and running weight of each distinct value of a group.

    ``df`` holds each (group, value) once. Adds ``_position`` (from 1), ``_count`` (values in the
    group), ``_next`` and ``_running``.
    """
    by = list(by)
    weight = F.lit(1) if weight is None else weight
    rows = df.withColumns(
        {"_bucket": _bucket(F.col(value)), "_weight": weight, "_value": F.col(value)}
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value)
    until_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns(
        {
            "_local_position": F.row_number().over(inside),
            "_local_next": F.lead(value).over(inside),
            "_local_running": F.sum("_weight").over(until_here),
        }
    )
    placed = null_safe_join(local, _totals(rows, by, "_weight"), [*by, "_bucket"], "inner")
    return placed.select(
        *df.columns,
        (F.col("_n_before") + F.col("_local_position")).cast("int").alias("_position"),
        "_count",
        F.coalesce("_local_next", "_next_first").alias("_next"),
        (F.col("_w_before") + F.col("_local_running")).alias("_running"),
    )


def quantiles(
    df: DataFrame, by: Sequence[str], value: Column, probabilities: Sequence[float]
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, as columns ``q0``, ``q1``, ...

    Rows are counted per distinct value and per value bucket. The bucket totals say which buckets
    hold the wanted ranks; only the values of those buckets are ordered.
    """
    by = list(by)
    counted = (
        df.select(*by, value.cast("double").alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*by, "_value")
        .agg(F.count("*").alias("_c"))
        .withColumn("_bucket", _bucket(F.col("_value")))
    )
    ranks = {}
    for i, p in enumerate(probabilities):
        spot = F.lit(float(p)) * (F.col("_all") - 1)
        ranks[f"_low{i}"], ranks[f"_high{i}"] = F.floor(spot), F.ceil(spot)
    low, high = F.col("_w_before"), F.col("_w_before") + F.col("_w")
    holds = reduce(lambda a, b: a | b, [(low <= r) & (r < high) for r in ranks.values()])
    buckets = _totals(counted, by, "_c").where(holds).select(*by, "_bucket", "_w_before", "_all")
    rows = null_safe_join(counted, buckets, [*by, "_bucket"], "inner")
    inside = Window.partitionBy(*by, "_bucket").orderBy("_value")
    running = F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_last", F.col("_w_before") + running)
    picks = [
        F.max(
            F.when((F.col("_last") - F.col("_c") <= rank) & (rank < F.col("_last")), F.col("_value"))
        ).alias(name)
        for name, rank in ranks.items()
    ]
    values = placed.groupBy(*by, "_all").agg(*picks)
    result = []
    for i, p in enumerate(probabilities):
        spot = F.lit(float(p)) * (F.col("_all") - 1)
        first, second = F.col(f"_low{i}"), F.col(f"_high{i}")
        result.append((first + (second - first) * (spot - F.floor(spot))).alias(f"q{i}"))
    return values.select(*by, *result)
