"""Column casts and target encoding of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearshelf.functions.numeric import hundredths


def cast_columns(
    df: DataFrame,
    *,
    strings: Sequence[str] = (),
    dates: Sequence[str] = (),
    floats: Sequence[str] = (),
) -> DataFrame:
    casts: dict[str, Column] = {}
    for names, dtype in ((strings, "string"), (dates, "timestamp"), (floats, "double")):
        casts.update({c: F.col(c).cast(dtype) for c in names})
    return df.withColumns(casts)


def category_codes(train: DataFrame, *, cols: Sequence[str], target: str) -> DataFrame:
    """Target sum and row count of every category of every column, in one pass over ``train``.

    Targets are summed as whole hundredths.
    """
    values = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols
    ]
    return (
        train.select(F.explode(F.array(*values)).alias("v"), hundredths(F.col(target)).alias("t"))
        .groupBy("v.column", "v.category")
        .agg((F.sum("t").cast("double") / 100.0).alias("sum_target"), F.count("*").alias("n"))
    )


def target_prior(train: DataFrame, *, target: str) -> DataFrame:
    """Mean target of all rows."""
    total = F.sum(hundredths(F.col(target))).cast("double") / 100.0
    return train.agg((total / F.count("*").cast("double")).alias("prior"))


def target_encode(
    train: DataFrame,
    other: DataFrame,
    *,
    cols: Sequence[str],
    target: str,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Replace the category columns of ``other`` by codes fitted on ``train``:
    (sum of target + prior) / (rows + 1), and the prior for a category not seen there.

    ``codes`` is the stored table of ``category_codes``, if there is one: the planner then knows
    its size and, while it is small, joins it without moving the rows of ``other``.
    """
    if codes is None:
        codes = category_codes(train, cols=cols, target=target)
    return apply_codes(codes, target_prior(train, target=target), other, cols=cols)


def apply_codes(
    codes: DataFrame, prior: DataFrame, other: DataFrame, *, cols: Sequence[str]
) -> DataFrame:
    """Replace the category columns of any set of rows by fitted codes."""
    encoded = other.withColumn("_prior", prior.select("prior").scalar())
    for c in cols:
        own = codes.where(F.col("column") == c).drop("column")
        code = F.coalesce(
            (F.col("sum_target") + F.col("_prior")) / (F.col("n") + 1), F.col("_prior")
        )
        encoded = (
            encoded.join(own, F.col(c).cast("string") == F.col("category"), "left")
            .withColumn(c, code)
            .drop("category", "sum_target", "n")
        )
    return encoded.drop("_prior")
