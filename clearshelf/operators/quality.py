"""Data-quality checks before and after a job, as rows of a log table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_COLUMNS = ("column_name", "expectation_type", "success", "element_count", "unexpected_count",
               "unexpected_percent", "observed_type")


def dq_not_null(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls and null percentage of each column over the whole table, in one aggregate."""
    counts = df.agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )
    per_column = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(f"null_{c}").alias("nulls")) for c in columns]
        )
    )
    nulls = F.col("r.nulls")
    return counts.select("n", per_column.alias("r")).select(
        F.col("r.column").alias("column_name"),
        F.lit("expect_column_values_to_not_be_null").alias("expectation_type"),
        (nulls == 0).alias("success"),
        F.col("n").alias("element_count"),
        nulls.alias("unexpected_count"),
        F.try_divide(nulls.cast("double") * 100, F.col("n").cast("double")).alias(
            "unexpected_percent"
        ),
        F.lit(None).cast("string").alias("observed_type"),
    )


def dq_type(df: DataFrame, *, expected: Mapping[str, str]) -> DataFrame:
    """Declared against actual column types; the row count shows what the check stands for."""
    actual = dict(df.dtypes)
    found = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(actual.get(c)).cast("string").alias("observed"),
            F.lit(actual.get(c) == dtype).alias("ok"),
        )
        for c, dtype in expected.items()
    ]
    return df.agg(F.count("*").alias("n")).select("n", F.explode(F.array(*found)).alias("r")).select(
        F.col("r.column").alias("column_name"),
        F.lit("expect_column_values_to_be_of_type").alias("expectation_type"),
        F.col("r.ok").alias("success"),
        F.col("n").alias("element_count"),
        F.lit(None).cast("bigint").alias("unexpected_count"),
        F.lit(None).cast("double").alias("unexpected_percent"),
        F.col("r.observed").alias("observed_type"),
    )


def dq_report(*checks: DataFrame, checked_at: datetime) -> DataFrame:
    """All checks of a job as one long log, stamped with the check time."""
    log = checks[0]
    for check in checks[1:]:
        log = log.unionByName(check)
    return log.select(F.lit(checked_at.strftime("%Y-%m-%d %H:%M:%S")).alias("utc_time"), *LOG_COLUMNS)
