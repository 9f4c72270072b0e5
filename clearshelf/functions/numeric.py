"""Rounding, division and exact-hundredths helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def half_up_sql(x: str, digits: int = 2, *, infinite: str = "x") -> str:
    """SQL text of :func:`half_up` for a column, cheap to build for wide tables.

    ``infinite`` is ``x`` to keep infinities or ``NULL`` to drop them.
    """
    x, scale = f"double({x})", 10**digits
    limit = f"{9e15 / scale:.1e}D"
    beyond = x if infinite == "x" else f"CASE WHEN abs({x}) = double('infinity') THEN NULL ELSE {x} END"
    return (
        f"CASE WHEN abs({x}) >= {limit} THEN {beyond} "
        f"ELSE double(floor({x} * {scale}D + 0.5D)) / {scale}D END"
    )


def half_up(x: Column, digits: int = 2) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d``; infinities and very large values pass through.

    Written out rather than ``round`` because engines disagree on how a binary double that
    sits next to a half way point is rounded; this form is plain IEEE arithmetic.
    """
    scale = float(10**digits)
    x = x.cast("double")
    return F.when(F.abs(x) >= 9e15 / scale, x).otherwise(
        F.floor(x * scale + 0.5).cast("double") / scale
    )


def finite(x: Column) -> Column:
    """Null in place of +/- infinity."""
    return F.when(F.abs(x) != INF, x)


def ratio(num: Column, den: Column) -> Column:
    """Double division, null when the denominator is zero or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def hundredths(x: Column) -> Column:
    """A two-decimal value as a long count of hundredths.

    Window and median state over longs stays primitive, and sums do not depend on order.
    """
    return (x.cast("decimal(18,2)") * 100).cast("long")


def from_hundredths(x: Column) -> Column:
    return x.cast("double") / 100.0
