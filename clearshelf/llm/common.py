"""Helpers shared by the operators: rows kept aside in a struct, exact positions and running sums
in two levels, and byte-level tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.session import ship_package

#: ``[^\x20\x09-\x0D]+`` in a Java or DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` become a space, A-Z become a-z.
ALNUM_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)


#: Most bytes of a batch that goes to a worker, but for a single longer row.
BATCH_BYTES = 16 * 1024 * 1024


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters and everything beyond ASCII; none of a null."""
    return text.translate(ALNUM_TABLE).split() if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased; none of a null."""
    return text.lower().split() if text else []


def utf8(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, one value at a time."""
    for value in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()):
        yield value.as_py()


def crc32_text(value: Column) -> Column:
    """CRC-32 of a value written as text; a null counts as an empty text."""
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 of a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def as_row(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that no working column clashes with one of the input."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name))


def arrow_map(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path and batches of bounded size."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)


def positions(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], name: str
) -> DataFrame:
    """``df`` with ``name``: the 0-based position of each row of a group of ``by``.

    Rows are ordered by ``bucket`` and inside it by ``order``. Only a bucket meets in one task, and
    only the bucket totals of a group are ordered among themselves, so a group may hold any share
    of all rows as long as ``bucket`` splits it. ``df`` is read twice.
    """
    by = list(by)
    inside = Window.partitionBy(*by, bucket).orderBy(*order)
    across = Window.partitionBy(*by).orderBy(F.col("_bucket").asc_nulls_first())
    totals = (
        df.groupBy(*by, F.col(bucket).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            "_bucket",
            F.coalesce(
                F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
        )
    )
    local = df.withColumn("_local", F.row_number().over(inside).cast("long"))
    condition = local[bucket].eqNullSafe(totals["_bucket"])
    for c in by:
        condition = condition & local[c].eqNullSafe(totals[f"_by_{c}"])
    return local.join(totals, condition).select(
        *[local[c] for c in df.columns], (F.col("_before") + F.col("_local") - 1).alias(name)
    )
