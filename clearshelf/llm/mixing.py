"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.llm.common import as_row, positions, word_count

#: Offsets are multiples of 2^-16, so that rank x rate + offset is exact where the rate is whole.
_OFFSET_STEPS = 65536


def size_bucket(size: str) -> Column:
    """A monotone bucket of a size column, eight to an octave, from its leading four bits."""
    return F.expr(
        f"length(bin({size})) * 8"
        f" + cast(shiftright({size}, greatest(length(bin({size})) - 4, 0)) & 7 as int)"
    )


def source_targets(
    sizes: DataFrame, *, weights: Sequence[int] = (5, 2, 1), cap: int = 3
) -> DataFrame:
    """The target of every source: (``_source``, ``source_size``, ``target``).

    ``sizes`` has one row per source with ``source_size``. Sources in code point order, null last,
    weigh ``weights`` in turn and share the sum of all sizes. No target exceeds ``cap`` times its
    source's size; the excess goes to the others by weight. With sources in the order of
    cap/weight, the level of a share is the largest of (rest of the total)/(rest of the weights)
    over all prefixes. The table of sources has one row per source, hence the unpartitioned window.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    weighted = sizes.select("_source", "source_size", weight.alias("_weight")).withColumn(
        "_most", F.lit(cap) * F.col("source_size")
    )
    everything = Window.partitionBy()
    full = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)

    def rest(name: str, total: Column) -> Column:
        return total - F.coalesce(F.sum(name).over(before), F.lit(0))

    level = rest("_most", F.sum("source_size").over(everything)) / rest(
        "_weight", F.sum("_weight").over(everything)
    )
    levels = weighted.withColumn("_level", level)
    highest = levels.withColumn("_level", F.max("_level").over(everything))
    target = F.least(F.col("_most").cast("double"), F.col("_level") * F.col("_weight"))
    return highest.select("_source", "source_size", target.cast("double").alias("target"))


def _offset(source: Column, seed: str) -> Column:
    """The random offset of a source, the same in every run."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("double") / _OFFSET_STEPS


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How often the mix takes each document: (``row``, ``size``, ``source_size``, ``target``,
    ``copies``).

    ``row`` holds all input columns. Within a source every document expects target/source_size
    copies. Documents stand in the order of size bucket, then md5 of the id; a document is taken
    once per whole number crossed by the running sum of expected copies plus one offset per source.
    All documents of a source expect the same, so the running sum is rank x rate, without rounding
    error that grows. Size order keeps the taken words near the target; ids decide inside a bucket,
    so that reruns agree.

    A null text has size 0, a null source is a source of its own, a null id sorts like an empty
    one, repeated rows are documents of their own, an empty table gives no rows. A source of size
    0 takes nothing. The hottest source is split by size bucket and 256 md5 prefixes.
    """
    keyed = as_row(docs).select(
        "row",
        word_count(F.col(f"row.`{text_col}`")).alias("_size"),
        F.col(f"row.`{source_col}`").cast("string").alias("_source"),
        F.md5(F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit("")).cast("binary")).alias(
            "_key"
        ),
    )
    placed = keyed.withColumn(
        "_bucket",
        F.concat(
            F.lpad(size_bucket("_size").cast("string"), 4, "0"), F.substring("_key", 1, 2)
        ),
    )
    ranked = positions(placed, ["_source"], "_bucket", [F.col("_key"), F.col("_size")], "_rank")
    sizes = keyed.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, weights=weights, cap=cap).withColumnRenamed("_source", "_name")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _offset(F.col("_source"), seed)
    crossed = F.floor((F.col("_rank") + 1) * rate + offset) - F.floor(F.col("_rank") * rate + offset)
    joined = ranked.join(targets, ranked["_source"].eqNullSafe(targets["_name"]))
    return joined.select(
        "row",
        F.col("_size").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        crossed.cast("long").alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of the input."""
    taken = mix_sources(docs, **options).where(F.col("copies") > 0)
    repeated = F.explode(F.array_repeat("row", F.col("copies").cast("int")))
    return taken.select(repeated.alias("copy")).select("copy.*")
