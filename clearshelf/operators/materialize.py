"""Stored feature tables: a keyed upsert of the newest rows, and reads as of a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearshelf.operators.second_level import latest_features
from clearshelf.sources.tables import exists, replace_partitions, stage

ENTITY_KEYS = ("mds_fam_id", "club_nbr")
#: Entities are stored in this many parts; a night rewrites the parts it has entities of.
BUCKETS = 64
_BUCKET = "entity_bucket"


def _newest(keys: Sequence[str]) -> Window:
    """Rows of an entity, the newest first; of equal days the later session and the later run."""
    order = [F.col(c).desc_nulls_last() for c in ("date", "item_on_shelf_date_dt", "created_timestamp")]
    return Window.partitionBy(*keys).orderBy(*order)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The stored table of newest rows."""
    return spark.read.parquet(path).drop(_BUCKET)


def upsert_latest(
    panel: DataFrame,
    path: str,
    *,
    as_of: date,
    lookback_days: int = 2,
    keys: Sequence[str] = ENTITY_KEYS,
    buckets: int = BUCKETS,
) -> None:
    """Bring the stored table of newest rows up to ``as_of``.

    Only rows of the last ``lookback_days`` days are read from ``panel``; a stored row gives way to a newer
    day, or to a later run of its day, so late rows inside the lookback arrive. Parts of the table
    without an entity of these days are neither read nor written; the others are replaced at once,
    and a run that is repeated leaves the table as it is.
    """
    recent = latest_features(panel, as_of=as_of, lookback_days=lookback_days)
    updates = stage(recent.withColumn(_BUCKET, _bucket(keys, buckets)), "latest_updates")
    touched = [r[0] for r in updates.select(_BUCKET).distinct().collect()]
    if not touched:
        return
    rows = updates
    if exists(panel.sparkSession, path):
        stored = panel.sparkSession.read.schema(updates.schema).parquet(path)
        rows = stored.where(F.col(_BUCKET).isin(*touched)).unionByName(updates)
    ranked = rows.withColumn("_row", F.row_number().over(_newest(keys)))
    kept = ranked.where("_row = 1").drop("_row")
    replace_partitions(stage(kept.select(*updates.columns), "latest_rows"), path, by=[_BUCKET])


def point_in_time(
    requests: DataFrame,
    features: DataFrame,
    *,
    columns: Sequence[str],
    max_age_days: int,
    keys: Sequence[str] = ENTITY_KEYS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``requests`` (``keys`` and ``event_timestamp``) with the feature ``columns`` as they were known then.

    A request takes the newest feature row of its entity whose ``event_timestamp`` is not after its own
    and at most ``max_age_days`` before it; of equal times, the one created last, then the one highest in
    ``ties``. Without one, the columns are null, ``feature_timestamp`` too. Both tables meet in one ordered pass per entity, and
    no pair of rows is made. Requests with a null key or time find nothing; repeated ones stay.
    """
    known = F.col("event_timestamp").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    rows = features.where(known).select(
        *keys, "event_timestamp", F.struct("created_timestamp", *ties).alias("_created"), F.lit(0).alias("_asks"),
        F.struct(F.col("event_timestamp").alias("feature_timestamp"), *columns).alias("_found"),
    )
    asked = requests.select(
        *keys, "event_timestamp", F.struct(*[requests[f"`{c}`"] for c in requests.columns]).alias("_own"),
        F.lit(1).alias("_asks"),
    )
    order = Window.partitionBy(*keys).orderBy("event_timestamp", "_asks", F.col("_created").asc_nulls_first())
    found = F.last("_found", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = rows.unionByName(asked, allowMissingColumns=True).withColumn("_last", found).where("_asks = 1")
    oldest = F.col("event_timestamp") - F.make_dt_interval(F.lit(max_age_days))
    fresh = known & (F.col("_last.feature_timestamp") >= oldest)
    wanted = [F.when(fresh, F.col(f"_last.`{c}`")).alias(c) for c in ("feature_timestamp", *columns)]
    return met.select("_own.*", *wanted)
