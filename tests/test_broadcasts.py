"""Tables that grow with the data are not sent to the driver by the size of their compressed files."""

import os

import pytest
from pyspark.sql import functions as F

from clearshelf.plans import workspace as wk
from clearshelf.session import measured_broadcasts

GUESS = "spark.sql.autoBroadcastJoinThreshold"
MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def threshold(spark):
    before = spark.conf.get(GUESS)
    spark.conf.set(GUESS, "1m")
    yield
    spark.conf.set(GUESS, before)


@pytest.fixture
def folder(spark, sf_dir, tmp_path):
    """Parts whose files are far below the threshold of the test and whose rows are above it."""
    parts = spark.range(120_000).select(
        F.col("id").alias("p_partkey"), F.lit("a part").alias("p_name"),
        F.concat(F.lit("Brand#"), (F.col("id") % 20 + 11).cast("string")).alias("p_brand"),
        F.lit("PROMO").alias("p_type"), F.lit(5).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    parts.coalesce(1).write.parquet(str(tmp_path / "in" / "part.parquet"))
    for name in ("lineitem", "orders", "supplier", "nation", "region"):
        os.symlink(f"{sf_dir}/{name}.parquet", tmp_path / "in" / f"{name}.parquet")
    return str(tmp_path / "in")


def test_a_fine_stage_broadcasts_no_item_table_above_the_threshold(spark, threshold, folder, tmp_path, monkeypatch):
    plans = {}

    def run(df, name, path):
        assert df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return df

    monkeypatch.setattr(wk, "stage", run)
    wk.Workspace(spark, folder, fine=True, folder=str(tmp_path / "ws")).inventory_daily
    assert "isFinalPlan=true" in plans["inventory_daily"]
    joins = [line for line in plans["inventory_daily"].splitlines() if "Join [scan_id" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]


def test_small_tables_still_go_broadcast_and_settings_come_back(spark, threshold, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "small"))
    joined = spark.range(1000).join(spark.read.parquet(str(tmp_path / "small")), "id")
    with measured_broadcasts(spark):
        assert int(spark.conf.get(GUESS)) == (1 << 20) // 64
        assert joined.count() == 100
        assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert (spark.conf.get(GUESS), spark.conf.get(MEASURED, None)) == ("1m", None)
    with pytest.raises(ValueError), measured_broadcasts(spark):
        raise ValueError
    assert (spark.conf.get(GUESS), spark.conf.get(MEASURED, None)) == ("1m", None)
    spark.conf.set(GUESS, "-1")
    with measured_broadcasts(spark):
        assert spark.conf.get(GUESS) == "-1"


def test_every_stage_of_the_fine_second_level_is_written_by_measured_sizes(spark, threshold, folder, tmp_path, monkeypatch):
    limits = {}
    monkeypatch.setattr(wk, "stage", lambda df, name, path: limits.update({name: spark.conf.get(GUESS)}) or df)
    wk.Workspace(spark, folder, fine=True, folder=str(tmp_path / "ws")).second
    assert limits == dict.fromkeys(
        ("inventory_daily", "panel", "weekly_summary", "second_level"), str((1 << 20) // 64)
    )
    limits.clear()
    wk.Workspace(spark, folder, folder=str(tmp_path / "ws")).inventory_daily
    assert limits == {"inventory_daily": "1m"}
