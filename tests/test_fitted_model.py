"""The fitted model as a scorer, the workspace's own folder, visits, the other mape."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from clearshelf.operators import evaluation as ev
from clearshelf.operators import scans as sc
from clearshelf.operators import training as tr
from clearshelf.plans.workspace import Workspace, workspace
from clearshelf.sources import tables as tb

NAMES = ("club_nbr", "week", "stock")


def _rows(spark, n=300):
    return spark.range(n).select(
        (F.col("id") % 4).cast("int").alias("club_nbr"),
        (F.col("id") % 13).cast("int").alias("week"),
        (F.col("id") % 7).cast("double").alias("stock"),
        ((F.col("id") % 4) * 10.0 + F.col("id") % 7).alias("target"),
        F.col("id").alias("_own"),
    )


def test_fitted_scorer_encodes_and_keeps_the_rows_own_columns(spark):
    rows = _rows(spark)
    encoder = tr.fit_encoder(rows, covariates=NAMES)
    encoded = encoder.encode(rows)
    trees = tr.train_model(
        encoded, encoded, covariates=NAMES, params=tr.TreeParams(trees=10, depth=4, rate=0.5)
    )
    unseen = rows.limit(1).withColumn("club_nbr", F.lit(99)).withColumn("stock", F.lit(None).cast("double"))
    model = tr.DemandModel(encoder, trees)
    scored = model(rows.unionByName(unseen))
    assert scored.columns == [*rows.columns, "prediction"]
    got = scored.where("club_nbr < 99")
    assert got.select(rows.columns).exceptAll(rows).count() == 0
    errors = got.agg(F.avg(F.abs(F.col("prediction") - F.col("target"))).alias("e")).first()
    assert errors.e < 2.0
    assert scored.where("club_nbr = 99 AND prediction IS NOT NULL").count() == 1


def test_search_runs_the_asked_number_of_trials(spark):
    rows = _rows(spark, 60)
    encoded = tr.fit_encoder(rows, covariates=NAMES).encode(rows)
    space = {"rate": (0.1, 0.3), "depth": (2, 3), "rows": (0.5, 0.9), "columns": (0.5, 1.0), "l2": (3.1, 10.1)}
    trials = tr.tune_model(
        encoded, encoded, covariates=NAMES, space=space, trials=2, base=tr.TreeParams(trees=2)
    ).collect()
    assert [t.trial for t in sorted(trials)] == [0, 1]
    assert len({tuple(t)[1:6] for t in trials}) == 2


def test_workspace_leaves_nothing_behind(spark, sf_dir, tmp_path):
    ws = Workspace(spark, sf_dir, folder=str(tmp_path))
    assert ws.inventory_daily.count() > 0
    assert os.listdir(tmp_path)
    ws.close()
    assert os.listdir(tmp_path) == []


def test_rewritten_tables_get_a_new_workspace(spark, tmp_path):
    folder = tmp_path / "in"
    spark.range(3).write.parquet(str(folder / "part.parquet"))
    first = workspace(spark, str(folder))
    assert workspace(spark, str(folder)) is first
    os.utime(folder / "part.parquet", (1, 1))
    assert workspace(spark, str(folder)) is not first


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tb.shared_folder(Session())


def _visits(spark):
    day, other = date(2001, 5, 1), date(2001, 5, 2)
    scan = spark.createDataFrame(
        [(1, 7, day, 100, 0, 1.0, 2.0), (2, 7, day, 100, 0, 1.0, 2.0), (1, 7, other, 100, 0, 1.0, 2.0)],
        "store_nbr int, visit_nbr int, visit_date date, scan_id int, scan_type int, unit_qty double, "
        "retail_price double",
    )
    stores = spark.createDataFrame([(1, 1, "S"), (2, 1, "S")], "store_nbr int, club_nbr int, store_type string")
    visit = spark.createDataFrame(
        [(1, 7, day, 1), (2, 7, day, 198), (1, 7, other, 1)],
        "store_nbr int, visit_nbr int, visit_date date, visit_subtype_code int",
    )
    return scan, stores, visit


def _sales(scan, stores, visit):
    return sc.scan_sales(
        scan, stores, visit, start=date(2001, 5, 1), end=date(2001, 5, 1),
        excluded_store_types=("W",), excluded_subtypes=(198,),
        visit_keys=("store_nbr", "visit_nbr", "visit_date"),
    )


def test_a_visit_number_may_start_anew_by_store_and_day(spark):
    rows = _sales(*_visits(spark)).collect()
    assert [(r.store_nbr, r.visit_date) for r in rows] == [(1, date(2001, 5, 1))]


def test_the_date_range_reaches_the_scan_of_the_visits(spark, tmp_path):
    scan, stores, visit = _visits(spark)
    visit.write.parquet(str(tmp_path / "visit"))
    plan = _sales(scan, stores, spark.read.parquet(str(tmp_path / "visit")))
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(x for x in text.splitlines() if "PushedFilters" in x)
    assert "GreaterThanOrEqual(visit_date" in pushed and "LessThanOrEqual(visit_date" in pushed


def test_the_other_mape_counts_zero_actuals(spark):
    pred = spark.createDataFrame(
        [("a", 4.0, 5.0), ("a", 0.0, 1.0), (None, 2.0, 1.0)],
        "dept_nbr string, target double, predicted_sales double",
    )
    plain = {r.dept_nbr: r for r in ev.metrics_overall(pred, by=["dept_nbr"]).collect()}
    assert plain["a"].mape == 0.25 and plain[None].median_ape == 0.5
    other = {
        r.dept_nbr: r for r in ev.metrics_overall(pred, by=["dept_nbr"], mape_epsilon=True).collect()
    }
    assert other["a"].mape == pytest.approx((0.25 + 1 / 2.220446049250313e-16) / 2)
    assert other[None].mape == 0.5
    test = ev.metrics_test(pred).first()
    assert (test.n_samples, test.mape, test.mae) == (3, 0.38, 1.0)
