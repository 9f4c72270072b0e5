"""Target encoding, data quality, table reads and writes, plan shape."""

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.operators import encoding as en
from clearshelf.operators import quality as dq
from clearshelf.operators import scans as sc
from clearshelf.plans.queries import QUERIES
from clearshelf.sources import tables as tb

AISLES = [("north", 6.0), ("south", 5.0), ("north", 2.0), ("east", 0.0), ("south", 7.0), ("north", 7.0)]


def test_target_encoding_by_hand(spark):
    """27 units in six rows: the prior is 4.5. North: (15 + 4.5) / 4, south: (12 + 4.5) / 3, east: 4.5 / 2."""
    train = spark.createDataFrame(AISLES, "aisle string, units double")
    other = spark.createDataFrame(
        [("north", 0), ("south", 1), ("east", 2), ("west", 3), (None, 4)], "aisle string, id int"
    )
    coded = en.target_encode(train, other, cols=["aisle"], target="units").collect()
    assert {r.id: r.aisle for r in coded} == {0: 4.875, 1: 5.5, 2: 2.25, 3: 4.5, 4: 4.5}


def test_casts(spark):
    df = spark.createDataFrame([(7, "2001-02-03", "1.5")], "a int, b string, c string")
    row = en.cast_columns(df, strings=["a"], dates=["b"], floats=["c"]).first()
    assert tuple(row) == ("7", datetime(2001, 2, 3), 1.5)


def test_not_null_check_counts_the_whole_table(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "y")], "a int, b string")
    rows = {r.column_name: r for r in dq.dq_not_null(df, columns=["a", "b"]).collect()}
    assert rows["a"].success and not rows["b"].success
    assert (rows["b"].element_count, rows["b"].unexpected_count, rows["b"].unexpected_percent) == (4, 2, 50.0)


def test_type_check_reports_missing_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    rows = {r.column_name: r for r in dq.dq_type(df, expected={"a": "int", "b": "int", "c": "int"}).collect()}
    assert [rows[c].success for c in "abc"] == [True, False, False]
    assert rows["c"].observed_type is None


def test_write_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    path = str(tmp_path / "t")
    tb.write_table(df, path)
    tb.write_table(df, path)
    assert tb.read_table(spark, path).count() == 2
    tb.write_table(df, path, mode="append")
    got = tb.read_table(spark, path, columns=["b"], where=F.col("a") == 2)
    assert [tuple(r) for r in got.collect()] == [("y",), ("y",)]


def test_gzip_export_replaces_old_files(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for rows in (df, df.where("a = 1")):
        paths = tb.extract_parquet({"one": rows}, str(tmp_path))
    assert spark.read.parquet(paths["one"]).count() == 1
    assert any(p.name.endswith(".gz.parquet") for p in (tmp_path / "one").iterdir())


def test_results_are_projected_stamped_and_appended(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("run_date", T.StringType())])
    df = spark.createDataFrame([(1, "dropped")], "a int, b string")
    path = str(tmp_path / "r")
    for day in (1, 2):
        tb.append_results(df, path, schema=schema, run_date=date(2001, 1, day))
    assert sorted(tuple(r) for r in tb.read_results(spark, path, schema=schema).collect()) == [
        (1.0, "2001-01-01"), (1.0, "2001-01-02"),
    ]


def test_stage_writes_under_the_configured_folder(spark):
    folder = tb.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder
    df = tb.stage(spark.range(5), "five")
    assert df.count() == 5
    assert all(folder in f for f in df.inputFiles())


def test_universe_and_sentinel(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "dept_nbr int")
    assert sc.category_universe(df, csv_list="2, 3").count() == 1
    assert sorted(r.dept_nbr for r in sc.fill_sentinel(df, column="dept_nbr").collect()) == [-1, 1, 2]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_pair_join_in_any_plan(ws):
    for name in ("first_level_features", "eval_manual", "disagg_final", "metrics_overall", "error_quantiles",
                 "cart_members_week_back", "elasticity_curve", "target_encode", "sample_ratios"):
        plan = _plan(QUERIES[name](ws))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_scan_is_pruned_and_filtered(ws):
    plan = _plan(QUERIES["daily_sales"](ws))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "l_tax" not in plan


def test_features_need_no_exchange_after_the_shelf_join(ws):
    """Shelf sessions, scaffold rows and all windows run on one partitioning by item and club."""
    plan = _plan(QUERIES["first_level_features"](ws))
    top = plan[: plan.index("Union")]
    assert top.count("Exchange hashpartitioning") == 1
    assert "Join" not in top
