"""Registered queries: one function per operator, from the derived tables to its output."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.functions.numeric import finite, ratio
from clearshelf.operators import boosting as bo
from clearshelf.operators import cart
from clearshelf.operators import disaggregation as dg
from clearshelf.operators import elasticity as el
from clearshelf.operators import encoding as en
from clearshelf.operators import evaluation as ev
from clearshelf.operators import first_level as fl
from clearshelf.operators import materialize as ma
from clearshelf.operators import quality as dq
from clearshelf.operators import sampling as sa
from clearshelf.operators import scans as sc
from clearshelf.operators import scoring as so
from clearshelf.operators import second_level as sl
from clearshelf.operators import training as tr
from clearshelf.plans.columns import COLUMNS, present
from clearshelf.plans.workspace import RUN_TS, Workspace, workspace
from clearshelf.sources import tables as tb
from clearshelf.sources.retail import CART_AS_OF

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}

GRID_WITH_DEEP = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
CSV_LIST = "0, 1, 2, 3"
#: The registered queries fit small trees; the operator's defaults are those of a production fit.
SMALL_FIT = tr.TreeParams(trees=20, depth=5, rate=0.1)
INGRESS_TYPES = {"scan_id": "bigint", "visit_nbr": "int"}
EGRESS_TYPES = {"parent_item_nbr": "int", "child_item_nbr": "int", "club_nbr": "int"}
CHECKED_AT = datetime(2001, 11, 5, 7, 0, 0)

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("subclass_nbr", T.IntegerType()),
        T.StructField("mds_fam_id", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("dept_nbr", T.IntegerType()),
        T.StructField("item_nbr", T.IntegerType()),
        T.StructField("club_nbr", T.IntegerType()),
        T.StructField("unit_price_amt", T.DoubleType()),
        T.StructField("markdown_start_date_dt", T.DateType()),
        T.StructField("oos_date", T.DateType()),
        T.StructField("num_weeks", T.DoubleType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("predicted_sales", T.DoubleType()),
        T.StructField("run_date", T.StringType()),
    ]
)


def _result_schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _DATE = T.StringType(), T.DateType()
_ERRORS = {
    "n_samples": _LONG, "rmse": _DOUBLE, "wmape": _DOUBLE, "smape": _DOUBLE,
    "oep_sample": _DOUBLE, "oe_value": _DOUBLE, "oep_total": _DOUBLE,
}
CATEGORY_RESULTS = _result_schema(
    **_ERRORS, dept_nbr=_INT, metric_target=_TEXT, eval_set_start_date=_DATE, description=_TEXT,
    run_date=_TEXT,
)
OVERALL_RESULTS = _result_schema(
    **_ERRORS, metric_target=_TEXT, eval_set_start_date=_DATE, run_date=_TEXT
)
HORIZON_RESULTS = _result_schema(
    n_samples=_LONG, wmape=_DOUBLE, wmape_weekly=_DOUBLE, num_weeks=_INT, metric_target=_TEXT,
    weekly_bias=_DOUBLE, eval_set_start_date=_DATE, run_date=_TEXT,
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- scans, sources, sinks ------------------------------------------------------------------


@query
def scan_sales(ws):
    return ws.scan_sales()


@query
def item_dim(ws):
    return ws.item_dim()


@query
def item_dim_current(ws):
    return sc.item_dim_current(
        ws.item_master(),
        country=ws.params.country,
        division=ws.params.division,
        excluded_subclasses=ws.params.excluded_subclasses,
    )


@query
def inventory_enriched(ws):
    return ws.inventory_enriched()


@query
def manual_markdowns(ws):
    return ws.manual()


@query
def plan_logs(ws):
    return ws.plans()


@query
def child_inventory(ws):
    return ws.child_inventory()


@query
def child_sales_1w(ws):
    return ws.child_sales()


@query
def parent_child_map(ws):
    return ws.parent_child_map()


@query
def disagg_input(ws):
    return ws.disagg_input()


@query
def read_table(ws):
    path = ws.path("read_table")
    tb.write_table(ws.panel, path)
    return tb.read_table(
        ws.spark,
        path,
        columns=["club_nbr", "mds_fam_id", "date", "unit_sold_cnt"],
        where=F.col("unit_sold_cnt") > 0,
    )


@query
def write_table(ws):
    path = ws.path("write_table")
    rows = ws.panel.select("club_nbr", "mds_fam_id", "date", "unit_sold_cnt")
    tb.write_table(rows, path, mode="overwrite", format="orc")
    return tb.read_table(ws.spark, path, format="orc")


def _five_sets(ws: Workspace) -> dict[str, DataFrame]:
    splits = {name: ws.splits.where(F.col("split") == name) for name in ("train", "val", "test")}
    return {**splits, "planned": ws.planned_eval, "manual": ws.manual_eval}


@query
def extract_parquet(ws):
    columns = ["mds_fam_id", "item_nbr", "club_nbr", "date", "num_weeks", "target"]
    paths = tb.extract_parquet(_five_sets(ws), ws.path("extract"))
    parts = [
        ws.spark.read.parquet(path).select(F.lit(name).alias("dataset"), *columns)
        for name, path in paths.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def append_results(ws):
    path = ws.path("results")
    names = [f.name for f in RESULT_SCHEMA if f.name != "run_date"]
    both = ws.manual_predictions().select(names).unionByName(ws.planned_predictions().select(names))
    for _ in range(2):  # a night that is run again
        tb.append_results(both, path, schema=RESULT_SCHEMA, run_date=ws.params.run_date)
    return tb.read_results(ws.spark, path, schema=RESULT_SCHEMA)


def _appended(ws: Workspace, report: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    path = ws.path(name)
    tb.append_results(report, path, schema=schema, run_date=ws.params.run_date)
    return tb.read_results(ws.spark, path, schema=schema)


@query
def append_category_results(ws):
    return _appended(ws, error_by_category(ws), CATEGORY_RESULTS, "category_results")


@query
def append_horizon_results(ws):
    return _appended(ws, error_by_horizon(ws), HORIZON_RESULTS, "horizon_results")


@query
def append_overall_results(ws):
    return _appended(ws, error_overall(ws), OVERALL_RESULTS, "overall_results")


@query
def dataset_profile(ws):
    return sc.dataset_profile(_five_sets(ws))


@query
def fill_sentinel(ws):
    return sc.fill_sentinel(ws.planned_eval, column="department_nbr")


@query
def category_description(ws):
    counts = ws.manual_predictions().groupBy("dept_nbr").agg(F.count("*").alias("n_samples"))
    return sc.category_description(counts, ws.descriptions)


# --- first level ----------------------------------------------------------------------------


@query
def inventory_effective(ws):
    return ws.inventory()


@query
def shelf_sessions(ws):
    return fl.shelf_sessions(ws.inventory())


@query
def daily_sales(ws):
    return ws.daily_sales()


@query
def daily_sales_catalog(ws):
    return ws.daily_catalog()


@query
def daily_sales_inventory(ws):
    return ws.daily_inventory()


@query
def shelf_interval_join(ws):
    return ws.shelf_panel()


@query
def active_pair_scaffold(ws):
    return ws.scaffold()


@query
def days_on_shelf(ws):
    return fl.days_on_shelf(ws.scaffold())


@query
def units_week_back(ws):
    return fl.units_week_back(ws.scaffold())


@query
def units_week_next(ws):
    return fl.units_week_next(ws.scaffold())


@query
def price_week_back(ws):
    return fl.price_week_back(ws.scaffold())


@query
def price_week_next(ws):
    return fl.price_week_next(ws.scaffold())


@query
def units_52_week_back(ws):
    return fl.units_52_week_back(ws.scaffold())


@query
def first_level_features(ws):
    return ws.first_level()


# --- second level ---------------------------------------------------------------------------


@query
def audit_columns(ws):
    return sl.audit_columns(ws.panel, run_ts=RUN_TS).select(
        "club_nbr",
        "mds_fam_id",
        "date",
        F.col("event_timestamp").cast("date").alias("event_date"),
        F.unix_timestamp("event_timestamp").alias("event_epoch"),
        F.unix_timestamp("created_timestamp").alias("created_epoch"),
    )


@query
def weekly_discount(ws):
    return sl.weekly_discount(ws.panel)


@query
def calendar_iso(ws):
    return sl.calendar_iso(ws.panel)


@query
def half_year_stats(ws):
    return sl.half_year_stats(ws.scaffold())


@query
def row_extremes(ws):
    return sl.row_extremes(sl.weekly_discount(ws.panel))


@query
def impute_features(ws):
    return sl.impute_features(sl.row_extremes(sl.weekly_discount(ws.panel)))


@query
def price_units_ratio(ws):
    return sl.price_units_ratio(impute_features(ws))


@query
def calendar_us_week(ws):
    return sl.calendar_us_week(ws.panel)


@query
def yoy_subclass_club(ws):
    return sl.yoy_subclass_club(ws.panel)


@query
def avg_dept_club_52w(ws):
    return sl.avg_dept_club_52w(ws.panel)


@query
def avg_dept_52w(ws):
    return sl.avg_dept_52w(ws.panel)


@query
def yoy_item(ws):
    return sl.yoy_item(ws.panel)


@query
def units_wow_change(ws):
    return sl.units_wow_change(impute_features(ws))


@query
def subclass_month_share(ws):
    return sl.subclass_month_share(ws.panel)


@query
def conform_schema(ws):
    return sl.conform_schema(
        price_units_ratio(ws), schema=sl.second_level_types(), drop=sl.WORK_COLUMNS
    )


@query
def second_level_features(ws):
    return ws.second


@query
def latest_features(ws):
    return sl.latest_features(ws.second, as_of=ws.params.run_date)


@query
def latest_materialized(ws):
    """The stored table of newest rows after three nights, the last of them run twice."""
    path, day = ws.path("latest"), ws.params.run_date
    for nights_ago in (2, 1, 0, 0):
        ma.upsert_latest(ws.second, path, as_of=day - timedelta(days=nights_ago))
    return ma.read_latest(ws.spark, path)


POINT_IN_TIME = ("inventory_qty", sl.WEEKLY_UNITS, sl.MEDIAN_PRICE)


@query
def point_in_time(ws):
    """Features as they were known at the start of each manual markdown."""
    start = F.col("markdown_start_date_dt").cast("timestamp").alias("event_timestamp")
    found = ma.point_in_time(
        ws.manual().select("item_nbr", "club_nbr", start),
        ws.second,
        columns=POINT_IN_TIME,
        max_age_days=14,
        keys=("item_nbr", "club_nbr"),
        ties=("item_on_shelf_date_dt", "mds_fam_id"),
    )
    return found.select(
        "item_nbr",
        "club_nbr",
        F.to_date("event_timestamp").alias("markdown_start_date_dt"),
        F.to_date("feature_timestamp").alias("feature_date"),
        *POINT_IN_TIME,
    )


# --- samples --------------------------------------------------------------------------------


@query
def discount_fill_filter(ws):
    return sa.discount_fill_filter(ws.second)


@query
def any_future_sales(ws):
    return sa.any_future_sales(ws.second)


@query
def discount_weight(ws):
    return sa.discount_weight(sa.any_future_sales(sa.discount_fill_filter(ws.second)))


@query
def top1_item_club_month(ws):
    return sa.initial_filter(ws.second)


@query
def initial_filter(ws):
    return sa.initial_filter(ws.second)


@query
def expand_horizons(ws):
    return sa.expand_horizons(sa.initial_filter(ws.second))


@query
def sample_ratios(ws):
    return sa.sample_ratios(expand_horizons(ws))


@query
def sample_filters(ws):
    return sa.sample_filters(expand_horizons(ws), after=ws.dates.warm_start)


@query
def horizon_matured(ws):
    return sa.horizon_matured(ws.samples, end=ws.dates.test[1])


@query
def first_week_of_target(ws):
    return sa.first_week_of_target(horizon_matured(ws))


@query
def train_val_test(ws):
    return ws.splits


@query
def select_covariates(ws):
    return sa.select_covariates(ws.splits)


@query
def eval_planned(ws):
    return ws.planned_eval


@query
def eval_planned_complete(ws):
    return sa.eval_planned_complete(ws.planned_samples, dates=ws.dates)


@query
def eval_manual(ws):
    return ws.manual_eval


@query
def period_split(ws):
    parts = [
        sc.period_split(ws.panel, run_date=ws.params.run_date, frequency=f).withColumn(
            "frequency", F.lit(f)
        )
        for f in ("weekly", "monthly")
    ]
    return parts[0].unionByName(parts[1])


@query
def category_universe(ws):
    every = sc.item_dim(ws.item_master(), depts=range(5))
    return sc.category_universe(every, csv_list=CSV_LIST)


# --- disaggregation -------------------------------------------------------------------------


@query
def disagg_raw_weights(ws):
    return ws.disagg_weights


@query
def disagg_scenarios(ws):
    return dg.disagg_scenarios(ws.disagg_weights, caps=ws.disagg_caps)


@query
def disagg_flags(ws):
    return dg.disagg_flags(ws.disagg_weights, disagg_scenarios(ws), caps=ws.disagg_caps)


@query
def disagg_final(ws):
    return dg.disagg_final(ws.disagg_weights, disagg_scenarios(ws), caps=ws.disagg_caps)


@query
def disagg_lookup(ws):
    """A tenth, a half and all of each parent's stock, in whole units of its children."""
    parts = F.explode(F.array(*[F.lit(p) for p in (10, 2, 1)])).alias("part")
    groups = ws.disagg_weights.select(*dg.GROUP, "inventory").distinct()
    requests = groups.select(*dg.GROUP, "inventory", parts).select(
        *dg.GROUP, F.floor(F.col("inventory") / F.col("part")).alias("quantity")
    )
    return dg.disagg_lookup(requests, ws.disagg_weights, caps=ws.disagg_caps)


# --- data quality ---------------------------------------------------------------------------


@query
def dq_not_null(ws):
    return dq.dq_not_null(
        ws.tables.scan(), columns=["scan_id", "unit_qty", "visit_nbr", "visit_date"]
    )


@query
def dq_type(ws):
    return dq.dq_type(ws.tables.scan(), expected=INGRESS_TYPES)


def _dq_checks(ws: Workspace) -> list[list[DataFrame]]:
    """The checks before and after the disaggregation job."""
    return [
        [dq.dq_not_null(df, columns=not_null), dq.dq_type(df, expected=types)]
        for df, not_null, types in (
            (ws.tables.scan(), ["scan_id"], INGRESS_TYPES),
            (ws.disagg_weights, list(EGRESS_TYPES), EGRESS_TYPES),
        )
    ]


@query
def dq_report(ws):
    ingress, egress = _dq_checks(ws)
    return dq.dq_report(*ingress, *egress, checked_at=CHECKED_AT)


@query
def dq_log(ws):
    path = ws.path("dq_log")
    for checks in _dq_checks(ws):
        tb.append_log(dq.dq_report(*checks, checked_at=CHECKED_AT), path)
    return ws.spark.read.parquet(path)


# --- encoding, training, scoring ------------------------------------------------------------


@query
def cast_columns(ws):
    rows = ws.panel.select(
        F.col("department_nbr").alias("dept_text"),
        F.date_format("date", "yyyy-MM-dd").alias("start_date"),
        F.col("unit_price_amt").cast("string").alias("price"),
    )
    return en.cast_columns(rows, strings=["dept_text"], dates=["start_date"], floats=["price"])


@query
def target_encode(ws):
    train = ws.splits.where(F.col("split") == "train")
    codes = ws.stage(en.category_codes(train, cols=tr.ENCODED, target="target"), "category_codes")
    return en.target_encode(train, ws.splits, cols=tr.ENCODED, target="target", codes=codes)


def _model(ws: Workspace) -> tuple[DataFrame, tr.DemandModel]:
    """Encoded splits and the model fitted on them, once per workspace."""
    if "_fitted" not in ws.__dict__:
        train = ws.splits.where(F.col("split") == "train")
        encoder = tr.fit_encoder(train, covariates=sa.COVARIATES, store=ws.stage)
        encoded = ws.stage(encoder.encode(ws.splits), "encoded")
        parts = {s: encoded.where(F.col("split") == s) for s in ("train", "val")}
        trees = tr.train_model(
            parts["train"], parts["val"], covariates=sa.COVARIATES, params=SMALL_FIT
        )
        ws.__dict__["_fitted"] = (encoded, tr.DemandModel(encoder, trees))
    return ws.__dict__["_fitted"]


@query
def train_model(ws):
    encoded, model = _model(ws)
    train = encoded.where(F.col("split") == "train")
    scored = model.trees.transform(encoded).withColumn(
        "mean", train.agg(F.avg("target").alias("m")).scalar()
    )
    return scored.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.avg(F.abs(F.col("prediction") - F.col("target"))).alias("model_mae"),
        F.avg(F.abs(F.col("mean") - F.col("target"))).alias("mean_mae"),
    )


@query
def tune_model(ws):
    encoded, _ = _model(ws)
    return tr.tune_model(
        encoded.where(F.col("split") == "train"),
        encoded.where(F.col("split") == "val"),
        covariates=sa.COVARIATES,
        space={**tr.SEARCHED, "rate": (0.1, 0.2, 0.3), "depth": (2, 3, 4)},
        trials=4,
        start=2,
        base=dataclasses.replace(SMALL_FIT, trees=8),
    )


def _grid(ws: Workspace, discounts=el.DISCOUNT_GRID) -> DataFrame:
    grid = el.discount_grid(ws.manual_eval, horizon=1, discounts=discounts)
    return so.grid_score(grid, so.closed_form_scorer)


@query
def monotone_envelope(ws):
    return so.monotone_envelope(_grid(ws), by=el.SAMPLE, order_by="discount")


@query
def feature_importance(ws):
    _, model = _model(ws)
    return tr.feature_importance(model.trees)


SAMPLE_KEY = ("mds_fam_id", "item_nbr", "club_nbr", "date", "item_on_shelf_date_dt")


def _fitted_predictions(ws: Workspace) -> DataFrame:
    """The test, planned and manual sets scored by the fitted model; more weeks never sell less.

    The envelope is for what changes along with the weeks: a sample's later horizons have other
    discounts and another stock in weeks of demand."""
    if "_fitted_predictions" not in ws.__dict__:
        _, model = _model(ws)
        sets = {
            "test": ws.splits.where(F.col("split") == "test"),
            "planned": ws.planned_eval,
            "manual": ws.manual_eval,
        }
        parts = [
            so.monotone_envelope(
                so.score_sales(rows, model, inventory_col="inventory_qty"),
                by=SAMPLE_KEY,
                order_by="num_weeks",
                value="predicted_sales",
            ).select(
                F.lit(name).alias("dataset"),
                *SAMPLE_KEY,
                "num_weeks",
                "inventory_qty",
                "target",
                F.col("monotone_predicted_sales").alias("predicted_sales"),
            )
            for name, rows in sets.items()
        ]
        every = parts[0].unionByName(parts[1]).unionByName(parts[2])
        ws.__dict__["_fitted_predictions"] = ws.stage(every, "fitted_predictions")
    return ws.__dict__["_fitted_predictions"]


@query
def score_fitted(ws):
    return _fitted_predictions(ws)


@query
def score_fitted_checks(ws):
    """What must hold of the model's predictions whatever its trees are, per set."""
    units, stock = F.col("predicted_sales"), F.col("inventory_qty")
    shorter = F.lag(units).over(Window.partitionBy("dataset", *SAMPLE_KEY).orderBy("num_weeks"))
    day = F.datediff("date", F.lit(datetime(1992, 1, 1)).cast("date"))
    key = F.col("mds_fam_id") * 100000 + F.col("club_nbr") * 10000 + day + F.col("num_weeks")
    return (
        _fitted_predictions(ws)
        .withColumn("_shorter", shorter)
        .groupBy("dataset")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(key.cast("long")).alias("key_sum"),
            F.sum(F.col("target").cast("decimal(18,2)")).cast("double").alias("target_sum"),
            F.count_if(units.isNull() | F.isnan(units) | (units < 0)).alias("n_negative"),
            F.count_if(units > stock).alias("n_above_stock"),
            F.count_if(units < F.col("_shorter")).alias("n_falling"),
        )
    )


@query
def grid_fitted_checks(ws):
    """The model on the discount grid, as it is: no deeper discount may sell less."""
    _, model = _model(ws)
    grid = so.grid_score(el.discount_grid(ws.manual_eval, horizon=1), model)
    value = F.col("predicted_sale")
    before = F.lag(value).over(Window.partitionBy(*el.SAMPLE).orderBy("discount"))
    return grid.withColumn("_before", before).agg(
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull() | (value < 0)).alias("n_negative"),
        F.count_if(value < F.col("_before")).alias("n_falling"),
        F.count_if(F.col("cap_predicted_sale") > value + 0.005).alias("n_below_own"),
    )


@query
def boost_histogram(ws):
    """Gradient sums and row counts of the first level: what the first split is chosen from."""
    encoded, model = _model(ws)
    trees = model.trees
    train = encoded.where(F.col("split") == "train")
    rows = bo.with_bins(train, trees.covariates, trees.cuts).select(
        F.lit(0).alias("node"), "_bins", bo.gradient(F.lit(trees.base), F.col("target")).alias("_g")
    )
    names = F.array(*map(F.lit, trees.covariates))
    return bo.histogram(rows, range(len(trees.covariates))).select(
        names[F.col("f")].alias("covariate"), "bin", F.col("g").alias("gradient_sum"), F.col("n").alias("n_rows")
    )


@query
def monotone_probes(ws):
    """Predictions of held-out rows, and of rows whose covariates are drawn anew, along each constrained
    covariate alone; nothing is made monotone afterwards."""
    encoded, model = _model(ws)
    held = encoded.where(F.col("split") == "test").select(*sa.COVARIATES)
    spread = {
        c: F.pmod(F.xxhash64(*sa.COVARIATES, F.lit(c)), F.lit(2001)) / F.lit(50.0) - 20.0 for c in sa.COVARIATES
    }
    sets = held.withColumn("dataset", F.lit("test")).unionByName(
        held.select(*[v.alias(c) for c, v in spread.items()], F.lit("random").alias("dataset"))
    )
    probes = ws.stage(sets.withColumn("probe", F.monotonically_increasing_id()), "probes")
    raised = None
    for name in tr.CONSTRAINED:
        levels = [i / 10 for i in range(10)] if name != "num_weeks" else [float(i) for i in range(1, 11)]
        one = probes.select(
            "dataset", "probe", F.lit(name).alias("covariate"), *[c for c in sa.COVARIATES if c != name],
            F.explode(F.array(*map(F.lit, levels))).alias(name),
        ).withColumn("level", F.col(name))
        raised = one if raised is None else raised.unionByName(one)
    scored = model.trees.transform(raised)
    before = F.lag("prediction").over(Window.partitionBy("dataset", "covariate", "probe").orderBy("level"))
    return scored.withColumn("_before", before).groupBy("dataset", "covariate").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("prediction") < F.col("_before")).alias("n_falling"),
    )


@query
def model_checks(ws):
    """Counts and yes/no facts about the fit, the search and the importances."""
    fit, trials, weights = train_model(ws), tune_model(ws), feature_importance(ws)
    train = F.col("split") == "train"
    better = F.max(F.when(train, (F.col("model_mae") < F.col("mean_mae")).cast("long")))
    facts = [
        fit.where(train).select(F.lit("train_rows").alias("fact"), F.col("n_rows").alias("value")),
        fit.where(F.col("split") == "val").select(F.lit("val_rows"), "n_rows"),
        fit.agg(better.alias("v")).select(F.lit("beats_mean_on_train"), "v"),
        trials.agg(F.count("*").alias("v")).select(F.lit("trials"), "v"),
        trials.agg(F.count_if(F.col("val_mae") >= 0).alias("v")).select(F.lit("trials_with_error"), "v"),
        weights.agg(F.count("*").alias("v")).select(F.lit("covariates"), "v"),
        weights.agg(F.rint(F.sum("importance")).cast("long").alias("v")).select(
            F.lit("importance_total"), "v"
        ),
    ]
    result = facts[0]
    for fact in facts[1:]:
        result = result.union(fact)
    return result


@query
def score_sales(ws):
    return ws.manual_predictions()


@query
def cap_by_bucket(ws):
    def bucketed(df):
        weekly = F.least(F.floor(sl.WEEKLY_UNITS), F.lit(9))
        return df.withColumn("bucket", weekly.cast("int"))

    caps = so.bucket_caps(
        bucketed(ws.samples), bucket="bucket", weekly_units=ratio(F.col("target"), F.col("num_weeks"))
    )
    return so.cap_by_bucket(
        bucketed(ws.manual_predictions()), caps, bucket="bucket", weeks="num_weeks"
    )


# --- evaluation -----------------------------------------------------------------------------


@query
def metrics_overall(ws):
    return ev.metrics_overall(ws.manual_predictions())


@query
def metrics_over_under(ws):
    return ev.metrics_over_under(ws.manual_predictions())


@query
def metrics_train_val_test(ws):
    return ev.metrics_train_val_test(ws.predictions(ws.splits))


@query
def metrics_test(ws):
    return ev.metrics_test(ws.predictions(ws.splits.where(F.col("split") == "test")))


@query
def metrics_by_horizon(ws):
    return ev.metrics_by_horizon(ws.manual_predictions())


@query
def weekly_decumulate(ws):
    return ws.weekly_predictions()


@query
def metrics_weekly(ws):
    return ev.metrics_weekly(ws.weekly_predictions())


@query
def error_by_category(ws):
    return sc.category_description(ev.error_by_category(ws.manual_predictions()), ws.descriptions)


@query
def error_by_horizon(ws):
    return ev.error_by_horizon(ws.weekly_predictions())


@query
def error_overall(ws):
    return ev.error_overall(ws.manual_predictions())


def _markdown_weeks(ws: Workspace) -> DataFrame:
    """Panel rows on which a manual markdown started; its number is its month."""
    starts = ws.tables.manual_executions().select(
        "item_nbr", "club_nbr", F.col("md_start_date").alias("date")
    )
    return ws.panel.join(starts, ["item_nbr", "club_nbr", "date"]).select(
        "club_nbr",
        "mds_fam_id",
        (F.year("date") * 100 + F.month("date")).alias("n_md"),
        F.col("unit_price_amt").alias("selling_price"),
        "date",
    )


@query
def first_markdown_week(ws):
    return ev.first_markdown_week(_markdown_weeks(ws))


@query
def first_session_week(ws):
    return ev.first_session_week(_markdown_weeks(ws))


@query
def combine_metrics(ws):
    test = ws.predictions(ws.splits.where(F.col("split") == "test"))
    reports = [
        ev.long_metrics(ev.metrics_over_under(test), prefix="test_"),
        ev.long_metrics(ev.metrics_test(test), prefix="test_"),
        ev.long_metrics(ev.metrics_overall(ws.planned_predictions()), prefix="cumul_eval_"),
        ev.long_metrics(ev.metrics_overall(ws.manual_predictions()), prefix="cumul_eval_"),
    ]
    return ev.combine_metrics(*reports, suffixes=["", "", "_logs", "_manual"])


@query
def error_quantiles(ws):
    return ev.error_quantiles(ws.manual_predictions())


@query
def error_density(ws):
    return ev.error_density(ws.manual_predictions())


@query
def joint_density(ws):
    return ev.joint_density(ws.manual_predictions())


# --- elasticity -----------------------------------------------------------------------------


@query
def discount_grid(ws):
    return el.discount_grid(ws.manual_eval, horizon=1)


@query
def grid_score(ws):
    return _grid(ws)


@query
def sale_lift(ws):
    return el.sale_lift(_grid(ws))


@query
def elasticity_curve(ws):
    return el.elasticity_curve(el.sale_lift(_grid(ws)))


@query
def elasticity_metrics(ws):
    scored = so.grid_score(ws.manual_eval, so.closed_form_scorer)
    return el.elasticity_metrics(scored, horizon=1)


@query
def monotonicity_check(ws):
    return el.monotonicity_check(_grid(ws), keys=el.SAMPLE, value="cap_predicted_sale")


@query
def elasticity_check(ws):
    return el.elasticity_check(_grid(ws, GRID_WITH_DEEP), value="cap_predicted_sale")


@query
def response_curve(ws):
    weekly = F.col("target") / F.col("num_weeks")
    return el.response_curve(
        ws.manual_eval, by=["mds_fam_id"], discount=F.col(sl.DISCOUNTS[0]), units=weekly
    )


def _recovery(ws: Workspace) -> DataFrame:
    median = F.col(sl.MEDIAN_PRICE)
    return el.recovery_rate(
        _grid(ws),
        price=finite(F.col(sl.PRICE_BACK[0])) * (1 - F.col("discount")),
        cost=0.7 * median,
        liquidation=0.3 * median,
        sold="cap_predicted_sale",
    )


@query
def recovery_rate(ws):
    return _recovery(ws)


@query
def best_markdown(ws):
    return el.best_markdown(_recovery(ws))


# --- online channel -------------------------------------------------------------------------


@query
def cart_clicks_week_back(ws):
    return cart.cart_clicks_week_back(ws.tables.cart_event(), as_of=CART_AS_OF)


@query
def cart_members_week_back(ws):
    return cart.cart_members_week_back(ws.tables.cart_event(), as_of=CART_AS_OF)


@query
def cart_members_stored(ws):
    """Four weeks from stored days: all but the last at once, then the last night, run twice."""
    events, path, day = ws.tables.cart_event(), ws.path("member_days"), timedelta(days=1)
    cart.store_member_days(events, path, first=CART_AS_OF - 28 * day, last=CART_AS_OF - 2 * day)
    for _ in range(2):
        cart.store_member_days(events, path, first=CART_AS_OF - day, last=CART_AS_OF - day)
    return cart.cart_members_stored(ws.spark.read.parquet(path), as_of=CART_AS_OF)


@query
def online_units_week_back(ws):
    sales = ws.daily_catalog().withColumnsRenamed(
        {"department_nbr": "category_nbr", "subclass_nbr": "sub_category_nbr"}
    )
    return cart.online_units_week_back(sales)


@query
def cart_ratios(ws):
    return cart.cart_ratios(ws.tables.cart_event())


# --- the same over keys that grow with the data ---------------------------------------------


@query
def first_level_features_fine(ws):
    return ws.first_level()


@query
def second_level_features_fine(ws):
    return ws.second


@query
def eval_manual_fine(ws):
    return ws.manual_eval


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output of one registered query over one driver folder."""
    ws = workspace(spark, sf_dir, fine=name.endswith("_fine"))
    return present(QUERIES[name](ws), COLUMNS[name])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: run(name, spark, sf_dir)

    return {name: bind(name) for name in QUERIES}
