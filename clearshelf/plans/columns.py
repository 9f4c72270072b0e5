"""Output columns of every registered query, shared by the Spark plan and its SQL oracle.

A column is written ``name`` (double) or ``name:kind`` with kind ``i`` int, ``l`` bigint,
``s`` string, ``t`` date, ``b`` boolean. Doubles are rounded half up to six digits and
infinities become null, by the same arithmetic on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clearshelf.functions.numeric import half_up_sql
from clearshelf.operators.second_level import (
    BACK,
    DISCOUNTS,
    MAX_DISCOUNT,
    MIN_PRICE,
    MIN_UNITS,
    NEXT,
    PRICE_BACK,
    PRICE_NEXT,
    UNITS_52,
    UNITS_BACK,
    UNITS_NEXT,
    WEEKLY_UNITS,
    second_level_types,
)
from clearshelf.operators.sampling import COVARIATES, STOCK_WEEKS

DIGITS = 6
SPARK_TYPES = {"i": "int", "l": "bigint", "s": "string", "t": "date", "b": "boolean"}
SQL_TYPES = {"i": "INTEGER", "l": "BIGINT", "s": "VARCHAR", "t": "DATE", "b": "BOOLEAN"}


def split_kind(column: str) -> tuple[str, str]:
    name, _, kind = column.partition(":")
    return name, kind or "d"


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select the output columns of a query in their output types."""
    out = []
    for name, kind in map(split_kind, columns):
        if kind == "d":
            value = half_up_sql(name, DIGITS, infinite="NULL")
        else:
            value = f"cast({name} AS {SPARK_TYPES[kind]})"
        out.append(f"{value} AS {name}")
    return df.selectExpr(*out)


def sql_round(x: str, digits: int) -> str:
    scale = f"1e{digits}"
    limit = f"{9e15 / 10**digits:.1e}"
    return (
        f"CASE WHEN abs({x}::DOUBLE) >= {limit} THEN {x}::DOUBLE "
        f"ELSE floor({x}::DOUBLE * {scale} + 0.5::DOUBLE) / {scale} END"
    )


def sql_present(columns: list[str], source: str) -> str:
    out = []
    for name, kind in map(split_kind, columns):
        if kind == "d":
            no_inf = f"(CASE WHEN isinf({name}::DOUBLE) THEN NULL ELSE {name}::DOUBLE END)"
            out.append(f"{sql_round(no_inf, DIGITS)} AS {name}")
        else:
            out.append(f"{name}::{SQL_TYPES[kind]} AS {name}")
    return f"SELECT {', '.join(out)} FROM {source}"


ROW = ["club_nbr:i", "mds_fam_id:i", "date:t"]
SAMPLE_ROW = ["mds_fam_id:i", "item_nbr:i", "club_nbr:i", "date:t", "num_weeks:i", "target"]
PANEL = [
    *ROW, "department_nbr:i", "subclass_nbr:i", "item_nbr:i", "unit_sold_cnt", "sale_amt",
    "unit_price_amt", "inventory_on_site_qty:i", "inventory_on_order_qty:i", "inventory_qty:i",
]
SHELF = ["item_on_shelf_date_dt:t", "max_snapshot_date:t"]
YOY_SUBCLASS = [
    "avg_unit_sold_subcategory_52_week_back_cnt",
    "change_unit_sold_subcategory_same_week_1_year_back_cnt",
]
YOY_ITEM = ["avg_unit_sold_52_week_back_cnt", "change_unit_sold_same_week_1_year_back_cnt"]
WOW = [f"change_unit_sold_{k}_{k + 1}_week_back_cnt" for k in BACK[:-1]]
HALF_YEAR = [
    f"{stat}_{what}_6_month_last_{suffix}"
    for what, suffix in (("price", "amt"), ("unit", "nbr"))
    for stat in ("max", "min", "median")
]
RATIOS = [
    WEEKLY_UNITS,
    *[f"price_{k}_week_back_median_price_6_month_last_nbr" for k in BACK],
    *[f"inventory_unit_{k}_week_back_pct" for k in BACK],
    "inventory_1_month_last_weekly_sale_nbr",
]
US_WEEK = ["week:i", "year:i", "month:i", "week_ly:i", "year_ly:i", "month_ly:i"]
SAMPLE_RATIOS = [STOCK_WEEKS, "ratio_target", "over_sell_ratio", "under_sell_ratio"]
KINDS = {"int": ":i", "date": ":t", "double": ""}
SECOND = [f"{name}{KINDS[dtype]}" for name, dtype in second_level_types().items()]
INTEGER_COVARIATES = {
    "club_nbr", "department_nbr", "subclass_nbr", "day_on_shelf_cnt", "num_weeks", "month", "week",
}
COVARIATE_ROW = [f"{c}:i" if c in INTEGER_COVARIATES else c for c in COVARIATES]
ENCODED_ROW = ["club_nbr", "department_nbr", "subclass_nbr", "week", "month"]
ACCURACY = ["bias", "mae", "rmse", "mape", "smape", "weighted_mape", "median_ape"]
OVER = [f"overestimation_{w}" for w in ("sample_pct", "total_units", "units_pct", "mean_pct")]
UNDER = [f"underestimation_{w}" for w in ("sample_pct", "total_units", "units_pct", "mean_pct")]
CATEGORY = [
    "n_samples:l", "mae", "rmse", "wmape", "median_ape", "smape", "oep_sample", "oe_value",
    "oep_total", "oep_weighted", "metric_target:s", "eval_set_start_date:t",
]
PREDICTED = [*SAMPLE_ROW, "inventory_qty", "predicted_sales"]
GRID_ROW = ["club_nbr:i", "item_nbr:i", "date:t", "num_weeks:i", "discount"]
CART_CELLS = [
    (channel, fulfilment, k)
    for channel in ("app", "web")
    for fulfilment in ("delivery", "pickup", "shipping")
    for k in BACK
]
DISAGG = [
    "parent_item_nbr:i", "child_item_nbr:i", "club_nbr:i", "num_child:l", "inventory_qty:l",
    "inventory:l", "inv_weights", "sales_weights", "weights", "inv_cap",
]
DQ = [
    "column_name:s", "expectation_type:s", "success:b", "element_count:l", "unexpected_count:l",
    "unexpected_percent", "observed_type:s",
]

ERRORS = ["n_samples:l", "rmse", "wmape", "smape", "oep_sample", "oe_value", "oep_total"]
RESULT_RUN = ["metric_target:s", "eval_set_start_date:t"]

COLUMNS: dict[str, list[str]] = {
    "scan_sales": [
        "club_nbr:i", "store_nbr:l", "scan_id:l", "visit_date:t", "unit_qty", "retail_price",
    ],
    "item_dim": ["mds_fam_id:i", "item_nbr:i", "dept_nbr:i", "subclass_nbr:i"],
    "item_dim_current": ["mds_fam_id:i", "item_nbr:i", "dept_nbr:i", "subclass_nbr:i"],
    "inventory_enriched": [
        "mds_fam_id:i", "club_nbr:i", "snapshot_date:t", "onsite_onhand_qty:i", "on_order_qty:i",
        "item_on_shelf_date:t", "item_nbr:i", "dept_nbr:i", "subclass_nbr:i",
    ],
    "manual_markdowns": [
        "item_nbr:i", "club_nbr:i", "markdown_start_date_dt:t", "markdown_end_date_dt:t",
        "markdown_price_amt",
    ],
    "plan_logs": [
        "item_nbr:i", "club_nbr:i", "liquidation_price", "expected_sale_units",
        "current_retail_price", "current_inventory", "recommended_markdown_price", "oos_date:t",
        "markdown_start_date_dt:t", "date:t", "plan_id:i",
    ],
    "child_inventory": ["item_nbr:i", "club_nbr:i", "snapshot_date:t", "inventory_qty:i"],
    "child_sales_1w": ["item_nbr:i", "club_nbr:i", "unit_qty_1w"],
    "parent_child_map": [
        "parent_item_nbr:i", "child_item_nbr:i", "club_nbr:i", "date:t", "unit_sold_cnt",
    ],
    "disagg_input": [
        "parent_item_nbr:i", "child_item_nbr:i", "club_nbr:i", "inventory_qty:l", "unit_qty_1w",
    ],
    "read_table": [*ROW, "unit_sold_cnt"],
    "write_table": [*ROW, "unit_sold_cnt"],
    "extract_parquet": ["dataset:s", *SAMPLE_ROW],
    "append_results": [
        "subclass_nbr:i", "mds_fam_id:i", "date:t", "dept_nbr:i", "item_nbr:i", "club_nbr:i",
        "unit_price_amt", "markdown_start_date_dt:t", "oos_date:t", "num_weeks", "target",
        "predicted_sales", "run_date:s",
    ],
    "append_category_results": [
        *ERRORS, "dept_nbr:i", *RESULT_RUN, "description:s", "run_date:s",
    ],
    "append_horizon_results": [
        "n_samples:l", "wmape", "wmape_weekly", "num_weeks:i", "metric_target:s", "weekly_bias",
        "eval_set_start_date:t", "run_date:s",
    ],
    "append_overall_results": [*ERRORS, *RESULT_RUN, "run_date:s"],
    "dataset_profile": ["dataset:s", "min_date:t", "max_date:t", "n_rows:l"],
    "fill_sentinel": [*SAMPLE_ROW, "department_nbr:i"],
    "category_description": ["dept_nbr:i", "n_samples:l", "description:s"],
    "inventory_effective": [
        "mds_fam_id:i", "club_nbr:i", "snapshot_date:t", "dept_nbr:i", "inventory_qty:i",
    ],
    "shelf_sessions": [
        "mds_fam_id:i", "club_nbr:i", "item_on_shelf_date_dt:t", "max_snapshot_date:t",
    ],
    "daily_sales": [*ROW, "unit_sold_cnt", "sale_amt", "unit_price_amt"],
    "daily_sales_catalog": [
        *ROW, "department_nbr:i", "subclass_nbr:i", "item_nbr:i", "unit_sold_cnt", "sale_amt",
        "unit_price_amt",
    ],
    "daily_sales_inventory": PANEL,
    "shelf_interval_join": [*PANEL, *SHELF],
    "active_pair_scaffold": [*PANEL, *SHELF],
    "days_on_shelf": [*ROW, "on_shelf_date:s", "day_on_shelf_cnt:i"],
    "units_week_back": [*ROW, *UNITS_BACK],
    "units_week_next": [*ROW, *UNITS_NEXT],
    "price_week_back": [*ROW, *PRICE_BACK],
    "price_week_next": [*ROW, *PRICE_NEXT],
    "units_52_week_back": [*ROW, UNITS_52],
    "first_level_features": [
        *PANEL, *SHELF, "on_shelf_date:s", "day_on_shelf_cnt:i", *UNITS_BACK, *UNITS_NEXT,
        *PRICE_BACK, *PRICE_NEXT, UNITS_52,
    ],
    "audit_columns": [*ROW, "event_date:t", "event_epoch:l", "created_epoch:l"],
    "weekly_discount": [*ROW, *DISCOUNTS],
    "calendar_iso": [*ROW, "year:i", "week:i", "week_day:i"],
    "half_year_stats": [*ROW, *HALF_YEAR],
    "row_extremes": [*ROW, MIN_UNITS, MAX_DISCOUNT, MIN_PRICE],
    "impute_features": [*ROW, *UNITS_BACK, *PRICE_BACK, *UNITS_NEXT, UNITS_52],
    "price_units_ratio": [*ROW, *RATIOS],
    "calendar_us_week": [*ROW, *US_WEEK],
    "yoy_subclass_club": [*ROW, *YOY_SUBCLASS],
    "avg_dept_club_52w": [*ROW, "avg_unit_sold_dept_club_52_week_back_cnt"],
    "avg_dept_52w": [*ROW, "avg_unit_sold_dept_52_week_back_cnt"],
    "yoy_item": [*ROW, *YOY_ITEM],
    "units_wow_change": [*ROW, *WOW],
    "subclass_month_share": [*ROW, "subclass_unit_sold_same_week_1_year_back_nbr"],
    "conform_schema": [*ROW, "unit_price_amt", *PRICE_BACK, *RATIOS],
    "second_level_features": SECOND,
    "latest_features": [*ROW, "item_nbr:i", WEEKLY_UNITS, "inventory_qty"],
    "latest_materialized": [*ROW, "item_nbr:i", WEEKLY_UNITS, "inventory_qty"],
    "point_in_time": [
        "item_nbr:i", "club_nbr:i", "markdown_start_date_dt:t", "feature_date:t", "inventory_qty",
        WEEKLY_UNITS, "median_price_6_month_last_amt",
    ],
    "discount_fill_filter": [*ROW, *DISCOUNTS],
    "any_future_sales": [*ROW, *UNITS_NEXT],
    "discount_weight": [*ROW, "weights"],
    "top1_item_club_month": [*ROW, "year:i", "month:i", "weights"],
    "initial_filter": [*ROW, "week:i", "year:i", "month:i", "weights", *DISCOUNTS, *UNITS_NEXT],
    "expand_horizons": [*SAMPLE_ROW, *DISCOUNTS],
    "sample_ratios": [*SAMPLE_ROW, *SAMPLE_RATIOS],
    "sample_filters": [*SAMPLE_ROW, "inventory_qty"],
    "horizon_matured": SAMPLE_ROW,
    "first_week_of_target": SAMPLE_ROW,
    "train_val_test": ["split:s", *SAMPLE_ROW, *SAMPLE_RATIOS, *DISCOUNTS],
    "select_covariates": [
        *COVARIATE_ROW, "target", "inventory_qty", "item_nbr:i", "mds_fam_id:i", "date:t",
    ],
    "eval_planned": [
        *SAMPLE_ROW, "week_target", "markdown_start_date_dt:t", "oos_date:t", "max_oos_date:t",
        PRICE_BACK[0], *DISCOUNTS, *SAMPLE_RATIOS,
    ],
    "eval_planned_complete": [
        *SAMPLE_ROW, "week_target", "markdown_start_date_dt:t", "oos_date:t",
    ],
    "eval_manual": [
        *SAMPLE_ROW, "markdown_start_date_dt:t", "markdown_end_date_dt:t", "oos_date:t",
        *DISCOUNTS, *SAMPLE_RATIOS,
    ],
    "period_split": ["frequency:s", "split:s", *ROW],
    "category_universe": ["mds_fam_id:i", "item_nbr:i", "dept_nbr:i", "subclass_nbr:i"],
    "disagg_raw_weights": DISAGG,
    "disagg_scenarios": ["parent_item_nbr:i", "club_nbr:i", "inv_min", "inv_max", "scenario:i"],
    "disagg_flags": [*DISAGG, "inv_min", "inv_max", "scenario:i", "scenario_flag:i"],
    "disagg_final": [
        *DISAGG, "inv_min", "inv_max", "scenario:i", "scenario_flag:i", "total_scenario_weights",
        "final_weights",
    ],
    "disagg_lookup": ["parent_item_nbr:i", "club_nbr:i", "quantity:l", "child_item_nbr:i", "units:l"],
    "dq_not_null": DQ,
    "dq_type": DQ,
    "dq_report": ["utc_time:s", *DQ],
    "dq_log": ["utc_time:s", *DQ],
    "cast_columns": [
        "dept_text:s", "start_date:t", "price",
    ],
    "target_encode": ["split:s", "mds_fam_id:i", "date:t", "num_weeks:i", "target", *ENCODED_ROW],
    "train_model": ["split:s", "n_rows:l", "model_mae", "mean_mae"],
    "tune_model": [
        "trial:i", "learning_rate", "max_depth:i", "row_share", "column_share", "l2", "val_mae",
        "n_trees:i", "stopped_at:i",
    ],
    "boost_histogram": ["covariate:s", "bin:i", "gradient_sum:l", "n_rows:l"],
    "monotone_probes": ["dataset:s", "covariate:s", "n_rows:l", "n_falling:l"],
    "monotone_envelope": [*GRID_ROW, "predicted_sale", "monotone_predicted_sale"],
    "feature_importance": ["covariate:s", "importance"],
    "score_fitted": ["dataset:s", *SAMPLE_ROW, "inventory_qty", "predicted_sales"],
    "score_fitted_checks": [
        "dataset:s", "n_rows:l", "key_sum:l", "target_sum", "n_negative:l", "n_above_stock:l",
        "n_falling:l",
    ],
    "grid_fitted_checks": ["n_rows:l", "n_negative:l", "n_falling:l", "n_below_own:l"],
    "model_checks": ["fact:s", "value:l"],
    "score_sales": PREDICTED,
    "cap_by_bucket": [*SAMPLE_ROW, "bucket:i", "quantile80", "predicted_sales"],
    "metrics_overall": ["n_samples:l", "n_zero_actuals:l", *ACCURACY],
    "metrics_over_under": [*OVER, *UNDER],
    "metrics_train_val_test": ["split:s", "n_samples:l", *ACCURACY[1:], *OVER],
    "metrics_test": ["n_samples:l", *ACCURACY[1:], *OVER],
    "metrics_by_horizon": [f"cumul_eval_wmape_nw_{k}" for k in NEXT],
    "weekly_decumulate": [*SAMPLE_ROW, "predicted_sales", "target_weekly", "predicted_sales_weekly"],
    "metrics_weekly": [
        *ACCURACY, *OVER, *UNDER,
        *[f"weekly_eval_wmape_nw_{k}" for k in NEXT],
        *[f"weekly_eval_bias_nw_{k}" for k in NEXT],
        *[f"weekly_eval_sample_count_nw_{k}:l" for k in NEXT],
    ],
    "error_by_category": ["dept_nbr:i", "description:s", *CATEGORY],
    "error_by_horizon": [
        "num_weeks:i", "n_samples:l", "wmape", "wmape_weekly", "weekly_bias", "metric_target:s",
        "eval_set_start_date:t",
    ],
    "error_overall": CATEGORY,
    "first_markdown_week": ["club_nbr:i", "mds_fam_id:i", "n_md:i", "date:t", "selling_price"],
    "first_session_week": ["club_nbr:i", "mds_fam_id:i", "n_md:i", "selling_price", "date:t"],
    "combine_metrics": ["metric:s", "value"],
    "error_quantiles": ["kind:s", "category:i", "x", "y"],
    "error_density": ["x", "density"],
    "joint_density": ["actual", "predicted", "n_rows"],
    "response_curve": [
        "mds_fam_id:i", "discount_step:i", "n_samples:l", "mean_units", "envelope_units", "isotonic_units",
    ],
    "discount_grid": [*GRID_ROW, "inventory_qty", *DISCOUNTS],
    "grid_score": [*GRID_ROW, "predicted_sale", "cap_predicted_sale"],
    "sale_lift": [*GRID_ROW, "predicted_sale", "sale_lift", "max_sale_lift"],
    "elasticity_curve": ["discount", "q1", "median", "q3"],
    "elasticity_metrics": ["n_samples:l", "wmape", "smape", "bias"],
    "monotonicity_check": [
        "n_entities:l", "n_monotonic:l", "n_non_decreasing:l", "statement:s",
    ],
    "elasticity_check": ["n_entities:l", "n_inelastic:l", "inelastic_share"],
    "recovery_rate": [*GRID_ROW, "recovery_rate", "sell_through_rate"],
    "best_markdown": [*GRID_ROW, "recovery_rate", "sell_through_rate"],
    "cart_clicks_week_back": [
        "item_nbr:i", *[f"{c}_{f}_add2cart_click_{k}_week_back_cnt:l" for c, f, k in CART_CELLS],
    ],
    "cart_members_week_back": [
        "item_nbr:i", *[f"{c}_{f}_add2cart_member_{k}_week_back_cnt:l" for c, f, k in CART_CELLS],
    ],
    "online_units_week_back": [
        "mds_fam_id:i", "category_nbr:i", "sub_category_nbr:i", "date:t",
        *[f"units_sold_{k}_week_back_cnt" for k in BACK],
    ],
    "cart_ratios": ["item_nbr:i", "app_clicks:l", "web_clicks:l", "app_share"],
}
COLUMNS["cart_members_stored"] = COLUMNS["cart_members_week_back"]
for _name in ("first_level_features", "second_level_features", "eval_manual"):
    COLUMNS[f"{_name}_fine"] = COLUMNS[_name]
