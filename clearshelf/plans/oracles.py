"""SQL text of every query that SQL can express, for checking the Spark plans.

Each oracle is self-contained: it rebuilds the derived tables from the driver tables as common
table expressions and follows the definitions literally (outer joins, self joins, unordered
windows), not the shape of the Spark plans.
"""

from __future__ import annotations

import re
from datetime import date

from clearshelf.operators.sampling import COVARIATES, STOCK_WEEKS
from clearshelf.operators.second_level import (
    BACK,
    DISCOUNTS,
    MAX_DISCOUNT,
    MEDIAN_PRICE,
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
from clearshelf.plans.columns import COLUMNS, CART_CELLS, sql_present, sql_round
from clearshelf.sources.retail import CART_AS_OF, PARAMS

D = PARAMS.dates


def _d(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def _in(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


def r2(x: str) -> str:
    return sql_round(x, 2)


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


START, END = _d(D.history_start), _d(PARAMS.run_date)
TODAY, TEST_END = _d(D.today), _d(D.test[1])
ENTITY = "mds_fam_id, club_nbr, department_nbr, subclass_nbr, item_nbr"
BY_ENTITY = "PARTITION BY club_nbr, mds_fam_id ORDER BY day_number"
BRAND = "replace(p_brand, 'Brand#', '')::INTEGER"

CTE: dict[str, str] = {}

# --- derived tables -------------------------------------------------------------------------

CTE["item_master"] = f"""
SELECT p_partkey AS scan_id, {BRAND} AS mds_fam_id, 1000 + {BRAND} AS item_nbr,
       {BRAND} % 5 AS dept_nbr, {BRAND} % 10 AS subclass_nbr,
       CASE WHEN p_type = 'ECONOMY' THEN 'N' ELSE 'Y' END AS current_ind, 'US' AS country_code,
       CASE WHEN p_size > 45 THEN 17 ELSE 18 END AS base_div_nbr,
       (1000 + {BRAND}) * 1000 + p_size + 100 * list_position(
         ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p_type) AS child_nbr
FROM part"""
CTE["store_info"] = """
SELECT s_suppkey AS store_nbr, n_regionkey AS club_nbr,
       CASE WHEN s_suppkey % 20 = 0 THEN 'W' ELSE 'S' END AS store_type
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
CTE["visit"] = """
SELECT o_orderkey AS visit_nbr, CASE WHEN o_orderstatus = 'P' THEN 198 ELSE 1 END AS visit_subtype_code
FROM orders"""
CTE["scan"] = """
SELECT l_orderkey AS visit_nbr, l_suppkey AS store_nbr, l_partkey AS scan_id,
       l_shipdate::DATE AS visit_date, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS scan_type,
       l_quantity::DECIMAL(12,2) AS unit_qty,
       (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,4) AS retail_price,
       l_linenumber AS line_nbr
FROM lineitem"""
CTE["scan_by_club"] = """
SELECT s.*, i.mds_fam_id, i.item_nbr, i.child_nbr, si.club_nbr
FROM scan s JOIN item_master i USING (scan_id) JOIN store_info si USING (store_nbr)"""
_INVENTORY = """
SELECT {item} AS mds_fam_id, club_nbr, visit_date AS snapshot_date,
       (sum(unit_qty) * 12)::INTEGER AS onsite_onhand_qty, (count(*) * 5)::INTEGER AS on_order_qty,
       date_trunc('month', visit_date)::DATE AS item_on_shelf_date,
       CASE WHEN min(line_nbr) >= 7 THEN 'D' ELSE 'A' END AS status
FROM scan_by_club GROUP BY ALL"""
CTE["inventory_daily"] = _INVENTORY.format(item="mds_fam_id")
CTE["child_inventory_daily"] = _INVENTORY.format(item="child_nbr")
CTE["plan_details"] = """
SELECT item_nbr, club_nbr, visit_date AS created_date, visit_date AS markdown_start_date,
       visit_date + (28 + (mds_fam_id % 5) * 7) AS oos_date,
       max(retail_price::DOUBLE / unit_qty::DOUBLE) AS current_retail_price,
       max(retail_price::DOUBLE / unit_qty::DOUBLE) * 0.25::DOUBLE AS liquidation_price,
       max(retail_price::DOUBLE / unit_qty::DOUBLE) * 0.75::DOUBLE AS recommended_markdown_price,
       sum(unit_qty)::DOUBLE AS expected_sale_units, sum(unit_qty)::DOUBLE * 12 AS current_inventory,
       mds_fam_id * 10 + club_nbr AS plan_id,
       10 + (mds_fam_id + club_nbr) % 3 AS plan_status_code,
       CASE WHEN scan_type = 1 THEN 'Data science' ELSE 'Manual' END AS markdown_reason_code
FROM scan_by_club GROUP BY mds_fam_id, item_nbr, club_nbr, visit_date, scan_type"""
CTE["manual_executions"] = """
SELECT item_nbr, club_nbr, visit_date AS md_start_date, visit_date + 35 AS md_end_date,
       sum(retail_price)::DOUBLE * 0.5::DOUBLE AS sp,
       CASE WHEN mds_fam_id % 3 = 0 THEN 'DS-1' ELSE 'EOL-1' END AS retail_reason_code
FROM scan_by_club GROUP BY mds_fam_id, item_nbr, club_nbr, visit_date"""
CTE["cart_event"] = """
SELECT event_id, user_id AS member_id, ts::DATE AS date,
       CASE WHEN event_id % 2 = 0 THEN 'app' ELSE 'web' END AS channel,
       CASE event_id % 3 WHEN 0 THEN 'delivery' WHEN 1 THEN 'pickup' ELSE 'shipping' END AS fulfilment,
       1001 + json_extract_string(props, '$.k')::INTEGER % 25 AS item_nbr
FROM events WHERE event_type = 'click'"""

# --- scans ----------------------------------------------------------------------------------

CTE["scan_sales"] = f"""
SELECT si.club_nbr, s.store_nbr, s.scan_id, s.visit_date, s.unit_qty, s.retail_price
FROM scan s, store_info si, visit v
WHERE s.store_nbr = si.store_nbr AND s.visit_nbr = v.visit_nbr AND v.visit_subtype_code != 198
  AND s.scan_type = 0 AND s.visit_date >= {START} AND s.visit_date <= {END}
  AND si.store_type NOT IN ('G', 'W')"""
CTE["item_dim"] = f"""
SELECT DISTINCT mds_fam_id, item_nbr, dept_nbr, subclass_nbr FROM item_master
WHERE dept_nbr IN {_in(PARAMS.departments)}"""
CTE["item_dim_current"] = """
SELECT DISTINCT mds_fam_id, item_nbr, dept_nbr, subclass_nbr FROM item_master
WHERE current_ind = 'Y' AND country_code = 'US' AND base_div_nbr = 18 AND subclass_nbr NOT IN (9)"""
CTE["inventory_enriched"] = f"""
SELECT i.mds_fam_id, club_nbr, snapshot_date, onsite_onhand_qty, on_order_qty, item_on_shelf_date,
       item_nbr, dept_nbr, subclass_nbr
FROM inventory_daily i JOIN item_dim USING (mds_fam_id)
WHERE snapshot_date BETWEEN {START} AND {END} AND status NOT IN {_in(PARAMS.excluded_status)}"""
_EFFECTIVE = f"""CASE WHEN dept_nbr IN (2) THEN onsite_onhand_qty + on_order_qty
       ELSE onsite_onhand_qty END::INTEGER"""
CTE["inventory_effective"] = f"SELECT *, {_EFFECTIVE} AS inventory_qty FROM inventory_enriched"
CTE["manual_markdowns"] = f"""
SELECT item_nbr, club_nbr, md_start_date AS markdown_start_date_dt,
       md_end_date AS markdown_end_date_dt, sp AS markdown_price_amt
FROM manual_executions
WHERE club_nbr NOT IN (4) AND md_start_date >= {_d(D.max_eval_start)}
  AND retail_reason_code NOT LIKE '%DS%' AND retail_reason_code LIKE '%EOL%'"""
CTE["plan_logs"] = f"""
SELECT DISTINCT item_nbr, club_nbr, liquidation_price, expected_sale_units, current_retail_price,
       current_inventory, recommended_markdown_price, oos_date,
       markdown_start_date AS markdown_start_date_dt, created_date AS date, plan_id
FROM plan_details
WHERE plan_status_code IN (10, 11) AND created_date >= {_d(D.max_eval_start)}
  AND markdown_reason_code LIKE '%Data%'"""

# --- first level ----------------------------------------------------------------------------

CTE["daily_sales"] = f"""
SELECT club_nbr, mds_fam_id, visit_date AS date, sum(unit_qty)::DECIMAL(18,2) AS unit_sold_cnt,
       sum(retail_price)::DECIMAL(18,2) AS sale_amt,
       ({r2("(sum(retail_price)::DOUBLE / sum(unit_qty)::DOUBLE)")})::DECIMAL(18,2) AS unit_price_amt
FROM scan_sales JOIN item_master USING (scan_id) WHERE unit_qty > 0 GROUP BY ALL"""
CTE["daily_sales_catalog"] = """
SELECT s.*, item_nbr, dept_nbr AS department_nbr, subclass_nbr
FROM daily_sales s JOIN item_dim USING (mds_fam_id)"""
CTE["daily_sales_inventory"] = """
SELECT s.*, onsite_onhand_qty AS inventory_on_site_qty, on_order_qty AS inventory_on_order_qty,
       coalesce(inventory_qty, 0) AS inventory_qty
FROM daily_sales_catalog s
LEFT JOIN inventory_effective i
  ON i.mds_fam_id = s.mds_fam_id AND i.club_nbr = s.club_nbr AND i.snapshot_date = s.date"""
CTE["shelf_sessions"] = """
SELECT mds_fam_id, club_nbr, item_on_shelf_date AS item_on_shelf_date_dt,
       max(snapshot_date) AS max_snapshot_date
FROM inventory_effective GROUP BY ALL"""
CTE["shelf_interval_join"] = """
SELECT d.*, item_on_shelf_date_dt, max_snapshot_date
FROM daily_sales_inventory d
LEFT JOIN shelf_sessions s
  ON s.mds_fam_id = d.mds_fam_id AND s.club_nbr = d.club_nbr
 AND d.date >= s.item_on_shelf_date_dt AND d.date <= s.max_snapshot_date"""
CTE["active_pairs"] = f"""
SELECT DISTINCT {ENTITY}, {TODAY} AS date FROM shelf_interval_join
WHERE date >= {_d(D.active_start)}"""
CTE["active_pair_scaffold"] = f"""
SELECT * REPLACE (coalesce(unit_sold_cnt, 0)::DECIMAL(18,2) AS unit_sold_cnt)
FROM shelf_interval_join FULL OUTER JOIN active_pairs USING (date, {ENTITY})"""
CTE["days_on_shelf"] = """
SELECT * REPLACE (unit_price_amt::DOUBLE AS unit_price_amt),
       strftime(item_on_shelf_date_dt, '%Y-%m-%d') AS on_shelf_date,
       date - item_on_shelf_date_dt AS day_on_shelf_cnt,
       date_diff('day', DATE '1970-01-01', date) AS day_number,
       unit_price_amt AS price_dec
FROM active_pair_scaffold"""


def _frame(first: int, last: int) -> str:
    def bound(n: int) -> str:
        return f"{-n} PRECEDING" if n < 0 else f"{n} FOLLOWING" if n else "CURRENT ROW"

    return f"({BY_ENTITY} RANGE BETWEEN {bound(first)} AND {bound(last)})"


def _units(first: int, last: int, name: str) -> str:
    return f"sum(unit_sold_cnt) OVER {_frame(first, last)}::DOUBLE AS {name}"


def _price(first: int, last: int, name: str) -> str:
    w = _frame(first, last)
    return (
        f"sum(price_dec) OVER {w}::DOUBLE / nullif(count(price_dec) OVER {w}, 0)::DOUBLE AS {name}"
    )


_WINDOWS = {
    "units_week_back": [_units(-7 * k, -7 * k + 6, UNITS_BACK[k - 1]) for k in BACK],
    "units_week_next": [_units(1, 7 * k, UNITS_NEXT[k - 1]) for k in NEXT],
    "price_week_back": [_price(-7 * k, -7 * k + 6, PRICE_BACK[k - 1]) for k in BACK],
    "price_week_next": [_price(7 * k - 7, 7 * k - 1, PRICE_NEXT[k - 1]) for k in NEXT],
    "units_52_week_back": [_units(-364, -358, UNITS_52)],
}
for _name, _columns in _WINDOWS.items():
    CTE[_name] = f"SELECT *, {', '.join(_columns)} FROM days_on_shelf"
CTE["first_level_features"] = (
    f"SELECT *, {', '.join(c for group in _WINDOWS.values() for c in group)} FROM days_on_shelf"
)
_HALF = _frame(-167, 0)
CTE["half_year_stats"] = "SELECT *, " + ", ".join(
    f"{fn} OVER {_HALF}::DOUBLE AS {stat}_{what}_6_month_last_{suffix}"
    for what, col, suffix in (("price", "price_dec", "amt"), ("unit", "unit_sold_cnt", "nbr"))
    for stat, fn in (
        ("max", f"max({col})"), ("min", f"min({col})"), ("median", f"quantile_disc({col}, 0.5)"),
    )
) + " FROM first_level_features"

# --- second level ---------------------------------------------------------------------------

CTE["audit_columns"] = """
SELECT *, date AS event_date, epoch(date::TIMESTAMP)::BIGINT AS event_epoch,
       epoch(TIMESTAMP '2001-11-05 07:00:00')::BIGINT AS created_epoch
FROM half_year_stats"""
CTE["weekly_discount"] = "SELECT *, " + ", ".join(
    f"1 - {div(p, PRICE_BACK[0])} AS {d}" for d, p in zip(DISCOUNTS, PRICE_NEXT, strict=True)
) + " FROM half_year_stats"
CTE["calendar_iso"] = """
SELECT *, year(date) AS year, weekofyear(date) AS week, isodow(date) AS week_day
FROM half_year_stats"""


def _known(cols, missing: str) -> str:
    return ", ".join(f"coalesce({c}::DOUBLE, '{missing}'::DOUBLE)" for c in cols)


CTE["row_extremes"] = f"""
SELECT *, least({_known(UNITS_BACK, "inf")}) AS {MIN_UNITS},
       greatest({_known(DISCOUNTS, "-inf")}) AS {MAX_DISCOUNT},
       least({_known(PRICE_BACK, "inf")}) AS {MIN_PRICE}
FROM weekly_discount"""
CTE["impute_features"] = "SELECT * REPLACE (" + ", ".join(
    [f"coalesce({c}, 0) AS {c}" for c in [*UNITS_BACK, *UNITS_NEXT, UNITS_52]]
    + [f"coalesce({c}, {MIN_PRICE}) AS {c}" for c in PRICE_BACK]
) + ") FROM row_extremes"
CTE["weekly_mean"] = f"""
SELECT *, greatest(({' + '.join(UNITS_BACK)}) / 4::DOUBLE, 0.1::DOUBLE) AS {WEEKLY_UNITS}
FROM impute_features"""
CTE["price_units_ratio"] = "SELECT *, " + ", ".join(
    [
        f"{div(PRICE_BACK[k - 1], MEDIAN_PRICE)} AS price_{k}_week_back_median_price_6_month_last_nbr"
        for k in BACK
    ]
    + [
        f"{div('inventory_qty', f'greatest({UNITS_BACK[k - 1]}, 0.025::DOUBLE)')} "
        f"AS inventory_unit_{k}_week_back_pct"
        for k in BACK
    ]
    + [f"{div('inventory_qty', WEEKLY_UNITS)} AS inventory_1_month_last_weekly_sale_nbr"]
) + " FROM weekly_mean"
_SAT = "({d} + (6 - dayofweek({d}))::INTEGER)"


def _us_week(d: str, week: str, year: str) -> str:
    sat = _SAT.format(d=d)
    return f"(dayofyear({sat}) - 1) // 7 + 1 AS {week}, year({sat}) AS {year}"


CTE["calendar_us_week"] = f"""
SELECT *, {_us_week("date", "week", "year")}, month(date) AS month,
       {_us_week("(date - 365)", "week_ly", "year_ly")}, month(date - 365) AS month_ly
FROM price_units_ratio"""


def _yoy(prefix: str, keys: list[str], this: str, change: str) -> None:
    k = ", ".join(keys)
    mean = f"sum({UNITS_52}::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE"
    CTE[f"{prefix}_ly"] = f"""
SELECT {k}, week, year, year_ly * 100 + week_ly AS ly, {mean} AS m
FROM calendar_us_week GROUP BY ALL"""
    CTE[f"{prefix}_week"] = f"""
SELECT {k}, week, year, min(ly) AS ly, sum(m) / count(*) AS m FROM {prefix}_ly
GROUP BY {k}, week, year"""
    CTE[f"{prefix}_later"] = f"""
SELECT {k}, ly, sum(m) / count(*) AS m FROM {prefix}_week GROUP BY {k}, ly"""
    same = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    CTE[f"{prefix}_change"] = f"""
SELECT {", ".join(f"a.{c}" for c in keys)}, a.week, a.year, a.m AS {this},
       a.m / nullif(b.m, 0) - 1 AS {change}
FROM {prefix}_week a LEFT JOIN {prefix}_later b
  ON {same} AND a.year * 100 + a.week = b.ly"""


_yoy(
    "subclass_club", ["subclass_nbr", "club_nbr"], "avg_unit_sold_subcategory_52_week_back_cnt",
    "change_unit_sold_subcategory_same_week_1_year_back_cnt",
)
_yoy(
    "item", ["mds_fam_id"], "avg_unit_sold_52_week_back_cnt",
    "change_unit_sold_same_week_1_year_back_cnt",
)
CTE["yoy_subclass_club"] = """
SELECT * FROM calendar_us_week
LEFT JOIN subclass_club_change USING (subclass_nbr, club_nbr, week, year)"""
_MEAN_52 = f"(sum({UNITS_52}::DECIMAL(18,2)) OVER w)::DOUBLE / (count(*) OVER w)::DOUBLE"
CTE["avg_dept_club_52w"] = f"""
SELECT *, {_MEAN_52} AS avg_unit_sold_dept_club_52_week_back_cnt
FROM yoy_subclass_club WINDOW w AS (PARTITION BY department_nbr, club_nbr, week, year)"""
CTE["avg_dept_52w"] = f"""
SELECT *, {_MEAN_52} AS avg_unit_sold_dept_52_week_back_cnt
FROM avg_dept_club_52w WINDOW w AS (PARTITION BY department_nbr, week, year)"""
CTE["yoy_item"] = """
SELECT * FROM avg_dept_52w LEFT JOIN item_change USING (mds_fam_id, week, year)"""
CTE["units_wow_change"] = "SELECT *, " + ", ".join(
    f"{div(f'{UNITS_BACK[k - 1]} - {UNITS_BACK[k]}', UNITS_BACK[k - 1])} "
    f"AS change_unit_sold_{k}_{k + 1}_week_back_cnt"
    for k in BACK[:-1]
) + " FROM yoy_item"
CTE["subclass_month"] = f"""
SELECT subclass_nbr, year, month, sum({UNITS_52}::DECIMAL(18,2)) AS units
FROM calendar_us_week GROUP BY ALL"""
CTE["month_total"] = "SELECT year, month, sum(units) AS total FROM subclass_month GROUP BY ALL"
CTE["subclass_month_share"] = f"""
SELECT u.*, {div("s.units", "t.total")} AS subclass_unit_sold_same_week_1_year_back_nbr
FROM units_wow_change u
LEFT JOIN subclass_month s USING (subclass_nbr, year, month)
LEFT JOIN month_total t USING (year, month)"""
CTE["second_level_features"] = "SELECT " + ", ".join(
    f"{r2(c)} AS {c}" if kind == "double" else c for c, kind in second_level_types().items()
) + " FROM subclass_month_share"
CTE["conform_schema"] = "SELECT * FROM second_level_features"
CTE["latest_features"] = f"""
SELECT * FROM second_level_features WHERE date BETWEEN {END} - 2 AND {END}
QUALIFY row_number() OVER (
  PARTITION BY mds_fam_id, club_nbr ORDER BY date DESC, item_on_shelf_date_dt DESC NULLS LAST) = 1"""

CTE["latest_materialized"] = f"""
SELECT * FROM second_level_features WHERE date BETWEEN {END} - 4 AND {END}
QUALIFY row_number() OVER (
  PARTITION BY mds_fam_id, club_nbr ORDER BY date DESC, item_on_shelf_date_dt DESC NULLS LAST) = 1"""
CTE["asked_starts"] = """
SELECT row_number() OVER () AS asked, item_nbr, club_nbr, markdown_start_date_dt FROM manual_markdowns"""
CTE["point_in_time"] = """
SELECT m.item_nbr, m.club_nbr, m.markdown_start_date_dt, f.date AS feature_date, f.inventory_qty,
       f.avg_weekly_unit_sold_1_month_back_cnt, f.median_price_6_month_last_amt
FROM asked_starts m LEFT JOIN second_level_features f
  ON f.item_nbr = m.item_nbr AND f.club_nbr = m.club_nbr
  AND f.date BETWEEN m.markdown_start_date_dt - 14 AND m.markdown_start_date_dt
QUALIFY row_number() OVER (PARTITION BY m.asked
  ORDER BY f.date DESC NULLS LAST, f.item_on_shelf_date_dt DESC NULLS LAST, f.mds_fam_id DESC) = 1"""

# --- samples --------------------------------------------------------------------------------

CTE["second"] = f"""
SELECT *, {_us_week("date", "week", "year")}, month(date) AS month FROM second_level_features"""
CTE["discount_fill_filter"] = f"""
SELECT * FROM (
  SELECT * REPLACE ({", ".join(f"coalesce({d}, {MAX_DISCOUNT}) AS {d}" for d in DISCOUNTS)})
  FROM second)
WHERE {" AND ".join(f"{d} >= 0" for d in DISCOUNTS)}"""
_ANY = "NOT (" + " AND ".join(f"{u} = 0" for u in UNITS_NEXT) + ")"
CTE["any_future_sales"] = f"SELECT * FROM second WHERE {_ANY}"
CTE["discount_weight"] = f"""
SELECT *, {r2(f"(abs({' + '.join(DISCOUNTS)}) + 1)")} AS weights
FROM discount_fill_filter WHERE {_ANY} AND {" + ".join(DISCOUNTS)} >= 0"""
CTE["initial_filter"] = """
SELECT * FROM discount_weight
QUALIFY row_number() OVER (
  PARTITION BY mds_fam_id, club_nbr, month, year
  ORDER BY weights DESC, date, item_on_shelf_date_dt NULLS LAST) = 1"""
_LATE = "coalesce({}.item_on_shelf_date_dt, DATE '9999-12-31')"
CTE["top1_item_club_month"] = f"""
SELECT d.* FROM discount_weight d WHERE NOT EXISTS (
  SELECT 1 FROM discount_weight o
  WHERE o.mds_fam_id = d.mds_fam_id AND o.club_nbr = d.club_nbr AND o.month = d.month
    AND o.year = d.year AND (o.weights > d.weights OR (o.weights = d.weights AND (
      o.date < d.date OR (o.date = d.date AND {_LATE.format("o")} < {_LATE.format("d")})))))"""


def _copies(source: str, extra=lambda n: "") -> str:
    """Eight unioned copies of a table, one per horizon."""
    parts = []
    for n in NEXT:
        gone = [f"-1.0::DOUBLE AS {d}" for k, d in enumerate(DISCOUNTS, start=1) if k > n]
        replaced = f" REPLACE ({', '.join(gone)})" if gone else ""
        parts.append(
            f"SELECT *{replaced}, {n} AS num_weeks, {UNITS_NEXT[n - 1]} AS target{extra(n)} FROM {source}"
        )
    return " UNION ALL ".join(parts)


_RATIOS = f"""{div("inventory_1_month_last_weekly_sale_nbr", "num_weeks")} AS {STOCK_WEEKS},
       {div("target", "inventory_qty")} AS ratio_target,
       {div(div("target", "num_weeks"), WEEKLY_UNITS)} AS over_sell_ratio,
       {div(WEEKLY_UNITS, "target")} * num_weeks AS under_sell_ratio"""
CTE["expand_horizons"] = _copies("initial_filter")
CTE["sample_ratios"] = f"SELECT *, {_RATIOS} FROM expand_horizons"
_SAMPLE_FILTER = f"""inventory_qty > 3 AND inventory_qty >= target AND date > {_d(D.warm_start)}"""
CTE["sample_filters"] = f"SELECT * FROM expand_horizons WHERE {_SAMPLE_FILTER}"
CTE["data_samples"] = f"SELECT * FROM sample_ratios WHERE {_SAMPLE_FILTER}"


def _matured(source: str, end: str, extra: str = "TRUE") -> str:
    return f"SELECT * FROM {source} WHERE {extra} AND ({end} - date)::DOUBLE / 7 >= num_weeks"


def _shortest(source: str, ties: str = "item_on_shelf_date_dt NULLS LAST") -> str:
    return f"""SELECT * FROM ({source}) QUALIFY row_number() OVER (
  PARTITION BY mds_fam_id, club_nbr, date, target ORDER BY num_weeks, {ties}) = 1"""


CTE["horizon_matured"] = _matured("data_samples", TEST_END)
CTE["first_week_of_target"] = _shortest("SELECT * FROM horizon_matured")


def _between(span) -> str:
    return f"date BETWEEN {_d(span[0])} AND {_d(span[1])}"


for _name, _span, _end in (
    ("train", D.train, D.train[1]), ("val", D.val, D.test[1]), ("test", D.test, D.test[1]),
):
    CTE[f"{_name}_set"] = _shortest(_matured("data_samples", _d(_end), _between(_span)))
CTE["train_val_test"] = " UNION ALL ".join(
    f"SELECT '{n}' AS split, * FROM {n}_set" for n in ("train", "val", "test")
)
CTE["select_covariates"] = f"""
SELECT {", ".join(COVARIATES)}, target, inventory_qty, item_nbr, mds_fam_id, date FROM train_val_test"""
CTE["planned_base"] = f"""
SELECT s.* REPLACE (least({PRICE_BACK[0]}, current_retail_price) AS {PRICE_BACK[0]}),
       current_retail_price, oos_date, markdown_start_date_dt, plan_id
FROM second s JOIN plan_logs p
  ON s.item_nbr = p.item_nbr AND s.club_nbr = p.club_nbr AND s.date = p.date
WHERE s.date >= {_d(D.max_eval_start)} AND markdown_start_date_dt IS NOT NULL
  AND {PRICE_BACK[0]} != 0"""
CTE["planned_priced"] = "SELECT * REPLACE (" + ", ".join(
    f"1 - {div(p, PRICE_BACK[0])} AS {d}" for d, p in zip(DISCOUNTS, PRICE_NEXT, strict=True)
) + ") FROM planned_base"
CTE["planned_copies"] = _copies(
    "planned_priced",
    lambda n: f", {UNITS_NEXT[n - 1]}" + (f" - {UNITS_NEXT[n - 2]}" if n > 1 else "") + " AS week_target",
)
CTE["planned_samples"] = f"""
SELECT *, {_RATIOS}, max(oos_date) OVER (PARTITION BY item_nbr, club_nbr) AS max_oos_date
FROM planned_copies"""
_OPEN = "(oos_date - date)::DOUBLE / 7 >= num_weeks AND date < oos_date"
CTE["planned_eval"] = (
    "SELECT * FROM ("
    + _shortest(
        _matured("planned_samples", TEST_END, f"date <= max_oos_date AND {_OPEN}"),
        "item_on_shelf_date_dt NULLS LAST, oos_date, plan_id, current_retail_price",
    )
    + f") WHERE {_ANY}"
)
CTE["eval_planned"] = (
    f"SELECT * FROM planned_eval WHERE date BETWEEN {_d(D.eval_start)} AND {TEST_END}"
)
CTE["eval_planned_complete"] = (
    f"SELECT * FROM planned_eval WHERE date BETWEEN {_d(D.max_eval_start)} AND {TEST_END}"
)
CTE["manual_base"] = f"""
SELECT s.*, markdown_start_date_dt, markdown_end_date_dt
FROM second s JOIN manual_markdowns m
  ON s.item_nbr = m.item_nbr AND s.club_nbr = m.club_nbr AND s.date = m.markdown_start_date_dt
WHERE s.date >= {_d(D.max_eval_start)}"""
CTE["manual_copies"] = _copies("manual_base")
CTE["manual_samples"] = f"""
SELECT *, {_RATIOS}, max(markdown_end_date_dt) OVER (PARTITION BY item_nbr) AS oos_date
FROM manual_copies"""
CTE["eval_manual"] = (
    "SELECT * FROM ("
    + _shortest(
        _matured(
            "manual_samples", TEST_END,
            f"date BETWEEN {_d(D.eval_start)} AND {TEST_END} AND {_OPEN}",
        )
    )
    + f") WHERE {_ANY}"
)
CTE["last_monday"] = f"SELECT date_trunc('week', {END})::DATE AS monday"
CTE["test_starts"] = """
SELECT 'weekly' AS frequency, 26 AS test_weeks, monday - 14 - 26 * 7 AS test_start FROM last_monday
UNION ALL
SELECT 'monthly', 10,
       date_trunc('month', monday)::DATE + CASE WHEN day(monday) < 15 THEN 0 ELSE 14 END - 70
FROM last_monday"""
CTE["period_split"] = """
SELECT frequency, CASE WHEN date < test_start THEN 'train' ELSE 'test' END AS split, p.*
FROM half_year_stats p JOIN test_starts t
  ON p.date >= test_start - 78 * 7 AND p.date < test_start + test_weeks * 7"""
CTE["category_universe"] = """
SELECT DISTINCT mds_fam_id, item_nbr, dept_nbr, subclass_nbr FROM item_master
WHERE dept_nbr IN (SELECT unnest(string_split(replace('0, 1, 2, 3', ' ', ''), ','))::INTEGER)"""

# --- disaggregation -------------------------------------------------------------------------

CTE["parent_child_map"] = """
SELECT DISTINCT s.item_nbr AS parent_item_nbr, i.child_nbr AS child_item_nbr, s.club_nbr, s.date,
       s.unit_sold_cnt
FROM second_level_features s JOIN item_master i ON s.item_nbr = i.item_nbr
WHERE s.date = (SELECT max(date) - 1 FROM second_level_features)"""
CTE["child_inventory"] = f"""
SELECT item_nbr, club_nbr, snapshot_date, max(inventory_qty) AS inventory_qty
FROM (
  SELECT m.child_nbr AS item_nbr, club_nbr, snapshot_date, {_EFFECTIVE} AS inventory_qty
  FROM child_inventory_daily c
  JOIN (SELECT DISTINCT child_nbr, dept_nbr FROM item_master) m ON c.mds_fam_id = m.child_nbr
  WHERE status NOT IN ('R', 'L', 'D') AND dept_nbr IN {_in(PARAMS.departments)}
    AND snapshot_date = {TODAY})
WHERE inventory_qty >= 0 GROUP BY ALL"""
CTE["child_sales_1w"] = f"""
SELECT child_nbr AS item_nbr, club_nbr, sum(unit_qty) AS unit_qty_1w
FROM scan_sales s JOIN item_master m USING (scan_id)
WHERE dept_nbr IN {_in(PARAMS.departments)} AND unit_qty > 0
  AND current_ind = 'Y' AND country_code = 'US' AND base_div_nbr = 18 AND subclass_nbr NOT IN (9)
  AND visit_date BETWEEN {_d(D.child_sales_week[0])} AND {_d(D.child_sales_week[1])}
GROUP BY ALL"""
CTE["disagg_input"] = """
SELECT parent_item_nbr, child_item_nbr, m.club_nbr, coalesce(i.inventory_qty, 0) AS inventory_qty,
       coalesce(s.unit_qty_1w, 0) AS unit_qty_1w
FROM parent_child_map m
LEFT JOIN child_inventory i ON i.item_nbr = m.child_item_nbr AND i.club_nbr = m.club_nbr
LEFT JOIN child_sales_1w s ON s.item_nbr = m.child_item_nbr AND s.club_nbr = m.club_nbr"""
CTE["disagg_totals"] = """
SELECT *, count(*) OVER w AS num_child, sum(inventory_qty) OVER w AS inventory,
       sum(unit_qty_1w) OVER w AS units_1w
FROM disagg_input WINDOW w AS (PARTITION BY parent_item_nbr, club_nbr)"""
CTE["disagg_shares"] = """
SELECT *,
  CASE WHEN inventory = 0 THEN 1.0::DOUBLE / num_child
       ELSE inventory_qty::DOUBLE / inventory::DOUBLE END AS inv_weights,
  CASE WHEN units_1w = 0 THEN 1.0::DOUBLE / num_child
       ELSE unit_qty_1w::DOUBLE / units_1w::DOUBLE END AS sales_weights
FROM disagg_totals"""
CTE["disagg_blend"] = """
SELECT *, 0.7::DOUBLE * inv_weights + 0.3::DOUBLE * sales_weights AS weights FROM disagg_shares"""
CTE["disagg_raw_weights"] = """
SELECT *, CASE WHEN weights = 0 THEN 0 ELSE inventory_qty::DOUBLE / weights END AS inv_cap
FROM disagg_blend"""
CTE["caps"] = "SELECT DISTINCT parent_item_nbr, club_nbr, inv_cap FROM disagg_raw_weights"
CTE["disagg_scenarios"] = """
SELECT *, row_number() OVER (PARTITION BY parent_item_nbr, club_nbr ORDER BY inv_min) AS scenario
FROM (
  SELECT a.parent_item_nbr, a.club_nbr, a.inv_cap AS inv_min, min(b.inv_cap) AS inv_max
  FROM caps a JOIN caps b
    ON a.parent_item_nbr = b.parent_item_nbr AND a.club_nbr = b.club_nbr AND a.inv_cap < b.inv_cap
  GROUP BY ALL)"""
CTE["disagg_flags"] = """
SELECT w.*, inv_min, inv_max, scenario,
       CASE WHEN inv_cap >= inv_max THEN 0 ELSE 1 END AS scenario_flag
FROM disagg_raw_weights w JOIN disagg_scenarios s USING (parent_item_nbr, club_nbr)"""
CTE["scenario_totals"] = """
SELECT parent_item_nbr, club_nbr, scenario,
       sum(CASE WHEN scenario_flag = 0 THEN weights ELSE 0 END) AS total_scenario_weights
FROM disagg_flags GROUP BY ALL"""
CTE["disagg_final"] = """
SELECT f.*, total_scenario_weights,
       CASE WHEN scenario_flag = 0 THEN weights / total_scenario_weights ELSE 0 END AS final_weights
FROM disagg_flags f JOIN scenario_totals USING (parent_item_nbr, club_nbr, scenario)"""

CTE["requests"] = """
SELECT DISTINCT parent_item_nbr, club_nbr, floor(inventory::DOUBLE / part)::BIGINT AS quantity
FROM disagg_raw_weights, (SELECT unnest([10, 2, 1]) AS part)"""
CTE["live_children"] = """
SELECT parent_item_nbr, club_nbr, quantity, child_item_nbr,
       quantity * weights / sum(weights) OVER (PARTITION BY parent_item_nbr, club_nbr, quantity) AS share
FROM disagg_raw_weights JOIN requests USING (parent_item_nbr, club_nbr) WHERE inv_cap > quantity"""
CTE["rounded_children"] = """
SELECT *, floor(share + 1e-9::DOUBLE) AS whole, floor((share - floor(share + 1e-9::DOUBLE)) * 1e6::DOUBLE + 0.5::DOUBLE) AS rest
FROM live_children"""
CTE["disagg_lookup"] = """
SELECT parent_item_nbr, club_nbr, quantity, child_item_nbr,
       (whole + CASE WHEN row_number() OVER (PARTITION BY parent_item_nbr, club_nbr, quantity
                       ORDER BY rest DESC, child_item_nbr)
                     <= quantity - sum(whole) OVER (PARTITION BY parent_item_nbr, club_nbr, quantity)
                     THEN 1 ELSE 0 END)::BIGINT AS units
FROM rounded_children"""

# --- data quality ---------------------------------------------------------------------------


def _not_null(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 'expect_column_values_to_not_be_null' AS expectation_type,
       count(*) = count({c}) AS success, count(*) AS element_count,
       count(*) - count({c}) AS unexpected_count,
       (count(*) - count({c}))::DOUBLE * 100 / nullif(count(*), 0)::DOUBLE AS unexpected_percent,
       NULL::VARCHAR AS observed_type FROM {source}"""
        for c in columns
    )


def _types(source: str, rows) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, 'expect_column_values_to_be_of_type' AS expectation_type,
       {ok} AS success, count(*) AS element_count, NULL::BIGINT AS unexpected_count,
       NULL::DOUBLE AS unexpected_percent, '{seen}' AS observed_type FROM {source}"""
        for c, seen, ok in rows
    )


_SCAN_TYPES = [("scan_id", "bigint", "TRUE"), ("visit_nbr", "bigint", "FALSE")]
_WEIGHT_TYPES = [
    ("parent_item_nbr", "int", "TRUE"), ("child_item_nbr", "int", "TRUE"),
    ("club_nbr", "int", "TRUE"),
]
CTE["dq_not_null"] = _not_null("scan", ["scan_id", "unit_qty", "visit_nbr", "visit_date"])
CTE["dq_type"] = _types("scan", _SCAN_TYPES)
CTE["dq_report"] = f"""
SELECT '2001-11-05 07:00:00' AS utc_time, * FROM ({" UNION ALL ".join([
    _not_null("scan", ["scan_id"]), _types("scan", _SCAN_TYPES),
    _not_null("disagg_raw_weights", [c for c, _, _ in _WEIGHT_TYPES]),
    _types("disagg_raw_weights", _WEIGHT_TYPES)])})"""

CTE["dq_log"] = "SELECT * FROM dq_report"

# --- encoding, scoring ----------------------------------------------------------------------

CTE["cast_columns"] = """
SELECT department_nbr::VARCHAR AS dept_text, date AS start_date, unit_price_amt AS price
FROM half_year_stats"""
CTE["train_rows"] = "SELECT * FROM train_val_test WHERE split = 'train'"
CTE["prior"] = """
SELECT sum(target::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE AS prior FROM train_rows"""
_ENCODED = ("club_nbr", "department_nbr", "subclass_nbr", "week", "month")
for _c in _ENCODED:
    CTE[f"code_{_c}"] = f"""
SELECT {_c}, (sum(target::DECIMAL(18,2))::DOUBLE + (SELECT prior FROM prior)) / (count(*) + 1) AS code
FROM train_rows GROUP BY {_c}"""
CTE["target_encode"] = f"""
SELECT split, mds_fam_id, date, num_weeks, target,
       {", ".join(f"coalesce(c_{c}.code, (SELECT prior FROM prior)) AS {c}" for c in _ENCODED)}
FROM train_val_test s
{" ".join(f"LEFT JOIN code_{c} c_{c} ON c_{c}.{c} = s.{c}" for c in _ENCODED)}"""
_LIFT = f"(1 + 1.5::DOUBLE * greatest({DISCOUNTS[0]}, 0::DOUBLE))"
_DEMAND = f"{WEEKLY_UNITS} * num_weeks * {_LIFT}"


def _predicted(source: str) -> str:
    return f"""
SELECT *, department_nbr AS dept_nbr,
       least(greatest(round_even({_DEMAND}, 0), 0::DOUBLE), inventory_qty) AS predicted_sales
FROM {source}"""


CTE["manual_pred"] = _predicted("eval_manual")
CTE["planned_pred"] = _predicted("eval_planned")
CTE["split_pred"] = _predicted("train_val_test")
CTE["test_pred"] = "SELECT * FROM split_pred WHERE split = 'test'"
CTE["score_sales"] = "SELECT * FROM manual_pred"
_BUCKET = f"least(floor({WEEKLY_UNITS}), 9)::INTEGER"
CTE["bucket_caps"] = f"""
SELECT {_BUCKET} AS bucket, quantile_cont(target::DOUBLE / num_weeks, 0.8) AS quantile80
FROM data_samples GROUP BY 1"""
CTE["cap_by_bucket"] = f"""
SELECT p.* REPLACE (CASE WHEN predicted_sales > round_even(quantile80 * num_weeks, 0)
       THEN round_even(quantile80 * num_weeks, 0) ELSE predicted_sales END AS predicted_sales),
       bucket, quantile80
FROM (SELECT *, {_BUCKET} AS bucket FROM manual_pred) p LEFT JOIN bucket_caps USING (bucket)"""

# --- evaluation -----------------------------------------------------------------------------


def _accuracy(t: str, f: str) -> dict[str, str]:
    e = f"({f} - {t})"
    return {
        "bias": div(f"sum{e}", f"sum({t})"),
        "mae": f"avg(abs{e})",
        "rmse": f"sqrt(avg({e} * {e}))",
        "mape": f"avg(abs{e} / nullif(abs({t}), 0))",
        "smape": f"avg(2 * abs{e} / (abs({t}) + abs({f}) + 1) * 100)",
        "weighted_mape": div(f"sum(abs{e})", f"sum({t})"),
        "median_ape": f"median(abs{e} / nullif(abs({t}), 0))",
    }


def _side(t: str, f: str, op: str, name: str) -> dict[str, str]:
    where = f"FILTER (WHERE {f} {op} {t})"
    share = f"(count(*) {where} / nullif(count(*), 0)::DOUBLE)"
    units = f"coalesce(sum({f} - {t}) {where}, 0)"
    return {
        f"{name}_sample_pct": share,
        f"{name}_total_units": units,
        f"{name}_units_pct": div(units, f"sum({t})"),
        f"{name}_mean_pct": f"CASE WHEN count(*) {where} = 0 THEN 0 ELSE "
        f"{div(units, f'sum({t}) {where}')} * {share} END",
    }


def _both_sides(t: str, f: str) -> dict[str, str]:
    return {**_side(t, f, ">", "overestimation"), **_side(t, f, "<", "underestimation")}


def _rounded(cols: dict[str, str], digits: int, source: str, by: str = "") -> str:
    inner = ", ".join(f"{sql} AS {name}" for name, sql in cols.items())
    outer = ", ".join(
        f"{sql_round(name, digits)} AS {name}"
        for name in cols
        if not name.startswith(("n_", "weekly_eval_sample")) and name != "first_date"
    )
    kept = ", ".join(
        [by] * bool(by)
        + [n for n in cols if n.startswith(("n_", "weekly_eval_sample")) or n == "first_date"]
    )
    group = f" GROUP BY {by}" if by else ""
    head = f"{by}, " if by else ""
    return f"SELECT {kept}{', ' if kept else ''}{outer} FROM (SELECT {head}{inner} FROM {source}{group})"


T_, F_ = "target", "predicted_sales"
_COUNTS = {"n_samples": "count(*)", "n_zero_actuals": "count(*) FILTER (WHERE target = 0)"}
_OVERALL = {**_COUNTS, **_accuracy(T_, F_)}
CTE["metrics_overall"] = _rounded(_OVERALL, 4, "manual_pred")
CTE["metrics_over_under"] = _rounded(_both_sides(T_, F_), 4, "manual_pred")
_SPLIT = {"n_samples": "count(*)", **_accuracy(T_, F_), **_side(T_, F_, ">", "overestimation")}
CTE["metrics_train_val_test"] = _rounded(_SPLIT, 4, "split_pred", "split")
CTE["metrics_test"] = _rounded(_SPLIT, 2, "test_pred")


def _horizon(t: str, f: str, k: int) -> tuple[str, str]:
    where = f"FILTER (WHERE num_weeks = {k})"
    total = f"sum({t}) {where}"
    return div(f"sum(abs({f} - {t})) {where}", total), div(f"sum({f} - {t}) {where}", total)


CTE["metrics_by_horizon"] = _rounded(
    {f"cumul_eval_wmape_nw_{k}": _horizon(T_, F_, k)[0] for k in NEXT}, 4, "manual_pred"
)
_LAG = "lag({c}) OVER (PARTITION BY mds_fam_id, club_nbr, date ORDER BY num_weeks)"
CTE["weekly_decumulate"] = f"""
SELECT *, target - coalesce({_LAG.format(c="target")}, 0) AS target_weekly,
       predicted_sales - coalesce({_LAG.format(c="predicted_sales")}, 0) AS predicted_sales_weekly
FROM manual_pred"""
TW, FW = "target_weekly", "predicted_sales_weekly"
CTE["metrics_weekly"] = _rounded(
    {
        **_accuracy(TW, FW),
        **_both_sides(TW, FW),
        **{f"weekly_eval_wmape_nw_{k}": _horizon(TW, FW, k)[0] for k in NEXT},
        **{f"weekly_eval_bias_nw_{k}": _horizon(TW, FW, k)[1] for k in NEXT},
        **{
            f"weekly_eval_sample_count_nw_{k}": f"count(*) FILTER (WHERE num_weeks = {k})"
            for k in NEXT
        },
    },
    4,
    "weekly_decumulate",
)


def _category() -> dict[str, str]:
    a, o = _accuracy(T_, F_), _side(T_, F_, ">", "overestimation")
    return {
        "n_samples": "count(*)",
        **{n: a[n] for n in ("mae", "rmse", "median_ape", "smape")},
        "wmape": a["weighted_mape"],
        "oep_sample": o["overestimation_sample_pct"],
        "oe_value": o["overestimation_total_units"],
        "oep_total": o["overestimation_units_pct"],
        "oep_weighted": o["overestimation_mean_pct"],
    }


_LABELS = "'units' AS metric_target, (SELECT min(date) FROM manual_pred) AS eval_set_start_date"
CTE["error_by_category"] = f"""
SELECT e.*, 'DEPT_' || dept_nbr AS description, {_LABELS}
FROM ({_rounded(_category(), 6, "manual_pred", "dept_nbr")}) e"""
CTE["error_overall"] = f"SELECT e.*, {_LABELS} FROM ({_rounded(_category(), 6, 'manual_pred')}) e"
CTE["error_by_horizon"] = f"""
SELECT e.*, {_LABELS} FROM ({_rounded({
    "n_samples": "count(*)",
    "wmape": _accuracy(T_, F_)["weighted_mape"],
    "wmape_weekly": _accuracy(TW, FW)["weighted_mape"],
    "weekly_bias": _accuracy(T_, F_)["bias"],
}, 4, "weekly_decumulate", "num_weeks")}) e"""
CTE["markdown_weeks"] = """
SELECT p.club_nbr, p.mds_fam_id, year(p.date) * 100 + month(p.date) AS n_md,
       p.unit_price_amt AS selling_price, p.date
FROM half_year_stats p JOIN manual_executions m
  ON p.item_nbr = m.item_nbr AND p.club_nbr = m.club_nbr AND p.date = m.md_start_date"""
_FIRST = """
SELECT * FROM markdown_weeks
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY date, selling_price) = 1"""
CTE["first_markdown_week"] = _FIRST.format(keys="club_nbr, mds_fam_id, n_md")
CTE["first_session_week"] = _FIRST.format(keys="club_nbr, mds_fam_id, n_md, selling_price")


def _long(source: str, prefix: str, suffix: str, cols: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{prefix}{c}{suffix}' AS metric, {c}::DOUBLE AS value FROM {source}" for c in cols
    )


CTE["planned_overall"] = _rounded(_OVERALL, 4, "planned_pred")
CTE["test_sides"] = _rounded(_both_sides(T_, F_), 4, "test_pred")
CTE["combine_metrics"] = " UNION ALL ".join(
    [
        _long("metrics_test", "test_", "", {k: v for k, v in _SPLIT.items() if k != "bias"}),
        _long("planned_overall", "cumul_eval_", "_logs", _OVERALL),
        _long("metrics_overall", "cumul_eval_", "_manual", _OVERALL),
        _long("test_sides", "test_", "", _side(T_, F_, "<", "underestimation")),
    ]
)
CTE["apes"] = """
SELECT unnest([dept_nbr, -1]) AS category, abs(predicted_sales - target) / nullif(abs(target), 0) AS x
FROM manual_pred WHERE target != 0"""
CTE["unit_errors"] = """
SELECT CASE WHEN e < -50 THEN 0 WHEN e >= 50 THEN 21 ELSE floor((e + 50) / 5) + 1 END AS bin
FROM (SELECT predicted_sales - target AS e FROM manual_pred)"""
CTE["error_quantiles"] = f"""
SELECT DISTINCT 'ape_cdf' AS kind, category, {sql_round("x", 6)} AS x,
       {sql_round("y", 6)} AS y
FROM (SELECT category, x, cume_dist() OVER (PARTITION BY category ORDER BY x) AS y FROM apes)
UNION ALL
SELECT 'unit_error', -1, -50 + (bin - 1) * 5, count(*) FROM unit_errors GROUP BY bin"""

CTE["known_errors"] = "SELECT predicted_sales - target AS e FROM manual_pred WHERE predicted_sales - target IS NOT NULL"
CTE["error_spread"] = """
SELECT count(*) AS n, stddev_samp(e) AS sd,
       (quantile_cont(e, 0.75) - quantile_cont(e, 0.25)) / 1.34::DOUBLE AS apart FROM known_errors"""
CTE["error_width"] = """
SELECT n, 0.9::DOUBLE * n ** -0.2::DOUBLE * CASE WHEN sd > 0 AND apart > 0 THEN least(sd, apart)
       WHEN apart > 0 THEN apart WHEN sd > 0 THEN sd ELSE 1 END AS h FROM error_spread"""
CTE["error_bins"] = """
SELECT i, sum(w) AS w FROM (
  SELECT floor((e + 50) * 2) AS i, 1 - ((e + 50) * 2 - floor((e + 50) * 2)) AS w FROM known_errors
  UNION ALL
  SELECT floor((e + 50) * 2) + 1, (e + 50) * 2 - floor((e + 50) * 2) FROM known_errors)
GROUP BY i"""
CTE["error_density"] = """
SELECT -50 + g.range * 0.5::DOUBLE AS x,
       sum(w * exp(-0.5::DOUBLE * ((i - g.range) * 0.5::DOUBLE / h) ** 2)) / any_value(n * h * sqrt(2 * pi())) AS density
FROM range(0, 201) g, error_bins, error_width
WHERE abs(i - g.range) <= ceil(8 * h / 0.5::DOUBLE) GROUP BY g.range"""
CTE["known_pairs"] = "SELECT target AS t, predicted_sales AS f FROM manual_pred WHERE predicted_sales - target IS NOT NULL"
CTE["pair_widths"] = """
SELECT stddev_samp(t) * count(*) ** (-1::DOUBLE / 6) / 2 AS ht, stddev_samp(f) * count(*) ** (-1::DOUBLE / 6) / 2 AS hf
FROM known_pairs"""
CTE["pair_bins"] = """
SELECT a, b, sum(w) AS w FROM (
  SELECT floor(t / 2) + x.range AS a, floor(f / 2) + y.range AS b,
         (CASE x.range WHEN 0 THEN 1 - (t / 2 - floor(t / 2)) ELSE t / 2 - floor(t / 2) END)
         * (CASE y.range WHEN 0 THEN 1 - (f / 2 - floor(f / 2)) ELSE f / 2 - floor(f / 2) END) AS w
  FROM known_pairs, range(0, 2) x, range(0, 2) y)
GROUP BY a, b"""
CTE["joint_density"] = """
SELECT x.range * 2::DOUBLE AS actual, y.range * 2::DOUBLE AS predicted,
       sum(w * exp(-0.5::DOUBLE * ((a - x.range) / ht) ** 2) * exp(-0.5::DOUBLE * ((b - y.range) / hf) ** 2))
       / any_value(ht * hf * 2 * pi()) AS n_rows
FROM range(0, 51) x, range(0, 51) y, pair_bins, pair_widths
WHERE abs(a - x.range) <= ceil(8 * ht) AND abs(b - y.range) <= ceil(8 * hf) GROUP BY ALL"""

# --- elasticity -----------------------------------------------------------------------------


def _grid(points: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT * REPLACE ({', '.join(f'-1.0::DOUBLE AS {d}' for d in DISCOUNTS[1:])}, "
        f"{n / 10}::DOUBLE AS {DISCOUNTS[0]}), {n / 10}::DOUBLE AS discount "
        f"FROM eval_manual WHERE num_weeks = 1"
        for n in range(points)
    )
    return rows


def _scored(source: str) -> str:
    sale = f"greatest({_DEMAND}, 0::DOUBLE)"
    return f"""
SELECT *, {r2("least(predicted_sale, inventory_qty)")} AS cap_predicted_sale
FROM (SELECT *, {sale} AS predicted_sale FROM {source})"""


CTE["discount_grid"] = _grid(9)
CTE["deep_grid"] = _grid(10)
CTE["grid_score"] = _scored("discount_grid")
CTE["deep_score"] = _scored("deep_grid")
_KEYS = "club_nbr, item_nbr, date, num_weeks"
CTE["sale_lift"] = f"""
SELECT *, (predicted_sale + 1) / (min(predicted_sale) OVER w + 1) AS sale_lift,
       (max(predicted_sale) OVER w + 1) / (min(predicted_sale) OVER w + 1) AS max_sale_lift
FROM grid_score WINDOW w AS (PARTITION BY {_KEYS})"""
CTE["elasticity_curve"] = """
SELECT discount, quantile_cont(sale_lift, 0.25) AS q1, quantile_cont(sale_lift, 0.5) AS median,
       quantile_cont(sale_lift, 0.75) AS q3
FROM sale_lift GROUP BY discount"""
CTE["monotone_envelope"] = f"""
SELECT *, max(predicted_sale) OVER (PARTITION BY {_KEYS} ORDER BY discount
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS monotone_predicted_sale
FROM grid_score"""
CTE["observed"] = f"""
SELECT mds_fam_id, floor(greatest({DISCOUNTS[0]}, 0::DOUBLE) * 10 + 1e-9::DOUBLE)::INTEGER AS discount_step,
       count(*) AS n_samples, avg(target / num_weeks) AS mean_units
FROM eval_manual GROUP BY ALL"""
CTE["pooled_means"] = """
SELECT a.mds_fam_id, a.discount_step AS low, b.discount_step AS high,
       sum(c.mean_units * c.n_samples) / sum(c.n_samples) AS pooled
FROM observed a JOIN observed b ON a.mds_fam_id = b.mds_fam_id AND a.discount_step <= b.discount_step
JOIN observed c ON a.mds_fam_id = c.mds_fam_id AND c.discount_step BETWEEN a.discount_step AND b.discount_step
GROUP BY ALL"""
CTE["least_above"] = """
SELECT p.mds_fam_id, p.discount_step, low, min(pooled) AS least
FROM observed p JOIN pooled_means m
  ON p.mds_fam_id = m.mds_fam_id AND p.discount_step BETWEEN low AND high
GROUP BY ALL"""
CTE["response_curve"] = """
SELECT o.*, max(mean_units) OVER (PARTITION BY mds_fam_id ORDER BY discount_step
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS envelope_units, isotonic_units
FROM observed o JOIN (SELECT mds_fam_id, discount_step, max(least) AS isotonic_units
                      FROM least_above GROUP BY ALL) USING (mds_fam_id, discount_step)"""
CTE["scored_one_week"] = "SELECT * FROM (" + _scored("eval_manual") + ") WHERE num_weeks = 1"
_EL = _accuracy("target", "cap_predicted_sale")
CTE["elasticity_metrics"] = f"""
SELECT count(*) AS n_samples, {_EL["weighted_mape"]} AS wmape, {_EL["smape"]} AS smape,
       {_EL["bias"]} AS bias FROM scored_one_week"""
CTE["running_min"] = f"""
SELECT {_KEYS}, discount, cap_predicted_sale AS p, lag(cap_predicted_sale) OVER o AS last,
       min(cap_predicted_sale) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lowest
FROM grid_score WINDOW o AS (PARTITION BY {_KEYS} ORDER BY discount)"""
CTE["entity_flags"] = f"""
SELECT {_KEYS}, max(CASE WHEN p >= lowest THEN 1 ELSE 0 END) AS monotonic,
       min(CASE WHEN p < last THEN 0 ELSE 1 END) AS non_decreasing
FROM running_min GROUP BY ALL"""
CTE["monotonicity_check"] = """
SELECT count(*) AS n_entities, sum(monotonic) AS n_monotonic, sum(non_decreasing) AS n_non_decreasing,
       CASE WHEN sum(monotonic) = count(*) THEN 'All Item Clubs Show Monotonic Behavior'
            ELSE 'Item Clubs Do Not Show Monotonic Behavior' END AS statement
FROM entity_flags"""
_BASE_PRICE = f"{MEDIAN_PRICE} * price_1_week_back_median_price_6_month_last_nbr"
CTE["deep_price"] = f"""
SELECT *, {r2("raw_price")} AS price
FROM (SELECT *, {_BASE_PRICE} * (1 - discount) AS raw_price FROM deep_score)"""
CTE["arc"] = f"""
SELECT a.{_KEYS.replace(", ", ", a.")}, a.inventory_qty,
       {div("b.cap_predicted_sale - a.cap_predicted_sale",
            "b.cap_predicted_sale + a.cap_predicted_sale")} AS change_in_sales,
       {div("a.price - b.price", "a.price + b.price")} AS change_in_price,
       c.cap_predicted_sale AS sale_90
FROM deep_price a JOIN deep_price b USING ({_KEYS}) JOIN deep_price c USING ({_KEYS})
WHERE a.discount = 0.1::DOUBLE AND b.discount = 0.6::DOUBLE AND c.discount = 0.9::DOUBLE"""
CTE["arc_flags"] = f"""
SELECT *, CASE WHEN sale_90 >= inventory_qty * 0.75::DOUBLE THEN 0
               WHEN {div("change_in_sales", "change_in_price")} < 0.10::DOUBLE THEN 1
               ELSE 0 END AS inelastic
FROM arc"""
CTE["elasticity_check"] = f"""
SELECT count(*) AS n_entities, sum(inelastic) AS n_inelastic,
       {div("sum(inelastic)", "count(*)")} AS inelastic_share FROM arc_flags"""
_PRICE = f"CASE WHEN NOT isinf({PRICE_BACK[0]}) THEN {PRICE_BACK[0]} END * (1 - discount)"
_COST, _LIQ = f"(0.7::DOUBLE * {MEDIAN_PRICE})", f"(0.3::DOUBLE * {MEDIAN_PRICE})"
CTE["recovery_rate"] = f"""
SELECT *, {div(f"{_PRICE} * cap_predicted_sale + (inventory_qty - cap_predicted_sale) * {_LIQ}",
               f"{_COST} * inventory_qty")} AS recovery_rate,
       {div("cap_predicted_sale", "inventory_qty")} AS sell_through_rate
FROM grid_score"""
CTE["best_markdown"] = f"""
SELECT * FROM recovery_rate WHERE recovery_rate IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_KEYS} ORDER BY recovery_rate DESC, discount) = 1"""

# --- online channel -------------------------------------------------------------------------

CTE["recent_cart"] = f"""
SELECT * FROM (SELECT *, ({_d(CART_AS_OF)} - date - 1) // 7 + 1 AS weeks_back FROM cart_event
               WHERE date < {_d(CART_AS_OF)})
WHERE weeks_back BETWEEN 1 AND 4"""


def _cells(what: str, agg: str) -> str:
    return ", ".join(
        f"{agg} FILTER (WHERE channel = '{c}' AND fulfilment = '{f}' AND weeks_back = {k}) "
        f"AS {c}_{f}_add2cart_{what}_{k}_week_back_cnt"
        for c, f, k in CART_CELLS
    )


CTE["cart_clicks_week_back"] = f"""
SELECT item_nbr, {_cells("click", "count(*)")} FROM recent_cart GROUP BY item_nbr"""
CTE["cart_members_week_back"] = f"""
SELECT item_nbr, {_cells("member", "count(DISTINCT member_id)")} FROM recent_cart GROUP BY item_nbr"""
CTE["cart_members_stored"] = "SELECT * FROM cart_members_week_back"
CTE["online_daily"] = """
SELECT mds_fam_id, department_nbr AS category_nbr, subclass_nbr AS sub_category_nbr, date,
       sum(unit_sold_cnt) AS units, date_diff('day', DATE '1970-01-01', date) AS day_number
FROM daily_sales_catalog GROUP BY ALL"""
CTE["online_units_week_back"] = "SELECT *, " + ", ".join(
    f"(sum(units) OVER (PARTITION BY mds_fam_id ORDER BY day_number RANGE BETWEEN {7 * k} PRECEDING "
    f"AND {7 * k - 6} PRECEDING))::DOUBLE AS units_sold_{k}_week_back_cnt"
    for k in BACK
) + " FROM online_daily"
CTE["cart_ratios"] = """
SELECT item_nbr, count(*) FILTER (WHERE channel = 'app') AS app_clicks,
       count(*) FILTER (WHERE channel = 'web') AS web_clicks,
       (count(*) FILTER (WHERE channel = 'app'))::DOUBLE / count(*) AS app_share
FROM cart_event GROUP BY item_nbr"""

# --- sinks and profiles ---------------------------------------------------------------------

CTE["read_table"] = "SELECT * FROM days_on_shelf WHERE unit_sold_cnt > 0"
CTE["write_table"] = "SELECT * FROM days_on_shelf"
_IDS = "mds_fam_id, item_nbr, club_nbr, date, num_weeks, target"
CTE["extract_parquet"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, {_IDS} FROM {source}"
    for name, source in (
        ("train", "train_set"), ("val", "val_set"), ("test", "test_set"),
        ("planned", "eval_planned"), ("manual", "eval_manual"),
    )
)
CTE["datasets"] = "SELECT unnest(['train', 'val', 'test', 'planned', 'manual']) AS dataset"
CTE["dataset_profile"] = """
SELECT d.dataset, min(date) AS min_date, max(date) AS max_date, count(date) AS n_rows
FROM datasets d LEFT JOIN extract_parquet e USING (dataset) GROUP BY d.dataset"""
CTE["fill_sentinel"] = """
SELECT * REPLACE (coalesce(department_nbr, -1) AS department_nbr) FROM eval_planned"""
CTE["category_description"] = """
SELECT dept_nbr, count(*) AS n_samples, 'DEPT_' || dept_nbr AS description
FROM manual_pred GROUP BY dept_nbr"""
CTE["append_results"] = " UNION ALL ".join(
    f"""SELECT subclass_nbr, mds_fam_id, date, dept_nbr, item_nbr, club_nbr, unit_price_amt,
       markdown_start_date_dt, oos_date, num_weeks, target, predicted_sales,
       '{PARAMS.run_date.isoformat()}' AS run_date FROM {source}"""
    for source in ("manual_pred", "planned_pred")
)

for _name in ("category", "horizon", "overall"):
    _source = "error_overall" if _name == "overall" else f"error_by_{_name}"
    CTE[f"append_{_name}_results"] = (
        f"SELECT *, '{PARAMS.run_date.isoformat()}' AS run_date FROM {_source}"
    )

# --- facts about the fitted model -----------------------------------------------------------

CTE["score_fitted_checks"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS dataset, count(*) AS n_rows,
       sum(mds_fam_id * 100000 + club_nbr * 10000 + (date - DATE '1992-01-01') + num_weeks) AS key_sum,
       sum(target::DECIMAL(18,2))::DOUBLE AS target_sum, 0 AS n_negative, 0 AS n_above_stock,
       0 AS n_falling FROM {source}"""
    for name, source in (("test", "test_set"), ("planned", "eval_planned"), ("manual", "eval_manual"))
)
_VALUES = {
    c: f"coalesce(c_{c}.code, (SELECT prior FROM prior))" if c in _ENCODED
    else f"CASE WHEN abs(s.{c}::DOUBLE) = 'infinity'::DOUBLE THEN NULL ELSE s.{c}::DOUBLE END"
    for c in COVARIATES
}
CTE["encoded_train"] = f"""
SELECT target::DOUBLE AS target, {", ".join(f"coalesce({v}, -999)::DOUBLE AS {c}" for c, v in _VALUES.items())}
FROM train_rows s {" ".join(f"LEFT JOIN code_{c} c_{c} ON c_{c}.{c} = s.{c}" for c in _ENCODED)}"""
CTE["encoded_base"] = """
SELECT sum(floor(target * 65536 + 0.5)::HUGEINT)::DOUBLE / 65536 / count(*) AS base FROM encoded_train"""
CTE["encoded_long"] = """
SELECT * FROM encoded_train UNPIVOT (v FOR covariate IN (* EXCLUDE (target)))"""
CTE["encoded_cuts"] = f"""
SELECT covariate, quantile_cont(v, {[i / 32 for i in range(1, 32)]}) AS cuts FROM encoded_long GROUP BY covariate"""
CTE["boost_histogram"] = """
SELECT covariate, bin, sum(floor((base - target) * 65536 + 0.5)::BIGINT)::BIGINT AS gradient_sum, count(*) AS n_rows
FROM (SELECT encoded_long.covariate AS covariate, target,
             len(list_distinct(list_filter(cuts, lambda c: c < v)))::INTEGER AS bin
      FROM encoded_long JOIN encoded_cuts USING (covariate)) binned, encoded_base
GROUP BY covariate, bin"""
CTE["monotone_probes"] = f"""
SELECT dataset, covariate, 10 * (SELECT count(*) FROM test_set) AS n_rows, 0 AS n_falling
FROM (VALUES ('test'), ('random')) d(dataset),
     (VALUES ('num_weeks'), {", ".join(f"('discount_{k}_week_next_nbr')" for k in range(1, 9))}) c(covariate)"""
CTE["grid_fitted_checks"] = """
SELECT count(*) AS n_rows, 0 AS n_negative, 0 AS n_falling, 0 AS n_below_own FROM discount_grid"""
CTE["model_checks"] = f"""
SELECT 'train_rows' AS fact, count(*) AS value FROM train_set
UNION ALL SELECT 'val_rows', count(*) FROM val_set
UNION ALL VALUES ('beats_mean_on_train', 1), ('trials', 4), ('trials_with_error', 4),
  ('covariates', {len(COVARIATES)}), ('importance_total', 1)"""

#: Keys that grow with the data: an item is a part, a club is a nation.
FINE = {
    **CTE,
    "item_master": CTE["item_master"].replace(
        f"{BRAND} AS mds_fam_id, 1000 + {BRAND} AS item_nbr",
        "p_partkey::INTEGER AS mds_fam_id, (1000 + p_partkey)::INTEGER AS item_nbr",
    ),
    "store_info": CTE["store_info"].replace("n_regionkey AS", "n_nationkey AS"),
}

ROWS_ONLY = ("train_model", "tune_model", "feature_importance", "score_fitted")


def _needed(name: str, seen: dict[str, None], tables: dict[str, str]) -> None:
    """Collect the tables an expression refers to, each after those it needs itself."""
    for other in re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", tables[name]):
        if other in tables and other != name and other not in seen:
            _needed(other, seen, tables)
    seen[name] = None


def oracle(name: str) -> str:
    tables = FINE if name.endswith("_fine") else CTE
    source = name.removesuffix("_fine")
    seen: dict[str, None] = {}
    _needed(source, seen, tables)
    text = ",\n".join(f"{n} AS ({tables[n].strip()})" for n in seen)
    return f"WITH {text}\n{sql_present(COLUMNS[name], source)}"


def oracles() -> dict[str, str]:
    return {name: oracle(name) for name in COLUMNS if name not in ROWS_ONLY}
