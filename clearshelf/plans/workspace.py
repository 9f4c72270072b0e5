"""Intermediate tables over one driver folder, each written once and then read by its consumers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext
from datetime import datetime
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearshelf.operators import disaggregation as dg
from clearshelf.operators import evaluation as ev
from clearshelf.operators import first_level as fl
from clearshelf.operators import sampling as sa
from clearshelf.operators import scans as sc
from clearshelf.operators import second_level as sl
from clearshelf.params import PLAN_STATUS
from clearshelf.operators.scoring import closed_form_scorer, score_sales
from clearshelf.session import measured_broadcasts, prefer_small_methods
from clearshelf.sources.retail import PARAMS, RetailTables
from clearshelf.sources.tables import remove, shared_folder, stage, written

RUN_TS = datetime(2001, 11, 5, 7, 0, 0)


def _once(method: Callable[["Workspace"], DataFrame]) -> Callable[["Workspace"], DataFrame]:
    """Build a lazy frame once per workspace; repeated analysis of one plan is driver time."""
    name = f"_frame_{method.__name__}"

    @wraps(method)
    def frame(self: "Workspace") -> DataFrame:
        if name not in self.__dict__:
            self.__dict__[name] = method(self)
        return self.__dict__[name]

    return frame


class Workspace:
    """Stage tables and predictions over one driver folder.

    They lie in a folder of their own under ``folder``, by default the one the cluster names, until
    ``close()``. A workspace reads its input once: changed input needs a new one.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, *, fine: bool = False, folder: str | None = None
    ) -> None:
        self.spark = spark
        prefer_small_methods(spark)
        self.tables = RetailTables(spark, sf_dir, fine=fine)
        self.params = PARAMS
        self.dates = PARAMS.dates
        parent = folder or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
        self.folder = f"{parent}/workspace-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        """A new path in the workspace."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """With fine keys the item side of the joins grows with the data, so its guessed size is not trusted."""
        with measured_broadcasts(self.spark) if self.tables.fine else nullcontext():
            return stage(df, name, path=self.path(name))

    def close(self) -> None:
        """Delete everything this workspace wrote; frames taken from it can no longer be read."""
        remove(self.spark, self.folder)
        _forget(self)

    @cached_property
    def inventory_daily(self) -> DataFrame:
        """The snapshot table; written out because the stock join and the sessions both read it."""
        return self.stage(self.tables.inventory_daily(), "inventory_daily")

    # --- scans, lazy ---------------------------------------------------------------------

    @_once
    def scan_sales(self) -> DataFrame:
        t, p = self.tables, self.params
        return sc.scan_sales(
            t.scan(),
            t.store_info(),
            t.visit(),
            start=self.dates.history_start,
            end=p.run_date,
            excluded_store_types=p.excluded_store_types,
            excluded_subtypes=p.excluded_subtypes,
        )

    @_once
    def item_master(self) -> DataFrame:
        return self.tables.item_master()

    @_once
    def listed_items(self) -> DataFrame:
        """The item master of the department list: other items leave before any aggregation."""
        return self.item_master().where(F.col("dept_nbr").isin(*self.params.departments))

    @_once
    def item_dim(self) -> DataFrame:
        return sc.item_dim(self.item_master(), depts=self.params.departments)

    @_once
    def inventory_enriched(self) -> DataFrame:
        return sc.inventory_enriched(
            self.inventory_daily,
            self.item_dim(),
            start=self.dates.history_start,
            end=self.params.run_date,
            excluded_status=self.params.excluded_status,
        )

    @_once
    def inventory(self) -> DataFrame:
        return sc.inventory_effective(
            self.inventory_enriched(), on_order_depts=self.params.on_order_departments
        )

    @_once
    def daily_sales(self) -> DataFrame:
        return fl.daily_sales(self.scan_sales(), self.item_master())

    @_once
    def daily_catalog(self) -> DataFrame:
        return fl.daily_sales_catalog(
            fl.daily_sales(self.scan_sales(), self.listed_items()), self.item_dim()
        )

    @_once
    def daily_inventory(self) -> DataFrame:
        return fl.daily_sales_inventory(self.daily_catalog(), self.inventory())

    @_once
    def shelf_panel(self) -> DataFrame:
        return fl.shelf_interval_join(self.daily_inventory(), fl.shelf_sessions(self.inventory()))

    @_once
    def scaffold(self) -> DataFrame:
        return fl.active_pair_scaffold(
            self.shelf_panel(), today=self.dates.today, active_start=self.dates.active_start
        )

    @_once
    def first_level(self) -> DataFrame:
        return fl.first_level_features(
            self.scan_sales(),
            self.listed_items(),
            self.item_dim(),
            self.inventory(),
            today=self.dates.today,
            active_start=self.dates.active_start,
        )

    @_once
    def manual(self) -> DataFrame:
        return sc.manual_markdowns(
            self.tables.manual_executions(),
            since=self.dates.max_eval_start,
            excluded_clubs=self.params.excluded_clubs,
        )

    @_once
    def plans(self) -> DataFrame:
        return sc.plan_logs(
            self.tables.plan_details(),
            self.tables.plan_header(),
            status=PLAN_STATUS,
            since=self.dates.max_eval_start,
        )

    @_once
    def child_inventory(self) -> DataFrame:
        children = sc.item_dim(self.tables.child_master(), depts=self.params.departments)
        usable = sc.inventory_enriched(
            self.tables.child_inventory_daily(),
            children,
            start=self.dates.history_start,
            end=self.params.run_date,
            excluded_status=self.params.excluded_status,
        )
        stock = sc.inventory_effective(
            usable, on_order_depts=self.params.on_order_departments
        )
        return sc.child_inventory(stock, day=self.dates.today)

    @_once
    def child_sales(self) -> DataFrame:
        start, end = self.dates.child_sales_week
        listed = F.col("dept_nbr").isin(*self.params.departments)
        children = sc.current_items(
            self.tables.child_master().where(listed),
            country=self.params.country,
            division=self.params.division,
            excluded_subclasses=self.params.excluded_subclasses,
        )
        sales = self.scan_sales().join(children.select("scan_id", "item_nbr"), "scan_id")
        return sc.child_sales_1w(sales, start=start, end=end)

    @_once
    def parent_child_map(self) -> DataFrame:
        return sc.parent_child_map(self.second, self.tables.item_xref())

    @_once
    def disagg_input(self) -> DataFrame:
        return sc.disagg_input(self.parent_child_map(), self.child_inventory(), self.child_sales())

    # --- stage tables --------------------------------------------------------------------

    @cached_property
    def panel(self) -> DataFrame:
        """First-level table with the half-year statistics of the same window partitioning."""
        return self.stage(sl.half_year_stats(self.first_level()), "panel")

    @cached_property
    def second(self) -> DataFrame:
        """Second-level table."""
        summary = self.stage(sl.weekly_summary(self.panel), "weekly_summary")
        features = sl.second_level_features(
            self.panel, run_ts=RUN_TS, with_half_year=False, summary=summary
        )
        return self.stage(features, "second_level")

    @cached_property
    def samples(self) -> DataFrame:
        filtered = sa.initial_filter(self.second)
        return self.stage(sa.data_samples(filtered, after=self.dates.warm_start), "samples")

    @cached_property
    def splits(self) -> DataFrame:
        return self.stage(sa.train_val_test(self.samples, dates=self.dates), "splits")

    @cached_property
    def manual_eval(self) -> DataFrame:
        found = sa.eval_manual(self.second, self.manual(), dates=self.dates)
        return self.stage(found, "eval_manual")

    @cached_property
    def planned_samples(self) -> DataFrame:
        """Both planned sets are cut from this table."""
        found = sa.planned_samples(self.second, self.plans(), dates=self.dates)
        return self.stage(found, "planned_samples")

    @property
    def planned_eval(self) -> DataFrame:
        return sa.eval_planned(self.planned_samples, dates=self.dates)

    @cached_property
    def disagg_weights(self) -> DataFrame:
        return self.stage(dg.disagg_raw_weights(self.disagg_input()), "disagg_weights")

    @cached_property
    def disagg_caps(self) -> DataFrame:
        """The caps of every group in order; scenarios, flags and totals read them."""
        return self.stage(dg.ordered_caps(self.disagg_weights), "disagg_caps")

    @cached_property
    def descriptions(self) -> DataFrame:
        """Category text, kept as a CSV file next to the stage tables."""
        text = self.item_master().select(
            F.col("dept_nbr").alias("category_nbr"),
            F.concat(F.lit("DEPT_"), F.col("dept_nbr")).alias("description"),
        )
        path = self.path("descriptions")
        text.distinct().write.option("header", True).csv(path)
        return self.spark.read.schema("category_nbr int, description string").csv(path, header=True)

    # --- predictions ---------------------------------------------------------------------

    def predictions(self, samples: DataFrame) -> DataFrame:
        scored = score_sales(samples, closed_form_scorer, inventory_col="inventory_qty")
        return scored.withColumn("dept_nbr", F.col("department_nbr"))

    def manual_predictions(self) -> DataFrame:
        return self.predictions(self.manual_eval)

    def planned_predictions(self) -> DataFrame:
        return self.predictions(self.planned_eval)

    def weekly_predictions(self) -> DataFrame:
        return ev.weekly_decumulate(self.manual_predictions())


_WORKSPACES: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str, *, fine: bool = False) -> Workspace:
    """The workspace of this application and folder; stage tables are shared by its queries.

    Tables that were written anew in the meantime get a new one.
    """
    key = (spark.sparkContext.applicationId, sf_dir, fine, written(spark, sf_dir))
    if key not in _WORKSPACES:
        _WORKSPACES[key] = Workspace(spark, sf_dir, fine=fine)
    return _WORKSPACES[key]


def _forget(closed: Workspace) -> None:
    for key in [k for k, ws in _WORKSPACES.items() if ws is closed]:
        del _WORKSPACES[key]


def forget_workspaces() -> None:
    """Drop the shared stage tables, so that the next query builds its own (used by the bench)."""
    _WORKSPACES.clear()
