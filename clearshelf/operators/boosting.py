"""Boosted regression trees with monotone constraints, grown level by level with Spark aggregates.

Covariates become bins once. A level of a tree is one aggregate of gradient sums and row counts by
(node, covariate, bin); running sums over the bins give every split, and one best split a node
reaches the driver. Gradients are whole numbers of ``1 / SCALE``, so that sums do not depend on the
order of rows and a fit repeats on any partitioning.

A constrained covariate takes no split whose left weight is above the right one, and both children
inherit the mean of the two weights as a bound: predictions never fall with such a covariate.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.functions.ordered import quantiles
from clearshelf.sources.tables import fresh_path, remove, stage

#: Gradients are counted in units of this fraction.
SCALE = 1 << 16
#: Errors are summed as whole millionths.
_MILLION = 1_000_000
_LEAST_GAIN = 1e-6
INF = float("inf")


@dataclass(frozen=True)
class BoostParams:
    """Parameters of a fit, by default those of production.

    ``l2`` is added to every row count (the Hessian of squared error). Boosting stops once the mean
    absolute error on the validation rows has not fallen by more than ``tolerance`` in ``patience``
    trees, and keeps the trees up to the best. Predictions are written out every ``store`` trees.
    """

    trees: int = 600
    depth: int = 20
    rate: float = 0.04
    rows: float = 0.8
    columns: float = 0.6
    l2: float = 5.1
    bins: int = 32
    patience: int = 20
    tolerance: float = 0.0
    store: int = 10
    seed: int = 123


@dataclass
class Nodes:
    """Nodes of one tree or several: covariate and bin of the split, the left child (the right one
    follows it; -1 at a leaf) and the leaf's value."""

    covariate: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        self.covariate.append(0)
        self.cut.append(0)
        self.left.append(-1)
        self.value.append(value)
        return len(self.left) - 1

    def split(self, node: int, covariate: int, cut: int, left: float, right: float) -> int:
        self.covariate[node], self.cut[node] = covariate, cut
        self.left[node] = self.add(left)
        self.add(right)
        return self.left[node]


def _array(values: Iterable[float], kind: str) -> str:
    """SQL of a constant array. Spark folds it into one literal, which keeps generated code alike."""
    text = ",".join(repr(v) for v in values)
    return f"cast(split('{text}', ',') AS array<{kind}>)" if text else f"cast(array() AS array<{kind}>)"


def _walk(nodes: Nodes, start: str, depth: int, goes_right: str) -> str:
    """SQL of the node where a row ends that starts at node ``start``. ``goes_right`` compares the
    row with the split of a node ``n``."""
    return (
        f"aggregate(sequence(1, {max(depth, 1)}), {start}, (n, step) -> "
        f"if(_left[n] < 0, n, _left[n] + if({goes_right}, 1, 0)))"
    )


_BY_BIN = "_bins[_covariate[n]] > _cut[n]"


def _with_nodes(df: DataFrame, nodes: Nodes) -> DataFrame:
    return df.selectExpr(
        "*",
        f"{_array(nodes.covariate, 'int')} AS _covariate",
        f"{_array(nodes.cut, 'int')} AS _cut",
        f"{_array(nodes.left, 'int')} AS _left",
        f"{_array(nodes.value, 'double')} AS _value",
    )


def _sum_of_trees(nodes: Nodes, roots: Sequence[int], depth: int, goes_right: str, start: str) -> str:
    if not roots:
        return start
    leaf = _walk(nodes, "root", depth, goes_right)
    return f"aggregate({_array(roots, 'int')}, {start}, (sum, root) -> sum + _value[{leaf}])"


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees: a scorer of rows that hold the covariates as finite doubles."""

    covariates: tuple[str, ...]
    base: float
    cuts: tuple[tuple[float, ...], ...]
    nodes: Nodes
    roots: tuple[int, ...]
    depth: int
    #: Gain of all splits of each covariate.
    gains: tuple[float, ...]
    #: Validation error after each tree, those after the best included.
    errors: tuple[float, ...]
    stopped: int | None = None

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``."""
        limits = [
            self.cuts[f][k] if child >= 0 else 0.0
            for f, k, child in zip(self.nodes.covariate, self.nodes.cut, self.nodes.left)
        ]
        own = F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("_own")
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in self.covariates]).alias("_x")
        read = rows.select(own, values).selectExpr("*", f"{_array(limits, 'double')} AS _limit")
        total = _sum_of_trees(
            self.nodes, self.roots, self.depth, "_x[_covariate[n]] > _limit[n]", f"{self.base!r}D"
        )
        return _with_nodes(read, self.nodes).select("_own.*", F.expr(total).alias("prediction"))


def bin_cuts(train: DataFrame, covariates: Sequence[str], *, bins: int) -> list[list[float]]:
    """The distinct quantiles of every covariate; a row's bin is the number of cuts below its value."""
    pairs = [
        F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").cast("double").alias("v"))
        for i, c in enumerate(covariates)
    ]
    values = train.select(F.explode(F.array(*pairs)).alias("p")).select("p.f", "p.v")
    found = quantiles(values, ["f"], F.col("v"), [i / bins for i in range(1, bins)])
    cuts: list[list[float]] = [[] for _ in covariates]
    for row in found.collect():
        cuts[row[0]] = sorted({x for x in row[1:] if x is not None})
    return cuts


def with_bins(rows: DataFrame, covariates: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """``rows`` with ``_bins``."""
    bins = ", ".join(
        f"size(filter({_array(own, 'double')}, __cut -> __cut < cast(`{name}` AS double)))"
        for name, own in zip(covariates, cuts)
    )
    return rows.selectExpr("*", f"array({bins}) AS _bins")


def gradient(prediction: Column, target: Column) -> Column:
    """Gradient of half the squared error in whole units of ``1 / SCALE``."""
    return F.floor((prediction - target) * SCALE + 0.5).cast("long")


def drawn(tree: int, share: float, seed: int) -> Column:
    """Does the tree see the row? Decided by the row's bins and target."""
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64("_bins", "_target", F.lit(seed), F.lit(tree)), F.lit(10_000)) < round(10_000 * share)


def histogram(rows: DataFrame, covariates: Sequence[int]) -> DataFrame:
    """Gradient sum and row count of every (``node``, ``f``, ``bin``) of ``rows`` (``node``, ``_g``, ``_bins``)."""
    taken = F.expr(f"transform({_array(covariates, 'int')}, f -> struct(f AS f, _bins[f] AS bin))")
    return (
        rows.select("node", "_g", F.explode(taken).alias("p"))
        .groupBy("node", "p.f", "p.bin")
        .agg(F.sum("_g").alias("g"), F.count(F.lit(1)).alias("n"))
    )


def best_splits(
    sums: DataFrame,
    *,
    l2: float,
    rising: Sequence[bool],
    low: Sequence[float],
    high: Sequence[float],
) -> DataFrame:
    """The split of the highest gain of each ``node`` that has one.

    ``low`` and ``high`` bound the weights of each node's children, ``rising`` marks constrained
    covariates. Equal gains go to the first covariate and the lowest bin.
    """
    by = Window.partitionBy("node", "f")
    until = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = sums.select(
        "node", "f", "bin",
        F.sum("g").over(until).alias("gl"), F.sum("n").over(until).alias("nl"),
        F.sum("g").over(by).alias("ga"), F.sum("n").over(by).alias("na"),
    ).where("nl < na")

    def weight(g: str, n: str) -> str:
        return f"greatest(least(-({g} / {SCALE}D) / ({n} + {l2!r}D), _high), _low)"

    def score(w: str, g: str, n: str) -> str:
        return f"(-(2D * ({g} / {SCALE}D) * {w} + ({n} + {l2!r}D) * {w} * {w}))"

    marks = _array([int(r) for r in rising], "int")
    weighed = (
        sides.selectExpr(
            "*", "ga - gl AS gr", "na - nl AS nr",
            f"{_array(low, 'double')}[node] AS _low", f"{_array(high, 'double')}[node] AS _high",
        )
        .selectExpr(
            "*", f"{weight('gl', 'nl')} AS wl", f"{weight('gr', 'nr')} AS wr", f"{weight('ga', 'na')} AS wa"
        )
        .where(f"{marks}[f] = 0 OR wl <= wr")
        .selectExpr(
            "node", "f", "bin", "wl", "wr",
            f"{score('wl', 'gl', 'nl')} + {score('wr', 'gr', 'nr')} - {score('wa', 'ga', 'na')} AS gain",
        )
        .where(F.col("gain") > _LEAST_GAIN)
    )
    best = F.max(F.struct("gain", (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"), "wl", "wr"))
    return weighed.groupBy("node").agg(best.alias("s")).selectExpr(
        "node", "s.gain", "-s.f AS f", "-s.bin AS bin", "s.wl", "s.wr"
    )


class _Fit:
    """The state of a fit: rows with the predictions of the trees written so far, and the rest."""

    def __init__(self, rows: DataFrame, covariates: Sequence[str], rising: Sequence[bool], params: BoostParams):
        self.params, self.covariates, self.rising = params, covariates, rising
        self.spark = rows.sparkSession
        self.path: str | None = None
        self.nodes, self.roots = Nodes(), []
        self.pending, self.pending_roots = Nodes(), []
        self.gains = [0.0] * len(covariates)
        self._store(rows)

    def _store(self, rows: DataFrame) -> None:
        before, self.path = self.path, fresh_path(self.spark, "boosted")
        self.rows = stage(rows, "boosted", path=self.path)
        if before:
            remove(self.spark, before)

    def predicted(self) -> DataFrame:
        """Rows with the predictions of all trees, as ``_pred``."""
        if not self.pending_roots:
            return self.rows
        total = _sum_of_trees(self.pending, self.pending_roots, self.params.depth, _BY_BIN, "_pred")
        scored = _with_nodes(self.rows, self.pending).withColumn("_sum", F.expr(total))
        return scored.select("_val", "_bins", "_target", F.col("_sum").alias("_pred"))

    def grow(self, tree: int) -> bool:
        """Add one tree; False if no split gains anything."""
        p, nodes = self.params, Nodes()
        names = range(len(self.covariates))
        share = max(1, round(p.columns * len(self.covariates)))
        taken = sorted(random.Random(f"{p.seed}/{tree}").sample(names, share))
        root, low, high = nodes.add(0.0), {0: -INF}, {0: INF}
        sample = self.predicted().where(~F.col("_val") & drawn(tree, p.rows, p.seed))
        sample = sample.select("_bins", gradient(F.col("_pred"), F.col("_target")).alias("_g"))
        open_ = [root]
        for depth in range(p.depth):
            slot = [-1] * len(nodes.left)
            for i, node in enumerate(open_):
                slot[node] = i
            placed = _with_nodes(sample, nodes).selectExpr(
                "_bins", "_g", f"{_array(slot, 'int')}[{_walk(nodes, '0', depth, _BY_BIN)}] AS node"
            )
            found = best_splits(
                histogram(placed.where("node >= 0"), taken),
                l2=p.l2, rising=self.rising,
                low=[low[n] for n in open_], high=[high[n] for n in open_],
            ).collect()
            after = []
            for s in sorted(found, key=lambda s: s.node):
                node = open_[s.node]
                left = nodes.split(node, s.f, s.bin, s.wl * p.rate, s.wr * p.rate)
                self.gains[s.f] += s.gain
                middle = (s.wl + s.wr) / 2
                for child in (left, left + 1):
                    low[child], high[child] = low[node], high[node]
                if self.rising[s.f]:
                    high[left], low[left + 1] = min(high[node], middle), max(low[node], middle)
                after += [left, left + 1]
            if not after:
                break
            open_ = after
        if nodes.left[root] < 0:
            return False
        for held, roots in ((self.nodes, self.roots), (self.pending, self.pending_roots)):
            at = len(held.left)
            roots.append(at)
            held.covariate += nodes.covariate
            held.cut += nodes.cut
            held.left += [x + at if x >= 0 else -1 for x in nodes.left]
            held.value += nodes.value
        if len(self.pending_roots) >= p.store:
            self._store(self.predicted())
            self.pending, self.pending_roots = Nodes(), []
        return True

    def error(self) -> float:
        """Mean absolute error on the validation rows."""
        off = F.floor(F.abs(F.col("_pred") - F.col("_target")) * _MILLION + 0.5).cast("decimal(38,0)")
        total, n = self.predicted().where("_val").agg(F.sum(off), F.count(F.lit(1))).first()
        return float(total) / _MILLION / n if n else 0.0


def fit_boosted(
    train: DataFrame,
    val: DataFrame,
    *,
    covariates: Sequence[str],
    rising: Sequence[str] = (),
    params: BoostParams = BoostParams(),
    target: str = "target",
    watch: Callable[[int, float], bool] | None = None,
) -> BoostedTrees:
    """Fit on ``train`` by the error on ``val``; covariates are finite doubles, none of them null.

    ``rising`` names the covariates with which predictions must not fall. ``watch`` sees the number
    of trees and the validation error after each and may end the fit. Rows without a target take no
    part. Without training rows, or if no split gains anything, all predictions are the mean.
    Without validation rows all trees are grown.
    """
    known = F.col(f"`{target}`").isNotNull()
    train, val = train.where(known), val.where(known)
    cuts = bin_cuts(train, covariates, bins=params.bins)
    cents = F.floor(F.col(f"`{target}`").cast("double") * SCALE + 0.5).cast("decimal(38,0)")
    total, n = train.agg(F.sum(cents), F.count(F.lit(1))).first()
    base = float(total) / SCALE / n if n else 0.0

    def prepared(rows: DataFrame, is_val: bool) -> DataFrame:
        return with_bins(rows, covariates, cuts).select(
            F.lit(is_val).alias("_val"), "_bins",
            F.col(f"`{target}`").cast("double").alias("_target"), F.lit(base).alias("_pred"),
        )

    marks = [c in set(rising) for c in covariates]
    fit = _Fit(prepared(train, False).union(prepared(val, True)), covariates, marks, params)
    has_val = not val.isEmpty()
    errors, best, kept, stopped = [], INF, 0, None
    for tree in range(params.trees if n else 0):
        if not fit.grow(tree):
            break
        if not has_val:
            kept = len(fit.roots)
            continue
        errors.append(fit.error())
        if errors[-1] < best - params.tolerance:
            best, kept = errors[-1], len(fit.roots)
        if watch is not None and watch(len(errors), errors[-1]):
            stopped = len(errors)
            break
        if len(fit.roots) - kept >= params.patience:
            break
    remove(fit.spark, fit.path)
    return BoostedTrees(
        tuple(covariates), base, tuple(map(tuple, cuts)), fit.nodes, tuple(fit.roots[:kept]),
        params.depth, tuple(fit.gains), tuple(errors), stopped,
    )


def importance(model: BoostedTrees) -> Mapping[str, float]:
    """Each covariate's share of the gain of all splits."""
    total = sum(model.gains)
    return {c: g / total if total else 0.0 for c, g in zip(model.covariates, model.gains)}
