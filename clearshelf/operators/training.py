"""Demand model: encoded covariates and monotone boosted trees with early stopping on a validation split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearshelf.functions.numeric import finite
from clearshelf.operators.boosting import BoostedTrees, BoostParams, fit_boosted, importance
from clearshelf.operators.encoding import apply_codes, category_codes, target_prior
from clearshelf.operators.second_level import DISCOUNTS
from clearshelf.operators.tuning import SEARCHED, TRIALS, Space, tune_boosted

# The encoded categories.
ENCODED = ("club_nbr", "department_nbr", "subclass_nbr", "week", "month")
# Covariates with which predictions must not fall.
CONSTRAINED = ("num_weeks", *DISCOUNTS)
MISSING = -999.0
TreeParams = BoostParams


@dataclass(frozen=True)
class Encoder:
    """Codes and prior fitted on training rows, for any set of rows that is to be scored."""

    codes: DataFrame
    prior: DataFrame
    covariates: tuple[str, ...]

    def encode(self, rows: DataFrame) -> DataFrame:
        """Encoded, finite covariates, with a sentinel for what is missing."""
        cols = [c for c in ENCODED if c in self.covariates]
        encoded = apply_codes(self.codes, self.prior, rows, cols=cols)
        filled = {
            c: F.coalesce(finite(F.col(c).cast("double")), F.lit(MISSING)) for c in self.covariates
        }
        return encoded.withColumns(filled)


def fit_encoder(
    train: DataFrame,
    *,
    covariates: Sequence[str],
    target: str = "target",
    store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> Encoder:
    """``store`` may write the few codes out and read them back: the planner then knows their size."""
    cols = [c for c in ENCODED if c in covariates]
    codes = store(category_codes(train, cols=cols, target=target), "category_codes")
    prior = store(target_prior(train, target=target), "prior")
    return Encoder(codes, prior, tuple(covariates))


@dataclass(frozen=True)
class DemandModel:
    """Encoder and trees: a scorer for rows that hold the covariates as they are."""

    encoder: Encoder
    trees: BoostedTrees

    def __call__(self, samples: DataFrame) -> DataFrame:
        """``samples`` with ``prediction``; their own columns stay as they were."""
        own = F.struct(*[samples[f"`{c}`"] for c in samples.columns]).alias("_own")
        rows = samples.select(own, *self.encoder.covariates)
        scored = self.trees.transform(self.encoder.encode(rows))
        return scored.select("_own.*", "prediction")


def _rising(covariates: Sequence[str], constrained: Sequence[str]) -> list[str]:
    return [c for c in covariates if c in constrained]


def train_model(
    train: DataFrame,
    val: DataFrame,
    *,
    covariates: Sequence[str],
    params: TreeParams = TreeParams(),
    target: str = "target",
    constrained: Sequence[str] = CONSTRAINED,
) -> BoostedTrees:
    """Fit on ``train``; boosting stops when the error on ``val`` no longer falls.

    Both inputs hold encoded covariates. Predictions never fall with those that are ``constrained``.
    """
    rising = _rising(covariates, constrained)
    return fit_boosted(train, val, covariates=covariates, rising=rising, params=params, target=target)


def tune_model(
    train: DataFrame,
    val: DataFrame,
    *,
    covariates: Sequence[str],
    space: Space = SEARCHED,
    trials: int = TRIALS,
    start: int = 8,
    base: TreeParams = TreeParams(),
    target: str = "target",
    constrained: Sequence[str] = CONSTRAINED,
) -> DataFrame:
    """Validation MAE of the parameter settings of a sequential search, best first.

    ``space`` names the values of each searched parameter: learning rate, depth, the shares of rows
    and columns of a tree, L2. The first ``start`` trials are drawn at random.
    """
    return tune_boosted(
        train, val, covariates=covariates, rising=_rising(covariates, constrained), space=space,
        trials=trials, start=start, base=base, target=target,
    )


def feature_importance(model: BoostedTrees) -> DataFrame:
    """Importance of each covariate: its share of the gain of all splits."""
    rows = list(importance(model).items())
    return SparkSession.active().createDataFrame(rows, "covariate string, importance double")
