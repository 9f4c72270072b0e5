"""Sequential search for boosting parameters: a Parzen sampler that learns from earlier trials, and a
rule that ends trials whose validation curve lags behind."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from clearshelf.operators.boosting import BoostParams, fit_boosted

Setting = dict[str, float]
Space = Mapping[str, Sequence[float]]


def steps(low: float, high: float, step: float) -> tuple[float, ...]:
    """The values from ``low`` to ``high`` at equal distances."""
    return tuple(round(low + i * step, 10) for i in range(round((high - low) / step) + 1))


# The searched ranges.
SEARCHED: Space = {
    "rate": steps(0.001, 0.051, 0.01),
    "depth": tuple(range(14, 39, 2)),
    "columns": steps(0.6, 0.9, 0.1),
    "rows": steps(0.6, 0.9, 0.1),
    "l2": steps(3.1, 10.1, 1.0),
}
# Fixed value: trials of a search.
TRIALS = 50


@dataclass
class ParzenSampler:
    """Draws settings where good trials are dense and bad ones are not.

    The first ``start`` settings are uniform. From then on the best trials (a quarter, ``most_good`` at
    most) and the others each give a density per parameter: a kernel on every trial's value plus one
    uniform part. Of ``candidates`` settings drawn from the good density, the one with the highest
    ratio of good to bad is taken; settings tried before are passed over while others are at hand.
    """

    space: Space
    seed: int
    start: int = 8
    candidates: int = 24
    most_good: int = 25
    done: list[tuple[float, Setting]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._random = random.Random(self.seed)

    def add(self, setting: Setting, loss: float) -> None:
        self.done.append((loss, setting))

    def _density(self, name: str, trials: Sequence[Setting]) -> list[float]:
        """Probability of each value of a parameter."""
        values = self.space[name]
        places = {v: i for i, v in enumerate(values)}
        width = max(len(values) / (1 + math.sqrt(len(trials))) / 2, 0.5)
        total = [1 / len(values)] * len(values)
        for trial in trials:
            kernel = [math.exp(-(((i - places[trial[name]]) / width) ** 2) / 2) for i in range(len(values))]
            area = sum(kernel)
            total = [t + k / area for t, k in zip(total, kernel)]
        return [t / (len(trials) + 1) for t in total]

    def ask(self) -> Setting:
        """The next setting to try."""
        tried = [s for _, s in self.done]
        if len(tried) < self.start:
            drawn = [{n: self._random.choice(v) for n, v in self.space.items()} for _ in range(self.candidates)]
            return next((s for s in drawn if s not in tried), drawn[0])
        ranked = [s for _, s in sorted(self.done, key=lambda t: t[0])]
        n_good = min(math.ceil(len(ranked) / 4), self.most_good)
        good = {n: self._density(n, ranked[:n_good]) for n in self.space}
        bad = {n: self._density(n, ranked[n_good:]) for n in self.space}

        def draw() -> Setting:
            return {n: self._random.choices(v, good[n])[0] for n, v in self.space.items()}

        def worth(setting: Setting) -> float:
            return sum(
                math.log(good[n][v.index(setting[n])] / bad[n][v.index(setting[n])])
                for n, v in self.space.items()
            )

        drawn = [draw() for _ in range(self.candidates)]
        return max([s for s in drawn if s not in tried] or drawn, key=worth)


@dataclass
class Halving:
    """Ends a trial at a rung (a number of trees) if its error there is in the worse half of all
    trials that have reached the rung, once ``least`` of them have."""

    rungs: Sequence[int]
    least: int = 4
    seen: dict[int, list[float]] = field(default_factory=dict)

    def stops(self, trees: int, error: float) -> bool:
        if trees not in self.rungs:
            return False
        reached = self.seen.setdefault(trees, [])
        reached.append(error)
        better = sum(e < error for e in reached)
        return len(reached) >= self.least and 2 * better >= len(reached)


def search(
    objective: Callable[[Setting, Callable[[int, float], bool]], tuple[float, int, int | None]],
    sampler: ParzenSampler,
    halving: Halving,
    *,
    trials: int,
) -> list[tuple[int, Setting, float, int, int | None]]:
    """(trial, setting, loss, trees, tree it was stopped at) of all trials in their order.

    ``objective`` takes a setting and the rule to ask after each tree, and gives the lowest error,
    the trees grown and where it was stopped, if it was.
    """
    found = []
    for trial in range(trials):
        setting = sampler.ask()
        loss, trees, stopped = objective(setting, halving.stops)
        sampler.add(setting, loss)
        found.append((trial, setting, loss, trees, stopped))
    return found


def tune_boosted(
    train: DataFrame,
    val: DataFrame,
    *,
    covariates: Sequence[str],
    rising: Sequence[str] = (),
    space: Space = SEARCHED,
    trials: int = TRIALS,
    base: BoostParams = BoostParams(),
    start: int = 8,
    target: str = "target",
) -> DataFrame:
    """Validation MAE of the settings tried, best first; one distributed fit per trial, in turn.

    Every trial's setting follows from those before it and the seed of ``base``. Trials that lag at an
    eighth, a quarter or half of the trees end there (``stopped_at``, else null); their error up to
    then counts.
    """
    rungs = sorted({max(1, base.trees // part) for part in (8, 4, 2)} - {base.trees})

    def objective(setting: Setting, stops: Callable[[int, float], bool]):
        params = replace(base, **{n: int(v) if n == "depth" else v for n, v in setting.items()})
        model = fit_boosted(
            train, val, covariates=covariates, rising=rising, params=params, target=target, watch=stops
        )
        return min(model.errors, default=math.inf), len(model.errors), model.stopped

    sampler = ParzenSampler(space, base.seed, start=start)
    found = search(objective, sampler, Halving(rungs), trials=trials)
    rows = []
    for trial, setting, loss, trees, stopped in sorted(found, key=lambda t: (t[2], t[0])):
        full = {n: setting.get(n, getattr(base, n)) for n in SEARCHED}
        rows.append((
            trial, float(full["rate"]), int(full["depth"]), float(full["rows"]), float(full["columns"]),
            float(full["l2"]), float(loss), trees, stopped,
        ))
    schema = (
        "trial int, learning_rate double, max_depth int, row_share double, column_share double, l2 double, "
        "val_mae double, n_trees int, stopped_at int"
    )
    return train.sparkSession.createDataFrame(rows, schema)
