"""Hyper-parameter search with cross-validation on the cluster.

The search is sequential: after some random trials, the values of good and of bad trials give
two densities per parameter, and the next trial is the drawn candidate whose ratio of both is
highest (a tree-structured Parzen estimator over independent parameters).  Trials come in
batches that depend on earlier batches only, so they may run side by side and the result does
not depend on which one ends first.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from statistics import median
from typing import Any

from pyspark.sql import DataFrame, functions as F

from loanweave.operators.learning import FeatureSet, Prepared, fit_prepared, parameters, predict_proba, prepare
from loanweave.operators.metrics import ranked_scores, ranking_summary
from loanweave.operators.preparation import LABEL
from loanweave.operators.shared_fits import Fit, Matrix, fit_together, held_out_scores, write_matrix
from loanweave.operators.side_by_side import side_by_side
from loanweave.session import checkpointed

STARTUP_TRIALS, BATCH, CANDIDATES, GOOD_SHARE = 10, 5, 24, 0.25
#: A trial stops after its first fold if that is below the median of so many earlier ones.
STOP_AFTER = 5

# The search spaces.  ("int", low, high, step), ("float", low, high),
# ("log", low, high) or ("choice", values).  
SPACES: dict[str, dict[str, tuple]] = {
    "logistic": {"C": ("log", 1e-4, 10.0), "class_weight": ("choice", ("balanced", None))},
    "random_forest": {
        "n_estimators": ("int", 50, 500, 50),
        "max_depth": ("int", 3, 15, 1),
        "min_samples_leaf": ("int", 5, 100, 5),
        "max_features": ("choice", ("sqrt", "log2", None)),
        "class_weight": ("choice", ("balanced", None)),
    },
    "boosting_a": {
        "n_estimators": ("int", 100, 500, 50),
        "max_depth": ("int", 3, 10, 1),
        "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0),
        "colsample": ("float", 0.5, 1.0),
        "class_weight": ("float", 1.0, 20.0),
    },
    "boosting_b": {
        "n_estimators": ("int", 100, 500, 50),
        "max_depth": ("int", -1, 15, 1),
        "num_leaves": ("int", 10, 100, 1),
        "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.5, 1.0),
        "colsample": ("float", 0.5, 1.0),
        "class_weight": ("choice", ("unbalance", None)),
    },
    "boosting_c": {
        "n_estimators": ("int", 100, 500, 50),
        "max_depth": ("int", 3, 10, 1),
        "learning_rate": ("log", 0.01, 0.3),
        "l2": ("float", 1.0, 10.0),
        "max_bins": ("int", 50, 255, 1),
        "class_weight": ("choice", ("balanced", "sqrt_balanced", None)),
    },
}


def _draw(rng: random.Random, spec: tuple) -> Any:
    kind, *args = spec
    if kind == "int":
        low, high, step = args
        return rng.randrange(low, high + 1, step)
    if kind == "float":
        return rng.uniform(*args)
    if kind == "log":
        return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
    return rng.choice(args[0])


def draw_trials(model: str, trials: int, seed: int = 42, space: Mapping[str, tuple] | None = None) -> list[dict]:
    rng = random.Random(seed)
    chosen = space or SPACES[model]
    return [{n: _draw(rng, spec) for n, spec in chosen.items()} for _ in range(trials)]


@dataclass(frozen=True)
class Trial:
    parameters: dict[str, Any]
    score: float
    first: float
    stopped: bool = False


class Density:
    """Density of one parameter over trials, with one trial's worth of the uniform prior."""

    def __init__(self, spec: tuple, values: Sequence[Any]):
        self.kind, *self.spec = spec
        if self.kind == "choice":
            options = list(self.spec[0])
            counts = [1 / len(options) + sum(v == o for v in values) for o in options]
            self.options = {k: (o, c / sum(counts)) for k, (o, c) in enumerate(zip(options, counts))}
            return
        self.low, self.high = self._inner(self.spec[0]), self._inner(self.spec[1])
        self.range = (self.high - self.low) or 1.0
        self.centres = sorted(self._inner(v) for v in values)
        ends = [self.low, *self.centres, self.high]
        # a point is as wide as its farther neighbour is away, within bounds
        least = self.range / min(100, 1 + len(self.centres))
        self.widths = [
            min(self.range, max(least, ends[k + 1] - ends[k], ends[k + 2] - ends[k + 1]))
            for k in range(len(self.centres))
        ]

    def _inner(self, value: float) -> float:
        return math.log(value) if self.kind == "log" else float(value)

    def draw(self, rng: random.Random) -> Any:
        if self.kind == "choice":
            pairs = list(self.options.values())
            return rng.choices([o for o, _ in pairs], [w for _, w in pairs])[0]
        k = rng.randrange(len(self.centres) + 1)
        if k == len(self.centres):
            return _draw(rng, (self.kind, *self.spec))
        inner = rng.gauss(self.centres[k], self.widths[k])
        while not self.low <= inner <= self.high:
            inner = rng.gauss(self.centres[k], self.widths[k])
        if self.kind == "int":
            low, high, step = self.spec
            return min(low + (high - low) // step * step, low + round((inner - low) / step) * step)
        return math.exp(inner) if self.kind == "log" else inner

    def log(self, value: Any) -> float:
        if self.kind == "choice":
            return math.log(next(w for o, w in self.options.values() if o == value))
        x = self._inner(value)

        def normal(z: float) -> float:
            return 0.5 * (1 + math.erf(z / math.sqrt(2)))

        total = 1 / self.range
        for c, w in zip(self.centres, self.widths):
            inside = normal((self.high - c) / w) - normal((self.low - c) / w)
            total += math.exp(-0.5 * ((x - c) / w) ** 2) / (w * math.sqrt(2 * math.pi) * inside)
        return math.log(total / (1 + len(self.centres)))


def propose(
    space: Mapping[str, tuple], trials: Sequence[Trial], rng: random.Random, candidates: int = CANDIDATES
) -> dict[str, Any]:
    """The drawn candidate that is likeliest under good trials against bad ones."""
    ranked = sorted(trials, key=lambda t: (t.stopped, -t.score))
    good = ranked[: max(2, math.ceil(GOOD_SHARE * len(ranked)))]
    bad = ranked[len(good):]
    chosen = {}
    for name, spec in space.items():
        likely, unlikely = (Density(spec, [t.parameters[name] for t in part]) for part in (good, bad))
        drawn = [likely.draw(rng) for _ in range(candidates)]
        chosen[name] = max(drawn, key=lambda v: likely.log(v) - unlikely.log(v))
    return chosen


def optimise(
    evaluate: Callable[[dict[str, Any], float], Trial],
    space: Mapping[str, tuple],
    trials: int,
    seed: int = 42,
    startup: int = STARTUP_TRIALS,
    batch: int = BATCH,
    run: Callable[[Sequence[Callable[[], Trial]]], list[Trial]] = lambda tasks: [t() for t in tasks],
) -> list[Trial]:
    """All trials, in order.  ``evaluate`` gets parameters and the least first-fold score to go on."""
    rng, done = random.Random(seed), []
    while len(done) < trials:
        size = min(batch, trials - len(done))
        least = median(t.first for t in done) if len(done) >= STOP_AFTER else -math.inf
        drawn = [
            propose(space, done, rng) if len(done) >= startup else {n: _draw(rng, s) for n, s in space.items()}
            for _ in range(size)
        ]
        done += run([partial(evaluate, p, least) for p in drawn])
    return done


def prepared_folds(
    model: str, df: DataFrame, features: FeatureSet, folds: int = 3, fold: str = "fold"
) -> list[tuple[Prepared, DataFrame]]:
    """Per fold: the written matrix of the other folds, and the fold's own rows, written too.

    One preparation and one write per fold serve all trials.
    """
    parts = []
    for k in range(folds):
        prepared = prepare(model, df.filter(F.col(fold) != k), features)
        held_out = prepared.transform(df.filter(F.col(fold) == k))
        parts.append((prepared, checkpointed(held_out.select(LABEL, "features"))))
    return parts


def cross_validated_auc(
    model: str, parts: Sequence[tuple[Prepared, DataFrame]], overrides: Mapping[str, Any], seed: int = 42
) -> float:
    """Mean AUC over the prepared folds.  A fold that fails raises: a silent 0 would win nothing."""
    scores = None
    for k, (prepared, held_out) in enumerate(parts):
        learner = fit_prepared(model, prepared, overrides, seed=seed).stages[-1]
        scored = predict_proba(learner, held_out).select(
            F.lit(k).alias("fold"), F.col(LABEL).alias("y_true"), "y_proba"
        )
        scores = scored if scores is None else scores.unionByName(scored)
    by_fold = ranking_summary(ranked_scores(scores, ["fold"]), ["fold"])
    return by_fold.agg(F.avg("roc_auc")).first()[0]


def evaluate_trial(
    model: str, parts: Sequence[tuple[Prepared, DataFrame]], fixed: Mapping[str, Any], seed: int,
    drawn: Mapping[str, Any], least: float,
) -> Trial:
    """Mean AUC over the folds; the first one alone if it is below ``least``."""
    chosen = {**drawn, **fixed}
    first = cross_validated_auc(model, parts[:1], chosen, seed)
    if first < least or len(parts) == 1:
        return Trial(chosen, first, first, first < least)
    rest = cross_validated_auc(model, parts[1:], chosen, seed)
    return Trial(chosen, (first + rest * (len(parts) - 1)) / len(parts), first)


def evaluate_together(
    matrix: Matrix, known: list[Fit], drawn: Sequence[Mapping[str, Any]], least: float
) -> list[Trial]:
    """``evaluate_trial`` for the logistic trials of one batch; ``known`` fits of earlier ones get theirs added."""
    folds = len(matrix.folds)

    def scores(wanted: Sequence[tuple[int, int]]) -> dict[tuple[int, int], float]:
        """AUC by (trial, fold)."""
        fits = fit_together(matrix, [(k, drawn[t]) for t, k in wanted], known)
        known.extend(fits)
        found = ranking_summary(ranked_scores(held_out_scores(matrix, fits), ["fit"]), ["fit"])
        return {wanted[r.fit]: r.roc_auc for r in found.select("fit", "roc_auc").collect()}

    everyone = range(len(drawn))
    # before any trial can be stopped, all folds share the passes
    at_once = range(folds) if least == -math.inf else range(1)
    auc = scores([(t, k) for t in everyone for k in at_once])
    first = [auc.get((t, 0)) for t in everyone]
    if None in first:
        raise ValueError("the first fold needs rows of both classes")
    going = [t for t in everyone if first[t] >= least]
    if going and len(at_once) < folds:
        auc |= scores([(t, k) for t in going for k in range(1, folds)])
    done = []
    for t, p in enumerate(drawn):
        # folds of one class have no AUC
        rest = [a for k in range(1, folds) if (a := auc.get((t, k))) is not None]
        score = (first[t] + sum(rest) / len(rest) * (folds - 1)) / folds if rest else first[t]
        done.append(Trial(p, score, first[t], t not in going))
    return done


def search_trials(
    model: str, df: DataFrame, features: FeatureSet, trials: int = 30, folds: int = 3,
    fold: str = "fold", seed: int = 42, space: Mapping[str, tuple] | None = None,
    fixed: Mapping[str, Any] | None = None, workers: int = 1, startup: int = STARTUP_TRIALS, batch: int = BATCH,
) -> list[Trial]:
    """Every trial of the sequential search; each fold's matrix is written once for all of them.

    ``fixed`` parameters are the same in every trial.  ``workers`` trials of a batch run side
    by side; a failed one cancels the others.  Logistic models of a batch are fitted in shared
    passes over one matrix of all folds, whatever the number of workers.
    """
    free = {n: s for n, s in (space or SPACES[model]).items() if n not in (fixed or {})}
    if model == "logistic":
        parameters(model, fixed)  # unknown names fail before any work
        matrix, known = write_matrix(df, features, folds, fold), []

        def evaluate(drawn: Sequence[Mapping[str, Any]], least: float) -> list[Trial]:
            return evaluate_together(matrix, known, [{**p, **(fixed or {})} for p in drawn], least)

        try:
            return optimise(
                lambda p, least: evaluate([p], least)[0], free, trials, seed, startup, batch,
                lambda tasks: evaluate([t.args[0] for t in tasks], tasks[0].args[1]),  # a batch's least is the same
            )
        finally:
            matrix.close()
    parts = prepared_folds(model, df, features, folds, fold)
    return optimise(
        partial(evaluate_trial, model, parts, dict(fixed or {}), seed), free, trials, seed, startup, batch,
        lambda tasks: side_by_side(df.sparkSession, tasks, workers, f"search-{model}"),
    )


def best_trial(trials: Sequence[Trial]) -> Trial:
    """The best of the trials that saw every fold."""
    return max((t for t in trials if not t.stopped), key=lambda t: t.score)


def search(
    model: str, df: DataFrame, features: FeatureSet, trials: int = 30, folds: int = 3,
    fold: str = "fold", seed: int = 42, space: Mapping[str, tuple] | None = None,
    fixed: Mapping[str, Any] | None = None, **options,
) -> tuple[dict, list[tuple[dict, float]]]:
    """Best parameters and every trial with its score (a stopped one's is that of its first fold)."""
    found = search_trials(model, df, features, trials, folds, fold, seed, space, fixed, **options)
    return best_trial(found).parameters, [(t.parameters, t.score) for t in found]


def trials_table(spark, trials: Sequence[Trial]) -> DataFrame:
    rows = [(i, str(t.parameters), float(t.score), t.stopped) for i, t in enumerate(trials)]
    return spark.createDataFrame(rows, "trial int, parameters string, roc_auc double, stopped boolean")
