"""The model line-up on pyspark.ml: logistic, forest, three boosted models, stacking.

Every model is one ``PipelineModel`` from raw feature columns to a probability, so it is
saved, loaded and applied without any side tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from loanweave.operators.boosting import BoostedTrees, Growth, fit_trees
from loanweave.operators.ordered_encoding import ordered_rates
from loanweave.operators.preparation import (
    LABEL, WEIGHT, add_weight, collected_weights, feature_groups, preparation_stages,
)
from loanweave.operators.side_by_side import side_by_side
from loanweave.session import checkpointed

PATIENCE = 50
#: Fits of a stack that run side by side.
WORKERS = 4

# The published default parameters of every model.
DEFAULTS: dict[str, dict[str, Any]] = {
    "logistic": {"C": 1.0, "max_iter": 1000, "class_weight": "balanced"},
    "random_forest": {
        "n_estimators": 100, "max_depth": 10, "min_samples_leaf": 50, "max_features": "sqrt",
        "class_weight": "balanced",
    },
    "boosting_a": {
        "n_estimators": 200, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8,
        "colsample": 0.8, "class_weight": 10.0, "l2": 1.0, "min_hessian": 1.0,
    },
    "boosting_b": {
        "n_estimators": 200, "num_leaves": 31, "max_depth": -1, "learning_rate": 0.05, "subsample": 0.8,
        "bagging_freq": 5, "colsample": 0.8, "class_weight": "unbalance", "l2": 0.0, "min_rows": 20,
    },
    "boosting_c": {
        "n_estimators": 100, "max_depth": 6, "learning_rate": 0.05, "subsample": 1.0,
        "colsample": 1.0, "max_bins": 254, "class_weight": "balanced", "l2": 3.0,
    },
}
NOT_STACKED = ("boosting_c", "ensemble")


@dataclass(frozen=True)
class FeatureSet:
    """Which columns a model uses and which of them are categories."""

    names: Sequence[str]
    categorical: Sequence[str] = field(default_factory=tuple)

    @property
    def groups(self) -> tuple[list[str], list[str]]:
        return feature_groups(self.names, self.categorical)


def parameters(model: str, overrides: Mapping[str, Any] | None = None) -> dict[str, Any]:
    if model not in DEFAULTS:
        raise ValueError(f"unknown model {model!r}; choose from {sorted(DEFAULTS)}")
    unknown = set(overrides or {}) - set(DEFAULTS[model]) - {"max_bins"}
    if unknown:
        raise ValueError(f"{model} has no parameters {sorted(unknown)}")
    return {**DEFAULTS[model], **(overrides or {})}


def _outputs(prefix: str) -> dict[str, str]:
    return {
        "labelCol": LABEL, "featuresCol": f"{prefix}features", "probabilityCol": f"{prefix}probability",
        "rawPredictionCol": f"{prefix}rawPrediction", "predictionCol": f"{prefix}prediction",
    }


def _logistic(p: Mapping[str, Any], total_weight: float, prefix: str, seed: int):
    # C weighs the summed loss, regParam divides it: regParam = 1 / (C x sum of weights).
    return LogisticRegression(
        **_outputs(prefix), weightCol=WEIGHT, maxIter=p["max_iter"], standardization=False,
        regParam=1.0 / (p["C"] * total_weight), elasticNetParam=0.0,
    )


def _forest(p: Mapping[str, Any], total_weight: float, prefix: str, seed: int):
    return RandomForestClassifier(
        **_outputs(prefix), weightCol=WEIGHT, numTrees=p["n_estimators"], maxDepth=p["max_depth"],
        minInstancesPerNode=p["min_samples_leaf"], maxBins=p.get("max_bins", 64),
        featureSubsetStrategy=p["max_features"] or "all", seed=seed,
        cacheNodeIds=True,  # else every pass walks each row down all trees from their roots
    )


def boosting_growth(p: Mapping[str, Any], seed: int, patience: int = PATIENCE) -> Growth:
    """How the trees of a boosted model grow: by leaves if it names a number of them, else by levels."""
    return Growth(
        rounds=p["n_estimators"], learning_rate=p["learning_rate"], max_depth=p["max_depth"] if p["max_depth"] > 0 else None,
        max_leaves=p.get("num_leaves"), l2=p["l2"], min_rows=p.get("min_rows", 1), min_hessian=p.get("min_hessian", 1e-3),
        subsample=p["subsample"], bagging_every=p.get("bagging_freq", 1), colsample=p["colsample"],
        max_bins=p.get("max_bins", 254), patience=patience, seed=seed,
    )


class _Boosting:
    """Fits a boosted model on a matrix of label, weight and features."""

    def __init__(self, p: Mapping[str, Any], total_weight: float, prefix: str, seed: int):
        self.p, self.prefix, self.seed = p, prefix, seed

    def fit(self, matrix: DataFrame, validation: DataFrame | None = None, patience: int = PATIENCE) -> BoostedTrees:
        growth = boosting_growth(self.p, self.seed, patience)
        return BoostedTrees(fit_trees(matrix, growth, f"{self.prefix}features", validation), self.prefix)


BUILDERS: dict[str, Callable] = {
    "logistic": _logistic,
    "random_forest": _forest,
    "boosting_a": _Boosting,
    "boosting_b": _Boosting,
    "boosting_c": _Boosting,
}


def preparation_pipeline(model: str, features: FeatureSet, prefix: str = "") -> Pipeline:
    categorical, numeric = features.groups
    return Pipeline(stages=preparation_stages(
        categorical, numeric, prefix=prefix, scale=preparation_kind(model)[0],
        target_encode=preparation_kind(model)[1],
    ))


@dataclass(frozen=True)
class Prepared:
    """Fitted preparation stages and the narrow matrix (label, features) they gave.

    The matrix is written once.  A learner passes over it many times, and every model, trial
    and iteration (or a lost executor) reads the file instead of the raw panel.
    """

    stages: Sequence[Any]
    matrix: DataFrame
    prefix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(stages=list(self.stages)).transform(df)


def preparation_kind(model: str) -> tuple[bool, bool]:
    """Models of one kind share their preparation: (scaled numbers, target encoding)."""
    return model == "logistic", model == "boosting_c"


def prepare(model: str, train: DataFrame, features: FeatureSet, prefix: str = "") -> Prepared:
    """Fit the preparation of one kind of model and write the training matrix."""
    fitted = preparation_pipeline(model, features, prefix).fit(train)
    rows = fitted.transform(train)
    categorical, _ = features.groups
    if preparation_kind(model)[1] and categorical:
        # the model learns from rates of earlier rows; new rows get those of all training rows
        rates = [f"{prefix}_rate_{n}" for n in categorical]
        assembler = fitted.stages[-1]
        needed = [n for n in assembler.getInputCols() if n not in rates]
        codes = [f"{prefix}_code_{n}" for n in categorical]
        ordered = ordered_rates(rows.select(LABEL, *needed, *codes), codes)
        rows = assembler.transform(ordered.withColumnsRenamed({f"{c}__rate": r for c, r in zip(codes, rates)}))
    matrix = checkpointed(rows.select(LABEL, f"{prefix}features"))
    return Prepared(fitted.stages, matrix, prefix)


def fit_prepared(
    model: str, prepared: Prepared, overrides: Mapping[str, Any] | None = None,
    validation: DataFrame | None = None, seed: int = 42, patience: int = PATIENCE,
) -> PipelineModel:
    """Fit one model on a written matrix; see ``fit_model``."""
    p = parameters(model, overrides)
    weights = collected_weights(prepared.matrix, p["class_weight"])
    if set(weights) != {0, 1}:
        raise ValueError(f"training needs both classes, found {sorted(weights)}")
    weighted = add_weight(prepared.matrix, weights)
    total = weighted.agg(F.sum(WEIGHT)).first()[0]
    learner = BUILDERS[model](p, total, prepared.prefix, seed)
    if validation is not None and model.startswith("boosting"):
        held_out = prepared.transform(add_weight(validation, weights)).select(
            LABEL, WEIGHT, f"{prepared.prefix}features"
        )
        fitted = learner.fit(weighted, held_out, patience)
    else:
        fitted = learner.fit(weighted)
    return PipelineModel(stages=[*prepared.stages, fitted])


def fit_model(
    model: str,
    train: DataFrame,
    features: FeatureSet,
    overrides: Mapping[str, Any] | None = None,
    validation: DataFrame | None = None,
    prefix: str = "",
    seed: int = 42,
    patience: int = PATIENCE,
) -> PipelineModel:
    """Fit one model.

    With a validation set a boosted model keeps the rounds up to the best validation loss;
    rounds count until none of ``patience`` rounds in a row improves on the best.
    """
    parameters(model, overrides)  # unknown names fail before any work
    prepared = prepare(model, train, features, prefix)
    return fit_prepared(model, prepared, overrides, validation, seed, patience)


def best_round(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds up to the smallest loss met before ``patience`` rounds bring no better one."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


# ------------------------------------------------------------------ prediction


def positive(probability: str = "probability"):
    """Probability of the positive class as a plain double."""
    return vector_to_array(F.col(probability))[1]


def predict_proba(
    model: PipelineModel, df: DataFrame, output: str = "y_proba", prefix: str = ""
) -> DataFrame:
    """The input rows plus the probability; label and prediction stay on one row."""
    scored = model.transform(df)
    return scored.select(*df.columns, positive(f"{prefix}probability").alias(output))


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    scored = predict_proba(model, df)
    return scored.withColumn("y_pred", F.when(F.col("y_proba") >= threshold, 1).otherwise(0))


def score_customers(
    model: PipelineModel, df: DataFrame, name: str, key: str, target: str = "target"
) -> DataFrame:
    """Batch scoring table; the true label and a correct flag when the target is there."""
    scored = predict_proba(model, df, "predicted_probability")
    called = F.when(F.col("predicted_probability") >= 0.5, 1).otherwise(0)
    outputs = [
        F.col(key), F.col("predicted_probability"), called.alias("predicted_default"),
        F.lit(name).alias("model_used"),
    ]
    if target in df.columns:
        truth = F.col(target).cast("int")
        outputs += [truth.alias("true_default"), (called == truth).alias("correct")]
    return scored.select(*outputs)


def save_model(model: PipelineModel, directory: str, name: str) -> None:
    model.write().overwrite().save(f"{directory.rstrip('/')}/{name}")


def load_model(directory: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{directory.rstrip('/')}/{name}")


# ------------------------------------------------------------------ stacking


def stackable(models: Sequence[str]) -> list[str]:
    return [m for m in models if m not in NOT_STACKED]


def _cost(models: Sequence[str]) -> int:
    """About how long fits take, one after the other."""
    return sum({"logistic": 1, "random_forest": 2}.get(m, 4) for m in models)


def _fold_fits(
    models: Sequence[str], train: DataFrame, features: FeatureSet, folds: int,
    overrides: Mapping[str, Mapping[str, Any]] | None, fold: str, seed: int,
) -> list[Callable[[], tuple[int, dict[str, PipelineModel]]]]:
    """One task per fold and kind of preparation: the models of that kind, fitted outside of the fold."""
    kinds: dict[tuple[bool, bool], list[str]] = {}
    for name in models:
        kinds.setdefault(preparation_kind(name), []).append(name)

    def task(k: int, names: Sequence[str]) -> tuple[int, dict[str, PipelineModel]]:
        prepared = prepare(names[0], train.filter(F.col(fold) != k), features)
        return k, {n: fit_prepared(n, prepared, (overrides or {}).get(n), seed=seed) for n in names}

    longest_first = sorted(kinds.values(), key=_cost, reverse=True)
    return [partial(task, k, names) for names in longest_first for k in range(folds)]


def _fold_scores(
    fitted: Sequence[tuple[int, dict[str, PipelineModel]]], models: Sequence[str], train: DataFrame, folds: int, fold: str
) -> DataFrame:
    parts = []
    for k in range(folds):
        scored = train.filter(F.col(fold) == k)
        mine = {n: m for j, found in fitted if j == k for n, m in found.items()}
        for name in models:
            scored = predict_proba(mine[name], scored, f"p_{name}")
        parts.append(scored)
    return reduce(DataFrame.unionByName, parts)


def out_of_fold(
    models: Sequence[str], train: DataFrame, features: FeatureSet, folds: int = 3,
    overrides: Mapping[str, Mapping[str, Any]] | None = None, fold: str = "fold", seed: int = 42, workers: int = WORKERS,
) -> DataFrame:
    """Each row's base probabilities from models that never saw the row's fold."""
    tasks = _fold_fits(models, train, features, folds, overrides, fold, seed)
    fitted = side_by_side(train.sparkSession, tasks, workers, "folds")
    return _fold_scores(fitted, models, train, folds, fold)


def fit_stack(
    models: Sequence[str], train: DataFrame, features: FeatureSet, folds: int = 3,
    overrides: Mapping[str, Mapping[str, Any]] | None = None,
    meta: Mapping[str, Any] | None = None, fold: str = "fold", seed: int = 42,
    meta_model: str = "logistic", workers: int = WORKERS,
) -> PipelineModel:
    """Stacked model: base probabilities into ``meta_model``, balanced logistic by default.

    ``train`` carries an entity-level ``fold`` column.  The meta model learns from
    out-of-fold probabilities; the bases are then refitted on all rows.  The result is one
    PipelineModel.  With a single usable base model that model is returned alone.

    The fits of folds and of bases need nothing of each other, so ``workers`` of them run side by
    side; the result does not depend on how many.
    """
    bases = stackable(models)
    if not bases:
        raise ValueError(f"no model of {list(models)} can be stacked")
    if len(bases) == 1:
        return fit_model(bases[0], train, features, (overrides or {}).get(bases[0]), seed=seed)
    in_folds = _fold_fits(bases, train, features, folds, overrides, fold, seed)
    longest_first = sorted(bases, key=lambda n: -_cost([n]))
    whole = [
        partial(fit_model, n, train, features, (overrides or {}).get(n), prefix=f"{n}_", seed=seed) for n in longest_first
    ]
    # the folds' first kind is the longest; a long fit that begins last would be waited for alone
    first = in_folds[:folds]
    done = side_by_side(train.sparkSession, [*first, *whole, *in_folds[folds:]], workers, "stack")
    fitted = [*done[:folds], *done[folds + len(whole) :]]
    refitted = dict(zip(longest_first, done[folds : folds + len(whole)]))
    scored = checkpointed(
        _fold_scores(fitted, bases, train, folds, fold).select(LABEL, *[f"p_{n}" for n in bases])
    )
    p = parameters(meta_model, meta)
    weights = collected_weights(scored, p["class_weight"])
    assembler = VectorAssembler(inputCols=[f"p_{n}" for n in bases], outputCol="features")
    matrix = checkpointed(
        assembler.transform(add_weight(scored, weights)).select(LABEL, WEIGHT, "features")
    )
    total = matrix.agg(F.sum(WEIGHT)).first()[0]
    top = BUILDERS[meta_model](p, total, "", seed).fit(matrix)

    stages = []
    for name in bases:
        prefix = f"{name}_"
        stages += [
            *refitted[name].stages,
            VectorSlicer(inputCol=f"{prefix}probability", outputCol=f"_p_{name}", indices=[1]),
        ]
    stages.append(VectorAssembler(inputCols=[f"_p_{n}" for n in bases], outputCol="features"))
    return PipelineModel(stages=[*stages, top])


def average_probability(df: DataFrame, columns: Sequence[str], output: str = "y_proba") -> DataFrame:
    total = F.lit(0.0)
    for name in columns:
        total = total + F.col(name)
    return df.withColumn(output, total / len(columns))
