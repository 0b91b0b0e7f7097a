"""Dataset, feature-preparation, model, calibration and importance queries.

Fitting a model has no SQL counterpart, so those queries have none; whatever is SQL-like
about them (encodings, weights, scaling, the dataset itself) is compared.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanweave.columns import CATEGORICAL_FEATURES, DROP_FEATURES, KEY, TIME
from loanweave.operators import (
    calibration, cleaning, features, importance, learning, loans, preparation, splits, target, tuning,
)
from loanweave.operators.preparation import LABEL
from loanweave.plans import customers, dataset, modelling
from loanweave.plans.adapters import ORIGINATION_EXPRESSIONS
from loanweave.plans.catalog_cleaning import LOANS_CLEAN_SQL
from loanweave.plans.catalog_metrics import rounded
from loanweave.plans.catalog_panel import _ISLANDS, _SPLIT, ALL_FEATURES, ALL_FEATURES_SQL, W, rounded_features, target_sql
from loanweave.plans.registry import query, r6
from loanweave.session import checkpointed, ensure_checkpoint_dir
from loanweave.sources import layers

# Some registered queries bound the iterations of the fits, so that they run in minutes on one
# machine; the library's defaults are higher.  Rows, features, folds, trees of the forest and repeats
# are not reduced, and `ml_14` and the models of the stack have all iterations.
FEWER_ROUNDS, PATIENCE = {"n_estimators": 12}, 4
OVERRIDES = {"logistic": {"max_iter": 100}, "boosting_a": FEWER_ROUNDS, "boosting_b": FEWER_ROUNDS}
STACK_BASES = ["logistic", "random_forest", "boosting_a", "boosting_b"]
TRIALS = 6
IDS = ["row_id", KEY, "split"]


class Training:
    """The modelling rows of one directory, written once because models read them often."""

    def __init__(self, t, folds: int = 3):
        rows = dataset.training_frame(dataset.create_dataset(t.loans(), t.panel()))
        self.rows = checkpointed(splits.add_fold(rows, folds))
        self.features = dataset.feature_set(self.rows)

    def part(self, split):
        return self.rows.filter(F.col("split") == split)

    def fit(self, name, **options):
        validation = self.part("validation") if name.startswith("boosting") else None
        patience = PATIENCE if OVERRIDES.get(name) is FEWER_ROUNDS else learning.PATIENCE
        return learning.fit_model(
            name, self.part("train"), self.features, OVERRIDES.get(name), validation, patience=patience, **options
        )


def predictions(model, rows):
    return learning.predict_proba(model, rows).select("row_id", F.col(LABEL).alias("y_true"), "y_proba")


# ---------------------------------------------------------------- dataset

_DATASET_SQL = target_sql() + f""", dataset as (select *, {_SPLIT} as split from labelled where {_SPLIT} is not null)"""


_STATIC = (
    "CREDIT_SCORE FIRST_TIME_HOMEBUYER_FLAG MSA MI_PERCENTAGE NUMBER_OF_UNITS OCCUPANCY_STATUS ORIGINAL_CLTV "
    "ORIGINAL_DTI ORIGINAL_UPB ORIGINAL_LTV ORIGINAL_INTEREST_RATE CHANNEL PPM_FLAG PROPERTY_STATE PROPERTY_TYPE "
    "LOAN_PURPOSE ORIGINAL_LOAN_TERM NUMBER_OF_BORROWERS"
).split()
_CURRENT = (
    "CURRENT_ACTUAL_UPB ELTV INTEREST_BEARING_UPB CURRENT_LOAN_DELINQUENCY_STATUS LOAN_AGE "
    "REMAINING_MONTHS_TO_LEGAL_MATURITY MODIFICATION_FLAG CURRENT_INTEREST_RATE"
).split()
_MODEL_FEATURES = [n for n in ALL_FEATURES if n not in DROP_FEATURES]


FRAME_COLUMNS = [KEY, TIME, "target", "split", *_STATIC, *_CURRENT, *_MODEL_FEATURES]
FRAME_CTES = _DATASET_SQL + _ISLANDS
FRAME_SQL = (
    f"select d.{KEY}, d.{TIME}, d.target, d.split, {', '.join(f'l.{n}' for n in _STATIC)}, {', '.join(f'p.{n}' for n in _CURRENT)}, "
    f"{', '.join(f'f.{n}' for n in _MODEL_FEATURES)} from dataset d join loans_clean l using ({KEY}) "
    f"join panel_clean p using ({KEY}, {TIME}) join (select {KEY}, {TIME}, {ALL_FEATURES_SQL} from islands {W}) f using ({KEY}, {TIME})"
)


def dataset_frame(t):
    """Every column that reaches a model."""
    df = dataset.create_dataset(t.loans(), t.panel())
    return df.select(*[n for n in FRAME_COLUMNS if n not in _MODEL_FEATURES], *rounded_features(df, _MODEL_FEATURES))


@query("drv_11_dataset", FRAME_SQL, uses="loans panel", ctes=FRAME_CTES)
def _(t):
    return dataset_frame(t)


# ---------------------------------------------------------------- preparation

# the configured categories of the loans and their remaining text columns
_CATEGORIES = [n for n in ORIGINATION_EXPRESSIONS if n in CATEGORICAL_FEATURES or n in ("MSA", "SELLER_NAME")]
_NUMBERS = [n for n in (*_STATIC, "MATURITY_DATE") if n not in (*_CATEGORIES, "MSA", "MATURITY_DATE")]


def _prepared(categorical, numeric, **options) -> Pipeline:
    return Pipeline(stages=preparation.preparation_stages(categorical, numeric, **options))


def _text_sql(n: str) -> str:
    text = f"cast({n} as varchar)"
    return f"case when {n} is null or {text} in ('nan', 'None', '') then 'MISSING' else {text} end"


@query(
    "ml_03_missing_categories",
    f"select {KEY}, {', '.join(f'{_text_sql(n)} as {n}' for n in _CATEGORIES)} from loans",
    uses="loans",
)
def _(t):
    return preparation.fill_missing_categories(t.loans().select(KEY, *_CATEGORIES), _CATEGORIES)


@query(
    "ml_04_category_codes",
    f"select {KEY}, "
    + ", ".join(f"cast(dense_rank() over (order by {_text_sql(n)}) - 1 as double) as code_{n}" for n in _CATEGORIES)
    + " from loans",
    uses="loans",
)
def _(t):
    df = t.loans().select(KEY, *_CATEGORIES)
    codes = [F.col(f"_code_{n}").alias(f"code_{n}") for n in _CATEGORIES]
    return _prepared(_CATEGORIES, []).fit(df).transform(df).select(KEY, *codes)


@query(
    "ml_05_codes_fitted_once",
    f"""select {KEY}, cast(coalesce(code, (select count(*) from known)) as double) as code from
    (select {KEY}, {_text_sql('MSA')} as v from loans where vintage_year >= 2009)
    left join known using (v)""",
    uses="loans",
    ctes=f"known as (select v, dense_rank() over (order by v) - 1 as code from (select distinct {_text_sql('MSA')} as v from loans where vintage_year < 2009))",
)
def _(t):
    df = t.loans().select(KEY, "MSA", "vintage_year")
    fitted = _prepared(["MSA"], []).fit(df.filter("vintage_year < 2009"))
    return fitted.transform(df.filter("vintage_year >= 2009")).select(KEY, F.col("_code_MSA").alias("code"))


@query(
    "udf_02_restrict_to_known",
    f"select {KEY}, case when PROPERTY_STATE in ('CA', 'NY') then PROPERTY_STATE else 'MISSING' end as PROPERTY_STATE from loans",
    uses="loans",
)
def _(t):
    return t.loans().select(
        KEY, preparation.restrict_to_known("PROPERTY_STATE", ["CA", "NY"]).alias("PROPERTY_STATE")
    )


@query(
    "ml_07_fill_zero",
    f"select {KEY}, {', '.join(f'coalesce(cast({n} as double), 0) as {n}' for n in _NUMBERS)} from loans_clean",
    uses="loans",
    ctes=LOANS_CLEAN_SQL,
)
def _(t):
    filled = preparation.fill_stage([], _NUMBERS).transform(t.clean()[0])
    return filled.select(KEY, *[F.col(f"_num_{n}").alias(n) for n in _NUMBERS])


@query(
    "ml_08_standard_scaling",
    f"select {KEY}, "
    + ", ".join(
        f"round((x_{n} - avg(x_{n}) over ()) / stddev_samp(x_{n}) over (), 6) as {n}" for n in _NUMBERS
    )
    + f" from (select {KEY}, {', '.join(f'coalesce(cast({n} as double), 0) as x_{n}' for n in _NUMBERS)} from loans_clean)",
    uses="loans",
    ctes=LOANS_CLEAN_SQL,
)
def _(t):
    df = t.clean()[0].select(KEY, *_NUMBERS)
    scaled = _prepared([], _NUMBERS, scale=True).fit(df).transform(df).withColumn("v", vector_to_array("features"))
    return scaled.select(KEY, *[r6(F.col("v")[i], n) for i, n in enumerate(_NUMBERS)])


_SCHEMES = ["balanced", "sqrt_balanced", "unbalance", 10.0, None]


@query(
    "ml_10_class_weights",
    """select scheme, y_true, round(case scheme when 'balanced' then total / (2 * n) when 'sqrt_balanced' then sqrt(total / (2 * n))
      when 'unbalance' then case when y_true = 1 then neg / pos else 1 end when '10.0' then case when y_true = 1 then 10 else 1 end else 1 end, 6) as weight
    from (select y_true, count(*)::double as n from scored group by y_true)
    cross join (select count(*)::double as total, count_if(y_true = 1)::double as pos, count_if(y_true = 0)::double as neg from scored)
    cross join (values ('balanced'), ('sqrt_balanced'), ('unbalance'), ('10.0'), ('None')) s(scheme)""",
    uses="scored",
)
def _(t):
    rows = t.scored().select("y_true")
    out = None
    for scheme in _SCHEMES:
        table = preparation.class_weights(rows, scheme, "y_true").select(
            F.lit(str(scheme)).alias("scheme"), "y_true", r6("weight")
        )
        out = table if out is None else out.unionByName(table)
    return out


# ---------------------------------------------------------------- models

for _number, _name in (
    ("09", "logistic"), ("11", "random_forest"), ("12", "boosting_a"), ("13", "boosting_b"),
    ("14", "boosting_c"),
):

    @query(f"ml_{_number}_{_name}")
    def _(t, name=_name):
        training = Training(t)
        model = training.fit(name)
        return predictions(model, training.part("test"))


@query("ml_15_stacked_model")
def _(t):
    training = Training(t)
    model = learning.fit_stack(STACK_BASES, training.part("train"), training.features)
    return predictions(model, training.part("test"))


@query("ml_17_search_trials")
def _(t):
    training = Training(t)
    trials = tuning.search_trials(
        "logistic", training.part("train"), training.features, trials=TRIALS, fixed=OVERRIDES["logistic"],
        startup=3, batch=3, workers=3,
    )
    return tuning.trials_table(t.spark, trials)


@query("ml_18_predictions")
def _(t):
    training = Training(t)
    model = training.fit("logistic")
    return learning.predict(model, training.part("test")).select("row_id", "y_proba", "y_pred")


@query("ml_19_coefficient_importance")
def _(t):
    training = Training(t)
    model = training.fit("logistic")
    return importance.model_importance(model, training.features, t.spark)


@query("ml_20_gain_importance")
def _(t):
    training = Training(t)
    model = training.fit("random_forest")
    return importance.model_importance(model, training.features, t.spark)


@query("ml_21_permutation_importance")
def _(t):
    training = Training(t)
    model = training.fit("logistic")
    return importance.permutation_importance(model, training.part("test"), training.features, "row_id")


@query("ml_22_stack_importance")
def _(t):
    training = Training(t)
    model = learning.fit_stack(STACK_BASES, training.part("train"), training.features)
    return importance.stack_importance(model, STACK_BASES, t.spark)


@query("ord_02_top_features")
def _(t):
    training = Training(t)
    model = training.fit("random_forest")
    return importance.top_features(importance.model_importance(model, training.features, t.spark), 15)


# ---------------------------------------------------------------- calibration and scoring


@query("cal_01_isotonic")
def _(t):
    return calibration.fit_calibrator(t.scored()).transform(t.scored().drop("user_id"))


@query("cal_02_sigmoid")
def _(t):
    return calibration.fit_calibrator(t.scored(), "sigmoid").transform(t.scored().drop("user_id"))


@query("cal_03_across_folds")
def _(t):
    training = Training(t)
    fitted = calibration.calibrate_across_folds(
        lambda rows: learning.fit_model("logistic", rows, training.features, OVERRIDES["logistic"]),
        training.part("train"),
    )
    return fitted.transform(training.part("test")).select("row_id", "calibrated")


@query("cal_04_calibrated_probabilities")
def _(t):
    training = Training(t)
    model = training.fit("logistic")
    calibrator = calibration.fit_calibrator(predictions(model, training.part("validation")))
    return calibrator.both_classes(predictions(model, training.part("test")))


@query("sco_05_batch_scores")
def _(t):
    training = Training(t)
    model = training.fit("logistic")
    return learning.score_customers(model, training.part("test"), "logistic", "row_id")


# ---------------------------------------------------------------- jobs

JOB = modelling.Modelling(
    models=("logistic", "random_forest"), overrides={"logistic": OVERRIDES["logistic"]}, patience=PATIENCE
)


def modelling_root(t, plan: modelling.Modelling) -> str:
    """Target and dataset tables of one directory, and the modelling job run over them."""
    root = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    rows = features.create_all_features(*cleaning.clean_both(t.loans(), t.panel()))
    labelled = loans.select_model_columns(layers.write_layer(target.create_target(rows), f"{root}/target"))
    layers.write_layer(splits.split_out_of_time(labelled), f"{root}/dataset", layers.Layout(partition_by=("split",)))
    dataset.run_stages(modelling.model_stages(t.spark, root, plan))
    return root


@query("ml_25_modelling_job")
def _(t):
    return layers.read_layer(t.spark, f"{modelling_root(t, JOB)}/reports/model_results")


@query("ml_26_customer_job")
def _(t):
    stages = customers.customer_stages(t.spark, modelling_root(t, JOB))
    return dataset.run_stages(stages)["score"]
