"""Sample, score and validate customers: a job over the target table and the trained models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.columns import KEY, LOAN_SUMMARY, TARGET
from loanweave.functions.expressions import vintage_of
from loanweave.operators import learning, loans, scoring, splits
from loanweave.plans.modelling import STACK, Workspace
from loanweave.sources import layers


def customer_stages(
    spark: SparkSession, root: str, *, defaulted: int = 1000, non_defaulted: int = 1000, anyone: int = 500,
    model: str | None = None, seed: int = 42, force: bool = False,
) -> dict[str, Callable[[], DataFrame]]:
    """Summarise loans, sample customers, score them with a trained model, validate the scores.

    Reads ``target`` (every labelled row with all columns) below ``root``, and ``models`` and
    ``columns`` of the modelling job.  Rows of the sampled loans come from
    ``sampled_target`` where that table exists and holds one of them.  ``model`` is the stack,
    or the first model there is, unless named.
    """
    at = Workspace(spark, root, force)
    bound = defaulted + non_defaulted + anyone

    def labelled(name: str) -> DataFrame:
        rows = at.read(name)
        return rows if "vintage_year" in rows.columns else rows.withColumn("vintage_year", vintage_of(KEY))

    def summarise() -> DataFrame:
        return at.keep("customers/loans", ["target"], lambda: loans.loan_summary(labelled("target")))

    def sample() -> DataFrame:
        chosen = at.keep(
            "customers/sample", ["customers/loans"],
            lambda: splits.validation_loans(at.read("customers/loans"), defaulted, non_defaulted, anyone, seed=seed),
            defaulted=defaulted, non_defaulted=non_defaulted, anyone=anyone, seed=seed,
        )
        first = "sampled_target" if layers.manifest(spark, at.at("sampled_target")) else "target"
        rows = at.keep(
            "customers/rows", ["customers/sample", first, "target"],
            lambda: loans.latest_for(chosen, labelled(first), labelled("target"), bound),
        )
        at.keep("customers/summary", ["customers/rows"], lambda: rows.select(KEY, TARGET, *LOAN_SUMMARY[:4]))
        at.keep("customers/input", ["customers/rows"], lambda: loans.model_input(rows))
        return rows

    def score() -> DataFrame:
        names = at.model_names()
        used = model or scoring.choose_model(names, (STACK, *names))

        def build():
            aligned = loans.align_to_model(at.read("customers/rows"), at.features().names, passthrough=(KEY, TARGET))
            return learning.score_customers(at.model(used), aligned, used, KEY)

        return at.keep("customers/predictions", ["customers/rows", "models", "columns"], build, model=used)

    def validate() -> DataFrame:
        tables = scoring.validation_report(at.read("customers/predictions").filter(F.col("true_default").isNotNull()))
        for name, kind in (("confusion", "confusion_matrix"), ("classes", "classification_report")):
            at.keep(f"reports/customer_{name}", ["customers/predictions"], lambda kind=kind: tables[kind].coalesce(1))
        return at.keep("reports/customer_metrics", ["customers/predictions"], lambda: tables["metrics"].coalesce(1))

    return {"summarise": summarise, "sample": sample, "score": score, "validate": validate}
