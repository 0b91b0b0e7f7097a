"""The end-to-end jobs: from raw tables to a modelling dataset, models and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.columns import CATEGORICAL_FEATURES, DROP_FEATURES, KEY, TARGET, TIME
from loanweave.functions.history import History, one_row_per_month
from loanweave.operators import cleaning, features, incremental, loans, splits, target
from loanweave.operators.learning import FeatureSet
from loanweave.operators.long_history import all_features, features_and_target
from loanweave.operators.preparation import LABEL
from loanweave.sources import ingest, layers, storage


def create_dataset(
    origination: DataFrame, performance: DataFrame, *,
    threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
    history: History = History(), validation_fraction: float = 0.2, seed: int = 42,
    drop: Sequence[str] = DROP_FEATURES,
    max_history_rows: int | None = None, row_id: str | None = None,
) -> DataFrame:
    """Modelling rows with their split.

    One plan: the panel is shuffled by loan once and every feature, target and filter
    window reuses that exchange and its sort.  That needs histories that fit a task, which
    unique months guarantee; ``max_history_rows`` checks, and segments longer histories.
    """
    clean_loans, clean_panel = cleaning.clean_both(origination, performance)
    labelled = features_and_target(
        clean_panel, row_id, history, max_history_rows, threshold, lookahead, clean_loans
    )
    selected = loans.select_model_columns(labelled, drop)
    return splits.split_out_of_time(selected, validation_fraction=validation_fraction, seed=seed)


def training_frame(dataset: DataFrame) -> DataFrame:
    """The dataset with the label as a double and one text id per row."""
    return dataset.withColumns({
        LABEL: F.col(TARGET).cast("double"),
        "row_id": F.concat_ws("|", KEY, TIME),
    })


def feature_set(dataset: DataFrame, categorical: Sequence[str] = CATEGORICAL_FEATURES) -> FeatureSet:
    """Numeric and configured categorical columns; leftover text columns stay out."""
    outside = {KEY, TIME, TARGET, LABEL, "row_id", "split", "fold"}
    names = [
        n for n, kind in dataset.dtypes
        if n not in outside and (kind != "string" or n in categorical)
    ]
    return FeatureSet(tuple(names), tuple(n for n in names if n in categorical))


def run_stages(stages: Mapping[str, Callable[[], object]], only: Sequence[str] | None = None) -> dict:
    """Run the named stages in their order (all by default) and return their results."""
    unknown = set(only or ()) - set(stages)
    if unknown:
        raise ValueError(f"no such stages: {sorted(unknown)}")
    return {n: stage() for n, stage in stages.items() if only is None or n in only}


def data_stages(
    spark: SparkSession, raw: str, root: str, years: Sequence[int], *, force: bool = False,
    threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
    history: History = History(), validation_fraction: float = 0.2, buckets: int = 64,
    legacy_streak: bool = False, strict_periods: bool = False, extended_status: bool = False,
    require_full_horizon: bool = False, max_history_rows: int | None = None, row_id: Sequence[str] = (),
) -> dict[str, Callable[[], DataFrame]]:
    """Ingest, clean, feature, target and dataset stages over versioned tables under ``root``.

    Every stage reads the table before it and writes its own, unless the current version was
    made from the same extract files with the same parameters.  Cleaning deals the panel and
    the loans to ``buckets`` by loan; the later stages keep that layout, so none of them moves
    a row again.  ``buckets`` should let the loans of one bucket fit a task.

    Months have to be unique per loan, which is checked.  With ``max_history_rows`` they need
    not be: longer histories are cut, and ``row_id`` columns order rows of equal months.
    """
    at = lambda name: f"{root.rstrip('/')}/{name}"
    cleaned = {"strict_periods": strict_periods, "extended_status": extended_status}
    shaped = {"history": str(history), "legacy_streak": legacy_streak, "max_history_rows": max_history_rows, "row_id": list(row_id)}
    labelled_by = {"threshold": threshold, "lookahead": lookahead, "require_full_horizon": require_full_horizon}
    by_loan = layers.Layout(buckets, history.key, (history.key, history.time), ("reporting_year",))
    if max_history_rows is not None and (legacy_streak or require_full_horizon):
        raise ValueError("cut histories have neither the legacy streak nor the full horizon")

    def read(name: str) -> DataFrame:
        return layers.read_layer(spark, at(name))

    files = [
        f"{raw.rstrip('/')}/{prefix}_{year}.txt" for prefix in ingest.FILE_PREFIXES.values() for year in years
    ]

    def keep(name: str, build: Callable[[], DataFrame], layout: layers.Layout = layers.Layout(), laid_out: bool = False, **parameters) -> DataFrame:
        made_from = {"files": storage.file_states(spark, files), "years": list(years), **parameters}
        return layers.layer(spark, at(name), build, layout, made_from, force, laid_out)

    def bronze() -> DataFrame:
        counted = []
        for kind, by in (("origination", ()), ("performance", ("reporting_year",))):
            def records(kind=kind):
                df, counts = ingest.all_records(spark, raw, years, kind)
                counted.append((kind, counts))
                return df

            table = keep(f"bronze/{kind}", records, layers.Layout(partition_by=(ingest.STATUS, *by)))
        if counted:
            rows = [(kind, status, int(counts.get[status])) for kind, counts in counted for status in ingest.STATUSES]
            layers.write_layer(spark.createDataFrame(rows, "layout string, status string, records bigint").coalesce(1), at("reports/ingest"))
        return ingest.usable_records(table)

    def silver() -> DataFrame:
        keep(
            "silver/origination",
            lambda: cleaning.clean_origination(ingest.usable_records(read("bronze/origination")), strict_periods=strict_periods),
            layers.Layout(buckets, history.key, (history.key,)), **cleaned,
        )
        table = keep(
            "silver/performance",
            lambda: cleaning.clean_performance(ingest.usable_records(read("bronze/performance")), **cleaned),
            by_loan, **cleaned,
        )
        if max_history_rows is None and not one_row_per_month(table, history).isEmpty():
            raise ValueError("a loan has several rows in a month: give max_history_rows and row_id")
        return table

    def joined() -> DataFrame:
        # the loans of one bucket become a hash table, so the panel is neither moved nor sorted
        rows = features.join_static(read("silver/performance"), read("silver/origination").hint("shuffle_hash"), history.key)
        return rows.withColumn("_row_id", F.concat_ws("|", *row_id)) if row_id else rows

    def engineered() -> DataFrame:
        def build():
            if max_history_rows is None:
                return features.history_features(joined(), history, legacy_streak)
            return all_features(joined(), "_row_id" if row_id else None, history, max_history_rows).drop("_row_id")

        return keep("features", build, by_loan, max_history_rows is None, **cleaned, **shaped)

    def labelled() -> DataFrame:
        def build():
            if max_history_rows is None:
                return target.create_target(read("features"), threshold, lookahead, history, require_full_horizon)
            return features_and_target(
                joined(), "_row_id" if row_id else None, history, max_history_rows, threshold, lookahead
            ).drop("_row_id")

        return keep("target", build, by_loan, max_history_rows is None, **cleaned, **shaped, **labelled_by)

    def dataset() -> DataFrame:
        return keep(
            "dataset",
            lambda: splits.split_out_of_time(
                loans.select_model_columns(read("target")), validation_fraction=validation_fraction
            ),
            layers.Layout(partition_by=("split",)), **cleaned, **shaped, **labelled_by, validation_fraction=validation_fraction,
        )

    return {
        "ingest": bronze, "clean": silver, "features": engineered, "target": labelled,
        "dataset": dataset,
    }


def start_state(spark: SparkSession, root: str, history: History = History(), buckets: int = 64, **options) -> DataFrame:
    """The state of a features table that was built whole, to which months can be added."""
    rows = layers.read_layer(spark, f"{root.rstrip('/')}/features")
    state = incremental.state_of(rows, history, **options)
    return layers.write_layer(state, f"{root.rstrip('/')}/state", layers.Layout(buckets, history.key, (history.key,)), laid_out=True)


def add_months(
    spark: SparkSession, root: str, panel: DataFrame, history: History = History(), buckets: int = 64,
    threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
) -> dict[str, list[int]]:
    """Add cleaned months to the features, target and state tables under ``root``.

    Returns the reporting years that were written per table; other partitions stay as they are.
    Only the new rows are dealt to buckets.  The state is swapped last, so a job that was lost
    on the way can be run again with the same months.
    """
    at = lambda name: f"{root.rstrip('/')}/{name}"
    key, time = history.key, history.time
    state = layers.read_layer(spark, at("state"))
    new = layers.write_layer(panel, at("months"), layers.Layout(buckets, key, (key, time)))
    joined = features.join_static(new, layers.read_layer(spark, at("silver/origination")).hint("shuffle_hash"), key)
    if not incremental.late_rows(state, new, history).isEmpty():
        raise ValueError("some months are not later than what their loans already have: build anew")
    step = incremental.advance(state, joined, joined.columns, history, threshold, lookahead)
    touched = {}
    for name, rows, replaced in (("features", step.features, new.select(key, time)), ("target", step.target, step.redone)):
        table = layers.read_layer(spark, at(name))
        years = sorted(r[0] for r in replaced.select(F.substring(time, 1, 4).cast("int")).distinct().collect())
        kept = table.filter(F.col("reporting_year").isin(years)).join(replaced, [key, time], "left_anti")
        layers.replace_partitions(kept.select(*table.columns).unionByName(rows.select(*table.columns)), at(name))
        touched[name] = years
    merged = incremental.merged_state(state, step.state, history)
    layers.write_layer(merged, at("state"), layers.Layout(buckets, key, (key,)), laid_out=True)
    return touched
