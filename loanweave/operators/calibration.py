"""Probability calibration on a score histogram."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from loanweave.operators.learning import average_probability, predict_proba
from loanweave.operators.metrics import calibration_curve, calibration_error
from loanweave.operators.preparation import LABEL
from loanweave.operators.ranking import score_histogram
from loanweave.session import checkpointed

PLATT_C = 1e6
#: Pooling ends on the driver once so few blocks are left, or once blocks stop merging.
FINAL_BLOCKS = 10_000


class Calibrator:
    """A fitted map from raw to calibrated probability."""

    def __init__(self, method: str, model):
        self.method, self.model = method, model

    def transform(self, df: DataFrame, score: str = "y_proba", output: str = "calibrated") -> DataFrame:
        if self.method == "isotonic":
            mapped = self.model.setFeaturesCol(score).setPredictionCol("_mapped").transform(df)
            value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_mapped")))
        else:
            assembler = VectorAssembler(inputCols=[score], outputCol="_score")
            mapped = self.model.transform(assembler.transform(df))
            value = vector_to_array(F.col("_p"))[1]
        return mapped.select(*df.columns, value.alias(output))

    def both_classes(self, df: DataFrame, score: str = "y_proba") -> DataFrame:
        """Calibrated probability of either class, as the two-column output."""
        return self.transform(df, score, "proba_1").withColumn("proba_0", 1 - F.col("proba_1"))


def _pooled(batches):
    """Pool adjacent violators over one stretch of the score order."""
    import pyarrow as pa

    blocks: list[list[float]] = []  # low score, high score, sum of labels, weight
    for batch in batches:
        for low, high, total, weight in zip(*(c.to_pylist() for c in batch.columns)):
            blocks.append([low, high, total, weight])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
                _, high, total, weight = blocks.pop()
                last = blocks[-1]
                blocks[-1] = [last[0], high, last[2] + total, last[3] + weight]
    columns = list(zip(*blocks)) if blocks else [[], [], [], []]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, pa.float64()) for c in columns], names=["low", "high", "total", "weight"]
    )


def pooled_blocks(histogram: DataFrame) -> DataFrame:
    """Exact isotonic pooling of a score histogram, in stretches of the score order.

    Pooling a stretch never undoes a merge that the whole order would make, so stretches are
    pooled side by side, then pooled again in fewer and wider stretches, until few blocks are
    left or none merges any more.  Only blocks reach the last step.
    """
    schema = "low double, high double, total double, weight double"
    blocks = histogram.select(
        F.col("y_proba").cast("double").alias("low"), F.col("y_proba").cast("double").alias("high"),
        F.col("pos").cast("double").alias("total"), F.col("n").cast("double").alias("weight"),
    )
    spark = histogram.sparkSession
    stretches, before = int(spark.conf.get("spark.sql.shuffle.partitions")), None
    while True:
        ordered = blocks.repartitionByRange(stretches, "low").sortWithinPartitions("low")
        blocks = checkpointed(ordered.mapInArrow(_pooled, schema))
        left = blocks.count()
        if left <= FINAL_BLOCKS or left == before or stretches == 1:
            return blocks
        before, stretches = left, max(1, stretches // 4)


def fit_calibrator(scored: DataFrame, method: str = "isotonic") -> Calibrator:
    """Fit on ``y_true`` and ``y_proba``, which are used as they are.

    Equal scores are collapsed to one weighted row first, which leaves the fit unchanged.
    Isotonic regression then pools adjacent violators on the executors, so its last step,
    which Spark does on the driver, sees only the pooled blocks.
    """
    if method not in ("isotonic", "sigmoid"):
        raise ValueError(f"method is isotonic or sigmoid, not {method!r}")
    histogram = score_histogram(scored)
    if method == "isotonic":
        # both ends of a block carry its mean, so the fit interpolates between blocks only
        ends = F.when(F.col("low") == F.col("high"), F.array("low")).otherwise(F.array("low", "high"))
        points = pooled_blocks(histogram).select(
            F.explode(ends).alias("y_proba"), (F.col("total") / F.col("weight")).alias(LABEL),
            (F.col("weight") / F.size(ends)).alias("n"),
        )
        fitted = IsotonicRegression(
            featuresCol="y_proba", labelCol=LABEL, weightCol="n", predictionCol="_mapped"
        ).fit(points)
        return Calibrator(method, fitted)
    classes = histogram.select(
        "y_proba",
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias(LABEL), F.col("pos").cast("double").alias("n")),
                F.struct(F.lit(0.0).alias(LABEL), F.col("neg").cast("double").alias("n")),
            )
        ),
    ).filter(F.col("n") > 0)
    rows = classes.agg(F.sum("n")).first()[0]
    assembler = VectorAssembler(inputCols=["y_proba"], outputCol="_score")
    fitted = LogisticRegression(
        featuresCol="_score", labelCol=LABEL, weightCol="n", regParam=1 / (PLATT_C * rows),
        standardization=False, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_class",
    ).fit(assembler.transform(classes))
    return Calibrator(method, fitted)


def save_calibrator(calibrator: Calibrator, directory: str, name: str) -> None:
    calibrator.model.write().overwrite().save(f"{directory.rstrip('/')}/{name}_{calibrator.method}")


def load_calibrator(directory: str, name: str, method: str = "isotonic") -> Calibrator:
    kind = IsotonicRegressionModel if method == "isotonic" else LogisticRegressionModel
    return Calibrator(method, kind.load(f"{directory.rstrip('/')}/{name}_{method}"))


class CrossValidatedCalibration:
    """One model and one calibrator per fold; predictions are averaged."""

    def __init__(self, members: Sequence[tuple[PipelineModel, Calibrator]]):
        self.members = list(members)

    def transform(self, df: DataFrame, output: str = "calibrated") -> DataFrame:
        scored, names = df, []
        for i, (model, calibrator) in enumerate(self.members):
            raw, name = f"_raw_{i}", f"_calibrated_{i}"
            scored = calibrator.transform(predict_proba(model, scored, raw), raw, name).drop(raw)
            names.append(name)
        return average_probability(scored, names, output).drop(*names)


def calibrate_across_folds(
    fit: Callable[[DataFrame], PipelineModel], train: DataFrame, folds: int = 3,
    method: str = "isotonic", fold: str = "fold",
) -> CrossValidatedCalibration:
    """Calibration without a validation set: each fold calibrates the model of the others."""
    members = []
    for k in range(folds):
        model = fit(train.filter(F.col(fold) != k))
        held_out = predict_proba(model, train.filter(F.col(fold) == k)).select(
            F.col(LABEL).alias("y_true"), "y_proba"
        )
        members.append((model, fit_calibrator(held_out, method)))
    return CrossValidatedCalibration(members)


def evaluate_calibration(df: DataFrame, bins: int = 10) -> dict[str, DataFrame]:
    return {"errors": calibration_error(df, bins), "curve": calibration_curve(df, bins)}
