"""Logistic models of several folds and parameters, fitted in shared passes over one matrix.

A search fits the same rows many times.  Here they are written once, in columns and not scaled;
one pass gives loss, gradient and curvature of all models that are being fitted, each with its own
rows, weights, penalty and scaling, and the driver takes a Newton step for each of them.  A fit
needs fewer than ten passes, and as many models as a batch of trials has share them.  A pass sends
the driver a number for each pair of columns and each model, whatever the number of rows.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, functions as F

from loanweave.operators.learning import FeatureSet, parameters
from loanweave.operators.preparation import LABEL, preparation_stages, weights_of_counts
from loanweave.session import ensure_checkpoint_dir

#: A fit ends when a Newton step promises less than this share of the rows' weight as gain in loss.
TOLERANCE = 1e-12
_LEAST_DECREASE, _ROUNDING, _SHORTEST = 1e-4, 1e-13, 1e-6


@dataclass(frozen=True)
class Outside:
    """The rows outside of one fold: classes, scaling, and numbers of categories that not all folds have."""

    counts: Mapping[int, int]
    mean: np.ndarray
    deviation: np.ndarray
    renumbered: Mapping[int, np.ndarray]


@dataclass(frozen=True)
class Matrix:
    """Written rows: fold, label and the raw values; ``centre`` and ``spread`` are those of all rows."""

    rows: DataFrame
    path: str
    centre: np.ndarray
    spread: np.ndarray
    folds: Sequence[Outside]

    def close(self) -> None:
        hadoop = self.rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        configuration = self.rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
        hadoop.getFileSystem(configuration).delete(hadoop, True)


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Fold, label and values (rows x columns) of every batch that has rows."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            yield batch.column(0).to_numpy(), batch.column(1).to_numpy(), x.reshape(batch.num_rows, -1)


def _table(names: Sequence[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))


# ------------------------------------------------------------------ the matrix


def write_matrix(df: DataFrame, features: FeatureSet, folds: int = 3, fold: str = "fold") -> Matrix:
    """The rows as numbers, written once, and the scaling of every fold from one pass over them."""
    categorical, numeric = features.groups
    spark = df.sparkSession
    rows = df.filter(F.col(fold).isNotNull())
    # all but the last stage, which makes vectors
    stages = preparation_stages(categorical, numeric)[:-1]
    columns = [*[f"_code_{n}" for n in categorical], *[f"_num_{n}" for n in numeric]]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    (
        Pipeline(stages=stages).fit(rows).transform(rows)
        .select(F.col(fold).cast("int").alias("fold"), F.col(LABEL).cast("double").alias("y"),
                *[F.col(f"`{n}`").alias(f"x{j}") for j, n in enumerate(columns)])
        .write.option("compression", "snappy").parquet(path)
    )
    # columns compress better than arrays, and an array is copied to Python faster than many columns
    written = spark.read.parquet(path).select("fold", "y", F.array(*[f"x{j}" for j in range(len(columns))]).alias("x"))
    found = _statistics(written, len(columns), len(categorical))
    return Matrix(written, path, *found.scaling(None), [found.outside(k) for k in range(folds)])


@dataclass(frozen=True)
class _Statistics:
    """Per fold and column: rows, sums about ``origin``, ends; the label is the last column."""

    origin: np.ndarray
    cells: Mapping[int, np.ndarray]
    codes: Mapping[int, Mapping[int, Mapping[int, int]]]

    def sums(self, without: int | None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        kept = [c for k, c in self.cells.items() if k != without]
        if not kept:
            raise ValueError("training needs both classes, found no rows")
        n, total, square = sum(kept)[:3]
        return int(n[0]), total, square, np.min([c[3] for c in kept], 0), np.max([c[4] for c in kept], 0)

    def scaling(self, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Mean and sample deviation; a constant column has exactly 0."""
        n, total, square, low, high = self.sums(without)
        variance = np.maximum(square - total * total / n, 0) / max(n - 1, 1)
        return (self.origin + total / n)[:-1], np.where(low == high, 0.0, np.sqrt(variance))[:-1]

    def outside(self, k: int) -> Outside:
        n, total, *_ = self.sums(k)
        ones = round(self.origin[-1] * n + total[-1])
        counts = {c: m for c, m in ((0, n - ones), (1, ones)) if m}
        if set(counts) != {0, 1}:
            raise ValueError(f"training needs both classes, found {sorted(counts)}")
        mean, deviation = self.scaling(k)
        renumbered = {}
        for column, by_fold in self.codes.items():
            known = max(max(c) for c in by_fold.values()) + 1
            rows = np.zeros(known)
            for j, c in by_fold.items():
                if j != k:
                    rows[list(c)] += list(c.values())
            there = rows > 0
            if there.all():
                continue
            # numbers of the categories that the other folds have; all others share the last one
            number = np.where(there, np.cumsum(there) - 1, there.sum()).astype(np.float64)
            renumbered[column] = number
            mean[column] = (number * rows).sum() / n
            deviation[column] = math.sqrt((rows * (number - mean[column]) ** 2).sum() / max(n - 1, 1))
        return Outside(counts, mean, deviation, renumbered)


def _statistics(rows: DataFrame, width: int, codes: int) -> _Statistics:
    first = rows.first()
    if first is None:
        raise ValueError("training needs both classes, found no rows")
    # sums about a row of the table lose no digits to a large mean
    origin = np.array([*first.x, first.y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = {}, {}
        for f, y, x in _arrays(batches):
            for k in np.unique(f):
                part = np.column_stack([x[f == k], y[f == k]])
                moved = part - origin
                new = np.array([np.full(width + 1, len(part)), moved.sum(0), (moved * moved).sum(0), part.min(0), part.max(0)])
                old = cells.get(k)
                cells[k] = new if old is None else np.array([*(old[:3] + new[:3]), np.minimum(old[3], new[3]), np.maximum(old[4], new[4])])
                for c in range(codes):
                    seen.setdefault((k, c), Counter()).update(dict(zip(*np.unique(part[:, c], return_counts=True))))
        names = ("fold", "column", "code", "n", "total", "square", "low", "high")
        for k, cell in cells.items():
            at = np.arange(width + 1, dtype=np.int32)
            yield _table(names, np.full(len(at), k, np.int32), at, np.full(len(at), -1, np.int32), *cell)
        for (k, c), counts in seen.items():
            n, nothing = np.array(list(counts.values()), np.float64), np.zeros(len(counts))
            yield _table(
                names, np.full(len(n), k, np.int32), np.full(len(n), c, np.int32), np.array(list(counts)).astype(np.int32),
                n, nothing, nothing, nothing, nothing,
            )

    kinds = "fold int, column int, code int, n double, total double, square double, low double, high double"
    summed = rows.mapInArrow(run, kinds).groupBy("fold", "column", "code").agg(
        *[F.sum(c).alias(c) for c in ("n", "total", "square")], F.min("low").alias("low"), F.max("high").alias("high")
    ).collect()
    cells, seen = {}, {}
    for r in summed:
        if r.code < 0:
            cells.setdefault(r.fold, np.zeros((5, width + 1)))[:, r.column] = (r.n, r.total, r.square, r.low, r.high)
        else:
            seen.setdefault(r.column, {}).setdefault(r.fold, {})[r.code] = int(r.n)
    return _Statistics(origin, cells, seen)


# ------------------------------------------------------------------ the fits


@dataclass
class Fit:
    """One model on its way.  Its coefficients are those of the scaled columns, the intercept last."""

    fold: int
    weights: Mapping[int, float]
    penalty: float
    most: int
    weight: float
    change: np.ndarray  # from coefficients of scaled columns to those of the matrix's own units
    at: np.ndarray
    tried: np.ndarray
    loss: float = math.inf
    step: np.ndarray | None = None
    slope: float = 0.0
    share: float = 1.0
    steps: int = 0
    done: bool = False
    ridge: np.ndarray = field(init=False)

    def __post_init__(self):
        self.ridge = np.full(len(self.at), self.penalty)
        self.ridge[-1] = 0.0

    def learn(self, loss: float, gradient: np.ndarray, curvature: np.ndarray) -> None:
        """Take or shorten the step that was tried, and try the next."""
        loss += 0.5 * float((self.ridge * self.tried * self.tried).sum())
        if loss <= self.loss * (1 + _ROUNDING) + _LEAST_DECREASE * self.share * self.slope:
            self.at, self.loss, self.share = self.tried, loss, 1.0
            slopes = self.change.T @ gradient + self.ridge * self.at
            bent = self.change.T @ curvature @ self.change + np.diag(self.ridge)
            self.step = -np.linalg.solve(bent, slopes)
            self.slope = float(slopes @ self.step)
            self.done = -self.slope <= TOLERANCE * self.weight or self.steps >= self.most
            self.steps += 1
        else:
            self.share /= 2
            self.done = self.share < _SHORTEST
        self.tried = self.at + self.share * self.step


def _begin(matrix: Matrix, fold: int, overrides: Mapping[str, Any], known: Sequence[Fit]) -> Fit:
    """A fit that starts where the most similar of the known ones ended."""
    p, rows = parameters("logistic", overrides), matrix.folds[fold]
    weights = weights_of_counts(rows.counts, p["class_weight"])
    size = len(matrix.centre)
    scale = np.divide(1.0, rows.deviation, out=np.zeros(size), where=rows.deviation > 0)
    change = np.zeros((size + 1, size + 1))
    change[range(size), range(size)] = matrix.spread * scale
    change[size, :size] = (matrix.centre - rows.mean) * scale
    change[size, size] = 1.0
    start, penalty = np.zeros(size + 1), 1.0 / p["C"]
    start[-1] = math.log(weights[1] * rows.counts[1] / (weights[0] * rows.counts[0]))
    if alike := [f for f in known if (f.fold, f.weights) == (fold, weights)]:
        start = min(alike, key=lambda f: abs(math.log(f.penalty / penalty))).at
    weight = sum(weights[c] * n for c, n in rows.counts.items())
    return Fit(fold, weights, penalty, p["max_iter"], weight, change, start, start)


def _units(x: np.ndarray, renumbered: Mapping[int, np.ndarray], centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Columns in units of all rows' deviation about their mean, and a last column of ones."""
    z = np.ones((len(x), x.shape[1] + 1))
    np.multiply(x - centre, scale, out=z[:, :-1])
    for c, number in renumbered.items():
        z[:, c] = (number[x[:, c].astype(np.int64)] - centre[c]) * scale[c]
    return z


def _by_fold(matrix: Matrix, fits: Sequence[Fit], points: Sequence[np.ndarray]):
    """What a task needs: the scaling, and per fold its renumbered codes, its fits and their coefficients."""
    scale = np.divide(1.0, matrix.spread, out=np.zeros(len(matrix.spread)), where=matrix.spread > 0)
    groups = []
    for k in sorted({f.fold for f in fits}):
        mine = [m for m, f in enumerate(fits) if f.fold == k]
        groups.append((k, dict(matrix.folds[k].renumbered), mine, np.column_stack([fits[m].change @ points[m] for m in mine])))
    return matrix.rows.sparkSession.sparkContext.broadcast((matrix.centre, scale, groups))


def _pass(matrix: Matrix, fits: Sequence[Fit]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and curvature of every fit at the point it tries."""
    shared = _by_fold(matrix, fits, [f.tried for f in fits])
    weights = [(f.weights[0], f.weights[1]) for f in fits]
    size = len(matrix.centre) + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, scale, groups = shared.value
        sums, bent = np.zeros((len(weights), size + 1)), np.zeros((len(weights), size, size))
        for f, y, x in _arrays(batches):
            plain = _units(x, {}, centre, scale)
            for k, renumbered, mine, points in groups:
                z = _units(x, renumbered, centre, scale) if renumbered else plain
                margins = z @ points
                p = 1 / (1 + np.exp(-margins))
                w = np.column_stack([np.where(y == 1, weights[m][1], weights[m][0]) for m in mine]) * (f != k)[:, None]
                sums[mine, 0] += (w * (np.logaddexp(0, margins) - y[:, None] * margins)).sum(0)
                sums[mine, 1:] += (w * (p - y[:, None])).T @ z
                for m, h in zip(mine, np.sqrt(w * p * (1 - p)).T):
                    moved = z * h[:, None]
                    bent[m] += moved.T @ moved
        for m, line in enumerate(sums):
            values = np.concatenate([line, bent[m][upper]])
            yield _table(("fit", "place", "value"), np.full(len(values), m, np.int32), np.arange(len(values), dtype=np.int32), values)

    cells = matrix.rows.mapInArrow(run, "fit int, place int, value double")
    summed = cells.groupBy("fit", "place").agg(F.sum("value").alias("value")).toArrow()
    shared.unpersist()
    out = np.zeros((len(fits), size + 1 + len(upper[0])))
    out[summed["fit"].to_numpy(), summed["place"].to_numpy()] = summed["value"].to_numpy()
    results = []
    for line in out:
        curvature = np.zeros((size, size))
        curvature[upper] = line[size + 1 :]
        results.append((float(line[0]), line[1 : size + 1], curvature + np.triu(curvature, 1).T))
    return results


def fit_together(
    matrix: Matrix, wanted: Sequence[tuple[int, Mapping[str, Any]]], known: Sequence[Fit] = ()
) -> list[Fit]:
    """Fits of (fold to leave out, parameters), side by side in the same passes."""
    fits = [_begin(matrix, fold, overrides, known) for fold, overrides in wanted]
    while going := [f for f in fits if not f.done]:
        for fit, found in zip(going, _pass(matrix, going)):
            fit.learn(*found)
    return fits


def held_out_scores(matrix: Matrix, fits: Sequence[Fit]) -> DataFrame:
    """Every fit's probability (``fit``, ``y_true``, ``y_proba``) for the rows of its own fold."""
    shared = _by_fold(matrix, fits, [f.at for f in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, scale, groups = shared.value
        for f, y, x in _arrays(batches):
            for k, renumbered, mine, points in groups:
                own = f == k
                p = 1 / (1 + np.exp(-(_units(x[own], renumbered, centre, scale) @ points)))
                for column, m in enumerate(mine):
                    yield _table(
                        ("fit", "y_true", "y_proba"), np.full(own.sum(), m, np.int32), y[own], np.ascontiguousarray(p[:, column])
                    )

    return matrix.rows.mapInArrow(run, "fit int, y_true double, y_proba double")
