"""Quality classifier: a linear support vector machine on naive Bayes features.

A document is the set of its hashed n-grams: of characters, of character classes, and of the
marks that say whether a word equals the one before.  Each indicator is scaled by the log
ratio of its smoothed frequencies in the two classes, and a hinge-loss model is fitted on the
scaled vectors by dual coordinate descent.  Margins of models that did not see a row
calibrate the score.
"""

from __future__ import annotations

from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_texts, table

#: Labelled rows the fit uses at most, those with the smallest hash of their id.
SAMPLE_ROWS = 6_000
BITS = 17
CHARACTER_ORDERS = (1, 2, 3)
CLASS_ORDERS = (1, 2, 3, 4, 5, 6)
_SIZE = 1 << BITS
_FACTOR = np.uint32(0x9E3779B1)


def _classes() -> np.ndarray:
    """Class number of every code point below 0x3000: letter case, digit, gap, or itself."""
    out = np.arange(0x3000, dtype=np.uint32)
    for code in range(0x3000):
        c = chr(code)
        if c.isdigit():
            out[code] = 1
        elif c.isupper():
            out[code] = 2
        elif c.isalpha():
            out[code] = 3
        elif c != "\n" and c.isspace():
            out[code] = 4
    return out


_CLASS = _classes()


def _grams(codes: np.ndarray, orders: tuple[int, ...], stream: int) -> list[np.ndarray]:
    """Hashed n-grams of each order."""
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(orders) + 1):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] ^ codes[n - 1 :]) * _FACTOR
        h ^= h >> np.uint32(15)
        if n in orders:
            seeded = (h + np.uint32(stream * 64 + n)) * _FACTOR
            out.append(seeded >> np.uint32(32 - BITS))
    return out


class Features:
    """Distinct n-gram numbers of a text; keeps a scratch array between texts."""

    def __init__(self):
        self.seen = np.zeros(_SIZE, np.bool_)

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        kinds = np.where(codes < 0x3000, _CLASS[np.minimum(codes, 0x2FFF)], np.uint32(3))
        kinds = kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])]
        words = text.split()
        same = np.fromiter(map(eq, words, words[1:]), np.uint32, max(0, len(words) - 1))
        ids = np.concatenate(
            _grams(codes, CHARACTER_ORDERS, 1)
            + _grams(kinds, CLASS_ORDERS, 2)
            + _grams(same + np.uint32(1), (1, 2, 3), 3)
        )
        if len(ids) < 600:
            return np.unique(ids).astype(np.int32)
        self.seen[ids] = True
        distinct = np.flatnonzero(self.seen).astype(np.int32)
        self.seen[distinct] = False
        return distinct


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) of smoothed document counts of each feature."""
    counts = np.full((2, _SIZE), smoothing)
    for row, label in zip(rows, labels):
        counts[int(label), row] += 1
    totals = np.array([(labels == k).sum() for k in (0, 1)]) + 2 * smoothing
    return np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int,
    cost: float = 1.0, rounds: int = 30, tolerance: float = 1e-3, seed: int = 3,
) -> np.ndarray:
    """Weights (the last one the bias) of the L2-regularised hinge loss.

    Classes weigh alike.  The dual variables stay between 0 and the row's cost; a round
    visits the rows in a new random order, and the fit ends once no projected gradient
    exceeds the tolerance.
    """
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.maximum(1, np.array([(sign < 0).sum(), (sign > 0).sum()])) * 2 / len(sign)
    limit = np.where(sign > 0, cost / share[1], cost / share[0])
    square = np.array([v @ v for v in values]) + 1.0
    weights, alpha = np.zeros(size + 1), np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(rows)):
            slope = sign[i] * (weights[rows[i]] @ values[i] + weights[size]) - 1
            projected = min(slope, 0) if alpha[i] <= 0 else max(slope, 0) if alpha[i] >= limit[i] else slope
            worst = max(worst, abs(projected))
            if projected:
                moved = min(max(alpha[i] - slope / square[i], 0.0), limit[i])
                step = (moved - alpha[i]) * sign[i]
                alpha[i] = moved
                weights[rows[i]] += step * values[i]
                weights[size] += step
        if worst < tolerance:
            break
    return weights


def _sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins (Newton steps, smoothed targets)."""
    ones, zeros = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


class Model:
    """Feature weights with the naive Bayes scale folded in, and the calibration."""

    def __init__(self, weights: np.ndarray, ratio: np.ndarray, slope: float, offset: float):
        self.scale = ratio.astype(np.float64)
        self.weights = weights[:-1] * ratio
        self.bias, self.slope, self.offset = float(weights[-1]), slope, offset

    def margin(self, row: np.ndarray) -> float:
        norm = np.sqrt((self.scale[row] ** 2).sum()) if len(row) else 0.0
        return (float(self.weights[row].sum()) / norm if norm else 0.0) + self.bias

    def score(self, row: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(row) + self.offset, -30, 30))))


def _linear(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ratio = log_count_ratio(rows, labels)
    values = []
    for row in rows:
        v = ratio[row]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    return dual_coordinate_descent(rows, values, labels, _SIZE), ratio


def fit(rows: list[np.ndarray], labels: np.ndarray, folds: int = 3) -> Model:
    """Fit on all rows; calibrate on margins of models fitted without the row's fold."""
    if not len(rows):
        return Model(np.zeros(_SIZE + 1), np.zeros(_SIZE), 1.0, 0.0)
    fold = np.arange(len(rows)) % folds
    margins = np.zeros(len(rows))
    for k in range(folds):
        inside = [i for i in range(len(rows)) if fold[i] != k]
        part = Model(*_linear([rows[i] for i in inside], labels[inside]), 1.0, 0.0)
        for i in np.flatnonzero(fold == k):
            margins[i] = part.margin(rows[i])
    return Model(*_linear(rows, labels), *_sigmoid_fit(margins, labels))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, sample_rows: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[tuple[np.ndarray, int]]:
    """Features and label of the sampled labelled rows, in the order of their id's hash."""
    order = F.xxhash64(id_col, F.lit(7))
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).dropDuplicates([id_col])
    chosen = chosen.select(id_col, F.col(label_col).cast("int").alias("_label"), order.alias("_order"))
    chosen = chosen.orderBy("_order", id_col).limit(sample_rows)
    # at most sample_rows rows: safe to broadcast
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)

    def start():
        features = Features()
        return lambda column: [[features(t).tobytes() for t in as_texts(column)]]

    packed = annotate(rows, [text_col], "_ids binary", start).select("_order", id_col, "_label", "_ids").collect()
    packed.sort(key=lambda r: (r[0], r[1], bytes(r[3])))
    return [(np.frombuffer(bytes(r[3]), np.int32), r[2]) for r in packed]


def score(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Append ``score``: the chance of label 1, from 0 to 1.

    The model is fitted on at most ``sample_rows`` labelled rows and then scores every whole
    text; null and empty texts get the score of no features.  Without labels every score is
    one half.
    """
    sample = training_rows(docs, labels, label_col, sample_rows, id_col, text_col)
    model = fit([r for r, _ in sample], np.array([y for _, y in sample]))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def start():
        features, fitted = Features(), Model.__new__(Model)
        vars(fitted).update(shared.value)
        return lambda column: [[fitted.score(features(t)) for t in as_texts(column)]]

    return annotate(docs, [text_col], "score double", start)


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    """Whether crc32 of the id as text has this remainder."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus)) == remainder


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Quality scores of every document; rows with remainder 0 are never learned from."""
    docs = table(spark, directory, "documents").select("doc_id", "text")
    labels = table(spark, directory, "labels").where(~held_out(5, 0))
    return score(docs, labels).select(
        "doc_id",
        F.coalesce(held_out(5, 0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
