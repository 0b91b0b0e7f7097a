"""Toxicity of restored text: a noisy-channel decoder before the classifier.

Obfuscated words are written with look-alike signs, stretched letters and gaps between
letters.  Every such span becomes a lattice of the letters it may stand for, and Viterbi
decoding under a character language model of the whole corpus picks the reading.  The
classifier then looks for words, beginnings and endings that labelled toxic documents have
and clean ones lack, in contexts of their own.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_texts, bounded_batches, table
from loanweave.llm.nbsvm import held_out

#: Labelled rows the classifier learns from at most, those with the smallest hash of their id.
SAMPLE_ROWS = 16_000
#: Orders of the language model, and characters a task gathers before it adds up their n-grams.
ORDERS, GATHERED = 4, 1_000_000
#: Lengths of the beginnings and endings of words that are features beside the word itself.
AFFIXES = (4, 5, 6)
#: Chance of error over all features tested, and a document's score without any finding.
ERROR, LEAK = 0.05, 0.01
#: Share of toxic contexts below which a feature says too little to be used.
PRECISION = 0.75
#: An affix is used if so many words have it, of which this share leans to the toxic side.
AFFIX_WORDS, AFFIX_SHARE = 5, 0.95
#: From this share of toxic contexts an affix makes rare words that have it count.
SUSPICIOUS = 0.6
#: Token readings a task keeps.
CACHE = 400_000

# Signs that are written in place of letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
# Costs in nats of a look-alike, a stretched letter, a doubled one and a gap inside a word.
SUBSTITUTED, STRETCHED, DOUBLED, GAPPED = 1.5, 1.0, 4.0, 0.3

_SIGNS = re.escape("".join(LOOK_ALIKES))
_LETTER = r"[^\W\d_]"
_NOISY = re.compile(
    rf"{_LETTER}[{_SIGNS}]+{_LETTER}|(?<![{_SIGNS}\w])[{_SIGNS}]{{1,2}}{_LETTER}"
    rf"|{_LETTER}[0-9@$€£+]{{1,2}}(?![{_SIGNS}\w])|({_LETTER})\1\1"
)
_CORE = re.compile(rf"[\w{_SIGNS}]+(?:['’][\w]+)*")
_RUN = re.compile(r"(.)\1*", re.DOTALL)
_SPACED = re.compile(rf"(?<![^\s.,;:])(?:[\w{_SIGNS}](?:[ .*_-]|\s\s?)){{3,}}[\w{_SIGNS}](?![^\s.,;:!?])")
_WORD = re.compile(r"[^\W_]+")
_MASK = 0xFFFFFFFFFFFFFFFF
_STEP = 0x9E3779B97F4A7C15


class CharacterModel:
    """Interpolated character n-grams over the counts of ``character_counts``."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], weight: float = 4.0):
        self.counts, self.weight = counts, weight
        self.total = float(counts[0][1].sum()) or 1.0
        self.cached: dict[str, float] = {}

    def _count(self, gram: str) -> float:
        h = 0
        for c in gram:
            h = (h * _STEP + ord(c)) & _MASK
        keys, numbers = self.counts[len(gram) - 1]
        at = int(np.searchsorted(keys, np.uint64(h)))
        return float(numbers[at]) if at < len(keys) and int(keys[at]) == h else 0.0

    def cost(self, context: str, c: str) -> float:
        """-log P(c | up to three characters before)."""
        gram = context[-(ORDERS - 1) :] + c
        known = self.cached.get(gram)
        if known is None:
            p = (self._count(c) + 0.1) / (self.total + 200)
            for n in range(2, len(gram) + 1):
                part = gram[-n:]
                p = (self._count(part) + self.weight * p) / (self._count(part[:-1]) + self.weight)
            known = -math.log(max(p, 1e-12))
            if len(self.cached) > CACHE:
                self.cached.clear()
            self.cached[gram] = known
        return known


def character_counts(docs: DataFrame, text_col: str = "text") -> list[tuple[np.ndarray, np.ndarray]]:
    """Character n-gram counts of every whole text: sorted keys and numbers of orders 1 to ORDERS.

    A key is a 64-bit hash of one n-gram, so the counts are those of single n-grams (chance of
    any collision among 5 million: about 1e-6).  Tasks and the driver hold 16 bytes for each
    distinct n-gram, whose number grows much more slowly than the corpus.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(ORDERS)]
        pending: list[list[np.ndarray]] = [[] for _ in range(ORDERS)]
        waiting = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                line = f" {' '.join(text.lower().split())} "
                codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
                h = np.zeros(len(codes), np.uint64)
                for n in range(1, min(ORDERS, len(codes)) + 1):
                    h = h[: len(codes) - n + 1] * np.uint64(_STEP) + codes[n - 1 :]
                    pending[n - 1].append(h)
                waiting += len(codes)
                if waiting > GATHERED:
                    found, waiting = _added(found, pending), 0
        for n, (keys, numbers) in enumerate(_added(found, pending)):
            for k in range(0, len(keys), 50_000):
                part = keys[k : k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), n, np.int32)), pa.array(part.view(np.int64)), pa.array(numbers[k : k + 50_000])],
                    names=["length", "gram", "n"],
                )

    summed = (
        docs.select(text_col)
        .mapInArrow(run, "length int, gram bigint, n bigint")
        .groupBy("length", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    lengths, grams, numbers = (summed[c].to_numpy() for c in ("length", "gram", "n"))
    out = []
    for n in range(ORDERS):
        keys, counts = grams[lengths == n].view(np.uint64), numbers[lengths == n]
        order = np.argsort(keys)
        out.append((keys[order], counts[order]))
    return out


def _added(found: list[tuple[np.ndarray, np.ndarray]], pending: list[list[np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys and numbers with those of the pending keys added; ``pending`` is emptied."""
    out = []
    for (keys, numbers), parts in zip(found, pending):
        if parts:
            new, times = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            merged, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            total = np.zeros(len(merged), np.int64)
            np.add.at(total, at, np.concatenate([numbers, times]))
            keys, numbers = merged, total
        out.append((keys, numbers))
    return out


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each piece of a span with their channel costs."""
    pieces = []
    for m in _RUN.finditer(span):
        sign, length = m[1], len(m[0])
        readings = [(m[0], 0.0)]
        letters = LOOK_ALIKES.get(sign, sign if sign.isalpha() else "")
        for letter in letters:
            extra = 0.0 if letter == sign else SUBSTITUTED
            if length <= 2 and letter != sign:
                readings.append((letter * length, extra))
            if length >= 2:
                readings.append((letter, extra + (STRETCHED if length > 2 else DOUBLED)))
            if length >= 3:
                readings.append((letter * 2, extra + STRETCHED))
        if sign in " .*_-":
            readings.append(("", GAPPED))
        pieces.append(readings)
    return pieces


def decode(span: str, model: CharacterModel) -> str:
    """The cheapest reading of a span between two gaps (Viterbi over the last characters)."""
    keep = ORDERS - 1
    paths: dict[str, tuple[float, tuple]] = {" ": (0.0, ())}
    for readings in [*lattice(span), [(" ", 0.0)]]:
        ahead: dict[str, tuple[float, tuple]] = {}
        for before, (spent, trail) in paths.items():
            for reading, channel in readings:
                cost, context = spent + channel, before
                for c in reading:
                    cost += model.cost(context, c)
                    context = (context + c)[-keep:]
                if context not in ahead or cost < ahead[context][0]:
                    ahead[context] = (cost, (trail, reading))
        paths = ahead
    trail = min(paths.items(), key=lambda p: (p[1][0], p[0]))[1][1]
    parts = []
    while trail:
        trail, reading = trail
        parts.append(reading)
    return "".join(reversed(parts))[:-1]


class Restorer:
    """Restores texts; remembers the readings of tokens."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.model = CharacterModel(counts)
        self.known: dict[str, str] = {}

    def token(self, token: str) -> str:
        """A lower-case token with its noisy cores read as words."""
        reading = self.known.get(token)
        if reading is None:
            reading = token
            if _NOISY.search(token):
                reading = _CORE.sub(lambda m: decode(m[0], self.model) if _NOISY.search(m[0]) else m[0], token)
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[token] = reading
        return reading

    def spaced(self, lower: str) -> str:
        """Letters written apart are read as words where the model prefers that."""
        return _SPACED.sub(lambda m: decode(re.sub(r"\s+", " ", m[0]), self.model), lower)

    def joined(self, lower: str) -> list[str]:
        """Letters written apart, read as one word each: where words begin is left open."""
        runs = [re.sub(r"[^\w" + _SIGNS + "]+", "", m[0]) for m in _SPACED.finditer(lower)]
        return [decode(run, self.model) if _NOISY.search(run) else run for run in runs if len(set(run)) > 2]

    def text(self, text: str) -> str:
        return " ".join([self.token(t) for t in self.spaced(text.lower()).split()])


def _features(word: str) -> list[str]:
    ends = [word[:n] + "*" for n in AFFIXES if len(word) > n] + ["*" + word[-n:] for n in AFFIXES if len(word) > n]
    return [word, *ends]


def _squeezed(word: str) -> str:
    return _RUN.sub(r"\1", word)


def training_counts(
    docs: DataFrame, labels: DataFrame, counts, label_col: str, sample_rows: int, id_col: str, text_col: str
) -> tuple[list, int, int]:
    """(feature, toxic contexts, clean contexts, words, toxic words) and the class sizes.

    A document gives each of its words once, with the word before its first occurrence; equal
    pairs of several documents count once.  So copies of a document count like one.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).dropDuplicates([id_col])
    chosen = chosen.select(id_col, F.col(label_col).cast("int").alias("_label"), F.xxhash64(id_col, F.lit(5)).alias("_order"))
    chosen = chosen.orderBy("_order", id_col).limit(sample_rows)
    # at most sample_rows rows: safe to broadcast
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen.drop("_order")), id_col)

    def start():
        restorer = Restorer(counts.value)

        def work(column):
            out = []
            for text in as_texts(column):
                first: dict[str, str] = {}
                before = ""
                for word in _WORD.findall(restorer.text(text)):
                    first.setdefault(word, before)
                    before = word
                out.append([{"word": w, "before": b} for w, b in first.items()])
            return [out]

        return work

    pairs = annotate(rows, [text_col], "_pairs array<struct<word:string,before:string>>", start)
    words = (
        pairs.select("_label", F.explode("_pairs").alias("p"))
        .groupBy("p.word", "p.before")
        .agg(F.max("_label").alias("toxic"), (1 - F.min("_label")).alias("clean"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    size = F.length("word")
    affixes = [
        F.when(size > n, part)
        for n in AFFIXES
        for part in (F.concat(F.substring("word", 1, n), F.lit("*")), F.concat(F.lit("*"), F.substring(F.col("word"), F.greatest(size - n + 1, F.lit(1)), F.lit(n))))
    ]
    features = (
        words.select(F.explode(F.array_compact(F.array(F.col("word"), *affixes))).alias("feature"), "toxic", "clean")
        .groupBy("feature")
        .agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("*").alias("words"),
            F.sum(F.when(F.col("toxic") > F.col("clean"), 1).otherwise(0)).alias("toxic_words"),
        )
    )
    size_of = chosen.groupBy("_label").count().collect()
    by = {r["_label"]: r["count"] for r in size_of}
    found = features.where("toxic >= 2 and toxic > clean").collect()
    return [tuple(r) for r in found], by.get(1, 0), by.get(0, 0)


def _tail(n: int, k: int, p: float) -> float:
    """P(X >= k) of a binomial variable."""
    if p <= 0 or p >= 1:
        return 1.0
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, sum(math.exp(log(i)) for i in range(k, n + 1)))


def significant(found: list[tuple[str, int, int, int, int]], toxic_rows: int, clean_rows: int) -> dict[str, float]:
    """Features that chance doesn't explain, with their shrunken share of toxic contexts."""
    share = toxic_rows / max(1, toxic_rows + clean_rows)
    tests = max(1, sum(f[1] >= 3 for f in found)) * 20  # those seen are a fraction of those possible
    kept, suspicious = {}, set()
    for feature, toxic, clean, words, toxic_words in found:
        if _tail(toxic + clean, toxic, share) >= ERROR / tests:
            continue
        precision = (toxic + share) / (toxic + clean + 1)
        if "*" not in feature:
            if precision >= PRECISION:
                kept[feature] = precision
        elif words >= AFFIX_WORDS:
            if precision >= SUSPICIOUS:
                suspicious.add(feature)
            if precision >= AFFIX_SHARE and toxic_words >= AFFIX_SHARE * words:
                kept[feature] = precision
    # a rare word that only toxic documents have counts if its affix is suspicious too
    for feature, toxic, clean, _, _ in found:
        if "*" not in feature and not clean and not suspicious.isdisjoint(_features(feature)[1:]):
            kept.setdefault(feature, (toxic + share) / (toxic + 1))
    return kept


def score(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
) -> DataFrame:
    """Append ``score`` (0 to 1), ``findings`` (words) and, if asked, ``restored`` text.

    The language model counts every text; the classifier learns from at most ``sample_rows``
    labelled rows; every whole text is restored and scored.  Restored text is in lower case
    with single spaces.  Null and empty texts have the score of no findings and an empty
    restored text.
    """
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(character_counts(docs, text_col))
    found, toxic, clean = training_counts(docs, labels, counts, label_col, sample_rows, id_col, text_col)
    kept = spark.sparkContext.broadcast(significant(found, toxic, clean))

    def start():
        restorer, weights = Restorer(counts.value), kept.value
        # a reading may have lost or kept a doubled letter: words meet without them
        squeezed = {_squeezed(f): f for f in sorted(weights) if "*" not in f and len(f) >= 4}
        readings: dict[str, tuple[str, ...]] = {}
        # in letters written apart a word may hide behind a one-letter word: search inside
        whole = sorted((f for f in weights if "*" not in f and len(f) >= 4), key=lambda f: (-len(f), f))
        inside = re.compile("|".join(map(re.escape, whole))) if whole else None

        def findings(token: str) -> tuple[str, ...]:
            found = []
            for word in _WORD.findall(restorer.token(token)):
                found += [f for f in _features(word) if f in weights]
                if not found and (same := squeezed.get(_squeezed(word))):
                    found.append(same)
            return tuple(found)

        def work(column):
            scores, words, texts = [], [], []
            for text in as_texts(column):
                lower = text.lower()
                apart = {f for run in restorer.joined(lower) for f in inside.findall(run)} if inside else set()
                lower = restorer.spaced(lower)
                tokens = lower.split()
                distinct = set(tokens)
                if len(readings) > CACHE:
                    readings.clear()
                for token in distinct.difference(readings):
                    readings[token] = findings(token)
                hits: dict[str, float] = {f: weights[f] for f in apart}
                for token in distinct:
                    if features := readings[token]:
                        hits[restorer.token(token)] = max(weights[f] for f in features)
                clear = 1.0 - LEAK
                for share in sorted(hits.values()):
                    clear *= 1.0 - share
                scores.append(1.0 - clear)
                words.append(sorted(hits))
                texts.append(" ".join([restorer.token(t) for t in tokens]) if keep_text else None)
            return [scores, words, *([texts] if keep_text else [])]

        return work

    fields = "score double, findings array<string>" + (", restored string" if keep_text else "")
    return annotate(docs, [text_col], fields, start)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Toxicity scores of every document; rows with remainder 2 are never learned from."""
    docs = table(spark, directory, "documents").select("doc_id", "text")
    labels = table(spark, directory, "labels").where(~held_out(4, 2))
    return score(docs, labels, keep_text=False).select(
        "doc_id",
        F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
