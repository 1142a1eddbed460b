"""Toxicity by subword-bag embeddings and a linear softmax.

Characters are read as words between single blanks; every 3- to 5-gram of them, blanks included, has an
embedding in a table of hashed buckets, so a misspelling shares most vectors with the word it stands for. The
embeddings of a stretch of text are averaged and go through a linear softmax; table and softmax are trained
together in numpy. A document is judged by its worst stretch, so a long text does not water down one insult, and
a logistic curve fitted on rows apart turns that into a probability at the true share of toxic rows.

Averaging and softmax are linear, so for scoring they fold into one number per bucket and a whole text is
scored by running sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BITS = 17
ORDERS = (3, 4, 5)
DIMENSIONS = 8
STRETCH = 32  # characters averaged at a time
# Bounds of the fit: expected rows of either label, and of a longer text so many windows of so many characters.
SAMPLE_ROWS = 1500
WINDOW_CHARS, WINDOWS = 20_000, 4
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 64, 0.5
LEAST_STEPS = 150  # a small sample is gone through more often
SEED = 7


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point of the first plane: 0 blank and marks, 1-26 a-z, 27-36 digits, others 37-63."""
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        ch = chr(c)
        if 97 <= c <= 122:
            out[c] = c - 96
        elif 48 <= c <= 57:
            out[c] = c - 21
        elif ch.isalnum():
            out[c] = 37 + c % 27
    return out


def symbols(text: str) -> np.ndarray:
    """Symbols of a text, a blank at both ends and one between words; empty if there is no word."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = symbol_table()[np.minimum(points, (1 << 16) - 1)]
    s = np.concatenate([[0], s, [0]]).astype(np.uint8)
    s = s[(s != 0) | np.concatenate([[True], s[:-1] != 0])]
    return s if len(s) > 1 else s[:0]


def buckets(s: np.ndarray) -> np.ndarray:
    """Bucket of the n-gram that starts at each place, a row per n; -1 where none does."""
    out = np.full((len(ORDERS), len(s)), -1, np.int32)
    wide = s.astype(np.uint32)
    for row, n in enumerate(ORDERS):
        if len(s) >= n:
            code = wide[:len(s) - n + 1].copy()
            for i in range(1, n):
                code <<= np.uint32(6)
                code += wide[i:len(s) - n + 1 + i]
            code += np.uint32(n * 0x01000193)
            code *= np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x85EBCA77)
            out[row, :len(code)] = code >> np.uint32(32 - BUCKET_BITS)
    return out


def stretch_values(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean bucket value of the stretch that starts at each place (the whole text if it is shorter).

    ``table`` has one entry more than buckets, a 0 for places without an n-gram.
    """
    ids = buckets(s)
    sums = np.concatenate([[0.0], np.cumsum(table[ids].sum(axis=0, dtype=np.float64))])
    counts = np.concatenate([[0], np.cumsum((ids >= 0).sum(axis=0))])
    span = min(STRETCH, len(s))
    return (sums[span:] - sums[:-span]) / np.maximum(counts[span:] - counts[:-span], 1)


@dataclass
class ToxicityModel:
    """``table``: a value per bucket and a last 0; ``bias`` of the softmax; curve and share of toxic rows."""

    table: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def score(self, text: str) -> float:
        s = symbols(text)
        if not len(s):
            return self.prior
        worst = float(stretch_values(s, self.table).max()) + self.bias
        return 1 / (1 + math.exp(-min(max(self.slope * worst + self.shift, -500), 500)))


class _Trainer:
    """Embeddings and softmax, trained together by Adagrad on stretches."""

    def __init__(self):
        self.random = np.random.default_rng(SEED)
        size = 1 << BUCKET_BITS
        self.embedding = self.random.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32)
        self.softmax = self.random.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self._seen = np.full(size, 1e-6, np.float32)
        self._seen_out = np.full((DIMENSIONS + 1, 2), 1e-6, np.float32)

    def folded(self) -> tuple[np.ndarray, float]:
        table = self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0])
        return np.append(table, np.float32(0)), float(self.bias[1] - self.bias[0])

    def epoch(self, stretches: list[np.ndarray], labels: np.ndarray) -> None:
        order = self.random.permutation(len(stretches))
        for start in range(0, len(order), BATCH):
            self._step([stretches[i] for i in order[start:start + BATCH]], labels[order[start:start + BATCH]])

    def _step(self, bags: list[np.ndarray], labels: np.ndarray) -> None:
        ids = np.concatenate(bags)
        lengths = np.array([len(b) for b in bags])
        owner = np.repeat(np.arange(len(bags)), lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        mean = np.add.reduceat(self.embedding[ids], starts, axis=0) / lengths[:, None]
        logits = mean @ self.softmax + self.bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = odds / odds.sum(axis=1, keepdims=True)
        wrong[np.arange(len(bags)), labels] -= 1
        wrong /= len(bags)
        back = (wrong @ self.softmax.T) / lengths[:, None]
        grad_out = np.concatenate([mean.T @ wrong, wrong.sum(axis=0, keepdims=True)])
        self._seen_out += grad_out ** 2
        step = RATE * grad_out / np.sqrt(self._seen_out)
        self.softmax -= 0.1 * step[:-1]
        self.bias -= 0.1 * step[-1]
        touched, place = np.unique(ids, return_inverse=True)
        grad = np.zeros((len(touched), DIMENSIONS), np.float32)
        for d in range(DIMENSIONS):
            grad[:, d] = np.bincount(place, back[owner, d], len(touched))
        self._seen[touched] += (grad ** 2).mean(axis=1)
        self.embedding[touched] -= RATE * grad / np.sqrt(self._seen[touched])[:, None]


def _bag(s: np.ndarray, start: int, span: int) -> np.ndarray:
    ids = buckets(s[start:start + span])
    return ids[ids >= 0]


def fit_texts(texts: list[str], labels: list[int], positives: float, negatives: float) -> ToxicityModel:
    """Train on texts of both labels; the two last arguments are how many rows they stand for.

    First on stretches drawn from anywhere, then in rounds on the stretch that the model so far finds worst in
    each text: in a toxic text the likeliest insult, in a clean one the likeliest mistake.
    """
    pairs = [(s, y) for t, y in zip(texts, labels, strict=True) if len(s := symbols(t)) >= min(ORDERS)]
    apart = [i % 5 == 4 for i in range(len(pairs))]
    train = [p for p, a in zip(pairs, apart, strict=True) if not a]
    prior = positives / (positives + negatives)
    if len({y for _, y in train}) < 2:
        return ToxicityModel(np.zeros((1 << BUCKET_BITS) + 1, np.float32), 0.0, 0.0,
                             math.log((prior + 1e-6) / (1 - prior + 1e-6)), prior)
    trainer, y = _Trainer(), np.array([y for _, y in train])
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(train)))
    for _ in range(2 * epochs):
        starts = [int(trainer.random.integers(0, max(1, len(s) - 4 * STRETCH))) for s, _ in train]
        trainer.epoch([_bag(s, at, 4 * STRETCH) for (s, _), at in zip(train, starts, strict=True)], y)
    for _ in range(ROUNDS):
        table, _ = trainer.folded()
        worst = [int(stretch_values(s, table).argmax()) for s, _ in train]
        bags = [_bag(s, at, STRETCH) for (s, _), at in zip(train, worst, strict=True)]
        for _ in range(epochs):
            trainer.epoch(bags, y)
    table, bias = trainer.folded()
    held = [p for p, a in zip(pairs, apart, strict=True) if a]
    if len({y for _, y in held}) < 2:
        held = train
    x = np.array([stretch_values(s, table).max() + bias for s, _ in held])
    slope, shift = _logistic_curve(x, np.array([y for _, y in held]), positives, negatives)
    return ToxicityModel(table, bias, slope, shift, prior)


def _logistic_curve(x: np.ndarray, y: np.ndarray, positives: float, negatives: float) -> tuple[float, float]:
    """Slope and shift by Newton steps, with rows weighted to the true shares of the labels."""
    weight = np.where(y == 1, positives / max(1, (y == 1).sum()), negatives / max(1, (y == 0).sum()))
    weight = weight / weight.sum() * len(y)
    scale = max(float(np.abs(x).max()), 1e-9)
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = a.T @ (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + 1e-2 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hess, a.T @ (weight * (y - p)) - 1e-2 * w), -5, 5)
    return float(w[0] / scale), float(w[1])


def excerpt(text: Column) -> Column:
    """A text of up to WINDOWS * WINDOW_CHARS characters as a whole, of a longer one windows spread evenly over it."""
    n = F.char_length(text)
    starts = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.floor((n - WINDOW_CHARS) * i / (WINDOWS - 1)).cast("int") + 1)
    windows = F.array_join(F.transform(starts, lambda at: F.substr(text, at, F.lit(WINDOW_CHARS))), "\n")
    return F.when(n <= WINDOWS * WINDOW_CHARS, text).otherwise(windows)


def _uniform(*of) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / float(1 << 53)


def _fit_sample(sample: DataFrame, counts: dict[int, int]) -> ToxicityModel:
    """Equal texts are taken once; the order does not depend on partitions. Without rows the score is 0."""
    rows = sample.select(excerpt(F.col("text")).alias("text"), "y").distinct().orderBy(F.xxhash64("text"), "text", "y").collect()
    if not rows:
        return ToxicityModel(np.zeros((1 << BUCKET_BITS) + 1, np.float32), 0.0, 0.0, -40.0, 0.0)
    return fit_texts([r.text for r in rows], [r.y for r in rows], max(1, counts.get(1, 0)), max(1, counts.get(0, 0)))


def _share(counts: dict[int, int]) -> Column:
    """Share of the rows of a label that is drawn."""
    return F.when(F.col("y") == 1, SAMPLE_ROWS / max(1, counts.get(1, 0))).otherwise(2 * SAMPLE_ROWS / max(1, counts.get(0, 0)))


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Model from the labelled rows given (text, 0/1). Rows with a null or another label are left out.

    Of either label those rows are taken whose hash falls below ``SAMPLE_ROWS`` over their number, whatever their
    length: a bounded sample, spread over all rows. Rows that repeat a text draw alike and are taken once, but count
    each. An empty table gives a model whose score is 0. Other columns are not read.
    """
    rows = (labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("y"))
            .filter("text is not null and y in (0, 1)"))
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return _fit_sample(rows.filter(_uniform("text", F.lit("sample")) < _share(counts)), counts)


def fit_by_key(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
               label: str = "toxic") -> ToxicityModel:
    """Like ``fit``, for labels in a table of their own: keys are drawn first, by their hash, and texts are read
    for the drawn keys alone, so no text is shuffled. A key of many rows is likelier drawn, and then gives a share of its
    rows. Null keys have no label; a key with both labels has label 1, and repeated label rows count once."""
    by_key = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)").groupBy("_key").agg(F.max("y").alias("y"))
    sizes = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("_key")).groupBy("_key").agg(F.count("*").alias("_n"))
    keys = sizes.join(by_key, "_key")
    counts = {r.y: r.n for r in keys.groupBy("y").agg(F.sum("_n").alias("n")).collect()}
    likely = F.least(F.lit(1.0), _share(counts) * F.col("_n"))
    drawn = keys.withColumn("_likely", likely).filter(_uniform("_key", F.lit("sample")) < F.col("_likely"))
    drawn = F.broadcast(drawn.select("_key", "y", (_share(counts) / F.col("_likely")).alias("_rows")))  # about 3 * SAMPLE_ROWS keys
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("text")).join(drawn, "_key")
    # A key of one row gives it for sure.
    return _fit_sample(rows.filter((F.col("_rows") >= 1) | (_uniform("text", F.lit("row")) < F.col("_rows"))), counts)


def score(spark: SparkSession, model: ToxicityModel, text: Column) -> Column:
    """Probability that a text is toxic. Null and empty texts, and texts without a letter or digit, get the
    share of toxic rows among those learned from. Equal texts score alike; an empty table gives no score."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        known = shared.value
        return pa.array([known.score(t.as_py() or "") for t in texts], pa.float64())

    return scored(text)
