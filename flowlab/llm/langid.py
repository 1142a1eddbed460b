"""Language identification by a blended-spectrum string kernel.

The kernel of two texts is the mean over n = 1, 2, 3 of the share of n-grams present in both,
|A and B| / sqrt(|A| |B|). Landmark texts approximate it (Nyström), and one ridge regression per language against
the rest is fitted on the landmark coordinates. Because the kernel is linear in normalised presence vectors, the
landmarks and the regressions fold into one matrix with a row per n-gram, and a batch of texts is scored by one
matrix product per n.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SYMBOLS = 40
ORDERS = (1, 2, 3)
OFFSETS = [sum(SYMBOLS ** m for m in ORDERS if m < n) for n in ORDERS]
WIDTH = sum(SYMBOLS ** n for n in ORDERS)
BLOCK = 32

# Bounds of the fit: expected rows per language and in all (of many languages fewer each); landmarks in all, and per
# language if there are many.
ROWS_PER_LANGUAGE, ROWS = 300, 60_000
LANDMARKS, LANDMARKS_PER_LANGUAGE = 400, 2
RIDGE = 1e-4


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point of the first plane: 0 no letter, 1-26 a-z, other letters share 27-39."""
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        if 97 <= c <= 122:
            out[c] = c - 96
        elif chr(c).isalpha():
            out[c] = 27 + c * 2654435761 % (1 << 32) % 13
    return out


def symbols(text: str) -> np.ndarray:
    """Letters of the lower-cased text, with one 0 for whatever stands between words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = symbol_table()[np.minimum(points, (1 << 16) - 1)]
    return s[(s != 0) | np.concatenate([[True], s[:-1] != 0])] if len(s) else s


def grams(text: str) -> list[np.ndarray]:
    """Columns of the n-grams of a text, for each n; with repeats."""
    s = symbols(text).astype(np.int32)
    out = [s]
    for n in ORDERS[1:]:
        out.append(out[-1][:-1] * SYMBOLS + s[n - 1:] if len(s) >= n else s[:0])
    return [g + o for g, o in zip(out, OFFSETS, strict=True)]


@dataclass
class LanguageModel:
    """``weights``: for each n-gram a row, for each language a column; ``bias`` per language."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, texts: Sequence[str] | pa.Array) -> np.ndarray:
        """Regression values, one row per text, near 1 for its language and -1 for the others. Of an Arrow array only the
        texts of a block are strings at a time."""
        out = np.tile(self.bias, (len(texts), 1))
        width = len(self.languages)
        present = np.zeros((BLOCK, WIDTH), np.float32)
        for start in range(0, len(texts), BLOCK):
            block = texts[start:start + BLOCK]
            present[:] = 0
            for i, text in enumerate(block.to_pylist() if isinstance(block, pa.Array) else block):
                for columns in grams(text):
                    present[i, columns] = 1
            for n, low in zip(ORDERS, OFFSETS, strict=True):
                part = slice(low, low + SYMBOLS ** n)
                product = present[:len(block), part] @ self.weights[part]  # last column: number of n-grams
                out[start:start + len(block)] += product[:, :width] / np.sqrt(np.maximum(product[:, width:], 1))
        return out


def _presence(rows: list[np.ndarray]) -> np.ndarray:
    """Normalised presence vectors: the dot product of two is the kernel."""
    out = np.zeros((len(rows), WIDTH), np.float32)
    for i, columns in enumerate(rows):
        out[i, columns] = 1
    for n, low in zip(ORDERS, OFFSETS, strict=True):
        part = out[:, low:low + SYMBOLS ** n]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * len(ORDERS))
    return out


def fit_kernel_ridge(languages: list[str], rows: list[np.ndarray], labels: list[str]) -> LanguageModel:
    """Nyström landmarks taken in turn from each language, then ridge regression, each language weighted alike."""
    of = {name: [] for name in languages}
    for i, y in enumerate(labels):
        of[y].append(i)
    by_language = list(of.values())
    turns = [i for group in zip(*[g + [None] * (max(map(len, by_language)) - len(g)) for g in by_language], strict=True)
             for i in group if i is not None]
    landmarks = _presence([rows[i] for i in turns[:max(LANDMARKS, LANDMARKS_PER_LANGUAGE * len(languages))]])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > values[-1] * 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = np.concatenate([(_presence(rows[i:i + BLOCK]) @ landmarks.T).astype(np.float64) @ root
                               for i in range(0, len(rows), BLOCK)])
    target = np.full((len(labels), len(languages)), -1.0)
    for column, members in enumerate(by_language):
        target[members, column] = 1.0
    weight = np.array([1 / len(of[y]) for y in labels])
    weight *= len(weight) / weight.sum()
    mean, target_mean = weight @ features / len(weight), weight @ target / len(weight)
    centred = features - mean
    gram = centred.T @ (weight[:, None] * centred) + RIDGE * len(labels) * np.eye(centred.shape[1])
    slopes = np.linalg.solve(gram, centred.T @ (weight[:, None] * (target - target_mean)))
    folded = landmarks.T @ (root @ slopes).astype(np.float32) / np.float32(np.sqrt(len(ORDERS)))
    weights = np.concatenate([folded, np.ones((WIDTH, 1), np.float32)], axis=1)
    return LanguageModel(languages, weights, target_mean - mean @ slopes)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """Model from the labelled rows given; None if none has a text and a language.

    All languages are learned; of each about ``ROWS_PER_LANGUAGE`` texts (of many languages fewer, ``ROWS`` in all), those
    whose hash falls below that number over the number of its different texts. So the driver gets a bounded sample of
    presence sets that is spread over all rows; it holds 0.26 MB of weights per language. Equal texts draw alike and are
    taken once, so a language of many copies is learned like others; an empty table gives no model. A fit never sees ids or
    sources.
    """
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    if not counts:
        return None
    most = min(ROWS_PER_LANGUAGE, max(1, ROWS // len(counts)))
    shares = docs.sparkSession.createDataFrame([(name, most / max(1, n)) for name, n in counts.items()], "lang string, share double")
    draw = F.shiftrightunsigned(F.xxhash64("text", F.lit("sample")), 11) / float(1 << 53)
    sample = labelled.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("text", "lang").distinct()

    @F.arrow_udf("binary")
    def presence(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique(np.concatenate(grams(t.as_py()))).astype(np.int32).tobytes() for t in texts], pa.binary())

    rows = sample.select("lang", presence("text").alias("columns")).orderBy("lang", "columns").collect()
    missed = set(counts) - {r.lang for r in rows}
    if missed:  # every draw of a few texts missed: of such languages the texts with the smallest hashes
        first = labelled.join(F.broadcast(shares.filter(F.col("lang").isin(sorted(missed)))), "lang", "left_semi").groupBy("lang").agg(
            F.min(F.struct(F.xxhash64("text"), "text")).alias("_first"))
        rows += first.select("lang", presence("_first.text").alias("columns")).orderBy("lang").collect()
    labels = [r.lang for r in rows]
    return fit_kernel_ridge(sorted(set(labels)), [np.frombuffer(bytes(r.columns), np.int32) for r in rows], labels)


def has_letter(text: Column) -> Column:
    """Is there a letter in the text? Not in a null one."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(spark: SparkSession, model: LanguageModel | None, text: Column) -> Column:
    """Struct (lang_pred, score) for a text: the language of the largest regression value, and that value
    brought to 0 to 1. Null texts and texts without a letter are ``und`` with score 0, and so is every text when
    there is no model. Ties go to the language first in the alphabet; equal texts get equal answers; an empty table gives
    none. Columns beside the text are not read."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if known is not None and len(texts):
            margins = known.margins(texts)
            names = [known.languages[j] for j in margins.argmax(axis=1)]
            scores = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          ["lang_pred", "score"])

    letter = has_letter(text)
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(letter, predict(F.when(letter, text).otherwise(F.lit("")))).otherwise(none)
