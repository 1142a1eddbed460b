"""Evaluation of binary predictions. Every operator takes ``by`` keys, so many runs share a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.operators.running import fit_cuts, running_sums

# Alert limits for missed attacks and false alarms.
FNR_LIMIT = 0.10
FPR_LIMIT = 0.05


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _cells(label: str, prediction: str) -> dict[str, Column]:
    y, p = F.col(label), F.col(prediction)
    return {
        "tn": F.count_if((y == 0) & (p == 0)), "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)), "tp": F.count_if((y == 1) & (p == 1)),
    }


def _scores(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    return [
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def confusion(
    pred: DataFrame, label: str = "is_attack", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Counts tn, fp, fn, tp."""
    return pred.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(label, prediction).items()])


def binary_metrics(
    pred: DataFrame, label: str = "is_attack", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(pred, label, prediction, by).select(*by, *_scores(tn, fp, fn, tp))


def error_rates(
    pred: DataFrame, label: str = "is_attack", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """False positive and false negative rates."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(pred, label, prediction, by).select(
        *by, _ratio(fp, fp + tn).alias("fpr"), _ratio(fn, fn + tp).alias("fnr"))


def metric_alerts(rates: DataFrame, fnr: float = FNR_LIMIT, fpr: float = FPR_LIMIT) -> DataFrame:
    """Alert flags on a frame with ``fnr`` and ``fpr``."""
    return rates.withColumns({
        "high_fnr": F.col("fnr") > F.lit(fnr), "high_fpr": F.col("fpr") > F.lit(fpr)})


def cumulative_counts(
    pred: DataFrame,
    label: str = "is_attack",
    score: str = "p",
    by: Sequence[str] = (),
    rows_per_slice: int | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per distinct score, highest first: tp, fp, running ctp, cfp, and totals n_pos, n_neg.

    Ties collapse in a partial aggregate before anything is ordered, and the ordering runs in
    slices of bounded size, so neither equal nor all-different scores end up in one task.
    ``extra`` aggregates of the rows of a score ride along.
    """
    rows = pred.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    cuts = fit_cuts(rows, score, rows_per_slice)
    at = rows.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) == 0).alias("fp"),
        *[c.alias(n) for n, c in (extra or {}).items()])
    return running_sums(
        at, ["threshold"], {"ctp": F.col("tp"), "cfp": F.col("fp")}, by=by, descending=True, cuts=cuts,
        totals={"n_pos": F.col("tp"), "n_neg": F.col("fp")})


def _rank_sums() -> dict[str, Column]:
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    ctp, cfp = F.col("ctp").cast("double"), F.col("cfp").cast("double")
    pos, neg = F.sum(tp), F.sum(fp)
    both = (pos > 0) & (neg > 0)
    return {
        "roc_auc": F.when(both, F.sum(fp * (ctp - tp / 2)) / (pos * neg)),
        "pr_auc": F.when(both, F.sum(tp * ctp / (ctp + cfp)) / pos),
    }


def rank_metrics(
    pred: DataFrame, label: str = "is_attack", score: str = "p", by: Sequence[str] = (),
    rows_per_slice: int | None = None,
) -> DataFrame:
    """ROC-AUC and average precision from one ordering; null where only one class occurs."""
    counts = cumulative_counts(pred, label, score, by, rows_per_slice)
    return counts.groupBy(*by).agg(*[c.alias(n) for n, c in _rank_sums().items()])


def roc_auc(pred: DataFrame, label: str = "is_attack", score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties counted half."""
    return rank_metrics(pred, label, score, by).select(*by, "roc_auc")


def average_precision(
    pred: DataFrame, label: str = "is_attack", score: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    return rank_metrics(pred, label, score, by).select(*by, "pr_auc")


def _thin(points: DataFrame, by: Sequence[str], bins: int | None) -> DataFrame:
    """Keep the lowest threshold of each of ``bins`` equal score ranges."""
    if not bins:
        return points
    lo, hi = points.agg(F.min("threshold"), F.max("threshold")).first()
    if lo is None or lo == hi:
        return points
    slot = F.least(F.floor((F.col("threshold") - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    row = F.struct(*points.columns)
    return (points.groupBy(*by, slot.alias("__slot")).agg(F.min_by(row, "threshold").alias("__row"))
            .select("__row.*"))


def _anchored(curve: DataFrame, by: Sequence[str], values: Mapping[str, float]) -> DataFrame:
    """The curve plus one end point per key, above every score."""
    ends = curve.groupBy(*by).agg(F.lit(float("inf")).alias("threshold")).withColumns(
        {c: F.lit(v) for c, v in values.items()})
    return curve.unionByName(ends)


def pr_curve(
    pred: DataFrame, label: str = "is_attack", score: str = "p", by: Sequence[str] = (),
    bins: int | None = None, anchor: bool = False,
) -> DataFrame:
    """Precision and recall at each distinct threshold; ``anchor`` adds the end (recall 0, precision 1)."""
    points = _thin(cumulative_counts(pred, label, score, by), by, bins)
    ctp, cfp = F.col("ctp"), F.col("cfp")
    curve = points.select(*by, "threshold", (ctp / (ctp + cfp)).alias("precision"),
                          _ratio(ctp, F.col("n_pos")).alias("recall"))
    return _anchored(curve, by, {"precision": 1.0, "recall": 0.0}) if anchor else curve


def roc_curve(
    pred: DataFrame, label: str = "is_attack", score: str = "p", by: Sequence[str] = (),
    bins: int | None = None, anchor: bool = False,
) -> DataFrame:
    """False and true positive rate at each distinct threshold; ``anchor`` adds the origin."""
    points = _thin(cumulative_counts(pred, label, score, by), by, bins)
    curve = points.select(*by, "threshold", _ratio(F.col("cfp"), F.col("n_neg")).alias("fpr"),
                          _ratio(F.col("ctp"), F.col("n_pos")).alias("tpr"))
    return _anchored(curve, by, {"fpr": 0.0, "tpr": 0.0}) if anchor else curve


def evaluate(
    pred: DataFrame, label: str = "is_attack", prediction: str = "prediction", score: str = "p",
    by: Sequence[str] = (),
) -> DataFrame:
    """All six scores, one row per ``by`` key (or one row), from one grouping of the rows."""
    cells = {f"n_{n}": c for n, c in _cells(label, prediction).items()}
    counts = cumulative_counts(pred, label, score, by, extra=cells)
    sums = counts.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in cells], *[c.alias(n) for n, c in _rank_sums().items()])
    tn, fp, fn, tp = (F.col(n) for n in ("n_tn", "n_fp", "n_fn", "n_tp"))
    return sums.select(*by, *_scores(tn, fp, fn, tp), "roc_auc", "pr_auc")


def classification_report(
    pred: DataFrame, label: str = "is_attack", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted averages, accuracy."""
    cells = pred.groupBy(F.col(label).cast("string").alias("y"),
                         F.col(prediction).cast("string").alias("p")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"),
                 hit.alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"),
                 F.lit(0).cast("bigint").alias("hits")),
    )
    sums = cells.select(F.inline(sides)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hits").alias("hits"))
    hits, called, support = F.col("hits"), F.col("called"), F.col("support")
    classes = sums.select(
        "class", _ratio(hits, called).alias("precision"), _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, called + support).alias("f1"), "support", "hits")
    scores = ("precision", "recall", "f1")
    n = F.sum("support")
    averages = classes.agg(F.array(
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in scores], n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"),
                 *[_ratio(F.sum(F.col(c) * F.col("support")), n).alias(c) for c in scores], n.alias("support")),
        F.struct(F.lit("accuracy").alias("class"),
                 *[_ratio(F.sum("hits"), n).alias(c) for c in scores], n.alias("support")),
    ).alias("rows")).select(F.inline("rows"))
    return classes.drop("hits").unionByName(averages)


def accuracy_by_type(
    pred: DataFrame, kind: str = "attack_type", label: str = "is_attack", prediction: str = "prediction"
) -> DataFrame:
    """Rows and share of correct predictions per attack type."""
    right = (F.col(label) == F.col(prediction)).cast("double")
    return pred.groupBy(kind).agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))


def apply_threshold(df: DataFrame, score: str = "p", t: float = 0.5, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.when(F.col(score) >= F.lit(t), 1).otherwise(0))


def threshold_sweep(
    pred: DataFrame, thresholds: Sequence[float], label: str = "is_attack", score: str = "p"
) -> DataFrame:
    """Precision, recall and F1 at each given threshold, all in one scan."""
    y, p = F.col(label), F.col(score)
    rows = []
    for t in thresholds:
        tp, fp = F.count_if((y == 1) & (p >= t)), F.count_if((y == 0) & (p >= t))
        fn = F.count_if((y == 1) & (p < t))
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), _ratio(tp, tp + fp).alias("precision"),
                             _ratio(tp, tp + fn).alias("recall"),
                             _ratio(2 * tp, 2 * tp + fp + fn).alias("f1")))
    return pred.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
