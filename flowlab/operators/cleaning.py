"""Cleaning: labels, missing and infinite values, duplicates, outliers, column sets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.functions import finite, is_missing, present
from flowlab.functions.columns import FLOATING
from flowlab.operators.quantiles import approx_quantiles, exact_quantiles
from flowlab.session import drop_folder, fresh_folder

# Columns that identify a flow or place it in time.
IDENTIFIERS = ("flow_id", "src_ip", "dst_ip")
TIME_COLUMNS = ("Timestamp", "timestamp", "ts")

# Columns checked for outliers, and the quartile-range factor.
OUTLIER_COLUMNS = ("Flow Duration", "Tot Fwd Pkts", "Tot Bwd Pkts")
IQR_FACTOR = 1.5


def columns_by_type(
    df: DataFrame, kind: str = "numeric", pattern: str | None = None, exclude: Sequence[str] = ()
) -> list[str]:
    """Names of numeric (or non-numeric) columns, optionally matching a name pattern."""
    keep = []
    for field in df.schema.fields:
        numeric = isinstance(field.dataType, T.NumericType)
        if numeric == (kind == "numeric") and field.name not in exclude:
            if pattern is None or re.search(pattern, field.name, re.IGNORECASE):
                keep.append(field.name)
    return keep


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns],
                     *[expr.alias(c) for c, expr in new.items() if c not in df.columns])


def drop_unlabeled(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def normalize_labels(df: DataFrame, label: str = "Label", benign: str = "benign") -> DataFrame:
    """Trim the label; add ``is_attack`` (case-insensitive) and ``attack_type``."""
    name = F.trim(F.col(label))
    return replace_columns(df, {
        label: name,
        "is_attack": F.when(F.lower(name) == benign.lower(), 0).otherwise(1),
        "attack_type": name,
    })


def fill_missing_zero(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    inf_as_null: bool = True,
    label: str | None = "Label",
) -> DataFrame:
    """Numeric null, NaN and (unless told otherwise) infinity become 0; unlabeled rows go."""
    cols = columns_by_type(df, "numeric", exclude=[label] if label else []) if cols is None else cols
    clean = finite if inf_as_null else present
    zero = {c: F.coalesce(clean(df, c), F.lit(0).cast(df.schema[c].dataType)) for c in cols}
    filled = replace_columns(df, zero)
    return drop_unlabeled(filled, label) if label and label in df.columns else filled


def missing_ratios(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """Share of null or NaN per column, all columns in one scan; empty table gives 0."""
    cols = list(cols or df.columns)
    row = df.agg(F.count("*"), *[F.count_if(is_missing(df, c)) for c in cols]).first()
    return {c: row[i + 1] / row[0] if row[0] else 0.0 for i, c in enumerate(cols)}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with more than ``threshold`` of their values missing."""
    ratios = missing_ratios(df)
    return df.drop(*[c for c, r in ratios.items() if r > threshold and c not in keep])


def fit_median(df: DataFrame, cols: Sequence[str], finite_only: bool = False) -> dict[str, float | None]:
    """Exact medians over the values present."""
    found = exact_quantiles(df, {c: [0.5] for c in cols}, finite_only)
    return {c: v[0] for c, v in found.items()}


def apply_fill(df: DataFrame, values: Mapping[str, float | None], inf_too: bool = False) -> DataFrame:
    """Replace null and NaN (and infinity on request) by fitted values; columns become double."""
    clean = finite if inf_too else present
    return replace_columns(df, {
        c: F.coalesce(clean(df, c).cast("double"), F.lit(v).cast("double")) for c, v in values.items()
    })


def inf_to_median(
    df: DataFrame, cols: Sequence[str] | None = None, medians: Mapping[str, float | None] | None = None
) -> DataFrame:
    """Infinite (and missing) values become the median of the finite ones."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    return apply_fill(df, medians or fit_median(df, cols, finite_only=True), inf_too=True)


def parse_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns to double; text that is no number, and NaN, become null."""
    number = {c: F.expr(f"try_cast(`{c}` AS double)") for c in cols}
    return replace_columns(df, {c: F.when(~F.isnan(x), x) for c, x in number.items()})


def fit_coercion(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Median of the valid numbers per text column; 0 where nothing is valid."""
    medians = fit_median(parse_numeric(df.select(*cols), cols), cols)
    return {c: 0.0 if v is None else v for c, v in medians.items()}


def coerce_numeric(
    df: DataFrame, cols: Sequence[str] | None = None, fallback: Mapping[str, float] | None = None
) -> DataFrame:
    """Mixed-type columns to double; what does not parse becomes the fallback (fitted if not given)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return apply_fill(parse_numeric(df, cols), fallback or fit_coercion(df, cols))


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def with_row_key(df: DataFrame, out: str = "flow_key") -> DataFrame:
    """Key of a table without one: hash of the whole row, unique once duplicates are dropped."""
    return df.withColumn(out, F.md5(F.to_json(F.struct(*df.columns))))


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and removed rows in one grouped scan."""
    groups = df.groupBy(*(subset or df.columns)).agg(F.count("*").alias("__n"))
    total, distinct = F.coalesce(F.sum("__n"), F.lit(0)), F.count("*")
    return groups.agg(total.alias("n_rows"), distinct.alias("n_distinct"),
                      (total - distinct).alias("n_removed"))


def outlier_bounds(
    df: DataFrame, cols: Sequence[str], k: float = IQR_FACTOR, approx: bool = False
) -> dict[str, tuple[float, float] | None]:
    """Quartile-range bounds per column; None for a column without values."""
    points = {c: [0.25, 0.75] for c in cols}
    found = approx_quantiles(df, points) if approx else exact_quantiles(df, points)
    return {c: None if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
            for c, (q1, q3) in found.items()}


def keep_within(df: DataFrame, bounds: Mapping[str, tuple[float, float] | None]) -> DataFrame:
    for c, limits in bounds.items():
        if limits:
            df = df.filter(F.col(c).between(F.lit(limits[0]), F.lit(limits[1])))
    return df


def remove_outliers_iqr(
    df: DataFrame,
    cols: Sequence[str] = OUTLIER_COLUMNS,
    k: float = IQR_FACTOR,
    sequential: bool = True,
    approx: bool = False,
) -> DataFrame:
    """Keep rows inside the bounds; in sequence, a column's bounds see only the rows left so far.

    A row with null in a checked column is dropped. In sequence the checked columns are stored once and narrowed there:
    the table itself is read for that and for the result, however many columns and scans there are.
    """
    cols = [c for c in cols if c in df.columns]
    if not sequential or len(cols) < 2:
        return keep_within(df, outlier_bounds(df, cols, k, approx))
    path = fresh_folder(df.sparkSession, "checked")
    df.select(*cols).write.parquet(path)
    left, bounds = df.sparkSession.read.parquet(path), {}
    for c in cols:
        bounds |= outlier_bounds(left, [c], k, approx)
        left = keep_within(left, {c: bounds[c]})
    drop_folder(df.sparkSession, path)
    return keep_within(df, bounds)


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The listed features in order, absent ones as 0, others dropped (but for ``keep``)."""
    have = set(df.columns)
    return df.select(*[F.col(c) for c in keep],
                     *[F.col(c) if c in have else F.lit(0).alias(c) for c in features if c not in keep])


def drop_identifiers(
    df: DataFrame, cols: Sequence[str] = IDENTIFIERS + TIME_COLUMNS
) -> DataFrame:
    return df.drop(*cols)


def schema_diff(spark: SparkSession, before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added and removed between two frames, with the net change on each row."""
    old, new = set(before.columns), set(after.columns)
    rows = [(c, "added") for c in sorted(new - old)] + [(c, "removed") for c in sorted(old - new)]
    net = len(new) - len(old)
    return spark.createDataFrame([(c, change, net) for c, change in rows],
                                 "column_name string, change string, net_change int")


def filter_attacks(
    df: DataFrame, min_prob: float = 0.8, prediction: str = "prediction", prob: str = "attack_probability"
) -> DataFrame:
    """Predicted attacks at or above a probability."""
    return df.filter((F.col(prediction) == 1) & (F.col(prob) >= min_prob))


def preprocess(
    df: DataFrame,
    remove_outliers: bool = False,
    label: str = "Label",
    outlier_cols: Sequence[str] = OUTLIER_COLUMNS,
    inf_as_null: bool = True,
    row_key: str | None = None,
) -> DataFrame:
    """Fill, deduplicate, normalise labels and, if asked, remove outliers.

    ``row_key`` names a key column made from the rows that are left, before labels are trimmed,
    so that it stays unique. Lazy without outliers to remove; with them the distinct rows are stored first, so that the
    scans for bounds do not deduplicate again. Take quality reports before and after as wanted.
    """
    distinct = df.transform(fill_missing_zero, inf_as_null=inf_as_null, label=label).transform(drop_duplicates)
    if row_key:
        distinct = with_row_key(distinct, row_key)
    clean = distinct.transform(normalize_labels, label)
    if not remove_outliers:
        return clean
    path = fresh_folder(df.sparkSession, "distinct")
    clean.write.parquet(path)
    return remove_outliers_iqr(df.sparkSession.read.schema(clean.schema).parquet(path), outlier_cols)
