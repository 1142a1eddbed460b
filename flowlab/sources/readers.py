"""Batch sources: CSV with a declared schema, Parquet, JSON flow records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.operators.cleaning import align_features
from flowlab.operators.ordering import union_all
from flowlab.schema import CIC_SCHEMA

CORRUPT = "_corrupt_record"


def _is_repeated_header(schema: T.StructType) -> Column:
    """A header line inside concatenated files: every text field equals its own name."""
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        line = F.coalesce(F.col(CORRUPT) == ",".join(schema.fieldNames()), F.lit(False))
        return line & F.col(schema.fieldNames()[0]).isNull()
    same = F.lit(True)
    for name in text:
        same = same & F.coalesce(F.trim(F.col(name)) == name, F.lit(False))
    return same


def read_flows_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = CIC_SCHEMA,
    mode: str = "PERMISSIVE",
    strict_header: bool = True,
    drop_repeated_headers: bool = True,
    keep_corrupt: bool = False,
    sample_fraction: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """CSV glob with a header and a declared schema; types are never inferred.

    With ``strict_header`` files whose column order differs from the schema fail instead of
    loading into the wrong columns. ``keep_corrupt`` adds the raw text of rows that do not parse.
    """
    schema = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    df = (
        spark.read.schema(wanted)
        .option("header", True)
        .option("mode", mode)
        .option("enforceSchema", not strict_header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path if isinstance(path, str) else list(path))
    )
    if drop_repeated_headers:
        df = df.filter(~_is_repeated_header(schema))
    if not keep_corrupt:
        df = df.drop(CORRUPT)
    return df.sample(fraction=sample_fraction, seed=seed) if sample_fraction else df


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan, pruned to the given columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV source; reads no data beyond the header."""
    return spark.read.option("header", True).csv(path).columns


def read_scoring_csv(
    spark: SparkSession,
    path: str,
    features: Sequence[str],
    types: Mapping[str, T.DataType] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """CSV flows for scoring, columns matched by header name, aligned to the model's features.

    Features are read as double unless ``types`` says otherwise, other columns as text.
    """
    types = dict(types or {})
    wanted = set(features)
    schema = T.StructType()
    for name in header_of(spark, path):
        schema.add(name, types.get(name, T.DoubleType() if name in wanted else T.StringType()), True)
    return align_features(read_flows_csv(spark, path, schema), features, keep)


def from_json_flows(df: DataFrame, col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON flow records to columns, in a table or a stream; a record that does not parse gives nulls."""
    return df.select(*keep, F.from_json(F.col(col), schema).alias("__flow")).select(*keep, "__flow.*")


def to_json_flows(df: DataFrame, cols: Sequence[str] | None = None, out: str = "json",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Columns to one JSON text per row."""
    return df.select(*keep, F.to_json(F.struct(*(cols or df.columns))).alias(out))


def combine(*dfs: DataFrame) -> DataFrame:
    """Append flow tables by column name."""
    return union_all(dfs)
