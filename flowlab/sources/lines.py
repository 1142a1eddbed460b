"""Slices of raw CSV captures, cut line by line before anything is parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.schema import CIC_SCHEMA
from flowlab.sources.readers import CORRUPT

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
HEADER, BAD, INSIDE, OUTSIDE = "header", "bad", "inside", "outside"


def _time_of(line: Column, schema: T.StructType, ts: str, time_format: str) -> Column:
    """The time field of a line; null where it is none. Fields before it must not hold commas."""
    before = schema.fieldNames().index(ts)
    text = F.regexp_extract(line, rf"^(?:[^,]*,){{{before}}}\"?([^,\"]*)", 1)
    return F.try_to_timestamp(F.trim(text), F.lit(time_format))


def classified_lines(
    spark: SparkSession, path: str, start: str, end: str, schema: T.StructType = CIC_SCHEMA, ts: str = "Timestamp",
    time_format: str = TIME_FORMAT, pattern: str | None = None,
) -> DataFrame:
    """Every line of the files: value, kind (header, bad, inside, outside) and, of lines inside, the parsed record.

    A line is inside if start <= its time < end and, with ``pattern``, if that expression is found in it. Bad are lines
    without a valid time, and lines inside whose fields do not fit the schema. Only lines inside are parsed.
    """
    names = ",".join(schema.fieldNames())
    when = _time_of(F.col("value"), schema, ts, time_format)
    within = (when >= F.lit(start).cast("timestamp")) & (when < F.lit(end).cast("timestamp"))
    if pattern:
        within = within & F.col("value").rlike(pattern)
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    record = F.from_csv("value", _ddl(wanted), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    lines = spark.read.text(path).filter(F.trim("value") != "")
    kind = F.when(F.col("value") == names, HEADER).when(when.isNull(), BAD).when(within, INSIDE).otherwise(OUTSIDE)
    parsed = lines.withColumn("kind", kind).withColumn("record", F.when(F.col("kind") == INSIDE, record))
    broken = (F.col("kind") == INSIDE) & F.col(f"record.{CORRUPT}").isNotNull()
    return parsed.withColumn("kind", F.when(broken, BAD).otherwise(F.col("kind")))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def slice_lines(spark: SparkSession, path: str, start: str, end: str, schema: T.StructType = CIC_SCHEMA, **options) -> DataFrame:
    """The records of the lines inside, in the columns of the schema."""
    lines = classified_lines(spark, path, start, end, schema, **options).filter(F.col("kind") == INSIDE)
    return lines.select(*[F.col("record").getField(n).alias(n) for n in schema.fieldNames()])


def count_lines(spark: SparkSession, path: str, start: str, end: str, schema: T.StructType = CIC_SCHEMA, **options) -> DataFrame:
    """How many lines of each kind there are; empty lines count for none."""
    return classified_lines(spark, path, start, end, schema, **options).groupBy("kind").agg(F.count("*").alias("n"))
