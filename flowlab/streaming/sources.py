"""File streams of flows and their execution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from flowlab.sources.readers import CORRUPT

PARSE_ERRORS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as timestamps, which watermarks need."""
    plain = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in plain else F.col(c) for c in df.columns])


def unzoned(df: DataFrame) -> DataFrame:
    """Timestamps back to the zone-less type of the tables."""
    zone = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in zone else F.col(c) for c in df.columns])


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder; at most ``files_per_batch`` new ones per batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return zoned(reader.parquet(path))


def csv_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """CSV files with a header arriving in a folder."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def json_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """One JSON flow per line; the text of a line that does not parse is kept beside the nulls."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return reader.text(path).select(F.from_json("value", wanted, PARSE_ERRORS).alias("f")).select("f.*")


def start(
    writer: DataStreamWriter, checkpoint: str, name: str | None = None, continuous: str | None = None
) -> StreamingQuery:
    """Start a query: over what is there now, or every ``continuous`` interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.start()
