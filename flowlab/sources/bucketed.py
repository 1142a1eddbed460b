"""Tables bucketed by a key, so that joins and groupings by it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` below ``path`` in buckets of ``key``, one sorted file each, as table ``table``; the table.

    Two tables with as many buckets join by their keys without a shuffle. All rows of a key are in one bucket, so
    tables in which one key holds a large share of the rows are better left to adaptive joins.
    """
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def read_bucketed(spark: SparkSession, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """A table written before, by another session too, with its layout; ``key`` and ``buckets`` as it was written."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)
