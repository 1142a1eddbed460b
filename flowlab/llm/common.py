"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.session import fresh_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new place in the shared folder and read it back.

    What follows starts from that table: its lineage is cut, it is computed once, and a lost executor costs
    only the tasks that read it.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(key: Column) -> Column:
    """CRC-32 of the id written as text; null for a null id."""
    return F.crc32(key.cast("string").cast("binary"))


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to clash with no column, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
