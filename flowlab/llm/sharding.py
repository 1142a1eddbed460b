"""Sharding by rendezvous hashing, with DataFrame expressions only.

Every shard draws an exponential time for a record from a hash of the record's key and the shard's number,
divided by the shard's weight; the record goes to the earliest. Shares follow the weights, a further shard
only takes records, and a removed one only gives its own away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import stored

SLOT_BUCKETS = 1024


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Number of the shard a key goes to. A null key is a key like any other."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))

    def draw(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(text, F.lit(shard)), 11)  # 53 bits
        return F.struct((-F.log((bits + 0.5) / float(1 << 53)) / weight).alias("at"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[draw(i, float(w)) for i, w in enumerate(weights)]))["shard"]


def shard(docs: DataFrame, weights: list[float], key: str = "doc_id", text: str = "text",
          grown_by: float | None = None) -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, grown_shard.

    ``size`` is UTF-8 bytes of the text plus 1, ``slot`` a number from 0 without gaps in each shard,
    ``grown_shard`` the place once a shard of weight ``grown_by`` is added (null if not asked). Null texts count
    as empty, null keys as one more key; repeated rows get a slot each; other columns are not read.

    Slots need no sorted shard: records are numbered in ``SLOT_BUCKETS`` buckets per shard, and the counts of
    the buckets before, a table of buckets times shards rows, are added.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    grown = rendezvous(F.col(key), [*weights, grown_by]) if grown_by else F.lit(None).cast("int")
    placed = stored(docs.select(
        F.col(key).alias("_key"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), rendezvous(F.col(key), weights).alias("shard"), grown.alias("grown_shard"),
    ).withColumn("_bucket", F.pmod(F.xxhash64("_key", "text_crc32"), F.lit(SLOT_BUCKETS)).cast("int")), "shards")
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(F.col("_key").asc_nulls_first(), "text_crc32", "size")
    return (placed.withColumn("_place", F.row_number().over(inside) - 1)
            .join(F.broadcast(first), ["shard", "_bucket"])  # buckets times shards rows
            .select(F.col("_key").alias(key), "size", "text_crc32", "shard",
                    (F.col("_first") + F.col("_place")).cast("bigint").alias("slot"), "grown_shard"))
