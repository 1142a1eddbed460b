"""A corpus pipeline: documents in, packed training pieces out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and hands the written table to the next stage. All stages but the last return the columns of documents.

Nulls: documents without text leave at language identification; null ids, sources and languages pass. Repeated rows
leave at near-duplicate removal. Empty tables pass through every stage. Further columns of documents are kept
up to the last stage, whatever their names.

Texts go to Python in batches of BATCH_ROWS rows. What a stage returns runs when its caller asks for it, so a stage called
by itself leaves that setting in the session; ``run`` puts it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import decontamination, langid, near_dedup, packing, toxicity
from flowlab.llm.common import parquet, stored
from flowlab.llm.queries import TOXIC_FROM, language_rows, toxicity_rows


# The answer of the language classifier counts from this score on; below it a text looks like none of its languages.
LANGUAGE_FROM = 0.32

# Rows of whole texts that go to a Python worker at once; Spark's 10,000 are some 35 MB in each task's buffers and worker.
BATCH_ROWS, BATCH_SETTING = 512, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with batches of BATCH_ROWS rows at most from then on; a smaller setting stays."""

    @wraps(stage)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return staged


@small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language the classifier tells with a score of LANGUAGE_FROM or more, but none that it
    calls ``und`` where that is a label it learned. Without a row to learn from, every document with a letter stays."""
    model = langid.fit(language_rows(docs))
    if model is None:
        return docs.filter(langid.has_letter(F.col("text")))
    answer = langid.predicted(spark, model, F.col("text"))
    return docs.filter(F.when(answer["lang_pred"] != "und", answer["score"]).otherwise(0.0) >= LANGUAGE_FROM)


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold; the model learns from those of them that have a label."""
    model = toxicity.fit_by_key(toxicity_rows(docs), parquet(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score(spark, model, F.col("text")) < TOXIC_FROM)


@small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8 or more."""
    return near_dedup.keep_one(docs, percent=80)


@small_batches
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: less than 80 % of the five-word shingles of each."""
    return decontamination.without_leaks(docs, parquet(spark, sf_dir, "benchmark"))


@small_batches
def pack_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", identify_language), ("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_leaks), ("packing", pack_pieces)]

# Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents of ``sf_dir``."""
    docs, before = parquet(spark, sf_dir, "documents"), spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
