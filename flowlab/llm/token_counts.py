"""Token counts from counts of distinct pre-tokens.

Pieces of the vocabulary never hold a space after another character, a line end, or a letter beside a full stop
or comma, so no merge crosses such a place: a text falls apart there into pre-tokens whose pieces are counted
once per distinct pre-token of the corpus. A document's count is the sum over its pre-tokens, frequency times
pieces; ids are never made for documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import stored

# At most so many pre-tokens, none longer than LONGEST_COMMON bytes, are sent to every task; others are joined.
COMMON_WORDS = 200_000
LONGEST_COMMON = 64
FLUSH_WORDS = 500_000

LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
PRETOKENS = re.compile(rf"\n| *[{LETTER}]+(?=[., \n]|\Z)| *[.,]+(?=[{LETTER} \n]|\Z)| *[^ \n]+| +")
CROSSING = re.compile(rf"[^▁]▁|\n| |[{LETTER}][.,]|[.,][{LETTER}]")


def pretokens(text: str) -> list[str]:
    """A text cut where no piece can cross; the blank that the library puts first is there."""
    return PRETOKENS.findall(" " + text.replace("▁", " ")) if text else []


@lru_cache(maxsize=2)
def processor(path: str):
    """The library's processor, once the vocabulary is known to allow the cuts."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    ordinary = (i for i in range(sp.get_piece_size())
                if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
    if (crossing := next((p for p in map(sp.id_to_piece, ordinary) if CROSSING.search(p)), None)) is not None:
        raise ValueError(f"piece {crossing!r} crosses a place where texts are cut")
    if "".join(sp.encode(" a  b ", out_type=str)) != "▁▁a▁▁b▁":
        raise ValueError("this vocabulary rewrites blanks")
    return sp


def count_pieces(words: list[str], path: str) -> list[int]:
    """Pieces of each pre-token. A line end before it keeps the library from adding its own blank to it."""
    sp = processor(path)
    lead = len(sp.encode("\n"))
    return [len(ids) - lead for ids in sp.encode(["\n" + w for w in words], num_threads=1)]


def dictionary(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Distinct pre-tokens of the corpus: word, uses, pieces."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(uses.keys(), pa.string()), pa.array(uses.values(), pa.int64())],
                                             ["word", "uses"])
            uses.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                uses.update(pretokens(value.as_py() or ""))
                if len(uses) >= FLUSH_WORDS:
                    yield flush()
        yield flush()

    @F.arrow_udf("int")
    def pieces(words: pa.Array) -> pa.Array:
        return pa.array(count_pieces(words.to_pylist(), path), pa.int32())

    counted = docs.select(F.col(text).alias("text")).mapInArrow(words, "word string, uses bigint")
    distinct = counted.groupBy("word").agg(F.sum("uses").alias("uses"))
    return stored(distinct.withColumn("pieces", pieces("word")), "pretokens")


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_tokens. Null texts count as empty ones, with 0 tokens; null keys
    stay; repeated rows are counted once each; other columns are not read.

    The most used pre-tokens (``COMMON_WORDS`` at most) go to every task as a table; each document's other
    pre-tokens meet the dictionary in a join.
    """
    spark = docs.sparkSession
    known = dictionary(docs, path, text)
    level = F.floor(F.log2("uses") * 8).cast("int")
    short = F.octet_length("word") <= LONGEST_COMMON
    total, border = 0, math.inf
    for row in (known.filter(short).groupBy(level.alias("level")).agg(F.count("*").alias("n"))
                .orderBy(F.desc("level")).collect()):  # 8 rows per doubling of the most uses
        if (total := total + row.n) > COMMON_WORDS:
            break
        border = row.level
    is_common = short & (level >= F.lit(border if border != math.inf else 1 << 30))
    common = {r.word: r.pieces for r in known.filter(is_common).select("word", "pieces").toLocalIterator()}
    shared = spark.sparkContext.broadcast(common)

    @F.arrow_udf("struct<tokens:bigint,rest:array<struct<word:string,freq:int>>>")
    def known_part(texts: pa.Array) -> pa.Array:
        table = shared.value
        sums, words, freqs, ends = [], [], [], [0]
        for value in texts:
            n = 0
            for word, freq in Counter(pretokens(value.as_py() or "")).items():
                if (each := table.get(word)) is not None:
                    n += freq * each
                else:
                    words.append(word)
                    freqs.append(freq)
            sums.append(n)
            ends.append(len(words))
        pairs = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(freqs, pa.int32())], ["word", "freq"])
        rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        return pa.StructArray.from_arrays([pa.array(sums, pa.int64()), rest], ["tokens", "rest"])

    split = docs.select(F.col(key).alias("_key"), F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint").alias("n_bytes"),
                        known_part(F.col(text)).alias("_part"))
    rows = stored(split.select(F.monotonically_increasing_id().alias("_row"), "_key", "n_bytes", "_part.*"), "counted")
    rare = rows.select("_row", F.inline("rest")).join(known.filter(~is_common).select("word", "pieces"), "word")
    sums = rare.select("_row", F.lit(None).cast(docs.schema[key].dataType).alias("_key"),
                       F.lit(None).cast("bigint").alias("n_bytes"), (F.col("freq") * F.col("pieces")).alias("tokens"))
    return (rows.select("_row", "_key", "n_bytes", "tokens").unionByName(sums).groupBy("_row")
            .agg(F.max("_key").alias(key), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"))
            .drop("_row"))
