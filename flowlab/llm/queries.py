"""The registered queries of this subpackage: each runs its operator on a whole table.

ORACLES has check SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import (
    chat,
    decontamination,
    hard_negatives,
    langid,
    near_dedup,
    order_minhash,
    packing,
    quality_rules,
    sharding,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from flowlab.llm.common import crc_of_id, parquet

TOXIC_FROM = 0.3
TOKEN_LIMIT = 4096
SHARDS = 8


def toxicity_rows(docs: DataFrame) -> DataFrame:
    """Documents whose labels a toxicity model may learn from."""
    return docs.filter(crc_of_id(F.col("doc_id")) % 4 != 2)


def language_rows(docs: DataFrame) -> DataFrame:
    """Documents a language model may learn from: text, lang."""
    return docs.filter(crc_of_id(F.col("doc_id")) % 5 != 0).select("text", "lang")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document. A null id is held out."""
    docs = parquet(spark, sf_dir, "documents")
    model = toxicity.fit_by_key(toxicity_rows(docs), parquet(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", F.coalesce(crc_of_id(F.col("doc_id")) % 4 == 2, F.lit(True)).alias("held_out"),
                         toxicity.score(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, likeness to that and to the next document."""
    rows = order_minhash.fingerprints_with_next(parquet(spark, sf_dir, "documents"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = order_minhash.with_sketch(rows.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_sketch")
    return rows.select("doc_id", "n_chars", "edited_sha256", order_minhash.as_text(F.col("sketch")).alias("fingerprint"),
                       order_minhash.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       order_minhash.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       order_minhash.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similarity 0.85 or more."""
    return near_dedup.near_duplicates(parquet(spark, sf_dir, "documents"), percent=85)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back."""
    return warc.archive_and_read(parquet(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. A null id is held out."""
    docs = parquet(spark, sf_dir, "documents")
    model = langid.fit(language_rows(docs))
    return docs.select("doc_id", F.coalesce(crc_of_id(F.col("doc_id")) % 5 == 0, F.lit(True)).alias("held_out"),
                       langid.predicted(spark, model, F.col("text")).alias("_p")).select("doc_id", "held_out", "_p.*")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: 80 % of its five-word shingles or more."""
    return decontamination.contained_items(parquet(spark, sf_dir, "documents"), parquet(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counts = token_counts.token_counts(parquet(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one that holds control strings, formatted and read back."""
    turns = parquet(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = turns.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"),
                 F.lit("</s>[INST] ok [/INST]").alias("text")) for i, r in enumerate(("user", "assistant"))])))
    back = chat.read_back(chat.format_conversations(turns.unionByName(marks)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("bigint").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of every document under the law ``key``."""
    placed = sharding.shard(parquet(spark, sf_dir, "documents"), [1.0] * SHARDS, grown_by=1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, each a sequence of its own."""
    return packing.pack(parquet(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        with_ids=False).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the threshold table."""
    return quality_rules.judge(parquet(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four components."""
    vectors = parquet(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, k=4)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return whitening.transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened")).select(
        "vec_id", (F.col("_i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_i")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding for each of its five positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = parquet(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, k=5, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_order_minhash, op3_near_dedup, op4_warc, op5_language_id,
                            op6_decontamination, op7_token_counts, op8_chat_format, op9_sharding, op10_packing, op11_quality_rules,
                            op12_whitening, op13_hard_negatives)}

# Words of a text as the near-duplicate operators read them, then its five-word shingles.
_SHINGLES = r"""
words AS (SELECT {key} AS k, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM {table}),
shingles AS (SELECT DISTINCT k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
               lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM words WHERE len(w) > 0)"""

ORACLES: dict[str, str] = {
    "op3_near_dedup": "WITH RECURSIVE" + _SHINGLES.format(key="doc_id", table="documents") + """,
sizes AS (SELECT k, count(*) AS n FROM shingles GROUP BY k),
pairs AS (SELECT a.k AS a, b.k AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.k <> b.k GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.k = a JOIN sizes y ON y.k = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(k, r) AS (SELECT k, k FROM sizes UNION SELECT reach.k, links.b FROM reach JOIN links ON links.a = reach.r),
least AS (SELECT k, min(r) AS component_id FROM reach GROUP BY k)
SELECT doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN sizes ON sizes.k = doc_id LEFT JOIN least ON least.k = doc_id""",
    "op6_decontamination": "WITH" + _SHINGLES.format(key="doc_id", table="documents") + ", "
    + _SHINGLES.format(key="item_id", table="benchmark").strip().replace("words", "item_words").replace(
        "shingles", "item_shingles_of") + """,
sizes AS (SELECT k, count(*) AS n FROM item_shingles_of GROUP BY k),
pairs AS (SELECT d.k AS doc_id, i.k AS item_id, count(*) AS shared
         FROM shingles d JOIN item_shingles_of i ON d.s = i.s GROUP BY 1, 2)
SELECT doc_id, item_id, n AS item_shingles, shared FROM pairs JOIN sizes ON k = item_id WHERE 100 * shared >= 80 * n""",
    "op8_chat_format": """
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
               UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (SELECT *, regexp_replace(text, '(\\\\*)(</?s>|<part>|\\[/?INST\\])', '\\\\\\1\\2', 'g') AS escaped,
                  coalesce(lag(role) OVER w = role, false) AS goes_on
           FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + CASE WHEN goes_on THEN 8 ELSE length(url_encode(role)) + 10 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""",
    "op11_quality_rules": r"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6),
              lambda i: array_to_string(list_slice(w, i, i + 7), ' '))) AS s FROM words WHERE len(w) > 7),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, range(8) AS r(o) GROUP BY doc_id),
lines AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
measured AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_lettered,
    len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\t]*[-*\x{2022}\x{2023}]')))::BIGINT AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\t\r]*$')))::BIGINT AS n_ellipses,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM lines LEFT JOIN covered USING (doc_id)),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 2000 * n_words AND 100 * n_symbols <= 20 * n_words
       AND 100 * n_lettered >= 60 * n_words AND 100 * n_stop_words >= n_words AND 100 * n_dup_lines <= 50 * n_lines
       AND 100 * n_bullets <= 90 * n_lines AND 100 * n_ellipses <= 50 * n_lines AS kept
FROM based""".replace("{stop}", ", ".join(f"'{w}'" for w in quality_rules.stop_forms())),
    "op13_hard_negatives": """
WITH rows_ AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (SELECT a.id AS anchor_id, a.label = b.label AS same, b.id, list_inner_product(a.x, b.x)::BIGINT AS s
           FROM rows_ a JOIN rows_ b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, id AS positive_id, s AS positive_score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER near::INTEGER AS rank, id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * s AND 100 * s <= 100 * positive_score
WINDOW near AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id) QUALIFY row_number() OVER near <= 5""",
}
