"""Order MinHash fingerprints, with DataFrame expressions only.

A text is read as tokens: runs of characters without blanks, cut after every eighth character. Longer runs than two
such tokens are read as the eight characters from each of their places, so that a character more or less does not
move all later cuts of a text without blanks. K tokens in a row are a k-mer, and repeats of a k-mer are told apart
by their occurrence number. The hash of (k-mer, occurrence) deals every k-mer to one of BINS sketches and ranks it
there; a sketch keeps its MINIMA smallest, puts them back in text order and hashes that tuple. Two fingerprints are as alike as the share of sketches with equal tuples, so moved text
counts as different though its k-mers are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, BINS, MINIMA = 3, 64, 2
# A run of over 16 characters as a whole, or a token; then the tokens of such a run.
TOKEN, LONG = r"\S{16}\S+|\S{1,8}", 16
PLACES = r"(?=(\S{8}))\S"
# A k-mer is one long: 35 bits of hash, of which the first 6 tell the bin, then 28 bits of place.
PLACE_BITS, HASH_BITS = 28, 35
BIN_SHIFT = PLACE_BITS + HASH_BITS - (BINS - 1).bit_length()
MAX_SPLITS = 4096


def _pack(hashed: Column, place: Column) -> Column:
    high = F.shiftleft(F.shiftrightunsigned(hashed, 64 - HASH_BITS), PLACE_BITS)
    return high.bitwiseOR(F.least(place, F.lit((1 << PLACE_BITS) - 1)).cast("bigint"))


def _place(kmer: Column) -> Column:
    return kmer.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _hash(kmer: Column) -> Column:
    return F.shiftright(kmer, PLACE_BITS)


def _bin(kmer: Column) -> Column:
    return F.shiftright(kmer, BIN_SHIFT)


def tokens(text: Column) -> Column:
    """The tokens of a text in their order."""
    def cut(runs: Column) -> Column:
        return F.flatten(F.transform(runs, lambda run: F.when(
            F.char_length(run) > LONG, F.regexp_extract_all(run, F.lit(PLACES), F.lit(1))).otherwise(F.array(run))))

    runs = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.when(text.rlike(rf"\S{{{LONG + 1}}}"), cut(runs)).otherwise(runs)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array of longs, bin number before 32 bits of the tuple's hash, for each bin that has a k-mer.

    A null text is an empty one; a text without tokens has an empty array; one with fewer than K tokens has one
    k-mer of what there is. Steps are columns of their own so that each array is made once.
    """
    kmers = F.transform(
        F.slice("_tokens", 1, F.greatest(F.size("_tokens") - (K - 1), F.least(F.size("_tokens"), F.lit(1)))),
        lambda t, i: _pack(F.xxhash64(t, *[F.get("_tokens", i + j) for j in range(1, K)]), i))
    again = F.filter("_kmers", lambda x, i: (i > 0) & (_hash(x) == _hash(F.get("_kmers", i - 1))))
    # A run of one repeated k-mer in _again starts where the hash changes; the place in the run is the occurrence.
    starts = F.filter(F.sequence(F.lit(0), F.size("_again") - 1),
                      lambda i: (i == 0) | (_hash(F.get("_again", i)) != _hash(F.get("_again", i - 1))))
    runs = F.transform("_starts", lambda s, j: F.slice(
        "_again", s + 1, F.coalesce(F.get("_starts", j + 1), F.size("_again")) - s))
    numbered = F.flatten(F.transform(runs, lambda run: F.transform(
        run, lambda x, occurrence: _pack(F.xxhash64(_hash(x), occurrence + 1), _place(x).cast("int")))))
    firsts = F.filter("_kmers", lambda x, i: (i == 0) | (_hash(x) != _hash(F.get("_kmers", i - 1))))
    minima = F.filter("_ranked", lambda x, i: (i < MINIMA) | (_bin(x) != _bin(F.get("_ranked", i - MINIMA))))
    no_longs = F.array().cast("array<bigint>")

    def sketch(x: Column, i: Column) -> Column:
        group = F.filter(F.slice("_minima", i + 1, MINIMA), lambda y: _bin(y) == _bin(x))
        in_text_order = F.sort_array(F.transform(group, lambda y: F.shiftleft(_place(y), HASH_BITS).bitwiseOR(_hash(y))))
        hashes = F.transform(in_text_order, lambda y: y.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
        return F.when((i == 0) | (_bin(F.get("_minima", i - 1)) != _bin(x)),
                      F.shiftleft(_bin(x), 32).bitwiseOR(F.shiftrightunsigned(F.xxhash64(hashes), 32)))

    return (df.withColumn("_tokens", tokens(F.coalesce(F.col(text), F.lit(""))))
            .withColumn("_kmers", F.sort_array(kmers)).drop("_tokens")
            .withColumn("_again", again)
            .withColumn("_starts", F.when(F.size("_again") > 0, starts).otherwise(F.array().cast("array<int>")))
            .withColumn("_ranked", F.when(F.size("_again") > 0, F.sort_array(F.concat(firsts, numbered)))
                        .otherwise(F.col("_kmers")))
            .drop("_again", "_starts", "_kmers")
            .withColumn("_minima", F.when(F.size("_ranked") > 0, minima).otherwise(no_longs)).drop("_ranked")
            .withColumn(out, F.filter(F.transform("_minima", sketch), lambda s: s.isNotNull())).drop("_minima"))


def as_text(sketch: Column) -> Column:
    """The fingerprint as a string: ten hexadecimal digits per bin that has a k-mer."""
    return F.array_join(F.transform(sketch, lambda s: F.lower(F.lpad(F.hex(s), 10, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the bins that either text has k-mers in; 1 for two texts without any."""
    both = F.size(F.array_intersect(F.transform(a, lambda s: F.shiftright(s, 32)),
                                    F.transform(b, lambda s: F.shiftright(s, 32))))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either).cast("double")


def _part_of(value: Column, splits: list[int]) -> Column:
    """How many of the sorted splits are at most ``value``, less one: two steps of a square root each."""
    step = max(1, int(len(splits) ** 0.5))
    coarse = F.size(F.filter(F.array(*map(F.lit, splits[::step])), lambda s: s <= value)) - 1
    fine = F.slice(F.array(*map(F.lit, splits)), coarse * step + 1, F.lit(step))
    return coarse * step + F.size(F.filter(fine, lambda s: s <= value)) - 1


def fingerprints_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, text, sketch, and the next document's next_text and next_sketch.

    Next is by ascending key, after the last comes the first. Null texts are empty; null keys come first; rows with
    one key are ordered by a hash of the text; repeated rows follow each other; an empty table gives no row;
    other columns are not read.

    Documents are cut into ranges at keys that exist, and the first row of a range is also sent to the range
    before, as its end: one shuffle of the texts, no sort of everything in one task.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    base = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.withColumn("_at", F.coalesce(F.col("_key").cast("bigint"), F.lit(lowest)))
    ranges = min(MAX_SPLITS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = base.agg(F.percentile_approx("_at", [i / ranges for i in range(ranges)], 20 * ranges).alias("splits"),
                     F.min("_at").alias("least")).first()
    splits = sorted({found.least, *(found.splits or [])}) if found.least is not None else [lowest]
    part = _part_of(F.col("_at"), splits)
    # The first row of all also ends the last range; the first row of any other range ends the one before.
    starts = F.array_contains(F.array(*map(F.lit, splits)), F.col("_at"))
    copies = F.when(starts, F.array(
        F.struct(F.col("_part").alias("part"), F.lit(0).alias("end")),
        F.struct(F.pmod(F.col("_part") - 1, F.lit(len(splits))).alias("part"), F.lit(1).alias("end")))).otherwise(
        F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("end"))))
    dealt = (with_sketch(base, "_text", "_sketch").withColumn("_part", part)
             .withColumn("_copy", F.explode(copies)).withColumn("_part", F.col("_copy.part"))
             .withColumn("_end", F.col("_copy.end")).drop("_copy"))
    order = Window.partitionBy("_part").orderBy("_end", "_at", F.xxhash64("_text"))
    rows = dealt.withColumn("_next_text", F.lead("_text").over(order)).withColumn("_next_sketch", F.lead("_sketch").over(order))
    return rows.filter("_end = 0").select(F.col("_key").alias(key), F.col("_text").alias("text"),
                                          F.col("_sketch").alias("sketch"), F.col("_next_text").alias("next_text"),
                                          F.col("_next_sketch").alias("next_sketch"))
