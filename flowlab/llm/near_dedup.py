"""Near-duplicate documents by circulant MinHash, bands and exact Jaccard verification.

Two permutations make the whole signature: the first scatters a document's shingles on a circle of 2**32 places,
the second ranks the places, and coordinate k is the smallest rank after turning the circle by k. Bands of
coordinates name buckets; documents that share one are candidates, and a link counts only when the full
shingle sets reach the similarity.

Documents with equal sets are one node. A shingle that no other candidate has can be in no intersection, so a node
with too many of those has no link and leaves before any comparison, and a pair is compared only if what either
shares with others could be enough. In each bucket nodes are first compared with the bucket's smallest node, so a
group of copies costs a comparison per copy; only nodes of a bucket that are then still in different components
are compared with each other, each pair once. Of those, pairs are left out by parities: a set is known by a bit
per cell, and two sets differ in at least as many shingles as cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import free_names, stored
from flowlab.llm.shingles import digest, mix, shingle_set

# A pair at similarity 0.85 shares no bucket with probability (1 - 0.85**4)**32 = 6e-11; at 0.8, 5e-8.
BANDS, ROWS = 32, 4
CHUNK = 4096
# Cells whose parities a set is known by: tight for differences up to about half as many shingles.
CELL_BITS = 11
# Candidate keys up to this number are sent to all tasks to pick their texts; more are joined.
BROADCAST_KEYS = 2_000_000


def signature(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of the ranks on the turned circle; the set must not be empty."""
    places = (mix(shingles) >> np.uint64(32)).astype(np.uint32)  # first permutation
    turns = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]
    out = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(places), CHUNK):
        x = places[None, start:start + CHUNK] + turns  # wraps: a circle
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):  # second permutation
            x ^= x >> np.uint32(shift)
            if factor:
                x *= np.uint32(factor)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """A 64-bit bucket name per band."""
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in rows.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _signatures(texts: pa.Array) -> pa.Array:
    sizes, digests, bands = [], [], []
    for value in texts:
        s = shingle_set(value.as_py())
        sizes.append(len(s))
        digests.append(digest(s))
        bands.append(band_keys(signature(s)) if len(s) else np.empty(0, np.int64))
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                       pa.array(bands, pa.list_(pa.int64()))], ["n", "digest", "bands"])


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit per cell: is the number of shingles whose leading bits name that cell odd?"""
    odd = np.bincount(shingles >> np.uint64(64 - CELL_BITS), minlength=1 << CELL_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 256):
            sets = [shingle_set(t.as_py()) for t in batch.column(0)[start:start + 256]]
            yield pa.RecordBatch.from_arrays([pa.array(map(digest, sets), pa.binary()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                                              pa.array(map(parities, sets), pa.list_(pa.int64()))],
                                             ["digest", "shingles", "parities"])


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): node, root, with root the smallest node. Nodes without a link are
    not listed. Rounds hang every component below its smallest neighbour and contract the links; their number
    grows with the logarithm of the longest chain."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots, edges = stored(ends.select("node", F.col("node").alias("root")), "roots"), links
    while True:
        edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), "edges")
        if edges.isEmpty():
            return roots
        up = stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "up")
        while True:  # follow parents to the top
            above = up.select(F.col("node").alias("root"), F.col("root").alias("_above"))
            jumped = stored(up.join(above, "root", "left").select(
                "node", F.coalesce("_above", "root").alias("root"), F.col("_above").isNotNull().alias("moved")), "up")
            up = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        to = up.select(F.col("node").alias("_from"), F.col("root").alias("_to"))
        roots = stored(roots.join(to, F.col("root") == F.col("_from"), "left")
                       .select("node", F.coalesce("_to", "root").alias("root")), "roots")
        for end in ("a", "b"):
            edges = (edges.join(to, F.col(end) == F.col("_from"), "left")
                     .withColumn(end, F.coalesce("_to", end)).drop("_from", "_to"))


def _reachable(a: str, b: str, percent: int) -> Column:
    """Could two nodes (columns n and shared behind these prefixes) reach the similarity at all?"""
    most = F.least(F.col(f"{a}shared"), F.col(f"{b}shared"))
    return most * 100 >= (F.col(f"{a}n") + F.col(f"{b}n") - most) * percent


def _few_differ(a: str, b: str, percent: int) -> Column:
    """Do so few cells differ between two nodes (columns n and parities) that they could reach the similarity?
    Sets of na and nb shingles that differ in d of them have (na + nb - d) / 2 in common."""
    cells = F.zip_with(f"{a}parities", f"{b}parities", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    d = F.aggregate(cells, F.lit(0), lambda total, one: total + one)
    both = F.col(f"{a}n") + F.col(f"{b}n")
    return (both - d) * 100 >= (both + d) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, could_be: bool = False) -> DataFrame:
    """Pairs (a, b) with a column ``linked``: do their full sets reach the similarity? Pairs that cannot are left out,
    which ``could_be`` says was seen to already."""
    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    right = side("b", "n", "shared").withColumnRenamed("b", "_b")
    fits = pairs if could_be else pairs.join(side("a", "n", "shared"), "a").join(
        right, (F.col("b") == F.col("_b")) & _reachable("a_", "b_", percent)).select("a", "b")
    both = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return fits.join(side("a", "n", "shingles"), "a").join(side("b", "n", "shingles"), "b").select(
        "a", "b", (both * 100 >= (F.col("a_n") + F.col("b_n") - both) * percent).alias("linked"))


def _with_shared(sets: DataFrame, percent: int) -> DataFrame:
    """Candidate sets with ``shared``, the number of shingles that some other candidate has; only nodes for which
    that can be enough for a link."""
    private = (sets.select("node", F.explode("shingles").alias("_s")).groupBy("_s")
               .agg(F.min("node").alias("_of"), F.count("*").alias("_n")).filter("_n = 1")
               .groupBy("_of").agg(F.count("*").alias("_private")))
    shared = F.col("n") - F.coalesce("_private", F.lit(0))
    return (sets.join(private, F.col("node") == F.col("_of"), "left")
            .select("node", "n", "shingles", "parities", shared.alias("shared")).filter(F.col("shared") * 100 >= F.col("n") * percent))


SIGNATURES = "struct<n:bigint,digest:binary,bands:array<bigint>>"
SETS = "digest binary, shingles array<bigint>, parities array<bigint>"


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text",
                    with_hash: bool = False) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept, and on request text_hash (64 bits) and root, a number
    of the component (null without words).

    ``component_id`` is the smallest key reachable over links of similarity ``percent`` / 100 or more, ``kept``
    whether that is the row's own. Documents without words (null texts among them) have no link and are their
    own component; null keys are never the smallest while another key is there; rows with one key are documents
    of their own; an empty table gives no row; other columns are not read.
    """
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    signed = stored(base.select("_key", F.xxhash64("_text").alias("text_hash"), F.arrow_udf(_signatures, SIGNATURES)("_text").alias("_s"))
                    .select("_key", "text_hash", "_s.*")
                    .withColumn("_row", F.monotonically_increasing_id()), "signatures")
    # Of equal sets one row stands for all.
    reps = stored(signed.filter("n > 0").groupBy("digest").agg(F.min("_row").alias("node"), F.min("_key").alias("_least")),
                  "sets")
    rows = signed.join(reps.select(F.col("node").alias("_row")), "_row", "left_semi")
    # Counts and hubs come from groupings, which sum before they shuffle, so a full bucket does not meet in one task.
    named = rows.select(F.col("_row").alias("node"), F.explode("bands").alias("band"))
    several = named.groupBy("band").agg(F.count("*").alias("_n")).filter("_n > 1").select("band")
    buckets = stored(named.join(several, "band").select("band", "node"), "buckets")
    sets = stored(_with_shared(_candidate_sets(base, signed, buckets), percent), "shared")
    sets = stored(_with_shared(sets.drop("shared"), percent), "shared")  # those that left no longer count
    central = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("private"), F.col("node").alias("node"))
    sized = stored(buckets.join(sets.select("node", "n", "shared"), "node").select("band", "node", "n", "shared"), "buckets")
    hubs = sized.groupBy("band").agg(F.min(central).alias("hub"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    buckets = stored(sized.join(hubs, "band").select("band", "node", "n", "shared", "hub"), "buckets")
    # Each node with the most central of its hubs, then with its other hubs, then what is left in each bucket.
    with_hub = buckets.filter("node <> hub.node")
    pair = [F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")]
    first = with_hub.groupBy("node").agg(F.min("hub").alias("hub")).select(*pair).distinct()
    tried = stored(_verified(first, sets, percent), "tried")
    roots = components(tried.filter("linked").select("a", "b"))
    more = stored(_verified(_apart(with_hub.select(*pair).distinct(), roots).join(tried, ["a", "b"], "left_anti"), sets, percent), "tried")
    tried = tried.unionByName(more)
    roots = components(tried.filter("linked").select("a", "b"))
    left = _left_in_buckets(buckets, sets, roots, percent).join(tried, ["a", "b"], "left_anti")
    rest = stored(_verified(left, sets, percent, could_be=True), "tried")
    roots = components(tried.unionByName(rest).filter("linked").select("a", "b"))
    named = reps.join(roots, "node", "left").select("digest", "_least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    hashed = ["text_hash", "root"] if with_hash else []
    by_set = named.join(least, "root").select("digest", "component_id", *hashed[1:])
    own = signed.filter("n = 0").withColumn("root", F.lit(None).cast("bigint")).select(
        "_key", "n", F.col("_key").alias("component_id"), *hashed)
    return (signed.filter("n > 0").join(by_set, "digest").select("_key", "n", "component_id", *hashed).unionByName(own)
            .select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id",
                    F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"), *hashed))


def _candidate_sets(base: DataFrame, signed: DataFrame, buckets: DataFrame) -> DataFrame:
    """Full shingle sets of the nodes that share a bucket: node, n, shingles, parities."""
    nodes = buckets.select(F.col("node").alias("_row")).distinct()
    wanted = stored(signed.join(nodes, "_row", "left_semi").select("_row", "_key", "digest", "n"), "wanted")
    keys = wanted.select(F.col("_key").alias("_wanted")).distinct()
    if wanted.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    texts = base.join(keys, F.col("_key").eqNullSafe(F.col("_wanted")), "left_semi")
    found = texts.select("_text").mapInArrow(_sets, SETS)
    # A key may stand for several texts, so the set decides; equal sets come once.
    return stored(wanted.select("digest", "n", F.col("_row").alias("node")).join(found, "digest")
                  .dropDuplicates(["node"]).select("node", "n", "shingles", "parities"), "shingles")


def _rooted(nodes: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    to = roots.select(F.col("node").alias("_of"), F.col("root").alias("_root"))
    return (nodes.join(to, F.col(column) == F.col("_of"), "left")
            .withColumn(name, F.coalesce("_root", column)).drop("_of", "_root"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    return _rooted(_rooted(pairs, roots, "a", "_ra"), roots, "b", "_rb").filter("_ra <> _rb").select("a", "b")


def _left_in_buckets(buckets: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket that are in different components and could be linked, each in the first bucket they share."""
    rooted = stored(_rooted(buckets.select("band", "node", "n", "shared"), roots, "node", "root"), "rooted")
    mixed = rooted.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo < _hi")
    some = rooted.join(mixed.select("band"), "band", "left_semi")
    bands = some.groupBy("node").agg(F.collect_set("band").alias("bands"))  # BANDS at most
    some = stored(some.join(bands, "node").join(sets.select("node", "parities"), "node"), "mixed")

    def side(name: str) -> DataFrame:
        return some.select(*[F.col(c).alias(f"{name}_{c}") for c in some.columns])

    pairs = side("a").join(side("b"), (F.col("a_band") == F.col("b_band")) & (F.col("a_node") < F.col("b_node"))
                           & (F.col("a_root") != F.col("b_root")) & _reachable("a_", "b_", percent)
                           & _few_differ("a_", "b_", percent)
                           & (F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("a_band")))
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def keep_one(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one of each group of near duplicates, with all their columns: of the texts with the group's
    smallest key the one with the smallest hash, once. A null key never stands for a group that has another key.

    Texts in no group stay, once for each key, also where they share their key with other texts. Only texts without
    words leave where a text with words stays under their key. An empty table gives no row; further columns stay,
    whatever their names.
    """
    kept_key, kept_hash, kept_rows = free_names(docs, "_kept_key", "_kept_hash", "_kept_rows")
    named = near_duplicates(docs, percent, key, text, with_hash=True).select(
        F.col(key).alias(kept_key), F.col("text_hash").alias(kept_hash), F.col("root").alias("_root"), "kept")
    named = stored(named, "named")
    grouped = named.filter("_root is not null")
    # Kept rows of a group have one key, its smallest.
    texts = grouped.filter("kept").groupBy("_root", kept_key, kept_hash).agg(F.count("*").alias(kept_rows))
    one = texts.groupBy("_root").agg(F.min(F.struct(kept_hash, kept_key, kept_rows)).alias("_one")).select("_one.*")
    wordless = (named.filter("_root is null").groupBy(kept_key, kept_hash).agg(F.count("*").alias(kept_rows))
                .join(one.select(kept_key).distinct(), kept_key, "left_anti"))
    kept = stored(one.unionByName(wordless), "kept")

    def rows_of(keys: DataFrame) -> DataFrame:
        near = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
        return docs.join(near, F.col(key).eqNullSafe(F.col(kept_key)) & (F.xxhash64(docs[text]) == F.col(kept_hash)))

    out = rows_of(kept.filter(F.col(kept_rows) == 1)).select(docs["*"])
    several = kept.filter(F.col(kept_rows) > 1)
    if several.isEmpty():
        return out
    repeated = rows_of(several).dropDuplicates([kept_key, kept_hash])
    return out.unionByName(repeated.select(*[F.col(f"`{c}`") for c in docs.columns]))
