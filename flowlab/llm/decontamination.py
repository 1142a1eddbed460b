"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity, so documents are split by size: one with more
than the window of its class has its shingles cut into windows of that size, which have a similarity to the
item that MinHash can see. A window has one minimum per bin (one permutation deals shingles to bins), with so
many bins for its size that nearly every shingle it holds is a minimum. A document and an item are a candidate
pair when any window shares a minimum with the item's signature for that class. A shingle is hidden by a smaller one of
its bin in about 3 of 100 windows, so items of up to four shingles, of which a match may share that few, are candidates
also by any shingle of theirs; with five or more a match is missed in fewer than 1 of a million pairs. Candidates are
then verified: the share of the item's shingles that the whole document holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import stored
from flowlab.llm.shingles import mix, shingle_set

# Classes of document sizes: up to 64 shingles, up to 512, and longer ones in windows of 512.
WINDOWS = (64, 512)
BINS_PER_SHINGLE = 16
EXACT_SHINGLES = 4  # items of so many shingles or fewer are looked up by each of them too
# Items are sent to the tasks in blocks of about so many bytes of text.
BLOCK_BYTES = 8_000_000


def minima(shingles: np.ndarray, bins: int) -> np.ndarray:
    """The smallest hash of each bin that has one; the bin is in the hash."""
    hashes = mix(shingles + np.uint64(1))
    ordered = np.sort(hashes)
    of_bin = (ordered >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    return ordered[np.concatenate([[True], of_bin[1:] != of_bin[:-1]])] if len(ordered) else ordered


def size_class(n: int) -> int:
    return next((i for i, w in enumerate(WINDOWS) if n <= w), len(WINDOWS) - 1)


class ItemIndex:
    """Signatures of a block of items, a sorted list per size class, and the items' full sets."""

    def __init__(self, items: list[tuple], size: int):
        self.ids = [i for i, _ in items]
        self.sets = [shingle_set(t, size) for _, t in items]
        self._keys, self._owners = [], []
        for window in WINDOWS:
            parts = [minima(s, window * BINS_PER_SHINGLE) for s in self.sets]
            keys = np.concatenate([*parts, np.empty(0, np.uint64)])
            owners = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            order = np.argsort(keys, kind="stable")
            self._keys.append(keys[order])
            self._owners.append(owners[order])
        few = [i for i, s in enumerate(self.sets) if 0 < len(s) <= EXACT_SHINGLES]
        keys = np.concatenate([*(self.sets[i] for i in few), np.empty(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self._few_keys, self._few_owners = keys[order], np.repeat(few, [len(self.sets[i]) for i in few]).astype(np.int64)[order]

    def candidates(self, shingles: np.ndarray) -> np.ndarray:
        """Items that share a minimum with any window of a document's set, and items of few shingles that share any."""
        kind = size_class(len(shingles))
        window, keys, owners = WINDOWS[kind], self._keys[kind], self._owners[kind]
        found = []

        def look_up(own: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> None:
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for a, b in zip(low[high > low], high[high > low], strict=True):
                found.append(owners[a:b])

        for start in range(0, len(shingles), window):
            look_up(minima(shingles[start:start + window], window * BINS_PER_SHINGLE), keys, owners)
        if len(self._few_keys):
            look_up(shingles, self._few_keys, self._few_owners)
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)

    def shared(self, item: int, shingles: np.ndarray) -> int:
        own = self.sets[item]
        place = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
        return int((shingles[place] == own).sum())


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id",
                    text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and an item whose shingles it holds to ``percent`` / 100 or more: key, item key,
    item_shingles, shared.

    Items without words (null texts among them) are in no document, documents without words hold none; items
    with fewer words than a shingle are one shingle, found in documents that are that sequence. Null keys stay;
    repeated documents and items give a pair each; empty tables give no row; other columns are not read.

    Items are the query set: their different texts go to the documents in blocks of a bounded size, one pass over the
    documents per block, and no document is shuffled. The ids of a text are joined to what was found for it.
    """
    spark = docs.sparkSession
    named = stored(items.filter(F.col(item_text).isNotNull()).select(
        F.col(item_key).alias("_item"), F.col(item_text).alias("text"), F.sha2(F.col(item_text), 256).alias("_hash")), "items")
    wanted = stored(named.groupBy("_hash").agg(F.first("text").alias("text")), "items")
    n_bytes = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // BLOCK_BYTES)
    schema = f"_key {docs.schema[key].dataType.simpleString()}, _hash string, item_shingles bigint, shared bigint"
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("_hash"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(ItemIndex(
            sorted((r["_hash"], r.text) for r in part.toLocalIterator()), size))
        out = out.unionByName(rows.mapInArrow(_search(shared, percent, size), schema))
    return out.join(named.select("_item", "_hash"), "_hash").select(
        F.col("_key").alias(key), F.col("_item").alias(item_key), "item_shingles", "shared")


def _search(shared, percent: int, size: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = shared.value
        for batch in batches:
            rows, found = [], []
            for i, value in enumerate(batch.column(1)):
                shingles = shingle_set(value.as_py(), size)
                for item in index.candidates(shingles) if len(shingles) else ():
                    both, n = index.shared(item, shingles), len(index.sets[item])
                    if both * 100 >= n * percent:
                        rows.append(i)
                        found.append((index.ids[item], n, both))
            if rows:
                ids, sizes, both = (list(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(ids), pa.array(sizes, pa.int64()),
                     pa.array(both, pa.int64())], ["_key", "_hash", "item_shingles", "shared"])

    return search


def without_leaks(docs: DataFrame, items: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id",
                  text: str = "text", item_text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns. Same cases as ``contained_items``; the test is
    made on each row's own text, so rows that share a key are judged apart."""
    spark = docs.sparkSession
    wanted = stored(items.select(F.col(item_text).alias("text")).filter("text is not null").distinct(), "items")
    n_bytes = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // BLOCK_BYTES)
    clean = docs
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(ItemIndex(
            [(i, t) for i, t in enumerate(sorted(r.text for r in part.toLocalIterator()))], size))
        clean = clean.filter(~_leaks(shared, percent, size)(F.col(text)))
    return clean


def _leaks(shared, percent: int, size: int):
    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        index: ItemIndex = shared.value
        out = []
        for value in texts:
            s = shingle_set(value.as_py(), size)
            out.append(bool(len(s)) and any(index.shared(i, s) * 100 >= len(index.sets[i]) * percent
                                            for i in index.candidates(s)))
        return pa.array(out, pa.bool_())

    return leaks
