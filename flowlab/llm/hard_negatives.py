"""Hard negatives by anchor spanning-tree bounds.

Anchors are dealt to blocks of near ones, and each block gets a minimum spanning tree. Along an edge a score changes by at
most the edge's length times the candidate's norm, so a parent's score, or what is known of it, bounds the score of
its child; only candidates whose bounds overlap a window of the child are scored again. Two passes use this: the first finds
each anchor's positives (its window starts at the worst of the best found so far), the second the negatives whose
score lies in the window of a positive.

Rows and blocks meet by a join on salts: every group holds a bounded share of the rows and a bounded number of blocks,
so work grows with anchors times rows, memory with neither. Products are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.llm.common import stored
from flowlab.llm.vectors import common_length, integers, matrix

BLOCK = 512  # anchors of a tree
BLOCKS_PER_GROUP = 32
ROWS_PER_GROUP = 16_384
LEAST_GROUPS = 32
CHUNK = 2048  # rows scored at once
SKETCH_BITS = 12
LONGEST = float(1 << 62)  # squared length of a vector; products of two such fit a long
NONE = -(1 << 63) + 1  # score of a pair that was not scored

BLOCK_SCHEMA = ("block bigint, ids array<bigint>, labels array<bigint>, x array<bigint>, parent array<bigint>, "
                "edge array<double>, level array<bigint>")
FOUND = "anchor bigint, block bigint, slot bigint, window bigint, score bigint, id bigint"


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows: parent, length of the edge to it and level of each; the root, nearest to the
    middle of all, has parent -1."""
    points, n = x.astype(float), len(x)
    squares = (points * points).sum(axis=1)
    root = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, level = np.full(n, -1), np.zeros(n, np.int64)
    near, left, at = np.full(n, np.inf), np.ones(n, bool), root
    for _ in range(n - 1):
        left[at] = False
        apart = squares + squares[at] - 2 * (points @ points[at])
        nearer = left & (apart < near)
        near[nearer], parent[nearer] = apart[nearer], at
        at = int(np.where(left, near, np.inf).argmin())
        level[at] = level[parent[at]] + 1
    up = np.where(parent < 0, np.arange(n), parent)
    return parent, np.sqrt(((points - points[up]) ** 2).sum(axis=1)), level


class Block:
    """Anchors of a tree, with the windows that scores are looked for in: ``low`` and ``high``, a column per window."""

    def __init__(self, ids, labels, x, parent, edge, level, low: np.ndarray, high: np.ndarray):
        self.ids, self.labels, self.x, self.parent, self.edge, self.level = ids, labels, x, parent, edge, level
        self.low, self.high = low, high
        self.longest = int(np.abs(x).max(initial=0))

    def scores(self, x: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, int]:
        """Exact scores, anchors by rows, of allowed pairs that may lie in a window, else NONE; and how many of
        the pairs below the root were scored."""
        size = x.shape[1]
        # Doubles hold these products exactly, and are multiplied faster; else longs.
        kind = np.float64 if self.longest * int(np.abs(x).max(initial=0)) * size < 1 << 53 else np.int64
        anchors, rows = self.x.astype(kind), x.astype(kind)
        norms = np.sqrt((x.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
        out = np.full(allowed.shape, NONE, np.int64)
        low, high = np.full(allowed.shape, -np.inf), np.full(allowed.shape, np.inf)
        # Windows of an anchor as one from its lowest to its highest; those that hold nothing do not count.
        real = self.low <= self.high
        least = np.where(real, self.low.astype(float), np.inf).min(axis=1)
        most = np.where(real, self.high.astype(float), -np.inf).max(axis=1)
        scored = 0
        for depth in range(int(self.level.max()) + 1):
            at = np.flatnonzero(self.level == depth)
            if depth == 0:
                near = np.ones((1, len(x)), bool)
            else:
                reach = self.edge[at][:, None] * norms
                reach += np.abs(reach) * 1e-9 + 1
                up = self.parent[at]
                low[at], high[at] = low[up] - reach, high[up] + reach
                # Doubles that stand for longs are right to a share of 2**-52.
                slack = 1 + np.maximum(np.abs(low[at]), np.abs(high[at])) * 1e-12
                near = allowed[at] & (high[at] + slack >= least[at][:, None]) & (low[at] - slack <= most[at][:, None])
                scored += int(near.sum())
            if near.mean() > 0.25:
                exact = (anchors[at] @ rows.T).astype(np.int64)
                low[at] = np.where(near, exact, low[at])
                high[at] = np.where(near, exact, high[at])
                out[at] = np.where(near & allowed[at], exact, NONE)
            else:
                a, r = np.nonzero(near)
                exact = np.einsum("ij,ij->i", anchors[at[a]], rows[r]).astype(np.int64)
                low[at[a], r] = high[at[a], r] = exact
                out[at[a], r] = exact
        return out, scored


def first_in_windows(scores: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """Of each row of ``scores`` and each window the k highest scores in it, ties by position: anchor, window, score, id."""
    some = (scores > NONE).any(axis=0)
    scores, ids = scores[:, some], ids[some]
    order = np.argsort(-scores, axis=1, kind="stable")
    ranked = np.take_along_axis(scores, order, axis=1)
    parts = []
    for w in range(low.shape[1]):
        start = (ranked > high[:, w, None]).sum(axis=1)
        at = start[:, None] + np.arange(k)
        inside = at < ranked.shape[1]
        a, j = np.nonzero(inside)
        place = at[a, j]
        value = ranked[a, place]
        good = (value > NONE) & (value >= low[a, w])
        a, place = a[good], place[good]
        parts.append((a, np.full(len(a), w), value[good], ids[order[a, place]]))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True))


def _best(found: tuple, k: int) -> tuple:
    """The k first of each anchor and window: highest scores, ties by smaller id."""
    a, w, s, i = found
    order = np.lexsort((i, -s, w, a))
    a, w, s, i = a[order], w[order], s[order], i[order]
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])) if len(a) else np.zeros(0, int)
    place = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
    keep = place < k
    return a[keep], w[keep], s[keep], i[keep]


def _search(ids, labels, x, block: Block, k: int, same_label: bool) -> tuple:
    """The k first rows of each window of each anchor, among rows in rising order of ids."""
    found = tuple(np.zeros(0, np.int64) for _ in range(4))
    for start in range(0, len(ids), CHUNK):
        i, y = ids[start:start + CHUNK], labels[start:start + CHUNK]
        same = block.labels[:, None] == y
        allowed = same & (block.ids[:, None] != i) if same_label else ~same
        scores, _ = block.scores(x[start:start + CHUNK], allowed)
        more = first_in_windows(scores, i, block.low, block.high, k)
        found = _best(tuple(np.concatenate(c) for c in zip(found, more, strict=True)), k)
        # What is full is looked for above its last score only; an equal one has a larger id.
        a, w, s, _ = found
        full = np.flatnonzero((a[k - 1:] == a[:len(a) - k + 1]) & (w[k - 1:] == w[:len(a) - k + 1])) if len(a) >= k else []
        for first in full:
            block.low[a[first], w[first]] = max(block.low[a[first], w[first]], s[first + k - 1] + 1)
    return found


def _pass(rows: DataFrame, blocks: DataFrame, size: int, k: int, groups: int, block_groups: int, percent: int | None) -> DataFrame:
    """FOUND: the k first rows of each group for each anchor and window. Without ``percent`` there is one open window
    and rows are positives; with it, blocks have a column ``windows`` (slot, rank and score of positives)."""

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("id")
        ids, labels = (left.column(c).to_numpy() for c in ("id", "label"))
        x = matrix(left.column("x"), size)
        out = []
        for b in right.to_pylist() if len(ids) else []:
            n = len(b["ids"])
            columns = [np.array(b[c]) for c in ("ids", "labels", "x", "parent", "edge", "level")]
            columns[2] = columns[2].reshape(n, size)
            if percent is None:
                low, high = np.full((n, 1), NONE), np.full((n, 1), -NONE)
            else:
                low, high = np.full((n, k), -NONE), np.full((n, k), NONE)  # nothing lies in these
                for window in b["windows"]:
                    low[window["slot"], window["rank"]] = -(-percent * window["score"] // 100)
                    high[window["slot"], window["rank"]] = window["score"]
            found = _search(ids, labels, x, Block(*columns, low, high), k, percent is None)
            out.append(pa.table([columns[0][found[0]], np.full(len(found[0]), b["block"]), *found],
                                ["anchor", "block", "slot", "window", "score", "id"]))
        empty = pa.table([pa.array([], pa.int64())] * 6, ["anchor", "block", "slot", "window", "score", "id"])
        return pa.concat_tables([empty, *out])

    left = rows.select("id", "label", "x", F.pmod(F.xxhash64("id"), F.lit(groups)).alias("_g"),
                       F.explode(F.sequence(F.lit(0), F.lit(block_groups - 1))).alias("_h"))
    right = blocks.withColumn("_h", F.pmod("block", F.lit(block_groups)).cast("int")).withColumn(
        "_g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
    found = left.groupBy("_g", "_h").cogroup(right.groupBy("_g", "_h")).applyInArrow(search, FOUND)
    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _blocks(anchors: DataFrame, size: int) -> DataFrame:
    """BLOCK_SCHEMA: trees of about BLOCK anchors each, near ones together."""
    planes = np.random.default_rng(20_240_229).normal(size=(size, SKETCH_BITS))

    @F.arrow_udf("bigint")
    def sketch(x: pa.Array) -> pa.Array:
        signs = (matrix(x, size).astype(float) @ planes) > 0
        return pa.array(signs @ (1 << np.arange(SKETCH_BITS)), pa.int64())

    sketched = stored(anchors.select("id", "label", "x", sketch("x").alias("_s")), "anchors")
    # Sketches in order share blocks until one is full; a sketch of several blocks' anchors is dealt out by the hash of ids.
    counts = {r._s: r["count"] for r in sketched.groupBy("_s").count().collect()}  # at most 2**SKETCH_BITS rows
    first, parts, block, held = {}, {}, 0, 0
    for s in sorted(counts):
        n = counts[s]
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        first[s], parts[s] = block, -(-n // BLOCK)
        if parts[s] > 1:
            block, held = block + parts[s], 0
        else:
            held += n
    numbers = sketched.sparkSession.createDataFrame([(s, first[s], parts[s]) for s in first], "_s bigint, _first bigint, _parts bigint")
    placed = sketched.join(F.broadcast(numbers), "_s").select(
        (F.col("_first") + F.pmod(F.xxhash64("id", F.lit("block")), F.col("_parts"))).alias("block"), "id", "label", "x")

    def tree(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        x = matrix(group.column("x"), size)
        parent, edge, level = spanning_tree(x)
        lists = [group.column("id").to_numpy(), group.column("label").to_numpy(), x.ravel(), parent, edge, level]
        return pa.table([group.column("block").slice(0, 1), *[pa.array([v]) for v in lists]],
                        ["block", "ids", "labels", "x", "parent", "edge", "level"])

    return stored(placed.groupBy("block").applyInArrow(tree, BLOCK_SCHEMA), "trees")


def vectors_of(df: DataFrame, is_anchor: Column, key: str, label: str, vector: str) -> tuple[DataFrame, int]:
    """The rows that take part, once per key: id, label, x, anchor; and the length of their vectors."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                     integers(F.col(vector)).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    squares = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double"))
    rows = stored(rows.filter("id is not null and label is not null and x is not null").filter(squares < LONGEST), "rows")
    size = common_length(rows, "x")
    rows = rows.filter(F.size("x") == size)
    repeated = stored(rows.groupBy("id").count().filter("count > 1").select("id"), "repeated")
    if repeated.isEmpty():
        return rows, size
    one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("x", "label", "anchor")).alias("_one"))
    return stored(rows.join(repeated, "id", "left_anti").unionByName(one.select("id", "_one.*")), "rows"), size


def hard_negatives(df: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
                   k: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(256 * c). An anchor's positives are its ``k`` first other rows of its label, and
    for each of them its negatives are the ``k`` first rows of other labels whose score is at least ``percent`` / 100 of
    the positive's and at most that; higher scores come first, ties by smaller key. Fewer where there are fewer.

    Rows with a null key or label, a null vector or an entry that is null or not finite take no part, nor do vectors
    of another length than the commonest, empty ones, and those with a squared length of 2**62 or more. Of rows that
    repeat a key the one with the smallest vector, then label, takes part. Equal vectors under different keys are rows
    of their own. Without anchors or rows there is no result. Other columns are not read, except by ``is_anchor``.
    """
    rows, size = vectors_of(df, is_anchor, key, label, vector)
    blocks = _blocks(rows.filter("anchor"), size)
    groups = max(LEAST_GROUPS, -(-rows.count() // ROWS_PER_GROUP))
    block_groups = max(1, -(-blocks.count() // BLOCKS_PER_GROUP))
    positives = stored(_pass(rows, blocks, size, k, groups, block_groups, None), "positives")
    windows = positives.groupBy("block").agg(F.collect_list(F.struct(
        "slot", (F.col("rank") - 1).cast("bigint").alias("rank"), "score")).alias("windows"))
    negatives = _pass(rows, blocks.join(windows, "block"), size, k, groups, block_groups, percent)
    of = positives.select("anchor", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    return negatives.join(of, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
