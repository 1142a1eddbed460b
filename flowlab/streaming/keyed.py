"""Per-source context from keyed state: only the bundles of sources a batch touches are read and written."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from flowlab.operators.windows import HOUR_SECONDS
from flowlab.streaming.sources import start

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUB_KEYS = 4
BUNDLES = 512
BLOCKS_PER_WINDOW = 16
NEVER = -(2**62)  # time of a previous flow where there is none
RESULT = ["source", "flow", "t", "pkts", "place", "recent_flows", "recent_pkts", "previous"]


def _text(name: str) -> Column:
    """Any value as text, and null as empty text: state goes by it, and pandas turns numbers beside nulls into floats."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def _value(name: str, kind: T.DataType) -> Column:
    return F.when(F.col(name) != "", F.substr(F.col(name), F.lit(2)).cast(kind))


def _packed(frame: pd.DataFrame) -> bytes:
    batch, sink = pa.RecordBatch.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(value) as held:
        return held.read_all().to_pandas()


class SourceHistory(StatefulProcessor):
    """Flows of one part of a bundle of sources: source, time and packets of those still in reach, in blocks of time.

    ``blocks`` maps a block's number to its flows, so a batch rewrites the blocks it adds to and no others. ``past`` holds
    per source the time of the newest flow dropped and of the newest of all, the flows of sources that fell behind the
    bundle's blocks, the bundle's newest time, and the timer that ends the state.
    """

    def __init__(self, whole_keys: bool, seconds: int, ttl_seconds: int, delay_seconds: int) -> None:
        self.whole_keys, self.window = whole_keys, seconds * 1_000_000
        self.reach = (seconds + delay_seconds) * 1_000_000
        self.life = (max(ttl_seconds, seconds) + delay_seconds) * 1_000
        self.block = max(1, self.window // BLOCKS_PER_WINDOW)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block bigint", "flows binary")
        self.past = handle.getValueState("past", "sources binary, behind binary, newest bigint, timer bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows), ignore_index=True)
        # By source, time, key and packets, so that all parts of the bundle number the flows alike; a null key is first.
        flow = new["number"].to_numpy(np.int64) if self.whole_keys else pd.factorize(new["flow"], sort=True)[0]
        code, names = pd.factorize(new["source"], sort=True)
        order = np.lexsort((new["pkts"].to_numpy(np.int64), flow, new["flow"].to_numpy() != "", new["t"].to_numpy(np.int64), code))
        new, who = new.take(order).reset_index(drop=True), code[order]
        t, own, pkts = new["t"].to_numpy(np.int64), new["own"].to_numpy(bool), new["pkts"].to_numpy(np.int64)

        packed, behind, newest_of_all, timer = self.past.get() or (None, None, NEVER, 0)
        flows = [] if behind is None else [_unpacked(behind)]
        stored = []
        for number, value in self.blocks.iterator():
            flows.append(_unpacked(value[0]))
            stored += [number[0]] * len(flows[-1])
        held = pd.concat(flows, ignore_index=True) if flows else pd.DataFrame({"source": [], "t": [], "pkts": []})
        sources = pd.DataFrame({"source": names, "dropped": NEVER, "newest": NEVER})
        if packed is not None:
            known = _unpacked(packed)
            sources = pd.concat([known, sources[~sources["source"].isin(known["source"])]], ignore_index=True)
        at = pd.Index(sources["source"])
        who, old_who = at.get_indexer(names)[who], at.get_indexer(held["source"])
        old_t, old_p = held["t"].to_numpy(np.int64), held["pkts"].to_numpy(np.int64)
        dropped, newest = sources["dropped"].to_numpy(np.int64).copy(), sources["newest"].to_numpy(np.int64).copy()

        all_who, all_t = np.concatenate([old_who, who[own]]), np.concatenate([old_t, t[own]])
        all_p = np.concatenate([old_p, pkts[own]])
        recent_flows, recent_pkts, before = self._answers(who, t, all_who, all_t, all_p, len(old_t))
        before = np.where(before == NEVER, dropped[who], before)
        # Of this batch, the flow before is the one before in order.
        last = np.maximum.accumulate(np.concatenate([[-1], np.where(own, np.arange(len(t)), -1)[:-1]]))
        before = np.maximum(before, np.where((last >= 0) & (who[last] == who), t[last], NEVER))
        out = new.assign(place=np.arange(len(new)), recent_flows=recent_flows, recent_pkts=recent_pkts, previous=before)

        if own.any():
            np.maximum.at(newest, who[own], t[own])
            # A flow ends with its block, by the newest time of its own source.
            gone = (all_t // self.block + 1) * self.block <= newest[all_who] - self.reach
            np.maximum.at(dropped, all_who[gone], all_t[gone])
            alive = newest // 1_000 + self.life > timerValues.getCurrentWatermarkInMs()
            alive &= newest > NEVER
            is_new = np.arange(len(all_t)) >= len(old_t)
            at_block = np.concatenate([np.full(len(old_t) - len(stored), NEVER), np.array(stored, np.int64), all_t[is_new] // self.block])
            kept = pd.DataFrame({"source": sources["source"].to_numpy()[all_who], "t": all_t, "pkts": all_p})
            sources = sources.assign(dropped=dropped, newest=newest)[alive]
            newest_of_all = max(newest_of_all, int(t[own].max()))
            self._store(kept, ~gone & alive[all_who], is_new, at_block, sources, newest_of_all, timer)
        yield out[RESULT]

    def _answers(self, who, t, all_who, all_t, all_p, n_old: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per new flow: flows and packets of its source in the window up to it, and the newest time of earlier batches in it.

        Flows are laid out by source and time; a window opens before the flows of its first instant and ends after those of its last.
        """
        n, m = len(t), len(all_t)
        kind = np.repeat(np.array([0, 1, 2], np.int8), [n, m, n])
        order = np.lexsort((kind, np.concatenate([t - self.window, all_t, t]), np.concatenate([who, all_who, who])))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        is_flow = kind[order] == 1
        at = np.where(is_flow, order - n, 0)
        count, total = np.cumsum(is_flow), np.cumsum(np.where(is_flow, all_p[at], 0) if m else is_flow)
        low, high = place[:n], place[n + m:]
        before = np.full(n, NEVER)
        if n_old:
            last = np.maximum.accumulate(np.where(is_flow & (at < n_old), np.arange(len(order)), -1))[high]
            flow = at[np.maximum(last, 0)]
            before = np.where((last >= 0) & (all_who[flow] == who), all_t[flow], NEVER)
        return count[high] - count[low], total[high] - total[low], before

    def _store(
        self, flows: pd.DataFrame, keep: np.ndarray, is_new: np.ndarray, at_block: np.ndarray, sources: pd.DataFrame,
        newest: int, timer: int,
    ) -> None:
        """Write the blocks that change and drop those past the newest time; what a source still needs of them goes with ``past``."""
        past_block = (newest - self.reach) // self.block  # the first block that is not over
        behind = keep & (at_block < past_block)
        for number in np.unique(at_block[(at_block < past_block) & (at_block != NEVER) & ~is_new]).tolist():
            self.blocks.removeKey((number,))
        for number in np.unique(at_block[(at_block >= past_block) & (is_new | ~keep)]).tolist():
            mine = keep & (at_block == number)
            if mine.any():
                self.blocks.updateValue((number,), (_packed(flows[mine]),))
            elif not is_new[at_block == number].all():
                self.blocks.removeKey((number,))
        if not timer:
            timer = newest // 1_000 + self.life
            self.handle.registerTimer(timer)
        self.past.update((_packed(sources), _packed(flows[behind]), newest, timer))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """A timer is not moved with every flow: where newer flows came since it was set, it is set anew for them."""
        sources, behind, newest, _ = self.past.get()
        ends = newest // 1_000 + self.life
        if ends <= timerValues.getCurrentWatermarkInMs():
            self.blocks.clear()
            self.past.clear()
        else:
            self.handle.registerTimer(ends)
            self.past.update((sources, behind, newest, ends))
        yield from ()

    def close(self) -> None:
        pass


def _start_on_rocksdb(spark: SparkSession, writer, checkpoint: str, continuous: str | None) -> StreamingQuery:
    """A query takes its settings when it starts, so the session's own store is put back after that."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start(writer, checkpoint, continuous=continuous)
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_keyed_context(
    stream: DataFrame,
    ts: str,
    by: str,
    key: str,
    out: str,
    checkpoint: str,
    pkts: str = "tot_fwd_pkts",
    seconds: int = HOUR_SECONDS,
    ttl_seconds: int = 24 * HOUR_SECONDS,
    delay_seconds: int = 0,
    sub_keys: int = SUB_KEYS,
    bundles: int = BUNDLES,
    continuous: str | None = None,
) -> StreamingQuery:
    """Write key, source, time and packets of each flow with the context of its source as of its arrival.

    Sources are dealt to ``bundles`` by their hash, so small ones share a state call. A bundle is dealt to ``sub_keys`` parts by
    the hash of the flow's key: each part holds the history of its own flows and answers for all flows of its sources that
    arrive, and the answers are added up per batch. So the state of a source that holds a third of all flows lies in several
    tasks. State is kept by RocksDB under the query's checkpoint, changes with the bundles that arrive, and ends per source once
    the watermark is past the lifetime. A checkpoint must go on with the ``bundles`` and ``sub_keys`` it began with.

    A source or key may be null. Flows at or before the watermark (the newest time of earlier batches less the delay) are dropped as late, and so are
    flows without a time. A null number of packets counts 0. Of two flows of one time, the one of the earlier batch, then
    the one with the smaller key, came first. Other columns are not carried; join them by the key.
    """
    if {by, key, ts, pkts} & {"recent_flows", "recent_pkts", "gap_s"}:
        raise ValueError("a column has the name of a result")
    kinds = {c: stream.schema[c].dataType for c in (by, key)}
    whole_keys = isinstance(kinds[key], T.IntegralType)
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(0)) if whole_keys else F.lit(0).cast("bigint")
    flows = stream.filter(F.col(ts).isNotNull()).select(
        _text(by).alias("source"), _text(key).alias("flow"), F.unix_micros(F.col(ts)).alias("t"), F.col(ts).alias("seen"),
        F.coalesce(F.col(pkts).cast("bigint"), F.lit(0)).alias("pkts"), number.alias("number")).withWatermark("seen", f"{delay_seconds} seconds")
    dealt = flows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(sub_keys - 1)))).withColumn(
        "own", F.col("part") == F.pmod(F.xxhash64("flow"), F.lit(sub_keys))).withColumn(
        "bundle", F.pmod(F.xxhash64("source"), F.lit(bundles)))
    history = SourceHistory(whole_keys, seconds, ttl_seconds, delay_seconds)
    numbers = ", ".join(f"{c} bigint" for c in RESULT[2:])
    parts = dealt.groupBy("bundle", "part").transformWithStateInPandas(
        history, f"source string, flow string, {numbers}", "Append", "EventTime")

    def add_up(batch: DataFrame, batch_id: int) -> None:
        flows = batch.groupBy("source", "flow", "t", "pkts", "place").agg(
            F.sum("recent_flows").alias("recent_flows"), F.sum("recent_pkts").alias("recent_pkts"),
            F.max("previous").alias("previous"))
        gap = (F.col("t") - F.col("previous")) / F.lit(1e6)
        flows.select(
            _value("flow", kinds[key]).alias(key), _value("source", kinds[by]).alias(by), F.timestamp_micros("t").alias(ts),
            F.col("pkts").alias(pkts), "recent_flows", "recent_pkts",
            F.when((F.col("previous") > NEVER) & (gap <= ttl_seconds), gap).alias("gap_s"),
        ).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start_on_rocksdb(stream.sparkSession, parts.writeStream.foreachBatch(add_up), checkpoint, continuous)
