"""Open positions as the state of a stream of bars: score exits decided bar by bar, and tracked peaks and stops.

Bars may come late and out of order, up to the watermark's delay, and the stream may stop and start
again between micro-batches: all that is known of an entity lies in the state store. Closed trades are
the stream's output; positions that are open are read from the store.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from ..sources.tables import read_or_empty

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = "stock_id long, signal_ms long, buy_ms long, sell_ms long, buy_price double, sell_price double, hold int, exit_reason string"


#: A bar that waits; unknown values are NaN.
BAR = np.dtype([("id", "<i8"), ("ms", "<i8"), ("open", "<f8"), ("score", "<f8")])
BLOCK = 10_000  # bars of an element of the list of those that wait
PACKED = 1 << 20  # bars that a task holds to pack them by bucket
KEYLESS = -1  # the bucket of bars without an entity
REASONS = np.array([None, "score", "max_hold"])


class ScoreExits(StatefulProcessor):
    """The rules of simulation.score_exit for a bucket of entities, as their bars pass the watermark.

    A call reads and writes each state once for all entities of its bucket, as a call costs far more than an entity's bars. Bars
    come packed in blocks, as the engine hands rows over one by one. A bar that comes too late is taken if none after it was.
    Times are milliseconds. State: the bars that wait for the watermark in packed blocks, with a timer at the earliest; and, as
    arrays, each entity's number of bars so far with the last of them, and the open positions, `most` + 1 an entity at most:
    without a price before the purchase, and with out_at -1 before the bar at which the sale is decided (why: a place in REASONS).
    """

    def __init__(self, buy: float, sell: float, most: int):
        self.buy, self.sell, self.most = buy, sell, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "bars binary")
        self.line = handle.getValueState("line", "stock_id array<long>, bars array<int>, last_ms array<long>, last_open array<double>")
        self.open = handle.getValueState("open", "stock_id array<long>, signal_ms array<long>, at array<int>, buy_ms array<long>, buy_price array<double>, out_at array<int>, why array<int>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = []
        for frame in rows:
            bars = np.frombuffer(b"".join(frame["bars"]), BAR)
            if len(bars):
                self._wait(bars)
                earliest.append(int(bars["ms"].min()))
        watermark = timerValues.getCurrentWatermarkInMs()
        if earliest and min(earliest) <= watermark:
            yield self._settled(key, watermark)
        else:  # what waits already has a timer of its own
            if earliest:
                self.handle.registerTimer(min(earliest))
            yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settled(key, timerValues.getCurrentWatermarkInMs())

    def _wait(self, bars: np.ndarray) -> None:
        for k in range(0, len(bars), BLOCK):
            self.waiting.appendValue((bars[k : k + BLOCK].tobytes(),))

    def _settled(self, key, watermark: int) -> pd.DataFrame:
        """The trades that close on the bars that no earlier one can precede."""
        bars = np.concatenate([np.empty(0, BAR), *[np.frombuffer(block, BAR) for (block,) in self.waiting.get()]])
        ready, rest = bars[bars["ms"] <= watermark], bars[bars["ms"] > watermark]
        closed = pd.DataFrame()
        if len(ready):
            line, held = self._told(self.line, "stock_id bars last_ms last_open"), self._told(self.open, "stock_id signal_ms at buy_ms buy_price out_at why")
            closed, line, held = exits(ready, line, held, self.buy, self.sell, self.most)
            for state, arrays in ((self.line, line), (self.open, held)):
                state.update(tuple([None if v != v else v for v in x.tolist()] for x in arrays.values()))
            self.waiting.clear()
            self._wait(rest)
            if key[0] == KEYLESS:
                closed["stock_id"] = None
        if len(rest):
            self.handle.registerTimer(int(rest["ms"].min()))
        return closed

    @staticmethod
    def _told(state, names: str) -> dict[str, np.ndarray]:
        found = state.get() if state.exists() else [[]] * len(names.split())
        return {c: np.array(x, float if c in ("buy_price", "last_open") else np.int64) for c, x in zip(names.split(), found)}


def exits(ready: np.ndarray, line: dict[str, np.ndarray], held: dict[str, np.ndarray], buy: float, sell: float, most: int) -> tuple[pd.DataFrame, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Trades that close on ready bars of many entities, and their lines and open positions after them.

    Of two bars of one time the later to arrive holds; bars up to an entity's last one are repeated. A position is bought at
    the bar after its signal's, decided at the first bar from there with a low score or `most` after the signal's, and sold at the next.
    """
    bars = ready[np.lexsort((ready["ms"], ready["id"]))]
    same = (bars["id"][1:] == bars["id"][:-1]) & (bars["ms"][1:] == bars["ms"][:-1])
    bars = bars[~np.append(same, False)]
    known, at = _found(line["stock_id"], bars["id"])
    bars = bars[~known | (bars["ms"] > line["last_ms"][at])] if len(line["stock_id"]) else bars
    ids, start, count = np.unique(bars["id"], return_index=True, return_counts=True)
    known, at = _found(line["stock_id"], ids)
    before = np.zeros(len(ids), np.int64)  # bars so far
    before[known] = line["bars"][at[known]]
    ms, opened, score = bars["ms"], bars["open"], bars["score"]

    mine, of = _found(ids, held["stock_id"])
    kept = {c: x[~mine] for c, x in held.items()}
    signal = np.flatnonzero(score >= buy)
    entity = np.repeat(np.arange(len(ids)), count)[signal]
    e = np.concatenate((of[mine], entity))
    new = {"stock_id": bars["id"][signal], "signal_ms": ms[signal], "at": before[entity] + signal - start[entity] + 1, "buy_ms": np.zeros(len(signal), np.int64), "buy_price": np.full(len(signal), np.nan), "out_at": np.full(len(signal), -1), "why": np.zeros(len(signal), np.int64)}
    p = {c: np.concatenate((held[c][mine], x)) for c, x in new.items()}
    row = lambda e, n: start[e] + n - before[e] - 1  # noqa: E731  where an entity's bar of number n lies
    end = before + count

    buys = np.isnan(p["buy_price"]) & (p["at"] < end[e])
    where = row(e[buys], p["at"][buys] + 1)
    p["buy_ms"][buys], p["buy_price"][buys] = ms[where], np.where(opened[where] > 0, opened[where], np.nan)
    stays = ~(buys & np.isnan(p["buy_price"]))
    p, e = {c: x[stays] for c, x in p.items()}, e[stays]

    lows = np.where(score <= sell, np.arange(len(bars)), len(bars))
    lows = np.minimum.accumulate(lows[::-1])[::-1]  # the next low score from each row on
    asks = np.flatnonzero(~np.isnan(p["buy_price"]) & (p["out_at"] < 0))
    asked = e[asks]
    first = row(asked, np.maximum(p["at"][asks], before[asked]) + 1)
    low, latest = lows[first], np.maximum(row(asked, p["at"][asks] + most), first)
    decided = np.minimum(low, latest)
    told = decided < start[asked] + count[asked]
    p["out_at"][asks[told]] = (before[asked] + decided - start[asked] + 1)[told]
    p["why"][asks[told]] = np.where(low <= latest, 1, 2)[told]

    done = (p["out_at"] >= 0) & (p["out_at"] < end[e])
    sold = row(e[done], p["out_at"][done] + 1)
    q = {c: x[done] for c, x in p.items()}
    closed = pd.DataFrame({"stock_id": q["stock_id"], "signal_ms": q["signal_ms"], "buy_ms": q["buy_ms"], "sell_ms": ms[sold], "buy_price": q["buy_price"], "sell_price": opened[sold], "hold": q["out_at"] - q["at"], "exit_reason": REASONS[q["why"]]})
    held = {c: np.concatenate((kept[c], x[~done])) for c, x in p.items()}

    final = start + count - 1
    others = ~_found(ids, line["stock_id"])[0]
    after = {"stock_id": ids, "bars": end, "last_ms": ms[final], "last_open": opened[final]}
    line = {c: np.concatenate((line[c][others], x)) for c, x in after.items()}
    order = np.argsort(line["stock_id"])
    return closed, {c: x[order] for c, x in line.items()}, held


def _found(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted id is among the sorted ids, and where (any place, if it is not)."""
    if not len(ids):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return ids[at] == wanted, at


def _known(x) -> float | None:
    return None if x is None or x != x else float(x)


def _put(state, rows: list[tuple]) -> None:
    if rows:
        state.put(rows)
    else:
        state.clear()


class Tracker(StatefulProcessor):
    """Peak, last close and number of bars of each position; rows are bars (close) or purchases (buy_price).

    All three hold for any order of the bars after the purchase, so late bars need no waiting. Bars are
    kept until the watermark passes them, for purchases that come after them, and to tell repeated ones.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "ms long, close double")
        self.held = handle.getListState("held", "buy_ms long, buy_price double, peak double, last double, last_ms long, bars int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = {ms: close for ms, close in self.seen.get()}
        held = {x[0]: tuple(x) for x in self.held.get()}
        new, bought = {}, {}
        for frame in rows:
            for ms, close, price in zip(frame["ms"].tolist(), frame["close"], frame["buy_price"]):
                if _known(price) is not None:
                    bought.setdefault(ms, (ms, float(price), None, None, None, 0))
                elif _known(close) is not None and ms not in seen:
                    new[ms] = float(close)
        for at, position in held.items():
            held[at] = self._marked(position, new)
        for at in bought.keys() - held.keys():
            held[at] = self._marked(bought[at], seen | new)
        seen |= new
        _put(self.held, list(held.values()))
        self._keep(seen, timerValues)
        yield pd.DataFrame()

    @staticmethod
    def _marked(position: tuple, bars: dict[int, float]) -> tuple:
        at, price, peak, last, last_ms, n = position
        after = {ms: c for ms, c in bars.items() if ms >= at}
        if after:
            top, latest = max(after.values()), max(after)
            peak = top if peak is None else max(peak, top)
            last, last_ms = (after[latest], latest) if last_ms is None or latest > last_ms else (last, last_ms)
        return at, price, peak, last, last_ms, n + len(after)

    def _keep(self, seen: dict[int, float], timerValues) -> None:
        rest = sorted((ms, c) for ms, c in seen.items() if ms > timerValues.getCurrentWatermarkInMs())
        _put(self.seen, rest)
        if rest:
            self.handle.registerTimer(rest[0][0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep({ms: c for ms, c in self.seen.get()}, timerValues)
        yield pd.DataFrame()


def bar_stream(spark: SparkSession, folder: str, schema: str, delay: str, files: int | None = 1) -> DataFrame:
    """The Parquet files that come to lie in a folder, oldest first, so many a micro-batch (None: all new ones), with a watermark on date."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(folder).withWatermark("date", delay)


def _stateful(stream: DataFrame, processor: StatefulProcessor, schema: str, key: str) -> DataFrame:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return stream.groupBy(key).transformWithStateInPandas(processor, schema, "append", "EventTime")


def _packed(stream: DataFrame, buckets: int) -> DataFrame:
    """(bucket, bars): a stream's bars in packed blocks, each of one bucket, in the order in which a task meets them."""
    entity = F.col("stock_id")
    bucket = F.when(entity.isNull(), KEYLESS).otherwise(F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int"))
    rows = stream.where("date is not null").select(bucket.alias("bucket"), F.coalesce(entity, F.lit(0).cast("long")).alias("id"), F.unix_millis("date").alias("ms"), F.col("open").cast("double"), F.col("score").cast("double"))

    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            bars = np.empty(batch.num_rows, BAR)
            for c in BAR.names:
                bars[c] = batch[c].to_numpy(zero_copy_only=False)
            held.append((batch["bucket"].to_numpy(zero_copy_only=False), bars))
            n += len(bars)
            if n >= PACKED:
                yield told(held)
                held, n = [], 0
        if n:
            yield told(held)

    def told(held):
        places, bars = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(places, kind="stable")
        found, start = np.unique(places[order], return_index=True)
        return pa.record_batch([pa.array(found, pa.int32()), pa.array([x.tobytes() for x in np.split(bars[order], start[1:])], pa.binary())], names=["bucket", "bars"])

    return rows.mapInArrow(blocks, "bucket int, bars binary")


def _buckets(spark: SparkSession, folder: str, wanted: int) -> int:
    """The number of buckets with which a folder's state was begun, or the wanted one, kept for later calls."""
    path = f"{folder}/buckets"
    kept = read_or_empty(spark, path, StructType([StructField("n", IntegerType())])).first()
    if kept is None:
        spark.createDataFrame([(wanted,)], "n int").write.mode("overwrite").parquet(path)
    return wanted if kept is None else kept["n"]


def run_score_exits(stream: DataFrame, buy: float, sell: float, most: int, folder: str, buckets: int = 64) -> None:
    """Take in all that the stream has and stop; a later call with the same folder goes on from there.

    stream: stock_id, date (timestamp with a watermark), open, score. Each micro-batch's trades replace what
    an interrupted run of the same batch has left. Entities share so many buckets of state, each of which a task holds
    at once; the first call for a folder settles their number.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/closed/batch={number}")

    rows = _packed(stream, _buckets(stream.sparkSession, folder, buckets))
    found = _stateful(rows, ScoreExits(buy, sell, most), CLOSED, "bucket")
    found.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()


def state_rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A state variable's keys and values as the last finished micro-batch left them."""
    return spark.read.format("statestore").option("stateVarName", name).load(f"{folder}/state")


def _entity_rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A state variable of arrays as a row for each of their elements."""
    state = state_rows(spark, folder, name).select("key.bucket", "value.*")
    rows = state.select("bucket", F.explode(F.arrays_zip(*state.columns[1:])).alias("row")).select("bucket", "row.*")
    return rows.withColumn("stock_id", F.when(F.col("bucket") != KEYLESS, F.col("stock_id"))).drop("bucket")


def score_trades(spark: SparkSession, folder: str) -> DataFrame:
    """All trades so far in the form of simulation.score_exit: closed ones, and open ones as if sold at their entity's last bar."""
    closed = spark.read.schema(f"{CLOSED}, batch long").parquet(f"{folder}/closed").drop("batch")
    held, last = _entity_rows(spark, folder, "open"), _entity_rows(spark, folder, "line").withColumnRenamed("stock_id", "of")
    open_ = held.join(last, F.col("stock_id").eqNullSafe(F.col("of"))).where("buy_price is not null and bars >= at + 2").select(
        "stock_id", "signal_ms", "buy_ms", F.col("last_ms").alias("sell_ms"), "buy_price", F.col("last_open").alias("sell_price"), (F.col("bars") - F.col("at") - 1).alias("hold"), F.lit("data_end").alias("exit_reason")
    )
    rows = closed.unionByName(open_)
    dates = [_date(f"{c}_ms").alias(f"{c}_date") for c in ("signal", "buy", "sell")]
    return rows.select("stock_id", *dates, "buy_price", "sell_price", (F.col("sell_price") / F.col("buy_price") - 1).alias("ret"), "hold", "exit_reason")


def _date(ms: str) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def run_tracker(stream: DataFrame, folder: str) -> None:
    """Take in purchases and bars (stock_id, date with a watermark, close, buy_price) and stop; later calls go on."""
    found = _stateful(stream.withColumn("ms", F.unix_millis("date")), Tracker(), "stock_id long", "stock_id")
    found.writeStream.outputMode("append").format("noop").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()


def tracked_positions(spark: SparkSession, folder: str, stop_loss: float, arm: float, give_back: float) -> DataFrame:
    """The positions of a tracker's state in the form of simulation.track_position."""
    from ..operators.simulation import position_status

    held = state_rows(spark, folder, "held").select(F.col("key.stock_id").alias("stock_id"), _date("list_element.buy_ms").alias("buy_date"), "list_element.*")
    return position_status(held.where("bars > 0"), stop_loss, arm, give_back)
