"""Event bars by tumbling, sliding and session windows, carried state, and incremental feature runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators.windows import mean
from ..sources.tables import shared_folder


def _summaries() -> list:
    return [F.count("*").alias("n"), F.sum(F.floor(F.col("value") * 100)).alias("cents"), F.max("value").alias("high"), F.min("value").alias("low")]


def _bars(events: DataFrame, window) -> DataFrame:
    return events.groupBy("event_type", window.alias("w")).agg(*_summaries()).select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "cents", "high", "low")


def tumbling(events: DataFrame) -> DataFrame:
    return _bars(events, F.window("ts", "1 hour"))


def sliding(events: DataFrame) -> DataFrame:
    return _bars(events, F.window("ts", "1 hour", "15 minutes"))


def sessions(events: DataFrame) -> DataFrame:
    found = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return found.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("stop"), "n")


def event_stream(spark: SparkSession, sf_dir: str, late: str = "10 minutes") -> DataFrame:
    """The events as a stream with a watermark; Parquet's zoneless times are read as UTC."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def drained(spark: SparkSession, sf_dir: str, bars: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Run a windowed stream over all there is, and return its complete result as a table.

    Complete mode holds every window, as late rows may still change it, and so equals the batch; the last
    micro-batch's table replaces the earlier ones.
    """
    folder = _folder(spark)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out")

    query = bars(event_stream(spark, sf_dir)).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def since_event(spark: SparkSession, sf_dir: str, event: str) -> DataFrame:
    """Per user the events so far and those since the last one of a type, carried as state from batch to batch."""
    folder = _folder(spark)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen, since = state.get if state.exists else (0, -1)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for kind in rows["event_type"]:
            seen, since = seen + 1, 0 if kind == event else (since + 1 if since >= 0 else -1)
        state.update((seen, since))
        yield pd.DataFrame({"user_id": [key[0]], "events": [seen], "since": [since if since >= 0 else None]}).astype({"since": "Int64"})

    stream = event_stream(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    found = stream.groupBy("user_id").applyInPandasWithState(update, "user_id long, events long, since long", "seen long, since long", "update", "NoTimeout")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    query = found.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    last = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("batch").desc()))
    return rows.withColumn("_last", last).where("_last = 1").select("user_id", "events", "since")


def incremental_ma(prices: DataFrame, since: str, n: int) -> DataFrame:
    """The close over its n-bar mean for dates from `since` on, reading only the n - 1 bars that each entity had before."""
    start = F.lit(since).cast("timestamp_ntz")
    back = F.row_number().over(Window.partitionBy("stock_id").orderBy(F.col("date").desc()))
    warm = prices.where(F.col("date") < start).withColumn("_back", back).where(F.col("_back") < n).drop("_back")
    rows = warm.unionByName(prices.where(F.col("date") >= start))
    return rows.select("stock_id", "date", ratio(F.col("close"), mean(F.col("close"), n)).cast("float").alias("close_ma20_ratio")).where(F.col("date") >= start)
