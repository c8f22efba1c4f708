"""Joint statistics of many conditions by a bit-sliced index, and verdicts by greedy conjunction.

The index holds, for each block of bars, one packed bitmap a condition and two more: of the bars whose
outcome is known and of those that won. The bars that meet a set of conditions are the AND of its
bitmaps; their number and wins are population counts. Sets are counted block by block and added up,
so no table of subsets is made and the number of conditions is not limited.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import drop_stored, stored

CHUNK = 4096  # sets that meet a block at once


def bit_index(rows: DataFrame, flags: list[str], outcome: str, block_rows: int = 1 << 16, words: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """A row (block, known, won, bits) for each block of at most block_rows rows; bits follow the order of flags.

    rows: flags of 0 and 1 (null is 0) and an outcome that wins above 0 and is unknown where null. Flags may also lie as
    bits of whole numbers: words tells the column and bit of each. Each task packs its own rows as they come, so that none
    move; counts don't hang on which rows share a block.
    """
    columns = list(dict.fromkeys(c for c, _ in words.values())) if words else flags
    told = [F.coalesce(F.col(c), F.lit(0)).cast("long") if words else F.coalesce(F.col(c).cast("int") == 1, F.lit(False)) for c in columns]
    packed = rows.select(F.col(outcome).isNotNull().alias("_known"), F.coalesce(F.col(outcome) > 0, F.lit(False)).alias("_won"), *[x.alias(c) for c, x in zip(columns, told)])
    places = [(columns.index(words[c][0]) + 2, words[c][1]) if words else (k + 2, 0) for k, c in enumerate(flags)]

    def pack(batches):
        held, n, block = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block_rows - n)
                held.append([c.to_numpy(zero_copy_only=False) for c in part.columns])
                n, batch = n + part.num_rows, batch.slice(part.num_rows)
                if n == block_rows:
                    yield row(held, block)
                    held, n, block = [], 0, block + 1
        if held:
            yield row(held, block)

    def row(held, block):
        whole = [np.concatenate(parts) for parts in zip(*held)]
        known, won, *bits = [np.packbits((whole[k] >> bit & 1).astype(bool)).tobytes() for k, bit in [(0, 0), (1, 0), *places]]
        return pa.record_batch([pa.array([block], pa.int32()), pa.array([known]), pa.array([won]), pa.array([bits], pa.list_(pa.binary()))], names=["block", "known", "won", "bits"])

    return packed.mapInArrow(pack, "block int, known binary, won binary, bits array<binary>")


def joint_counts(index: DataFrame, sets: DataFrame) -> DataFrame:
    """(members, n, wins): for each set of conditions, given by their places in the index, the known bars that meet all, and how many won.

    Each block meets the sets in chunks: every set against all bars, as asked, without any pair of bars.
    """
    chunks = sets.select("members").distinct().groupBy(F.pmod(F.xxhash64("members"), F.lit(1 << 30)).alias("part")).agg(F.collect_list("members").alias("some"))
    chunks = chunks.groupBy(F.floor(F.col("part") / ((1 << 30) // max(1, -(-sets.count() // CHUNK)))).alias("chunk")).agg(F.flatten(F.collect_list("some")).alias("sets"))

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = lambda b: np.frombuffer(b + b"\0" * (-len(b) % 8), np.uint64)
                known, won, bits = words(row["known"]), words(row["won"]), [words(b) for b in row["bits"]]
                found = []
                for members in row["sets"]:
                    met = known
                    for m in members:
                        met = met & bits[m]
                    n = int(np.bitwise_count(met).sum())
                    if n:
                        found.append((members, n, int(np.bitwise_count(met & won).sum())))
                members, n, wins = zip(*found) if found else ((), (), ())
                yield pa.record_batch([pa.array(members, pa.list_(pa.int32())), pa.array(n, pa.int64()), pa.array(wins, pa.int64())], names=["members", "n", "wins"])

    pairs = index.crossJoin(F.broadcast(chunks.select("sets")))
    return pairs.mapInArrow(count, "members array<int>, n long, wins long").groupBy("members").agg(F.sum("n").alias("n"), F.sum("wins").alias("wins"))


def single_counts(index: DataFrame, flags: list[str]) -> dict[str, int]:
    """How many known bars meet each condition: as many rows as conditions."""
    spark = index.sparkSession
    counted = joint_counts(index, spark.range(len(flags)).select(F.array(F.col("id").cast("int")).alias("members"))).collect()
    return {flags[r["members"][0]]: r["n"] for r in counted}


def greedy_conjunctions(index: DataFrame, asked: DataFrame, least: int) -> DataFrame:
    """(members, chosen, n, wins) for each asked list of conditions, given in the order in which they are tried.

    A condition joins if at least `least` bars meet all chosen ones and it. A round counts, for every list,
    each condition left together with those chosen; what falls short then does so with any larger set, and
    goes for good; the first that doesn't is chosen. So there are as many rounds as conditions in the
    longest choice, whatever their number. n and wins are null where nothing is chosen.
    """
    none = F.array().cast("array<int>")
    state, path = stored(asked.select("members").distinct().select("members", none.alias("chosen"), F.col("members").alias("left"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("wins")), "greedy")
    spark = asked.sparkSession
    while not (open_ := state.where(F.size("left") > 0)).isEmpty():
        tried = open_.select("members", "chosen", F.posexplode("left").alias("at", "next")).withColumn("set", F.array_sort(F.array_append("chosen", F.col("next"))))
        counted = joint_counts(index, tried.select(F.col("set").alias("members"))).where(F.col("n") >= least)
        passed = tried.join(counted.select(F.col("members").alias("set"), F.col("n").alias("n1"), F.col("wins").alias("wins1")), "set")
        best = passed.groupBy("members").agg(F.min(F.struct("at", "next", "n1", "wins1")).alias("first"), F.array_sort(F.collect_list(F.struct("at", "next"))).alias("ok"))
        later = F.transform(F.filter("ok", lambda x: x["at"] > F.col("first")["at"]), lambda x: x["next"])
        done = state.join(best, "members", "left").select(
            "members", F.when(F.col("first").isNull(), F.col("chosen")).otherwise(F.array_append("chosen", F.col("first")["next"])).alias("chosen"), F.when(F.col("first").isNull(), none).otherwise(later).alias("left"),
            F.coalesce(F.col("first")["n1"], F.col("n")).alias("n"), F.coalesce(F.col("first")["wins1"], F.col("wins")).alias("wins"),
        )
        state, new = stored(done, "greedy")
        drop_stored(spark, path)
        path = new
    return state.drop("left")


def tone(edge: Column, bullish: Column, bearish: Column, even: float = 0.01) -> Column:
    """Where the history leans; without one, where more of the conditions lean."""
    by_number = F.when(bullish > bearish, "bullish").when(bearish > bullish, "bearish").otherwise("neutral")
    return F.when(edge.isNull(), by_number).when(edge >= even, "bullish").when(edge <= -even, "bearish").otherwise("neutral")
