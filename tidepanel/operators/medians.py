"""Running medians along a threshold curve as a distributed order statistic.

Rows are dealt to buckets of falling scores. A grid of counts by bucket and class of returns tells, for
each bucket, in which classes the median can lie anywhere inside it; so a bucket needs the values of
those classes only, of its own and the earlier rows, and all others as counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored


def quantile_bounds(rows: DataFrame, column: str, parts: int) -> list[float]:
    """The different approximate quantiles that part the column's values into about equal shares."""
    if parts < 2:
        return []
    found = rows.agg(F.percentile_approx(column, [k / parts for k in range(1, parts)], 100 * parts).alias("q")).first()["q"]
    return sorted(set(found or []))


def class_of(column: str, bounds: list[float]) -> Column:
    """How many bounds lie below the value: equal values share a class, and classes keep the order. A search, as bounds may be thousands."""
    if not bounds:
        return F.lit(0)
    ordered = np.array(bounds, float)

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ordered, x.to_numpy(float), side="left").astype(np.int32))

    return place(F.col(column).cast("double"))


def exact_medians(rows: DataFrame, value: str, keys: tuple[str, ...] = (), parts: int = 256) -> DataFrame:
    """(keys, median): the exact median of known values per group, or of all rows, however many rows a group has.

    Equal values travel as one with their number. Values are dealt to classes by approximate quantiles; counts by class
    tell in which one or two classes a group's middle ranks lie, and only these are ordered, each in a task of its own.
    """
    told, _ = stored(rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n")), "median-rows")
    placed = told.withColumn("_class", class_of("_v", quantile_bounds(told, "_v", parts)))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy()  # a row per class
    counts = placed.groupBy(*keys, "_class").agg(F.sum("_n").alias("_own")).withColumn("_all", F.sum("_own").over(group))
    counts = counts.withColumn("_before", F.sum("_own").over(group.orderBy("_class")) - F.col("_own"))
    low, high = (F.col("_all") - 1).cast("long"), F.col("_all").cast("long")
    low, high = F.floor(low / 2), F.floor(high / 2)  # ranks from 0
    holds = lambda rank, before, own: (before <= rank) & (rank < before + own)
    spans = counts.where(holds(low, F.col("_before"), F.col("_own")) | holds(high, F.col("_before"), F.col("_own"))).drop("_own")
    near = placed.join(F.broadcast(spans), [*keys, "_class"])
    inside = Window.partitionBy(*keys, "_class").orderBy("_v")
    near = near.withColumn("_at", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))
    middle = near.groupBy(*keys).agg(*[F.max(F.when(holds(rank, F.col("_at"), F.col("_n")), F.col("_v"))).alias(n) for n, rank in (("_low", low), ("_high", high))])
    return middle.select(*keys, (0.5 * F.col("_low") + 0.5 * F.col("_high")).alias("median"))


class _Ranks:
    """Weights of ordered values with the value at a rank (a Fenwick tree)."""

    def __init__(self, weights: np.ndarray):
        self.n = len(weights)
        sums = np.concatenate(([0], np.cumsum(weights)))
        at = np.arange(1, self.n + 1)
        self.tree = [0, *(sums[at] - sums[at - (at & -at)]).tolist()]
        self.top = 1 << max(self.n.bit_length() - 1, 0)

    def add(self, i: int, weight: int) -> None:
        i += 1
        while i <= self.n:
            self.tree[i] += weight
            i += i & -i

    def at(self, rank: int) -> int:
        """The place of the value whose rank, from 0, this is."""
        i, step = 0, self.top
        while step:
            if i + step <= self.n and self.tree[i + step] <= rank:
                i += step
                rank -= self.tree[i]
            step >>= 1
        return i


def _bucket_medians(pdf: pd.DataFrame) -> pd.DataFrame:
    """The medians of one bucket's points. Kinds: 0 values of earlier rows, 1 own values, 2 own counts (all, below) of a score."""
    start, below = int(pdf["start"].iat[0]), int(pdf["below"].iat[0])
    values = pdf[pdf["kind"] < 2]
    distinct, place = np.unique(values["ret"].to_numpy(float), return_inverse=True)
    earlier = values["kind"].to_numpy() == 0
    ranks = _Ranks(np.bincount(place[earlier], weights=values["n"].to_numpy()[earlier], minlength=len(distinct)).astype(np.int64))
    own = pd.DataFrame({"score": values["score"].to_numpy()[~earlier], "place": place[~earlier], "n": values["n"].to_numpy()[~earlier]}).sort_values("score", ascending=False)
    points = pdf[pdf["kind"] == 2].sort_values("score", ascending=False)
    added = list(zip(own["score"].tolist(), own["place"].tolist(), own["n"].tolist()))
    out, k = [], 0
    for score, n, under in zip(points["score"].tolist(), points["n"].tolist(), points["under"].tolist()):
        while k < len(added) and added[k][0] == score:
            ranks.add(added[k][1], added[k][2])
            k += 1
        start, below = start + n, below + under
        low, high = (distinct[ranks.at(r - below)] for r in ((start - 1) // 2, start // 2))
        out.append((score, start, (low + high) / 2))
    return pd.DataFrame(out, columns=["threshold", "n", "med_return"])


def threshold_medians(rows: DataFrame, score: str, ret: str, least: int = 40, bucket_rows: int = 1 << 18, classes: int = 1024) -> DataFrame:
    """(threshold, n, med_return): for each score, the number and the median return of all rows of at least that score.

    From `least` rows on; rows without a score or return don't count. Equal scores form one point. Rows of
    equal score and return travel as one with their number, and a score with more than bucket_rows rows is a
    bucket of its own, which needs the values around one median only. So a task gets about bucket_rows rows
    of its own and as many of others, whatever the scores. The grid has classes x buckets rows.
    """
    spark = rows.sparkSession
    told = rows.select(F.col(score).cast("double").alias("score"), F.col(ret).cast("double").alias("ret")).where("score is not null and ret is not null and not isnan(score) and not isnan(ret)")
    told, _ = stored(told.groupBy("score", "ret").agg(F.count("*").alias("n")), "curve-rows")
    points = told.groupBy("score").agg(F.sum("n").alias("n"))
    total = points.agg(F.sum("n")).first()[0] or 0
    parts = min(-(-total // bucket_rows), 1 << 14)
    bounds = quantile_bounds(points.where(F.col("n") <= bucket_rows), "score", 2 * parts)
    heavy = points.where(F.col("n") > bucket_rows).select("score")  # at most total / bucket_rows
    bounds = sorted({*bounds, *(x for r in heavy.toLocalIterator() for x in (r["score"], np.nextafter(r["score"], -np.inf).item()))})
    return_bounds = quantile_bounds(told, "ret", classes)
    placed = told.withColumn("bucket", len(bounds) - class_of("score", bounds)).withColumn("class", class_of("ret", return_bounds))
    placed, _ = stored(placed, "curve-placed")
    grid = spark.range(len(bounds) + 1).select(F.col("id").cast("int").alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(len(return_bounds)))).alias("class"))
    counts = grid.join(placed.groupBy("bucket", "class").agg(F.sum("n").alias("own")), ["bucket", "class"], "left").na.fill(0, ["own"])
    by_class, by_bucket = Window.partitionBy("class").orderBy("bucket"), Window.partitionBy("bucket").orderBy("class")
    counts = counts.withColumn("first", F.sum("own").over(by_class) - F.col("own"))  # of earlier buckets
    sums = counts.select("bucket", "class", "own", "first", F.sum("first").over(by_bucket).alias("until"), F.sum(F.col("first") + F.col("own")).over(by_bucket).alias("until_end"))
    whole = Window.partitionBy("bucket")
    sums = sums.withColumns({"start": F.max("until").over(whole), "end": F.max("until_end").over(whole)})
    one = F.broadcast(placed.groupBy("bucket").agg((F.min("score") == F.max("score")).alias("one")))
    sums = sums.join(one, "bucket")
    # a class can't hold a median of the bucket if too few rows end in or below it even at the end, or enough lie below it from the start
    least_rank = F.when(F.col("one"), F.floor((F.col("end") - 1) / 2)).otherwise(F.greatest(F.floor((F.col("start") - 1) / 2), F.lit(0)))
    most_rank = F.floor(F.col("end") / 2)
    sure = F.when(F.col("one"), F.col("until_end") - F.col("first") - F.col("own")).otherwise(F.col("until") - F.col("first"))  # below the class at every point
    inside = (F.col("until_end") > least_rank) & (sure <= most_rank)
    spans, _ = stored(sums.groupBy("bucket").agg(F.min(F.when(inside, F.col("class"))).alias("low"), F.max(F.when(inside, F.col("class"))).alias("high"), F.max("start").alias("start")), "curve-spans")
    below = sums.join(spans.select("bucket", "low"), "bucket").groupBy("bucket").agg(F.sum(F.when(F.col("class") < F.col("low"), F.col("first")).otherwise(0)).alias("below"))
    spans = spans.join(below, "bucket")
    own = placed.join(F.broadcast(spans), "bucket")
    within = F.col("class").between(F.col("low"), F.col("high"))
    none = F.lit(0).cast("long")
    shape = ["bucket", "start", "below", "kind", "score", "ret", "n", "under"]
    values = own.where(within).withColumns({"kind": F.lit(1), "under": none})
    numbers = own.groupBy("bucket", "start", "below", "score").agg(F.sum(F.when(F.col("class") < F.col("low"), F.col("n")).otherwise(0)).alias("under"), F.sum("n").alias("n")).withColumns({"kind": F.lit(2), "ret": F.lit(None).cast("double")})
    asked = spans.select(F.col("bucket").alias("asking"), "start", "below", F.explode(F.sequence("low", "high")).alias("class"))
    earlier = placed.select("bucket", "class", "ret", "n").join(F.broadcast(asked), "class").where("bucket < asking")
    earlier = earlier.groupBy(F.col("asking").alias("bucket"), "start", "below", "ret").agg(F.sum("n").alias("n")).withColumns({"kind": F.lit(0), "score": F.lit(None).cast("double"), "under": none})
    parts_ = values.select(*shape).unionByName(numbers.select(*shape)).unionByName(earlier.select(*shape))
    return parts_.groupBy("bucket").applyInPandas(_bucket_medians, "threshold double, n long, med_return double").where(F.col("n") >= least)
