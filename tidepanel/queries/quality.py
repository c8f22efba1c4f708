"""Data-quality rules as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as dq
from ..sources.panel import BARS, FLOWS, SCORES, bars, flows, scores, table
from . import registry as q
from .registry import query


@query(f"WITH {BARS}, d AS (SELECT stock_id, date, open, CASE WHEN volume > 60 THEN close ELSE high END AS high, low, close FROM bars) SELECT stock_id, date, open, high, low, close FROM d WHERE high < greatest(open, close, low) - 1e-9 OR low > least(open, close, high) + 1e-9")
def dq_ohlc_invariant(spark, sf_dir):
    """The rule over bars whose high was replaced by the close on busy days."""
    df = bars(spark, sf_dir).withColumn("high", F.when(F.col("volume") > 60, F.col("close")).otherwise(F.col("high")))
    return dq.ohlc_violations(df).select("stock_id", "date", "open", "high", "low", "close")


@query(f"WITH {BARS}, {FLOWS}, a AS (SELECT date, count(*) AS n FROM bars GROUP BY date), b AS (SELECT date, count(*) AS m FROM flows WHERE foreign_net <> 0 GROUP BY date) SELECT date, n, coalesce(m, 0) AS flow_rows, coalesce(m, 0)::DOUBLE / n AS ratio, (coalesce(m, 0)::DOUBLE / n < 0.5)::INT AS failed FROM a LEFT JOIN b USING (date)")
def dq_row_ratio(spark, sf_dir):
    a = bars(spark, sf_dir).groupBy("date").agg(F.count("*").alias("n"))
    b = flows(spark, sf_dir).where("foreign_net <> 0").groupBy("date").agg(F.count("*").alias("flow_rows"))
    df = a.join(b, "date", "left").na.fill(0, ["flow_rows"])
    share = F.col("flow_rows") / F.col("n")
    return df.select("date", "n", "flow_rows", share.alias("ratio"), (share < 0.5).cast("int").alias("failed"))


@query(f"WITH {BARS} SELECT date, avg((volume < 10)::INT) AS thin_share, (avg((volume < 10)::INT) > 0.5)::INT AS failed FROM bars GROUP BY date")
def dq_zero_volume(spark, sf_dir):
    share = F.avg((F.col("volume") < 10).cast("int"))
    return bars(spark, sf_dir).groupBy("date").agg(share.alias("thin_share"), (share > 0.5).cast("int").alias("failed"))


@query(f"WITH {BARS}, d AS (SELECT date, count(*) AS n FROM bars GROUP BY date), l AS (SELECT date, n, lag(n) OVER (ORDER BY date) AS before FROM d) SELECT date, n AS rows, before FROM l WHERE before >= 20 AND n < before * 0.95::DOUBLE")
def dq_row_drop(spark, sf_dir):
    return dq.row_count_drops(bars(spark, sf_dir), floor=20)


JUMPS = f"""{BARS}, days AS (SELECT date, row_number() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM bars)), a AS (SELECT stock_id, date, close, {q.lag("close")} AS prev_close, day, {q.lag("day")} AS pday, row_number() OVER ({q.PART}) AS k FROM bars JOIN days USING (date))
SELECT date, stock_id, prev_close, close, close / prev_close - 1 AS ret FROM a WHERE abs(close / prev_close - 1) > 0.11::DOUBLE AND day - pday = 1 AND k > {{listed}} AND (stock_id, date) NOT IN (SELECT l_suppkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R')"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("stock_id"), F.col("l_shipdate").alias("date"))


@query("WITH " + JUMPS.format(listed=0))
def dq_overnight(spark, sf_dir):
    return dq.unexplained_jumps(bars(spark, sf_dir), _events(spark, sf_dir), 0.11, listed=0)


@query("WITH " + JUMPS.format(listed=5))
def unexplained_jumps(spark, sf_dir):
    return dq.unexplained_jumps(bars(spark, sf_dir), _events(spark, sf_dir), 0.11)


@query(f"WITH {BARS}, {SCORES}, r AS (SELECT b.close, s.score, f.foreign_net FROM bars b LEFT JOIN score s USING (stock_id, date) LEFT JOIN (SELECT l_suppkey AS stock_id, l_shipdate AS date, max(l_tax) AS foreign_net FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL) f USING (stock_id, date)) SELECT 'close' AS column_name, avg((close IS NULL)::INT) AS missing FROM r UNION ALL SELECT 'score', avg((score IS NULL)::INT) FROM r UNION ALL SELECT 'foreign_net', avg((foreign_net IS NULL)::INT) FROM r")
def missing_rates(spark, sf_dir):
    prices = bars(spark, sf_dir)
    taxes = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").groupBy(F.col("l_suppkey").alias("stock_id"), F.col("l_shipdate").alias("date")).agg(F.max("l_tax").alias("foreign_net"))
    df = prices.join(scores(prices), ["stock_id", "date"], "left").join(taxes, ["stock_id", "date"], "left")
    return dq.missing_rates(df, ["close", "score", "foreign_net"])


@query(f"WITH {BARS}, {SCORES} SELECT DISTINCT date FROM bars WHERE date NOT IN (SELECT date FROM score WHERE score IS NOT NULL)")
def score_completeness(spark, sf_dir):
    """Trading days without any score."""
    prices = bars(spark, sf_dir)
    return prices.select("date").distinct().join(scores(prices).where("score is not null").select("date").distinct(), "date", "left_anti")
