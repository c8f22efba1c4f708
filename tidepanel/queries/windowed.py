"""Window primitives as queries over the bars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import flag, ratio
from ..operators import windows as w
from ..sources.panel import BARS, SCORES, bars, parts, scores
from . import registry as q
from .registry import query

f32 = lambda x, name: x.cast("float").alias(name)


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, close, {q.roll("avg", "close", 5)} AS ma5, {q.roll("avg", "close", 20)} AS ma20, close / {q.lag("close", 5)} - 1 AS ret_5 FROM bars),
b AS (SELECT *, {q.flag("close > ma20")} AS above_ma20, rank() OVER (PARTITION BY date ORDER BY ret_5 NULLS LAST) AS rk, count(ret_5) OVER (PARTITION BY date, ret_5) AS ties, count(ret_5) OVER (PARTITION BY date) AS n,
 CASE WHEN {q.ahead("count", "close", 1, 20)} = 20 THEN ({q.ahead("sum", "up", 1, 20)} >= 10)::INT END AS label_up20 FROM (SELECT *, (close > {q.lag("close")})::INT AS up FROM a)),
c AS (SELECT *, sum(1 - above_ma20) OVER (PARTITION BY stock_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS island FROM b)
SELECT stock_id, date, (ma5 / ma20)::FLOAT AS ma5_ma20_ratio, above_ma20, sum(above_ma20) OVER (PARTITION BY stock_id, island ORDER BY date ROWS UNBOUNDED PRECEDING)::INT AS above_streak,
 ret_5::FLOAT AS ret_5, CASE WHEN ret_5 IS NOT NULL THEN (rk + (ties - 1) / 2.0::DOUBLE) / n END::FLOAT AS rank_ret_5, label_up20 FROM c""")
def panel_slice(spark, sf_dir):
    """Moving averages, a streak, a cross-sectional rank and a forward label in one panel."""
    df = bars(spark, sf_dir).select("stock_id", "date", "close", w.mean(F.col("close"), 5).alias("ma5"), w.mean(F.col("close"), 20).alias("ma20"), w.change(F.col("close"), 5).alias("ret_5"), (F.col("close") > w.lag(F.col("close"))).cast("int").alias("up"))
    label = F.when(F.count("close").over(w.ahead(1, 20)) == 20, (F.sum("up").over(w.ahead(1, 20)) >= 10).cast("int"))
    df = df.withColumn("above_ma20", flag(F.col("close") > F.col("ma20"))).withColumn("label_up20", label)
    df = w.with_streak(df, F.col("above_ma20") == 1, "above_streak")
    return df.select("stock_id", "date", f32(ratio(F.col("ma5"), F.col("ma20")), "ma5_ma20_ratio"), "above_ma20", "above_streak", f32(F.col("ret_5"), "ret_5"), f32(w.rank_in_section(F.col("ret_5"), "ret_5"), "rank_ret_5"), "label_up20")


@query(f"""WITH {BARS} SELECT stock_id, date, {", ".join(f"{q.roll(a, 'close', n)}::FLOAT AS {a}_{n}" for n in (5, 10, 60) for a in ("avg", "min", "max"))},
 {q.roll("stddev_samp", "close", 20)}::FLOAT AS std_20, {q.roll("sum", "volume", 20, 5)} AS volume_20, (close - {q.lag("close", 3)})::FLOAT AS diff_3 FROM bars""")
def rolling_stats(spark, sf_dir):
    stats = [f32(w.roll(a, F.col("close"), n), f"{name}_{n}") for n in (5, 10, 60) for name, a in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    return bars(spark, sf_dir).select(
        "stock_id", "date", *stats, f32(w.roll(F.stddev_samp, F.col("close"), 20), "std_20"), w.roll(F.sum, F.col("volume"), 20, 5).alias("volume_20"), f32(F.col("close") - w.lag(F.col("close"), 3), "diff_3")
    )


@query(f"""WITH {BARS} SELECT stock_id, date, {", ".join(f"{q.roll('median', 'amount', n, max(5, n // 3))}::FLOAT AS median_{n}" for n in (10, 20, 60))} FROM bars""")
def rolling_median(spark, sf_dir):
    median = lambda x: F.percentile(x, F.lit(0.5))
    return bars(spark, sf_dir).select("stock_id", "date", *[f32(w.roll(median, F.col("amount"), n, max(5, n // 3)), f"median_{n}") for n in (10, 20, 60)])


@query(f"""WITH {BARS}, l AS (SELECT stock_id, date, close, list(close) {q.over(60)} AS seen FROM bars)
SELECT stock_id, date, CASE WHEN len(seen) >= 60 THEN ((list_sum(list_transform(seen, lambda v: (v < close)::INT)) + (list_sum(list_transform(seen, lambda v: (v = close)::INT)) + 1) / 2.0::DOUBLE) / len(seen)) END::FLOAT AS rank_60 FROM l""")
def rolling_rank_pct(spark, sf_dir):
    return bars(spark, sf_dir).select("stock_id", "date", f32(w.rank_in_window(F.col("close"), 60), "rank_60"))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, (close > {q.lag("close")})::INT AS up FROM bars), b AS (SELECT *, coalesce(up, 0) AS hit FROM a),
c AS (SELECT *, sum(1 - hit) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS island FROM b), d AS (SELECT *, sum(hit) OVER (PARTITION BY stock_id, island ORDER BY date ROWS UNBOUNDED PRECEDING)::INT AS s FROM c)
SELECT stock_id, date, s AS up_streak, (s >= 1)::INT AS up_1d, (s >= 3)::INT AS up_3d, (s >= 5)::INT AS up_5d, (s >= 10)::INT AS up_10d, ln(1 + s::DOUBLE)::FLOAT AS up_log FROM d""")
def streaks(spark, sf_dir):
    df = bars(spark, sf_dir).withColumn("up", F.col("close") > w.lag(F.col("close")))
    df = w.with_streak(df, F.col("up"), "up_streak")
    return df.select("stock_id", "date", "up_streak", *w.streak_columns("up_streak", "up"))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, row_number() OVER ({q.PART}) AS i, close >= {q.roll("max", "close", 60)} AS ev FROM bars),
b AS (SELECT *, (i - last_value(CASE WHEN ev THEN i END IGNORE NULLS) OVER ({q.PART} ROWS UNBOUNDED PRECEDING))::INT AS s FROM a)
SELECT stock_id, date, s AS since_high, {q.flag("s = 0")} AS high_1d, {q.flag("s <= 3")} AS high_3d, {q.flag("s <= 5")} AS high_5d, {q.flag("s <= 10")} AS high_10d, ln(1 + s::DOUBLE)::FLOAT AS high_log FROM b""")
def event_recency(spark, sf_dir):
    df = bars(spark, sf_dir).withColumn("top", F.col("close") >= w.roll(F.max, F.col("close"), 60))
    return w.bars_since(df, F.col("top"), "since_high").select("stock_id", "date", "since_high", *w.event_columns("since_high", "high"))


def _rank_sql(x):
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY date, {x}) - 1) / 2.0::DOUBLE) / count({x}) OVER (PARTITION BY date) END::FLOAT AS rank_{x}"


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, {", ".join(f"close / {q.lag('close', n)} - 1 AS return_{n}d" for n in (5, 20, 60))}, volume FROM bars)
SELECT stock_id, date, {", ".join(_rank_sql(x) for x in ("return_5d", "return_20d", "return_60d", "volume"))} FROM a""")
def xs_rank_pct(spark, sf_dir):
    df = bars(spark, sf_dir).select("stock_id", "date", "volume", *[w.change(F.col("close"), n).alias(f"return_{n}d") for n in (5, 20, 60)]).repartition(parts(spark, sf_dir), "date")
    return df.select("stock_id", "date", *[f32(w.rank_in_section(F.col(x), x), f"rank_{x}") for x in ("return_5d", "return_20d", "return_60d", "volume")])


@query(f"""WITH {BARS}, {SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, stock_id) AS place, count(*) OVER (PARTITION BY date) AS n FROM score WHERE score IS NOT NULL)
SELECT stock_id, date, score::FLOAT AS score, place::INT AS place FROM k WHERE place <= greatest(round_even(n * 0.015, 0), 1)""")
def top_pct_per_day(spark, sf_dir):
    day = Window.partitionBy("date")
    ranked = scores(bars(spark, sf_dir)).where("score is not null").withColumn("place", F.row_number().over(day.orderBy(F.col("score").desc(), "stock_id")))
    keep = F.greatest(F.bround(F.count("*").over(day) * F.lit(0.015)), F.lit(1))
    return ranked.withColumn("keep", keep).where("place <= keep").select("stock_id", "date", f32(F.col("score"), "score"), F.col("place").cast("int").alias("place"))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, {q.flag("close > " + q.lag("close"))} AS hit FROM bars WHERE date <= TIMESTAMP '1998-01-01'),
b AS (SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY date DESC) AS back FROM a)
SELECT stock_id, max(date) AS date, coalesce(min(CASE WHEN hit = 0 THEN back END) - 1, count(*))::INT AS streak FROM b GROUP BY stock_id""")
def trailing_streak_asof(spark, sf_dir):
    df = bars(spark, sf_dir).where("date <= timestamp_ntz'1998-01-01 00:00:00'").withColumn("up", F.col("close") > w.lag(F.col("close")))
    df = w.with_streak(df, F.col("up"), "streak")
    return df.groupBy("stock_id").agg(F.max("date").alias("date"), F.max_by("streak", "date").alias("streak"))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, {q.lag("date")} AS previous FROM bars)
SELECT stock_id, previous, date, date_diff('day', previous, date)::INT AS gap_days FROM a WHERE date_diff('day', previous, date) > 5""")
def calendar_gaps(spark, sf_dir):
    df = bars(spark, sf_dir).select("stock_id", w.lag(F.col("date")).alias("previous"), "date")
    return df.withColumn("gap_days", F.datediff("date", "previous")).where("gap_days > 5")
