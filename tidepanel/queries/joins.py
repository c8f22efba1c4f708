"""Joins over the panel as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators import joins as j
from ..operators import windows as w
from ..sources.panel import ACTIONS, BARS, INDEX, REVENUE, SCORES, actions, bars, index_bars, revenue, scores, table
from . import registry as q
from .registry import query

DAY = "TIMESTAMP '1996-01-01'"


@query(f"""WITH {BARS}, {REVENUE} SELECT b.stock_id, b.date, b.close, r.revenue, r.revenue_month, r.revenue_year FROM bars b ASOF LEFT JOIN rev r ON b.stock_id = r.stock_id AND b.date >= r.announce_date""")
def asof_revenue(spark, sf_dir):
    left = bars(spark, sf_dir).select("stock_id", "date", "close")
    return j.asof_backward(left, revenue(spark, sf_dir), "announce_date", ["revenue", "revenue_month", "revenue_year"])


@query(f"""WITH {BARS}, v AS (SELECT l_suppkey AS stock_id, l_shipdate AS date, max(l_extendedprice) AS per FROM lineitem WHERE l_linenumber = 7 GROUP BY ALL),
m AS (SELECT b.stock_id, b.date, v.per FROM bars b LEFT JOIN v USING (stock_id, date))
SELECT stock_id, date, last_value(per IGNORE NULLS) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS per FROM m""")
def ffill_fundamental(spark, sf_dir):
    values = table(spark, sf_dir, "lineitem").where("l_linenumber = 7").groupBy(F.col("l_suppkey").alias("stock_id"), F.col("l_shipdate").alias("date")).agg(F.max("l_extendedprice").alias("per"))
    return j.forward_filled(bars(spark, sf_dir).select("stock_id", "date").join(values, ["stock_id", "date"], "left"), ["per"])


@query(f"""WITH {BARS}, {ACTIONS}, j AS (SELECT b.stock_id, b.date, coalesce(ca.ratio, 1) AS ratio FROM bars b LEFT JOIN ca ON ca.stock_id = b.stock_id AND ca.date = b.date)
SELECT stock_id, date, coalesce(product(ratio) OVER ({q.PART} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1)::FLOAT AS factor FROM j""")
def range_adjust_factor(spark, sf_dir):
    """The product of all later ratios of every bar; in the SQL, whose actions lie on bars, a window over them."""
    prices = bars(spark, sf_dir).select("stock_id", "date", "close")
    return j.later_product(prices, actions(prices)).select("stock_id", "date", F.col("factor").cast("float").alias("factor"))


@query(f"""WITH {BARS}, pos AS (SELECT stock_id, date AS buy_date, {q.lead("date", 10)} AS sell_date FROM bars), moves AS (SELECT buy_date AS date, count(*) AS k FROM pos GROUP BY 1 UNION ALL SELECT sell_date, -count(*) FROM pos WHERE sell_date IS NOT NULL GROUP BY 1),
days AS (SELECT date, sum(k) AS k FROM moves GROUP BY date), firsts AS (SELECT first_date AS date, min(stock_id) AS id FROM (SELECT stock_id, min(date) AS first_date FROM bars GROUP BY stock_id) GROUP BY 1)
SELECT date, (sum(k) OVER w)::BIGINT AS held, min(id) OVER w AS first_id, date AS last_buy FROM days LEFT JOIN firsts USING (date) WINDOW w AS (ORDER BY date ROWS UNBOUNDED PRECEDING)""")
def interval_holdings(spark, sf_dir):
    """Holdings where every bar opens a position for ten bars. The SQL counts purchases less sales; as an entity once bought is
    never without a position, and every day has a purchase, the least id and the last purchase follow from the first bars."""
    prices = bars(spark, sf_dir).select("stock_id", "date")
    return _holdings(prices.select("stock_id", F.col("date").alias("buy_date"), F.lead("date", 10).over(w.line()).alias("sell_date")), prices)


def _holdings(positions, prices):
    held = j.held_on(positions, prices.select("date").distinct())
    return held.groupBy("date").agg(F.count("*").alias("held"), F.min("stock_id").alias("first_id"), F.max("buy_date").alias("last_buy"))


@query(f"""WITH {BARS}, r AS (SELECT stock_id, date, floor((close / {q.lag("close")} - 1) * 10000)::BIGINT AS ret1, floor(({q.lead("close", 5)} / close - 1) * 10000)::BIGINT AS fwd FROM bars),
s AS (SELECT stock_id, date, fwd FROM r WHERE ret1 >= 5000 AND fwd IS NOT NULL)
SELECT a.stock_id, a.date, a.fwd, count(b.stock_id) AS peers, sum(b.fwd)::DOUBLE / nullif(count(b.stock_id), 0) AS peer_mean FROM s a LEFT JOIN s b ON a.date = b.date AND a.stock_id <> b.stock_id GROUP BY a.stock_id, a.date, a.fwd""")
def theta_peer_benchmark(spark, sf_dir):
    """Each signal against the other signals of its day: the day's sums less its own part, which needs no pairs."""
    df = bars(spark, sf_dir).select("stock_id", "date", F.floor(w.change(F.col("close")) * 10000).alias("ret1"), F.floor((F.try_divide(w.lead(F.col("close"), 5), F.col("close")) - 1) * 10000).alias("fwd"))
    signals = df.where("ret1 >= 5000 and fwd is not null")
    day = Window.partitionBy("date")
    peers = (F.count("*").over(day) - 1).alias("peers")
    rest = (F.sum("fwd").over(day) - F.col("fwd")).alias("rest")
    return signals.select("stock_id", "date", "fwd", peers, rest).select("stock_id", "date", "fwd", "peers", ratio(F.col("rest"), F.col("peers")).alias("peer_mean"))


@query(f"""WITH {BARS}, {SCORES}, trained AS (SELECT stock_id, date, score FROM score WHERE date < {DAY}), live AS (SELECT stock_id, date, 1 - score AS score FROM score WHERE date >= TIMESTAMP '1995-06-01')
SELECT *, 0 AS is_live FROM trained UNION ALL SELECT *, 1 AS is_live FROM live WHERE date NOT IN (SELECT date FROM trained)""")
def anti_live_scores(spark, sf_dir):
    """Trained scores, and live ones for the dates that those lack."""
    base = scores(bars(spark, sf_dir))
    trained = base.where("date < timestamp_ntz'1996-01-01 00:00:00'")
    live = base.where("date >= timestamp_ntz'1995-06-01 00:00:00'").withColumn("score", 1 - F.col("score"))
    return trained.withColumn("is_live", F.lit(0)).unionByName(live.join(trained.select("date").distinct(), "date", "left_anti").withColumn("is_live", F.lit(1)))


@query(f"""WITH {BARS} SELECT stock_id, date, close FROM bars WHERE stock_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def semi_universe(spark, sf_dir):
    universe = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("stock_id"))
    return bars(spark, sf_dir).select("stock_id", "date", "close").join(universe, "stock_id", "left_semi")


@query(f"""WITH {BARS}, o AS (SELECT stock_id, date, CASE WHEN stock_id % 7 = 0 THEN close + 1 ELSE close END AS close, CASE WHEN stock_id % 5 = 0 THEN NULL ELSE volume END AS volume FROM bars),
b AS (SELECT n.close AS c1, o.close AS c0, n.volume AS v1, o.volume AS v0 FROM bars n JOIN o USING (stock_id, date))
SELECT count(*) AS compared, 'close' AS column_name, count(*) FILTER (c1 IS DISTINCT FROM c0 AND coalesce(abs(c1 - c0) > 1e-9, true)) AS mismatches FROM b
UNION ALL SELECT count(*), 'volume', count(*) FILTER (v1 IS DISTINCT FROM v0 AND coalesce(abs(v1 - v0) > 1e-9, true)) FROM b""")
def value_diff(spark, sf_dir):
    new = bars(spark, sf_dir).select("stock_id", "date", "close", "volume")
    old = new.select("stock_id", "date", F.when(F.col("stock_id") % 7 == 0, F.col("close") + 1).otherwise(F.col("close")).alias("close"), F.when(F.col("stock_id") % 5 != 0, F.col("volume")).alias("volume"))
    return j.value_differences(new, old, ["stock_id", "date"], ["close", "volume"])


@query(f"""WITH {BARS} SELECT a.stock_id, a.date, count(b.date) AS neighbours, median(b.close)::FLOAT AS neighbour_median FROM bars a JOIN bars b ON a.stock_id = b.stock_id AND b.date <> a.date AND abs(date_diff('day', a.date, b.date)) <= 5 GROUP BY a.stock_id, a.date""")
def proximity_blame(spark, sf_dir):
    """The median close of an entity's other bars within five days: a range window over the day number."""
    days = F.datediff("date", F.lit("1970-01-01")).cast("long")
    near = Window.partitionBy("stock_id").orderBy("day").rangeBetween(-5, 5)
    df = bars(spark, sf_dir).select("stock_id", "date", "close", days.alias("day"))
    df = df.withColumn("seen", F.collect_list(F.struct("day", "close")).over(near))
    others = F.sort_array(F.transform(F.filter("seen", lambda x: x["day"] != F.col("day")), lambda x: x["close"]))
    df = df.withColumn("others", others).where(F.size("others") > 0)
    n = F.size("others")
    middle = (F.get("others", F.floor((n - 1) / 2).cast("int")) + F.get("others", F.floor(n / 2).cast("int"))) / 2
    return df.select("stock_id", "date", n.cast("long").alias("neighbours"), middle.cast("float").alias("neighbour_median"))


@query(f"""WITH {BARS}, {INDEX}, a AS (SELECT b.stock_id, b.date, b.close, i.close AS index_close FROM bars b LEFT JOIN idx i USING (date))
SELECT stock_id, date, (close / {q.lag("close", 20)} - 1)::FLOAT AS return_20d, ((close / {q.lag("close", 20)} - 1) - (index_close / {q.lag("index_close", 20)} - 1))::FLOAT AS rs_20d FROM a""")
def reindexed_strength(spark, sf_dir):
    """Return less the index's return over the entity's own dates: the index is joined first and lagged after."""
    prices = bars(spark, sf_dir).select("stock_id", "date", "close")
    df = prices.join(index_bars(prices).withColumnRenamed("close", "index_close"), "date", "left")
    own = w.change(F.col("close"), 20)
    return df.select("stock_id", "date", own.cast("float").alias("return_20d"), (own - w.change(F.col("index_close"), 20)).cast("float").alias("rs_20d"))


@query(f"""WITH {BARS} SELECT stock_id, max(date) AS date, arg_max(close, date) AS close FROM bars WHERE date <= {DAY} GROUP BY stock_id""")
def latest_asof(spark, sf_dir):
    return j.latest(bars(spark, sf_dir).select("stock_id", "date", "close"), until=F.lit("1996-01-01").cast("timestamp_ntz"))


@query(f"""WITH {BARS}, {SCORES}, n AS (SELECT s_suppkey AS stock_id, s_name FROM supplier), t AS (SELECT * FROM score WHERE score >= 0.97)
SELECT t.stock_id, n.s_name AS stock_name, t.date, t.score::FLOAT AS score, b.close, CASE WHEN p.score >= 0.9 THEN 1 ELSE 0 END AS also_peer
FROM t LEFT JOIN n USING (stock_id) LEFT JOIN bars b USING (stock_id, date) LEFT JOIN (SELECT stock_id, date + INTERVAL 1 DAY AS date, score FROM score) p USING (stock_id, date)""")
def signal_list(spark, sf_dir):
    """Signals with names, prices and whether another model's score of the day before agrees."""
    prices = bars(spark, sf_dir)
    base = scores(prices)
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("stock_id"), F.col("s_name").alias("stock_name"))
    peer = base.select("stock_id", (F.col("date") + F.expr("interval 1 day")).alias("date"), F.col("score").alias("peer"))
    df = base.where("score >= 0.97").join(names, "stock_id", "left").join(prices.select("stock_id", "date", "close"), ["stock_id", "date"], "left").join(peer, ["stock_id", "date"], "left")
    return df.select("stock_id", "stock_name", "date", F.col("score").cast("float").alias("score"), "close", F.coalesce((F.col("peer") >= 0.9).cast("int"), F.lit(0)).alias("also_peer"))
