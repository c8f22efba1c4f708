"""Chart levels and conditional statistics as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import flag
from ..operators import medians, rolling
from ..operators import windows as w
from ..operators.joins import latest
from ..operators.recursive import per_entity
from ..sources.panel import BARS, SCORES, bars, scores
from ..sources.tables import stored
from . import registry as q
from .registry import query
from .simulation import exact, exact_sql

TAIL = f"t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_id ORDER BY date DESC) AS back FROM bars) WHERE back <= 120)"


def tail(df, n=120):
    """The last n bars of each entity."""
    back = F.row_number().over(Window.partitionBy("stock_id").orderBy(F.col("date").desc()))
    return df.withColumn("back", back).where(F.col("back") <= n)


@query(f"""WITH {BARS}, {TAIL}, x AS (SELECT stock_id, min(low) AS lo, max(high) AS hi FROM t GROUP BY stock_id),
p AS (SELECT stock_id, least(floor(((high + low + close) / 3 - lo) / (hi - lo) * 48), 47)::INT AS bin, volume FROM t JOIN x USING (stock_id)) SELECT stock_id, bin, sum(volume) AS volume FROM p GROUP BY ALL""")
def volume_profile(spark, sf_dir):
    """Volume by 48 equal bins of the typical price; the top edge belongs to the last bin."""
    rows = tail(bars(spark, sf_dir))
    span = Window.partitionBy("stock_id")
    low, high = F.min("low").over(span), F.max("high").over(span)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    bins = F.least(F.floor(F.try_divide(typical - low, high - low) * 48), F.lit(47)).cast("int")
    return rows.select("stock_id", bins.alias("bin"), "volume").groupBy("stock_id", "bin").agg(F.sum("volume").alias("volume"))


@query(f"""WITH {BARS}, {TAIL} SELECT stock_id, date, (sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w)::FLOAT AS vwap FROM t WINDOW w AS (PARTITION BY stock_id ORDER BY date ROWS UNBOUNDED PRECEDING)""")
def anchored_vwap(spark, sf_dir):
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    return tail(bars(spark, sf_dir)).select("stock_id", "date", F.try_divide(F.sum(typical * F.col("volume")).over(w.running()), F.sum("volume").over(w.running())).cast("float").alias("vwap"))


@query(f"""WITH {BARS}, {TAIL}, x AS (SELECT stock_id, max(high) AS hi, min(low) AS lo, min(CASE WHEN high = mh THEN date END) AS hd, min(CASE WHEN low = ml THEN date END) AS ld FROM (SELECT *, max(high) OVER (PARTITION BY stock_id) AS mh, min(low) OVER (PARTITION BY stock_id) AS ml FROM t) GROUP BY stock_id)
SELECT stock_id, r::FLOAT AS ratio, (CASE WHEN hd < ld THEN lo + (hi - lo) * r ELSE hi - (hi - lo) * r END)::FLOAT AS level FROM x, (SELECT unnest([0.236::DOUBLE, 0.382::DOUBLE, 0.5::DOUBLE, 0.618::DOUBLE, 0.786::DOUBLE]) AS r)""")
def fibonacci(spark, sf_dir):
    """Retracement levels, from the low where the high came first, else from the high."""
    rows = tail(bars(spark, sf_dir)).groupBy("stock_id").agg(
        F.max("high").alias("hi"), F.min("low").alias("lo"), F.min_by("date", F.struct(-F.col("high"), "date")).alias("hd"), F.min_by("date", F.struct("low", "date")).alias("ld")
    )
    rows = rows.withColumn("r", F.explode(F.array(*[F.lit(x) for x in (0.236, 0.382, 0.5, 0.618, 0.786)])))
    move = (F.col("hi") - F.col("lo")) * F.col("r")
    return rows.select("stock_id", F.col("r").cast("float").alias("ratio"), F.when(F.col("hd") < F.col("ld"), F.col("lo") + move).otherwise(F.col("hi") - move).cast("float").alias("level"))


@query(f"""WITH {BARS}, l AS (SELECT stock_id, arg_max(high, date) AS h, arg_max(low, date) AS lo, arg_max(close, date) AS c FROM bars GROUP BY stock_id), p AS (SELECT *, (h + lo + c) / 3 AS p FROM l)
SELECT stock_id, p::FLOAT AS p, (2 * p - lo)::FLOAT AS r1, (2 * p - h)::FLOAT AS s1, (p + (h - lo))::FLOAT AS r2, (p - (h - lo))::FLOAT AS s2 FROM p""")
def pivot_points(spark, sf_dir):
    h, lo, c = F.col("high"), F.col("low"), F.col("close")
    p = (h + lo + c) / 3
    f = lambda x, n: x.cast("float").alias(n)
    return latest(bars(spark, sf_dir).select("stock_id", "date", "high", "low", "close")).select("stock_id", f(p, "p"), f(2 * p - lo, "r1"), f(2 * p - h, "s1"), f(p + (h - lo), "r2"), f(p - (h - lo), "s2"))


@query(f"""WITH {BARS}, a AS (SELECT *, {q.lag("high")} AS ph, {q.lag("low")} AS pl, min(close) OVER ({q.PART} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mn, max(close) OVER ({q.PART} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mx FROM bars)
SELECT stock_id, date, CASE WHEN low > ph * 1.01::DOUBLE THEN 'up' ELSE 'down' END AS side, CASE WHEN low > ph * 1.01::DOUBLE THEN ph ELSE high END AS bottom, CASE WHEN low > ph * 1.01::DOUBLE THEN low ELSE pl END AS top FROM a
WHERE (low > ph * 1.01::DOUBLE AND mn > ph) OR (high < pl * 0.99::DOUBLE AND mx < pl)""")
def unfilled_gaps(spark, sf_dir):
    """Gaps of 1 % or more that no later close has filled."""
    later = w.line().rowsBetween(0, Window.unboundedFollowing)
    df = bars(spark, sf_dir).select("*", w.lag(F.col("high")).alias("ph"), w.lag(F.col("low")).alias("pl"), F.min("close").over(later).alias("mn"), F.max("close").over(later).alias("mx"))
    up = F.col("low") > F.col("ph") * 1.01
    kept = df.where((up & (F.col("mn") > F.col("ph"))) | ((F.col("high") < F.col("pl") * 0.99) & (F.col("mx") < F.col("pl"))))
    return kept.select("stock_id", "date", F.when(up, "up").otherwise("down").alias("side"), F.when(up, F.col("ph")).otherwise(F.col("high")).alias("bottom"), F.when(up, F.col("low")).otherwise(F.col("pl")).alias("top"))


@query(f"""WITH {BARS}, {TAIL}, a AS (SELECT stock_id, close, row_number() OVER (PARTITION BY stock_id ORDER BY close) AS k, close / lag(close) OVER (PARTITION BY stock_id ORDER BY close) - 1 AS gap FROM t), b AS (SELECT *, sum(coalesce(gap > 0.02::DOUBLE, false)::INT) OVER (PARTITION BY stock_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS c FROM a)
SELECT stock_id, c::BIGINT AS cluster, min(close) AS low, max(close) AS high, count(*) AS members FROM b GROUP BY stock_id, c""")
def level_clusters(spark, sf_dir):
    """Sorted levels chained while each is within 2 % of the previous member."""
    order = Window.partitionBy("stock_id").orderBy("close")
    df = tail(bars(spark, sf_dir)).select("stock_id", "close", F.row_number().over(order).alias("k"), (F.try_divide("close", F.lag("close").over(order)) - 1).alias("gap"))
    steps = Window.partitionBy("stock_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("cluster", F.sum(flag(F.col("gap") > 0.02)).over(steps))
    return df.groupBy("stock_id", "cluster").agg(F.min("close").alias("low"), F.max("close").alias("high"), F.count("*").alias("members"))


@query(f"""WITH {BARS}, {SCORES} SELECT date, count(*) AS total, sum((score >= 0.97)::BIGINT)::BIGINT AS hits, sum((score >= 0.97)::BIGINT)::DOUBLE / count(*) AS density, CASE WHEN sum((score >= 0.97)::BIGINT)::DOUBLE / count(*) >= 0.002::DOUBLE THEN 'many' WHEN sum((score >= 0.97)::BIGINT)::DOUBLE / count(*) >= 0.0008::DOUBLE THEN 'some' ELSE 'few' END AS verdict FROM score WHERE score IS NOT NULL GROUP BY date""")
def signal_density(spark, sf_dir):
    hits = F.sum((F.col("score") >= 0.97).cast("long"))
    df = scores(bars(spark, sf_dir)).where("score is not null").groupBy("date").agg(F.count("*").alias("total"), hits.alias("hits"))
    density = F.col("hits") / F.col("total")
    return df.select("date", "total", "hits", density.alias("density"), F.when(density >= 0.002, "many").when(density >= 0.0008, "some").otherwise("few").alias("verdict"))


PATTERNS = {
    "above_ma20": ("close > m20", lambda: F.col("close") > F.col("m20")),
    "bull": ("m5 > m20 AND m20 > m60", lambda: (F.col("m5") > F.col("m20")) & (F.col("m20") > F.col("m60"))),
    "bear": ("m5 < m20 AND m20 < m60", lambda: (F.col("m5") < F.col("m20")) & (F.col("m20") < F.col("m60"))),
    "new_high": ("close >= h60", lambda: F.col("close") >= F.col("h60")),
    "heavy": ("volume > 1.5::DOUBLE * v20", lambda: F.col("volume") > 1.5 * F.col("v20")),
    "cross_up": ("close > m20 AND close_before <= m20_before", lambda: (F.col("close") > F.col("m20")) & (F.col("close_before") <= F.col("m20_before"))),
}
WIDE = f"""{BARS}, w0 AS (SELECT stock_id, date, close, volume, {q.roll("avg", "close", 5)} AS m5, {q.roll("avg", "close", 20)} AS m20, {q.roll("avg", "close", 60)} AS m60, {q.roll("max", "close", 60)} AS h60, {q.roll("avg", "volume", 20)} AS v20 FROM bars),
w AS (SELECT *, {q.lag("close")} AS close_before, {q.lag("m20")} AS m20_before, {q.lead("close", 21)} / {q.lead("close")} - 1 AS ret20 FROM w0), hits AS (SELECT stock_id, date, ret20, {", ".join(f"{q.flag(s)} AS {k}" for k, (s, _) in PATTERNS.items())} FROM w)"""


def _hits(spark, sf_dir):
    """Every pattern's flag for every bar in one wide projection, with the return from the next close to 20 bars on."""
    close = F.col("close")
    df = bars(spark, sf_dir).select("stock_id", "date", "close", "volume", w.lag(close).alias("close_before"), (F.try_divide(w.lead(close, 21), w.lead(close)) - 1).alias("ret20"))

    def compute(a):
        told = {**{f"m{n}": ("mean", "close", n) for n in (5, 20, 60)}, "h60": ("max", "close", 60), "v20": ("mean", "volume", 20)}
        out = rolling.statistics(a, told)
        return {**out, "m20_before": rolling.earlier(out["m20"], 1)}

    df = per_entity(df, ["close", "volume"], "m5 double, m20 double, m60 double, h60 double, v20 double, m20_before double", compute, keep=("close", "volume", "close_before", "ret20"))
    return df.select("stock_id", "date", "ret20", *[flag(c()).alias(k) for k, (_, c) in PATTERNS.items()])


@query(f"WITH {WIDE} SELECT stock_id, date, {', '.join(PATTERNS)} FROM hits")
def pattern_hits(spark, sf_dir):
    return _hits(spark, sf_dir).drop("ret20")


STATS = f"count(*) AS n, avg((ret20 > 0)::INT) AS win_rate, median(ret20)::FLOAT AS median_ret, {exact_sql('ret20')} / count(*) AS mean_ret"


def _stats(rows, *keys):
    """Number, win rate, median and mean of ret20 by keys; the median is exact and no task gets a whole group."""
    rows, _ = stored(rows.select(*keys, "ret20"), "returns")
    ret = F.col("ret20")
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((ret > 0).cast("int")).alias("win_rate"), (exact(ret) / F.count("*")).alias("mean_ret"))
    middle = medians.exact_medians(rows, "ret20", keys)
    joined = found.join(F.broadcast(middle), list(keys), "left") if keys else found.join(F.broadcast(middle), F.lit(True), "left")
    return joined.select(*keys, "n", "win_rate", F.col("median").cast("float").alias("median_ret"), "mean_ret")


@query(f"WITH {WIDE}, u AS (UNPIVOT (SELECT ret20, {', '.join(PATTERNS)} FROM hits WHERE ret20 IS NOT NULL) ON {', '.join(PATTERNS)} INTO NAME pattern VALUE hit) SELECT pattern, {STATS}, (count(*) >= 30)::INT AS conclusive FROM u WHERE hit = 1 GROUP BY pattern")
def pattern_stats(spark, sf_dir):
    long = _hits(spark, sf_dir).where("ret20 is not null").unpivot("ret20", list(PATTERNS), "pattern", "hit").where("hit = 1")
    return _stats(long, "pattern").withColumn("conclusive", (F.col("n") >= 30).cast("int"))


@query(f"WITH {WIDE} SELECT {STATS} FROM hits WHERE ret20 IS NOT NULL")
def baseline_stats(spark, sf_dir):
    close = F.col("close")
    returns = bars(spark, sf_dir).select((F.try_divide(w.lead(close, 21), w.lead(close)) - 1).alias("ret20"))  # no pattern is needed
    return _stats(returns.where("ret20 is not null"))


@query(f"WITH {WIDE} SELECT {STATS} FROM hits WHERE ret20 IS NOT NULL AND above_ma20 = 1 AND bull = 1 AND heavy = 1")
def joint_stats(spark, sf_dir):
    """The statistics of bars on which several patterns hold at once."""
    return _stats(_hits(spark, sf_dir).where("ret20 is not null and above_ma20 = 1 and bull = 1 and heavy = 1"))


@query(f"WITH {WIDE} SELECT stock_id, {STATS} FROM hits WHERE ret20 IS NOT NULL AND cross_up = 1 GROUP BY stock_id")
def crossing_history(spark, sf_dir):
    ret = F.col("ret20")
    rows = _hits(spark, sf_dir).where("ret20 is not null and cross_up = 1").groupBy("stock_id")
    return rows.agg(F.count("*").alias("n"), F.avg((ret > 0).cast("int")).alias("win_rate"), F.percentile(ret, F.lit(0.5)).cast("float").alias("median_ret"), (exact(ret) / F.count("*")).alias("mean_ret"))


@query(f"WITH {WIDE}, u AS (UNPIVOT (SELECT stock_id, date, {', '.join(PATTERNS)} FROM hits) ON {', '.join(PATTERNS)} INTO NAME pattern VALUE hit) SELECT stock_id, date, count(*) AS rules, string_agg(pattern, ', ' ORDER BY pattern) AS rule_list FROM u WHERE hit = 1 GROUP BY ALL HAVING count(*) >= 3")
def rule_screener(spark, sf_dir):
    long = _hits(spark, sf_dir).unpivot(["stock_id", "date"], list(PATTERNS), "pattern", "hit").where("hit = 1")
    return long.groupBy("stock_id", "date").agg(F.count("*").alias("rules"), F.array_join(F.array_sort(F.collect_list("pattern")), ", ").alias("rule_list")).where("rules >= 3")
