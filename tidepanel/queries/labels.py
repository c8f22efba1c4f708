"""Labels as queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import labels as lb
from ..operators import windows as w
from ..operators.recursive import per_entity
from ..sources import incremental
from ..sources.panel import BARS, bars
from ..sources.tables import shared_folder
from . import registry as q
from .registry import query

RISES = f"""{BARS}, u AS (SELECT stock_id, date, close, (close > {q.lag("close")})::INT AS up, abs(close - {q.lag("close")}) AS step, {q.roll("avg", "close", 20)} AS ma20, {q.roll("avg", "close", 10)} AS ma10 FROM bars)"""
FULL = f"{q.ahead('count', 'close', 1, 20)} = 20"
UP20 = f"{q.ahead('sum', 'up', 1, 20)} >= 10"


def _rises(spark, sf_dir):
    df = bars(spark, sf_dir).select("stock_id", "date", "close")
    return df.select("*", (F.col("close") > w.lag(F.col("close"))).cast("int").alias("up"), F.abs(F.col("close") - w.lag(F.col("close"))).alias("step"), w.mean(F.col("close"), 20).alias("ma20"), w.mean(F.col("close"), 10).alias("ma10"))


@query(f"WITH {RISES} SELECT stock_id, date, CASE WHEN {FULL} THEN ({UP20})::INT END AS label FROM u")
def label_up20(spark, sf_dir):
    return _rises(spark, sf_dir).select("stock_id", "date", lb.up_days(F.col("close"), F.col("up")).alias("label"))


@query(f"WITH {RISES} SELECT * FROM (SELECT stock_id, date, CASE WHEN {FULL} THEN ({UP20} AND {q.ahead('min', 'close', 1, 20)} / close - 1 > -0.1::DOUBLE)::INT END AS label FROM u) WHERE label IS NOT NULL")
def label_mdd10(spark, sf_dir):
    return _rises(spark, sf_dir).select("stock_id", "date", lb.shallow_drawdown(F.col("close"), F.col("up")).alias("label")).dropna(subset=["label"])


def _two_labels(prices):
    """Both labels of bars, which look 20 rows ahead and one back."""
    up = (F.col("close") > w.lag(F.col("close"))).cast("int")
    df = prices.select("stock_id", "date", "close", up.alias("up"))
    return df.select("stock_id", "date", lb.up_days(F.col("close"), F.col("up")).alias("label_up20"), lb.shallow_drawdown(F.col("close"), F.col("up")).alias("label_mdd10"))


@query(f"WITH {RISES} SELECT stock_id, date, CASE WHEN {FULL} THEN ({UP20})::INT END AS label_up20, CASE WHEN {FULL} THEN ({UP20} AND {q.ahead('min', 'close', 1, 20)} / close - 1 > -0.1::DOUBLE)::INT END AS label_mdd10 FROM u")
def labels_by_tail(spark, sf_dir):
    """Labels of a table that grows by four increments, each of which computes only the months that its bars can change."""
    prices = bars(spark, sf_dir).select("stock_id", "date", "close")
    base = f"{shared_folder(spark)}/tail-{uuid.uuid4().hex}"
    for start, stop in (("1992", "1996"), ("1996", "1998"), ("1998", "2000"), ("2000", "2100")):
        new = prices.where(F.col("date").between(F.lit(f"{start}-01-01").cast("timestamp_ntz"), F.lit(f"{stop}-01-01").cast("timestamp_ntz") - F.expr("interval 1 microsecond")))
        incremental.upsert_months(spark, f"{base}/bars", new, ["stock_id", "date"])
        incremental.recompute_tail(spark, f"{base}/bars", new.schema, f"{base}/labels", new.select("stock_id", "date"), _two_labels, 20, 1)
    return spark.read.parquet(f"{base}/labels").drop("month")


@query(f"""WITH {RISES}, a AS (SELECT *, close / {q.lag("close")} - 1 AS r FROM u), b AS (SELECT *, {q.lead("close", 20)} / close - 1 AS fwd, {q.roll("stddev_samp", "r", 20)} AS sd, (close > ma20)::INT AS above FROM a)
SELECT stock_id, date, label FROM (SELECT stock_id, date, (fwd > greatest(1.5::DOUBLE * sd * sqrt(20), 0.05::DOUBLE) AND {q.ahead("sum", "above", 1, 20)} >= 10)::INT AS label, {q.ahead("count", "above", 1, 20)} AS n, sd FROM b) WHERE n = 20 AND sd IS NOT NULL""")
def label_steady20(spark, sf_dir):
    forward, sd, _ = lb.steady(F.col("close"))
    df = _rises(spark, sf_dir).withColumn("r", w.change(F.col("close")))
    df = df.select("stock_id", "date", forward.alias("fwd"), w.roll(F.stddev_samp, F.col("r"), 20).alias("sd"), (F.col("close") > F.col("ma20")).cast("int").alias("above"))
    df = df.withColumn("n", F.count("above").over(w.ahead(1, 20))).withColumn("hits", F.sum("above").over(w.ahead(1, 20)))
    label = (F.col("fwd") > F.greatest(1.5 * F.col("sd") * F.sqrt(F.lit(20)), F.lit(0.05))) & (F.col("hits") >= 10)
    return df.where("n = 20 and sd is not null").select("stock_id", "date", label.cast("int").alias("label"))


def _barrier_sql(persist, profit=0.1, horizon=15):
    win = f"close / c0 - 1 >= {profit}::DOUBLE" + (" AND ups * 2 > k" if persist else "")
    return f"""WITH RECURSIVE {RISES}, n AS (SELECT stock_id, date, close, ma10, row_number() OVER ({q.PART}) AS i FROM u),
r AS (SELECT a.stock_id, a.i AS i0, b.close AS c0, b.close AS last, 1 AS k, false AS below, 0 AS ups, NULL::INT AS out FROM n a LEFT JOIN n b ON b.stock_id = a.stock_id AND b.i = a.i + 1
 UNION ALL SELECT stock_id, i0, c0, close, k, below, ups, CASE WHEN {win} THEN 1 WHEN below AND before THEN 0 END FROM (
  SELECT r.stock_id, r.i0, r.c0, n.close, r.k + 1 AS k, coalesce(n.close < n.ma10, false) AS below, r.below AS before, r.ups + (n.close > r.last)::INT AS ups
  FROM r JOIN n ON n.stock_id = r.stock_id AND n.i = r.i0 + r.k + 1 WHERE r.out IS NULL AND r.k < {horizon})),
f AS (SELECT stock_id, i0, coalesce(max(out), CASE WHEN max(k) = {horizon} THEN 0 END) AS label FROM r GROUP BY ALL)
SELECT n.stock_id, n.date, f.label::INT AS label FROM n JOIN f ON n.stock_id = f.stock_id AND n.i = f.i0"""


@query(_barrier_sql(False))
def triple_barrier(spark, sf_dir):
    return _rises(spark, sf_dir).select("stock_id", "date", lb.barrier(F.col("close"), F.col("ma10"), 0.1, 15).alias("label"))


@query(_barrier_sql(True))
def triple_barrier_persist(spark, sf_dir):
    return _rises(spark, sf_dir).select("stock_id", "date", lb.barrier(F.col("close"), F.col("ma10"), 0.1, 15, persist=True).alias("label"))


@query(f"WITH {RISES} SELECT stock_id, date, CASE WHEN count(close) OVER ({q.PART} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) = 11 THEN (close = min(close) OVER ({q.PART} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AND {q.lead('close', 5)} / close - 1 >= 0.07::DOUBLE)::INT END AS label FROM u")
def local_extrema(spark, sf_dir):
    return bars(spark, sf_dir).select("stock_id", "date", lb.local_low(F.col("close")).alias("label"))


@query(f"WITH {RISES} SELECT stock_id, date, (CASE WHEN count(step) OVER ({q.PART} ROWS BETWEEN 9 PRECEDING AND 10 FOLLOWING) = 20 THEN abs({q.lead('close', 10)} - {q.lag('close', 10)}) / sum(step) OVER ({q.PART} ROWS BETWEEN 9 PRECEDING AND 10 FOLLOWING) END)::FLOAT AS er FROM u")
def efficiency_ratio(spark, sf_dir):
    return _rises(spark, sf_dir).select("stock_id", "date", lb.efficiency(F.col("close"), F.col("step")).cast("float").alias("er"))


def _zigzag_sql(theta: float) -> str:
    """Recursive rows: direction, extreme so far, and the pivot that a row confirms."""
    up, down = f"n.close >= r.ec * (1 + {theta}::DOUBLE)", f"n.close <= r.ec * (1 - {theta}::DOUBLE)"
    on = "(r.dir = 1 AND n.close >= r.ec OR r.dir = -1 AND n.close <= r.ec)"
    turn = f"CASE WHEN {on} THEN 0 WHEN r.dir <= 0 AND {up} THEN 1 WHEN r.dir >= 0 AND {down} THEN -1 ELSE 0 END"
    return f"""n AS (SELECT stock_id, date, close, row_number() OVER ({q.PART}) AS i FROM bars),
z AS (SELECT stock_id, i, 0 AS dir, i AS ext, close AS ec, 0 AS turn, i AS at_ FROM n WHERE i = 1 UNION ALL
 SELECT stock_id, i, CASE WHEN turn <> 0 THEN turn ELSE dir END, CASE WHEN turn <> 0 OR moved THEN i ELSE ext END, CASE WHEN turn <> 0 OR moved THEN close ELSE ec END, turn, ext FROM (
  SELECT n.stock_id, n.i, n.close, r.dir, r.ext, r.ec, {on} AS moved, {turn} AS turn FROM z r JOIN n ON n.stock_id = r.stock_id AND n.i = r.i + 1)),
p AS (SELECT stock_id, at_ AS i, turn AS pivot FROM z WHERE turn <> 0)"""


@query(f"WITH RECURSIVE {BARS}, {_zigzag_sql(0.05)} SELECT n.stock_id, n.date, coalesce(p.pivot, 0)::BIGINT AS pivot FROM n LEFT JOIN p USING (stock_id, i)")
def zigzag_pivots(spark, sf_dir):
    df = bars(spark, sf_dir).select("stock_id", "date", "close")
    return per_entity(df, ["close"], "pivot long", lambda a: {"pivot": lb.zigzag(a["close"])})


_PATH = f"sum(step) OVER ({q.PART} ROWS BETWEEN 9 PRECEDING AND 10 FOLLOWING)"


@query(f"""WITH RECURSIVE {BARS}, {_zigzag_sql(0.5)}, ends AS (SELECT stock_id, max(i) AS last_ FROM p GROUP BY stock_id),
m AS (SELECT n.*, abs(n.close - lag(n.close) OVER ({q.PART})) AS step, count(*) OVER (PARTITION BY stock_id) AS bars_, last_value(CASE WHEN p.i < ends.last_ THEN p.pivot END IGNORE NULLS) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS way, ends.last_ FROM n LEFT JOIN p USING (stock_id, i) LEFT JOIN ends USING (stock_id)),
e AS (SELECT *, abs({q.lead("close", 10)} - {q.lag("close", 10)}) / nullif({_PATH}, 0) AS er FROM m),
s AS (SELECT *, CASE WHEN bars_ < 300 OR i > last_ OR way IS NULL OR er IS NULL THEN NULL WHEN er < 0.15::DOUBLE THEN 0 ELSE way END AS st FROM e),
g AS (SELECT *, sum((st IS DISTINCT FROM before)::INT) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(st) OVER ({q.PART}) AS before FROM s)),
t AS (SELECT *, row_number() OVER (PARTITION BY stock_id, run ORDER BY date) - 1 AS k, count(*) OVER (PARTITION BY stock_id, run) AS len, first_value(close) OVER (PARTITION BY stock_id, run ORDER BY date) AS c0, first_value(close) OVER (PARTITION BY stock_id, run ORDER BY date DESC) AS c1, max(CASE WHEN st IS NOT NULL THEN run END) OVER (PARTITION BY stock_id) AS final FROM g)
SELECT stock_id, date, CASE st WHEN 1 THEN 'up' WHEN -1 THEN 'down' ELSE 'flat' END AS state, CASE WHEN run < final THEN CASE 3 * k // len WHEN 0 THEN 'early' WHEN 1 THEN 'mid' ELSE 'late' END END AS phase, (c1 / c0 - 1)::FLOAT AS amplitude,
 CASE WHEN run < final AND 3 * k // len = 0 THEN CASE st WHEN 1 THEN 1 WHEN -1 THEN 0 END END AS label_swing_up FROM t WHERE st IS NOT NULL""")
def swing_nine_class(spark, sf_dir):
    """State between pivots, phase by thirds of a finished run, its amplitude, and the label of early rises (1) and falls (0)."""
    df = bars(spark, sf_dir).select("stock_id", "date", "close")
    rows = per_entity(df, ["close"], "state double, phase double, amplitude double", lambda a: lb.swing_states(a["close"], 0.5, 0.15)).where("state is not null")
    early = F.col("phase") == 0
    return rows.select(
        "stock_id", "date", F.when(F.col("state") == 1, "up").when(F.col("state") == -1, "down").otherwise("flat").alias("state"), F.when(early, "early").when(F.col("phase") == 1, "mid").when(F.col("phase") == 2, "late").alias("phase"),
        F.col("amplitude").cast("float").alias("amplitude"), F.when(early & (F.col("state") == 1), 1).when(early & (F.col("state") == -1), 0).alias("label_swing_up"),
    )


@query(f"""WITH RECURSIVE {BARS}, {_zigzag_sql(0.5)}, w AS (SELECT stock_id, i, p.pivot AS kind, lead(i) OVER (PARTITION BY stock_id ORDER BY i) AS next_i FROM p)
SELECT CASE kind WHEN 1 THEN 'up' ELSE 'down' END AS way, count(*) AS n_runs, count(*)::DOUBLE / sum(count(*)) OVER () AS share, sum(next_i - i)::BIGINT AS bars FROM w WHERE next_i IS NOT NULL GROUP BY kind""")
def swing_mix(spark, sf_dir):
    """The shares of rising and falling swings, from contiguous runs between pivots."""
    from pyspark.sql import Window

    df = per_entity(bars(spark, sf_dir).select("stock_id", "date", "close"), ["close"], "pivot long", lambda a: {"pivot": lb.zigzag(a["close"], 0.5)})
    at = df.withColumn("i", F.row_number().over(w.line())).where("pivot <> 0").withColumn("next_i", F.lead("i").over(Window.partitionBy("stock_id").orderBy("i"))).where("next_i is not null")
    mix = at.groupBy("pivot").agg(F.count("*").alias("n_runs"), F.sum(F.col("next_i") - F.col("i")).alias("bars"))
    return mix.select(F.when(F.col("pivot") == 1, "up").otherwise("down").alias("way"), "n_runs", (F.col("n_runs") / F.sum("n_runs").over(Window.partitionBy())).alias("share"), "bars")


def _scan_sql(shortest=3, longest=10):
    ys = ["close", *[q.lead("close", k) for k in range(1, longest)]]
    steps, found = [f"y AS (SELECT stock_id, date, {', '.join(f'{y} AS y{k}' for k, y in enumerate(ys))}, {q.lead('close', longest)} AS after FROM bars)"], []
    slopes, ts = [], []
    for n in range(shortest, longest + 1):
        x = [k - (n - 1) / 2 for k in range(n)]
        sxx = sum(v * v for v in x)
        slopes.append(f"({' + '.join(f'y{k} * ({x[k]}::DOUBLE)' for k in range(n))}) / {sxx}::DOUBLE AS s{n}, ({' + '.join(f'y{k}' for k in range(n))}) / {n} AS m{n}")
        rest = " + ".join(f"(y{k} - m{n} - s{n} * ({x[k]}::DOUBLE)) * (y{k} - m{n} - s{n} * ({x[k]}::DOUBLE))" for k in range(n))
        ts.append(f"abs(s{n}) / sqrt(greatest({rest}, 1e-18::DOUBLE) / {max(n - 2, 1)} / {sxx}::DOUBLE) AS t{n}")
        found.append(f"WHEN t{n} >= top THEN sign(s{n})")
    return f"""WITH {BARS}, {steps[0]}, s AS (SELECT *, {', '.join(slopes)} FROM y), t AS (SELECT *, {', '.join(ts)} FROM s),
m AS (SELECT *, greatest({', '.join(f't{n}' for n in range(shortest, longest + 1))}) AS top FROM t) SELECT stock_id, date, CASE WHEN after IS NULL THEN NULL {' '.join(found)} END::INT AS label FROM m"""


@query(_scan_sql())
def trend_scanning(spark, sf_dir):
    return bars(spark, sf_dir).select("stock_id", "date", lb.trend_scan(F.col("close")).alias("label"))
