"""Feature families as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import clip, flag, gate, ratio
from ..operators import windows as w
from ..operators.joins import asof_backward
from ..operators.rolling import rolled
from ..plans import lines, pivots, price
from ..sources.panel import BARS, FLOWS, INDEX, REVENUE, bars, flows, index_bars, revenue
from . import registry as q
from .families import NUMBERED, _HIGH9, _LOW9, _TR, between, floats
from .families import ewm as smoothed
from .families import wilder as smoothed_by_wilder
from .registry import query

SPANS = (5, 10, 20, 60, 120, 240)
MAS = ", ".join(f"{q.roll('avg', 'close', n)} AS ma{n}" for n in SPANS)


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, close, {MAS} FROM bars) SELECT stock_id, date, {", ".join(f"(close / ma{n})::FLOAT AS close_ma{n}_ratio, {q.flag(f'close > ma{n}')} AS above_ma{n}" for n in SPANS)},
 (ma5 / ma20)::FLOAT AS ma5_ma20_ratio, (ma10 / ma60)::FLOAT AS ma10_ma60_ratio, ((ma20 - {q.lag("ma20", 5)}) / (5 * close))::FLOAT AS ma20_slope,
 (CASE WHEN greatest(ma5, ma10, ma20) / least(ma5, ma10, ma20) - 1 <= 10 THEN greatest(ma5, ma10, ma20) / least(ma5, ma10, ma20) - 1 END)::FLOAT AS ma_squeeze FROM a""")
def ma_features(spark, sf_dir):
    return price.moving_averages(bars(spark, sf_dir))


def _streak_sql(cond, x, prefix):
    return f"{x}a AS (SELECT *, {q.flag(cond)} AS {x}hit FROM {{src}}), {x}b AS (SELECT *, sum(1 - {x}hit) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS {x}island FROM {x}a), {x}c AS (SELECT *, sum({x}hit) OVER (PARTITION BY stock_id, {x}island ORDER BY date ROWS UNBOUNDED PRECEDING)::INT AS {x} FROM {x}b)"


def _streak_out(x, prefix):
    return ", ".join(f"({x} >= {n})::INT AS {prefix}_{n}d" for n in (1, 3, 5, 10)) + f", ln(1 + {x}::DOUBLE)::FLOAT AS {prefix}_log"


@query(f"""WITH {BARS}, m AS (SELECT stock_id, date, {", ".join(f"{q.roll('avg', 'close', n)} AS ma{n}" for n in (5, 10, 20))} FROM bars),
{_streak_sql("ma5 > ma10 AND ma10 > ma20", "s", "").format(src="m")}, {_streak_sql("ma5 < ma10 AND ma10 < ma20", "t", "").format(src="sc")}
SELECT stock_id, date, {_streak_out("s", "bull_3ma")}, {_streak_out("t", "bear_3ma")} FROM tc""")
def bull_bear_streaks(spark, sf_dir):
    return price.bull_streaks(bars(spark, sf_dir))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, close, {q.roll("avg", "close", 20)} AS m, {q.roll("stddev_samp", "close", 20)} AS s FROM bars),
b AS (SELECT *, (close - (m - 2 * s)) / nullif((m + 2 * s) - (m - 2 * s), 0) AS b, ((m + 2 * s) - (m - 2 * s)) / m AS wd FROM a)
SELECT stock_id, date, b::FLOAT AS bb_pct_b, (b - {q.lag("b", 5)})::FLOAT AS bb_pct_b_change, wd::FLOAT AS bb_width_pct, {q.flag("close > m + 2 * s")} AS upper_break, {q.flag("close < m - 2 * s")} AS lower_break FROM b""")
def bollinger(spark, sf_dir):
    return price.bollinger(bars(spark, sf_dir))


def _ewm(name, source, x, alphas):
    """Recursive rows (stock_id, i, e0, e1, ..) of exponential means without gaps."""
    first = ", ".join(f"{x} AS e{k}" for k in range(len(alphas)))
    step = ", ".join(f"((1 - {a}::DOUBLE) * e{k} + {a}::DOUBLE * n.{x}) / ((1 - {a}::DOUBLE) + {a}::DOUBLE)" for k, a in enumerate(alphas))
    return f"{name} AS (SELECT stock_id, i, {first} FROM {source} WHERE i = 1 UNION ALL SELECT n.stock_id, n.i, {step} FROM {name} r JOIN {source} n ON n.stock_id = r.stock_id AND n.i = r.i + 1)"


@query(f"""WITH RECURSIVE {BARS}, n AS (SELECT stock_id, date, close, row_number() OVER ({q.PART}) AS i FROM bars), {_ewm("e", "n", "close", ("(2.0::DOUBLE/13)", "(2.0::DOUBLE/27)"))},
d AS (SELECT stock_id, i, e0 - e1 AS dif FROM e), {_ewm("g", "d", "dif", ("(2.0::DOUBLE/10)",))}, z AS (SELECT n.stock_id, n.date, n.close, d.dif, g.e0 AS sig FROM n JOIN d USING (stock_id, i) JOIN g USING (stock_id, i))
SELECT stock_id, date, (dif / close)::FLOAT AS dif_ratio, (sig / close)::FLOAT AS macd_ratio, (CASE WHEN abs((dif - sig) / close) <= 1 THEN (dif - sig) / close END)::FLOAT AS hist_ratio,
 {q.flag("dif > 0")} AS dif_positive, {q.flag(f"dif > sig AND {q.lag('dif')} <= {q.lag('sig')}")} AS macd_golden FROM z""")
def ewm_macd(spark, sf_dir):
    return price.macd(bars(spark, sf_dir))


@query(f"""WITH RECURSIVE {BARS}, a AS (SELECT *, (close - {_LOW9}) / nullif({_HIGH9} - {_LOW9}, 0) * 100 AS rsv FROM bars), {NUMBERED.format("a")}, {smoothed("e1", "n", "rsv", "(1.0::DOUBLE/3)")},
kk AS (SELECT stock_id, i, e AS k FROM e1), {smoothed("e2", "kk", "k", "(1.0::DOUBLE/3)")}, z AS (SELECT n.stock_id, n.date, kk.k, e2.e AS d FROM n JOIN kk USING (stock_id, i) JOIN e2 USING (stock_id, i))
SELECT stock_id, date, {floats({"k_value": "k", "d_value": "d", "kd_diff": "k - d"})}, {q.flag(f"k > d AND {q.lag('k')} <= {q.lag('d')}")} AS kd_golden, {q.flag("k > 80")} AS k_overbought, {q.flag("k < 20")} AS k_oversold FROM z""")
def kd(spark, sf_dir):
    return price.stochastic(bars(spark, sf_dir))


@query(f"""WITH {BARS}, s AS (SELECT stock_id, date, close - {q.lag("close")} AS step FROM bars), g AS (SELECT stock_id, date, CASE WHEN step IS NOT NULL THEN greatest(step, 0) END AS gain, CASE WHEN step IS NOT NULL THEN greatest(-step, 0) END AS loss FROM s)
SELECT stock_id, date, {", ".join(f"(CASE WHEN {q.roll('avg', 'loss', n)} > 1e-9 THEN 100 - 100 / (1 + {q.roll('avg', 'gain', n)} / {q.roll('avg', 'loss', n)}) END)::FLOAT AS rsi_{n}" for n in (7, 14, 21))} FROM g""")
def rsi_sma(spark, sf_dir):
    return price.simple_rsi(bars(spark, sf_dir))


@query(f"""WITH RECURSIVE {BARS}, a AS (SELECT *, close - {q.lag("close")} AS step FROM bars), g AS (SELECT *, greatest(step, 0) AS gain, greatest(-step, 0) AS loss FROM a), {NUMBERED.format("g")}, {smoothed_by_wilder("e", "n", ["gain", "loss"], 14, 2)}
SELECT n.stock_id, n.date, (CASE WHEN e.gain + e.loss = 0 THEN 0 ELSE 100 * (e.gain / (e.gain + e.loss)) END)::FLOAT AS rsi_w14 FROM n LEFT JOIN e USING (stock_id, i)""")
def rsi_wilder(spark, sf_dir):
    return price.wilder_rsi(bars(spark, sf_dir))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, {", ".join(f"CASE WHEN abs(close / {q.lag('close', n)} - 1) <= 1 THEN close / {q.lag('close', n)} - 1 END AS r{n}" for n in (1, 5, 20, 60))},
 {", ".join(f"close / {q.roll('max', 'close', n)} - 1 AS dh{n}, close / {q.roll('min', 'close', n)} - 1 AS dl{n}" for n in (60, 240))} FROM bars)
SELECT stock_id, date, {", ".join(f"r{n}::FLOAT AS return_{n}d" for n in (1, 5, 20, 60))}, {", ".join(f"dh{n}::FLOAT AS dist_high_{n}, dl{n}::FLOAT AS dist_low_{n}" for n in (60, 240))},
 {q.flag("dh60 >= 0")} AS is_new_high_60, {q.flag("r5 > 0 AND r20 > 0 AND r60 > 0")} AS momentum_align FROM a""")
def momentum(spark, sf_dir):
    return price.momentum(bars(spark, sf_dir))


@query(f"""WITH RECURSIVE {BARS}, a AS (SELECT *, {_TR} AS tr FROM bars), {NUMBERED.format("a")}, {smoothed("e", "n", "tr", "(1.0::DOUBLE/14)")}
SELECT n.stock_id, n.date, (CASE WHEN i >= 14 AND e.e / n.close <= 1 THEN e.e / n.close END)::FLOAT AS atr_ratio FROM n JOIN e USING (stock_id, i)""")
def atr_volatility(spark, sf_dir):
    return price.average_true_range(bars(spark, sf_dir))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, close, volume, coalesce(sign(close - {q.lag("close")}), 0) * volume AS signed, coalesce(((close - low) - (high - close)) / nullif(high - low, 0) * volume, 0) AS mfv FROM bars)
SELECT stock_id, date, sum(signed) OVER ({q.PART} ROWS UNBOUNDED PRECEDING) AS obv, (volume / {q.roll("avg", "volume", 5)})::FLOAT AS vol_ratio, ({q.roll("avg", "volume", 20)} / {q.roll("avg", "volume", 60)})::FLOAT AS avg_vol_ratio,
 ({q.roll("sum", "mfv", 20, 10)} / {q.roll("sum", "volume", 20, 10)})::FLOAT AS cmf FROM a""")
def obv_cmf_volume(spark, sf_dir):
    return price.volume_flow(bars(spark, sf_dir))


_W15 = f"OVER ({q.PART} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"
_UP15, _DN15 = f"(at_ - arg_max(at_, {{'x': high, 'at': at_}}) {_W15})", f"(at_ - arg_max(at_, {{'x': -low, 'at': at_}}) {_W15})"
_R14 = {x: q.roll(agg, x, 14) for x, agg in (("low", "min"), ("high", "max"))}


@query(f"""WITH {BARS}, a AS (SELECT *, (high + low + close) / 3 AS tp, row_number() OVER ({q.PART}) AS at_ FROM bars), b AS (SELECT *, {q.lag("tp")} AS tp0, {q.roll("avg", "tp", 14)} AS m, list(tp) {q.over(14)} AS seen FROM a),
c AS (SELECT *, CASE WHEN tp > tp0 THEN tp * volume ELSE 0 END AS up, CASE WHEN tp < tp0 THEN tp * volume ELSE 0 END AS dn, list_sum(list_transform(seen, lambda x: abs(x - m))) / 14 AS spread FROM b)
SELECT stock_id, date, {floats({
    "aroon_up_14": f"CASE WHEN count(close) {_W15} = 15 THEN 100 * (14 - {_UP15}) / 14.0::DOUBLE END", "aroon_dn_14": f"CASE WHEN count(close) {_W15} = 15 THEN 100 * (14 - {_DN15}) / 14.0::DOUBLE END",
    "aroonosc_14": f"CASE WHEN count(close) {_W15} = 15 THEN 100 * ({_DN15} - {_UP15}) / 14.0::DOUBLE END", "cci_14": "CASE WHEN len(seen) = 14 THEN (tp - m) / nullif(0.015::DOUBLE * spread, 0) END",
    "mfi_14": f"CASE WHEN count(tp0) {q.over(14)} = 14 THEN 100 * (sum(up) {q.over(14)} / nullif(sum(up) {q.over(14)} + sum(dn) {q.over(14)}, 0)) END",
    "mom_10": f"CASE WHEN close >= 1 THEN {between(f'(100 * (close - {q.lag('close', 10)}) / close)', -500, 500)} END", "roc_10": f"100 * (close / nullif({q.lag('close', 10)}, 0) - 1)", "rocp_10": f"close / nullif({q.lag('close', 10)}, 0) - 1",
    "willr_14": f"-100 * (({_R14['high']} - close) / nullif({_R14['high']} - {_R14['low']}, 0))",
})} FROM c""")
def talib_momentum(spark, sf_dir):
    return price.oscillators(bars(spark, sf_dir))


USUAL = f"avg(high - low) OVER ({q.PART} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"


@query(f"""WITH {BARS}, a AS (SELECT *, abs(close - open) AS body, {q.lag("abs(close - open)")} AS pbody, {q.lag("open")} AS po, {q.lag("close")} AS pc, high - greatest(open, close) AS up, least(open, close) - low AS dn, {USUAL} AS usual, {q.lag("high")} AS ph, {q.lag("low")} AS pl FROM bars)
SELECT stock_id, date, CASE WHEN body <= 0.1::DOUBLE * usual THEN 100 ELSE 0 END AS cdldoji,
 CASE WHEN close > open AND pc < po AND close > po AND open < pc THEN 100 WHEN close < open AND pc > po AND close < pc AND open > po AND close < po THEN -100 ELSE 0 END AS cdlengulfing,
 CASE WHEN pc < po AND greatest(open, close) < po AND least(open, close) > pc THEN 100 WHEN pc > po AND greatest(open, close) < pc AND least(open, close) > po THEN -100 ELSE 0 END AS cdlharami,
 CASE WHEN dn > 2 * body AND up < 0.1::DOUBLE * usual AND NOT body <= 0.1::DOUBLE * usual THEN 100 ELSE 0 END AS cdlhammer,
 CASE WHEN up > 2 * body AND dn < 0.1::DOUBLE * usual AND NOT body <= 0.1::DOUBLE * usual THEN -100 ELSE 0 END AS cdlshootingstar,
 CASE WHEN pc > po AND pbody > 0.5::DOUBLE * usual AND open > ph AND close < (po + pc) / 2 AND close > po THEN -100 ELSE 0 END AS cdldarkcloudcover,
 CASE WHEN pc < po AND pbody > 0.5::DOUBLE * usual AND open < pl AND close > (po + pc) / 2 AND close < po THEN 100 ELSE 0 END AS cdlpiercing,
 CASE WHEN body > 0.5::DOUBLE * usual AND close > open AND up < 0.05::DOUBLE * usual AND dn < 0.05::DOUBLE * usual THEN 100 WHEN body > 0.5::DOUBLE * usual AND close < open AND up < 0.05::DOUBLE * usual AND dn < 0.05::DOUBLE * usual THEN -100 ELSE 0 END AS cdlmarubozu FROM a""")
def candles_core(spark, sf_dir):
    return price.candles(bars(spark, sf_dir))


@query(f"""WITH {BARS}, {FLOWS}, a AS (SELECT stock_id, date, volume, foreign_net, trust_net, margin_balance, short_balance, coalesce(foreign_net, 0) + coalesce(trust_net, 0) AS inst FROM bars LEFT JOIN flows USING (stock_id, date)),
b AS (SELECT *, {q.roll("sum", "inst", 10)} AS i10, {q.roll("avg", "volume", 10)} AS v10, {q.roll("avg", "volume", 60)} AS v60 FROM a)
SELECT stock_id, date, (CASE WHEN abs(foreign_net / volume * 100) <= 100 THEN foreign_net / volume * 100 END)::FLOAT AS foreign_net_ratio, (CASE WHEN abs(i10 / v10 * 100) <= 1000 THEN i10 / v10 * 100 END)::FLOAT AS institutional_10d,
 {q.roll("avg", "(inst > 0)::INT", 10)}::FLOAT AS absorb_buy_ratio_10d, (margin_balance / v60)::FLOAT AS margin_ratio, (CASE WHEN short_balance >= 10 AND margin_balance / short_balance <= 1000 THEN margin_balance / short_balance END)::FLOAT AS margin_short_ratio FROM b""")
def chip_ratios(spark, sf_dir):
    df = bars(spark, sf_dir).select("stock_id", "date", "volume").join(flows(spark, sf_dir), ["stock_id", "date"], "left")
    df = df.withColumn("inst", F.coalesce("foreign_net", F.lit(0.0)) + F.coalesce("trust_net", F.lit(0.0)))
    return df.select(
        "stock_id", "date", gate(ratio(F.col("foreign_net"), F.col("volume")) * 100, -100, 100).cast("float").alias("foreign_net_ratio"),
        gate(ratio(w.roll(F.sum, F.col("inst"), 10), w.mean(F.col("volume"), 10)) * 100, -1000, 1000).cast("float").alias("institutional_10d"),
        w.mean((F.col("inst") > 0).cast("int"), 10).cast("float").alias("absorb_buy_ratio_10d"), ratio(F.col("margin_balance"), w.mean(F.col("volume"), 60)).cast("float").alias("margin_ratio"),
        F.when(F.col("short_balance") >= 10, gate(ratio(F.col("margin_balance"), F.col("short_balance")), 0, 1000)).cast("float").alias("margin_short_ratio"),
    )


@query(f"""WITH {REVENUE}, a AS (SELECT *, lag(revenue, 12) OVER (PARTITION BY stock_id ORDER BY announce_date) AS y, lag(revenue) OVER (PARTITION BY stock_id ORDER BY announce_date) AS m FROM rev),
b AS (SELECT *, CASE WHEN abs(y) >= 1000 AND abs(revenue / y - 1) <= 1000 THEN revenue / y - 1 END AS yoy, CASE WHEN abs(m) >= 1000 AND abs(revenue / m - 1) <= 1000 THEN revenue / m - 1 END AS mom FROM a)
SELECT stock_id, announce_date, revenue_month, revenue_year, yoy::FLOAT AS revenue_yoy, mom::FLOAT AS revenue_mom, (yoy - lag(yoy) OVER (PARTITION BY stock_id ORDER BY announce_date))::FLOAT AS revenue_accel FROM b""")
def revenue_yoy_mom(spark, sf_dir):
    """Changes over 12 rows and 1 row: a missing month shifts the comparison, as rows count and not months."""
    line = w.line(time="announce_date")
    base = lambda k: F.lag("revenue", k).over(line)
    moved = lambda k: F.when(F.abs(base(k)) >= 1000, gate(ratio(F.col("revenue"), base(k)) - 1, -1000, 1000))
    df = revenue(spark, sf_dir).select("stock_id", "announce_date", "revenue_month", "revenue_year", moved(12).alias("yoy"), moved(1).alias("mom"))
    return df.select("stock_id", "announce_date", "revenue_month", "revenue_year", F.col("yoy").cast("float").alias("revenue_yoy"), F.col("mom").cast("float").alias("revenue_mom"), (F.col("yoy") - F.lag("yoy").over(line)).cast("float").alias("revenue_accel"))


MKT = "OVER (ORDER BY date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


@query(f"""WITH {BARS}, {INDEX}, m AS (SELECT date, (close / avg(close) {MKT.format(4)} - 1)::FLOAT AS mkt_close_ma5, (close / avg(close) {MKT.format(19)} - 1)::FLOAT AS mkt_close_ma20, (close / lag(close, 5) OVER (ORDER BY date) - 1)::FLOAT AS mkt_return_5d, count(*) {MKT.format(19)} AS n FROM idx)
SELECT stock_id, bars.date, CASE WHEN n >= 3 THEN mkt_close_ma5 END AS mkt_close_ma5, CASE WHEN n >= 10 THEN mkt_close_ma20 END AS mkt_close_ma20, mkt_return_5d FROM bars LEFT JOIN m USING (date)""")
def market_broadcast(spark, sf_dir):
    """Index features, one row per date, joined onto every entity by date."""
    from pyspark.sql import Window

    prices = bars(spark, sf_dir).select("stock_id", "date", "close")
    line = Window.orderBy("date")
    frame = lambda n: line.rowsBetween(-(n - 1), 0)
    over_mean = lambda n, least: F.when(F.count("close").over(frame(n)) >= least, ratio(F.col("close"), F.avg("close").over(frame(n))) - 1)
    market = index_bars(prices).select("date", over_mean(5, 3).cast("float").alias("mkt_close_ma5"), over_mean(20, 10).cast("float").alias("mkt_close_ma20"), (F.try_divide("close", F.lag("close", 5).over(line)) - 1).cast("float").alias("mkt_return_5d"))
    return prices.select("stock_id", "date").join(market, "date", "left")


@query(f"""WITH {BARS}, a AS (SELECT *, close / {q.lag("close")} - 1 AS r FROM bars) SELECT stock_id, date, {", ".join(f"(CASE WHEN {q.roll('median', 'amount', n, max(5, n // 3))} IS NOT NULL THEN least(greatest(amount / {q.roll('median', 'amount', n, max(5, n // 3))}, 0), 20) END)::FLOAT AS rel_amt_{n}" for n in (10, 20, 60))},
 (CASE WHEN {q.lag("close", 20)} IS NOT NULL THEN least(greatest((close / {q.lag("close", 20)} - 1) / ({q.roll("stddev_samp", "r", 60, 20)} * sqrt(20)), -10), 10) END)::FLOAT AS rel_ramom_20_60 FROM a""")
def relative_self(spark, sf_dir):
    c = F.col("close")
    df = bars(spark, sf_dir).select("stock_id", "date", "amount", w.change(c).alias("r"), w.change(c, 20).alias("moved"))
    df = rolled(df, {**{f"median{n}": ("median", "amount", n, max(5, n // 3)) for n in (10, 20, 60)}, "sd": ("sd", "r", 60, 20)}, ("amount", "moved"))
    amounts = [clip(ratio(F.col("amount"), F.col(f"median{n}")), 0.0, 20.0).cast("float").alias(f"rel_amt_{n}") for n in (10, 20, 60)]
    moved = clip(ratio(F.col("moved"), F.col("sd") * F.sqrt(F.lit(20))), -10.0, 10.0)
    return df.select("stock_id", "date", *amounts, moved.cast("float").alias("rel_ramom_20_60"))


@query(f"""WITH {BARS}, a AS (SELECT stock_id, date, coalesce(abs(close / {q.lag("close")} - 1) >= 0.095::DOUBLE, false)::INT AS hit FROM bars) SELECT stock_id, date, {q.roll("avg", "hit", 20, 5)}::FLOAT AS limit_hit_rate FROM a""")
def limit_hit_rate(spark, sf_dir):
    df = bars(spark, sf_dir).withColumn("hit", flag(F.abs(w.change(F.col("close"))) >= 0.095))
    return df.select("stock_id", "date", w.mean(F.col("hit"), 20, 5).cast("float").alias("limit_hit_rate"))


@query(f"""WITH {BARS}, l AS (SELECT stock_id, date, amount, list(amount) {q.over(240)} AS seen FROM bars)
SELECT stock_id, date, CASE WHEN len(seen) >= 80 THEN ((list_sum(list_transform(seen, lambda v: (v < amount)::INT)) + (list_sum(list_transform(seen, lambda v: (v = amount)::INT)) + 1) / 2.0::DOUBLE) / len(seen)) END::FLOAT AS per_rank FROM l""")
def valuation_rank(spark, sf_dir):
    return rolled(bars(spark, sf_dir), {"rank": ("rank", "amount", 240, 80)}).select("stock_id", "date", F.col("rank").cast("float").alias("per_rank"))


@query(f"""WITH {BARS}, {INDEX}, {FLOWS}, {REVENUE}, p AS (SELECT stock_id, date, (close / {q.roll("avg", "close", 20)})::FLOAT AS close_ma20_ratio FROM bars), m AS (SELECT date, (close / lag(close, 5) OVER (ORDER BY date) - 1)::FLOAT AS mkt_return_5d FROM idx)
SELECT p.stock_id, p.date, close_ma20_ratio, f.foreign_net, f.margin_balance, m.mkt_return_5d, r.revenue FROM p LEFT JOIN flows f USING (stock_id, date) LEFT JOIN m ON m.date = p.date ASOF LEFT JOIN rev r ON p.stock_id = r.stock_id AND p.date >= r.announce_date""")
def feature_merge(spark, sf_dir):
    """Families joined onto the bars by entity and date, the index by date, revenue as of its announcement."""
    from pyspark.sql import Window

    prices = bars(spark, sf_dir)
    base = prices.select("stock_id", "date", ratio(F.col("close"), w.mean(F.col("close"), 20)).cast("float").alias("close_ma20_ratio"))
    market = index_bars(prices).select("date", (F.try_divide("close", F.lag("close", 5).over(Window.orderBy("date"))) - 1).cast("float").alias("mkt_return_5d"))
    joined = base.join(flows(spark, sf_dir).select("stock_id", "date", "foreign_net", "margin_balance"), ["stock_id", "date"], "left").join(market, "date", "left")
    return asof_backward(joined.select("stock_id", "date", "close_ma20_ratio", "foreign_net", "margin_balance", "mkt_return_5d"), revenue(spark, sf_dir), "announce_date", ["revenue"])


_WHOLE = f"count(close) OVER ({q.PART} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) = 11"
_TURN = {side: f"CASE WHEN {_WHOLE} AND close = {agg}(close) OVER ({q.PART} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AND close {sign} {q.lag('close')} THEN {{'at': at_, 'c': close}} END AS {side}_0" for side, agg, sign in (("high", "max", ">"), ("low", "min", "<"))}
_BEFORE = f"OVER ({q.PART} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _pivot_out(side: str, k: int) -> str:
    p = f"(last_value(CASE WHEN {side}_0 IS NOT NULL THEN {{'p': {side}_0, 'q': {side}_1, 'r': {side}_2}} END IGNORE NULLS) OVER ({q.PART} ROWS BETWEEN UNBOUNDED PRECEDING AND 5 PRECEDING)).{'pqr'[k - 1]}"
    return f"(close / ({p}).c - 1)::FLOAT AS {side}{k}_dist, ln(1 + (at_ - ({p}).at)::DOUBLE)::FLOAT AS {side}{k}_days"


@query(f"""WITH {BARS}, n AS (SELECT stock_id, date, close, row_number() OVER ({q.PART}) AS at_ FROM bars), a AS (SELECT *, {_TURN["high"]}, {_TURN["low"]} FROM n),
b AS (SELECT *, {", ".join(f"last_value({x}_0 IGNORE NULLS) {_BEFORE} AS {x}_1" for x in ("high", "low"))} FROM a), c AS (SELECT *, {", ".join(f"last_value(CASE WHEN {x}_0 IS NOT NULL THEN {x}_1 END IGNORE NULLS) {_BEFORE} AS {x}_2" for x in ("high", "low"))} FROM b)
SELECT stock_id, date, {", ".join(_pivot_out(side, k) for side in ("high", "low") for k in (1, 2, 3))} FROM c""")
def swing_pivots(spark, sf_dir):
    return pivots.swing_levels(bars(spark, sf_dir))


@query()
def trendline_envelope(spark, sf_dir):
    return pivots.trend_lines(bars(spark, sf_dir))


_U = {k: f"{q.roll('sum', 'bp', k)} / nullif({q.roll('sum', 'span', k)}, 0)" for k in (7, 14, 28)}


@query(f"""WITH RECURSIVE {BARS}, b AS (SELECT *, {q.lag("close")} AS c0, high - {q.lag("high")} AS up, {q.lag("low")} - low AS dn FROM bars),
a AS (SELECT *, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS plus, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS minus, CASE WHEN c0 IS NOT NULL THEN greatest(high - low, abs(high - c0), abs(low - c0)) END AS tr,
 CASE WHEN c0 IS NOT NULL THEN close - least(low, c0) END AS bp, CASE WHEN c0 IS NOT NULL THEN greatest(high, c0) - least(low, c0) END AS span FROM b), {NUMBERED.format("a")}, {smoothed_by_wilder("e", "n", ["plus", "minus", "tr"], 14, 2)},
x AS (SELECT stock_id, i, 100 * plus / nullif(tr, 0) AS pdi, 100 * minus / nullif(tr, 0) AS mdi, coalesce(100 * abs(100 * plus / nullif(tr, 0) - 100 * minus / nullif(tr, 0)) / nullif(100 * plus / nullif(tr, 0) + 100 * minus / nullif(tr, 0), 0), 0) AS dx FROM e), {smoothed_by_wilder("d", "x", ["dx"], 14, 15)},
z AS (SELECT n.*, x.pdi, x.mdi, x.dx, d.dx AS adx FROM n LEFT JOIN x USING (stock_id, i) LEFT JOIN d USING (stock_id, i)), y AS (SELECT *, (adx + {q.lag("adx", 13)}) / 2 AS adxr, 100 * (4 * ({_U[7]}) + 2 * ({_U[14]}) + ({_U[28]})) / 7 AS ult FROM z)
SELECT stock_id, date, {floats({"adx_14": between("adx", 0, 100), "adxr_14": between("adxr", 0, 100), "dx_14": between("dx", 0, 100), "plus_di": between("pdi", 0, 100), "minus_di": between("mdi", 0, 100), "ultosc": between("ult", 0, 100)})} FROM y""")
def talib_trend(spark, sf_dir):
    return price.trend_strength(bars(spark, sf_dir))


@query()
def trendline_family(spark, sf_dir):
    return lines.trend_line_family(bars(spark, sf_dir))


@query()
def trendline_carried(spark, sf_dir):
    """Days since the last break, continued from the value stored at 2000-01-01 or the last bar before."""
    found = lines.trend_line_family(bars(spark, sf_dir))
    stored = found.where("date <= timestamp_ntz '2000-01-01'").groupBy("stock_id").agg(F.max("date").alias("anchor_date"), F.max_by("tl_days_since_break", "date").alias("anchor_days"))
    return lines.carried_days(found.select("stock_id", "date", "tl_resist_break", "tl_days_since_break"), stored)


@query()
def lines_ahead(spark, sf_dir):
    """The prices of both boundaries on the business days of the two weeks after each entity's last bar."""
    from .registry import QUERIES

    prices = bars(spark, sf_dir)
    return lines.lines_ahead(lines.trend_line_family(prices), prices, QUERIES["future_days"](spark, sf_dir))


@query()
def swing_family(spark, sf_dir):
    return lines.swing_family(bars(spark, sf_dir))
