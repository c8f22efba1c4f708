"""Price, volume and momentum features of one entity's bars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, gate, ratio
from ..operators import windows as w
from ..operators.recursive import ewm, per_entity, wilder



def moving_averages(df: DataFrame, spans=(5, 10, 20, 60, 120, 240)) -> DataFrame:
    df = df.select("stock_id", "date", "close", *[w.mean(F.col("close"), n).alias(f"ma{n}") for n in spans])
    df = df.withColumn("ma20_before", w.lag(F.col("ma20"), 5))
    columns = [ratio(F.col("close"), F.col(f"ma{n}")).cast("float").alias(f"close_ma{n}_ratio") for n in spans]
    columns += [flag(F.col("close") > F.col(f"ma{n}")).alias(f"above_ma{n}") for n in spans]
    columns += [ratio(F.col("ma5"), F.col("ma20")).cast("float").alias("ma5_ma20_ratio"), ratio(F.col("ma10"), F.col("ma60")).cast("float").alias("ma10_ma60_ratio")]
    columns += [ratio(F.col("ma20") - F.col("ma20_before"), 5 * F.col("close")).cast("float").alias("ma20_slope")]
    rows = [F.col(f"ma{n}") for n in (5, 10, 20)]
    columns += [gate(ratio(F.greatest(*rows), F.least(*rows)) - 1, -1e9, 10).cast("float").alias("ma_squeeze")]
    return df.select("stock_id", "date", *columns)


def bull_streaks(df: DataFrame) -> DataFrame:
    """Streak of MA5 > MA10 > MA20 and its reverse."""
    df = df.select("stock_id", "date", "close", *[w.mean(F.col("close"), n).alias(f"ma{n}") for n in (5, 10, 20)])
    df = w.with_streak(df, (F.col("ma5") > F.col("ma10")) & (F.col("ma10") > F.col("ma20")), "bull")
    df = w.with_streak(df, (F.col("ma5") < F.col("ma10")) & (F.col("ma10") < F.col("ma20")), "bear")
    return df.select("stock_id", "date", *w.streak_columns("bull", "bull_3ma"), *w.streak_columns("bear", "bear_3ma"))


def bollinger(df: DataFrame) -> DataFrame:
    df = df.select("stock_id", "date", "close", w.mean(F.col("close"), 20).alias("m"), w.roll(F.stddev_samp, F.col("close"), 20).alias("s"))
    upper, lower = F.col("m") + 2 * F.col("s"), F.col("m") - 2 * F.col("s")
    df = df.select("stock_id", "date", ratio(F.col("close") - lower, upper - lower).alias("b"), ratio(upper - lower, F.col("m")).alias("width"), flag(F.col("close") > upper).alias("upper_break"), flag(F.col("close") < lower).alias("lower_break"))
    return df.select("stock_id", "date", F.col("b").cast("float").alias("bb_pct_b"), (F.col("b") - w.lag(F.col("b"), 5)).cast("float").alias("bb_pct_b_change"), F.col("width").cast("float").alias("bb_width_pct"), "upper_break", "lower_break")


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    def compute(a):
        dif = ewm(a["close"], 2 / (fast + 1)) - ewm(a["close"], 2 / (slow + 1))
        sig = ewm(dif, 2 / (signal + 1))
        return {"dif": dif, "sig": sig}

    rows = per_entity(df, ["close"], "dif double, sig double", compute, keep=("close",))
    dif, sig = F.col("dif"), F.col("sig")
    golden = flag((dif > sig) & (w.lag(dif) <= w.lag(sig)))
    return rows.select(
        "stock_id", "date", ratio(dif, F.col("close")).cast("float").alias("dif_ratio"), ratio(sig, F.col("close")).cast("float").alias("macd_ratio"),
        gate(ratio(dif - sig, F.col("close")), -1, 1).cast("float").alias("hist_ratio"), flag(dif > 0).alias("dif_positive"), golden.alias("macd_golden"),
    )


def stochastic(df: DataFrame) -> DataFrame:
    """K and D: thirds-smoothed position of the close in the range of 9 bars."""
    low, high = w.roll(F.min, F.col("low"), 9), w.roll(F.max, F.col("high"), 9)
    df = df.select("stock_id", "date", (ratio(F.col("close") - low, high - low) * 100).alias("rsv"))

    def compute(a):
        k = ewm(a["rsv"], 1 / 3)
        return {"k": k, "d": ewm(k, 1 / 3)}

    rows = per_entity(df, ["rsv"], "k double, d double", compute)
    k, d = F.col("k"), F.col("d")
    return rows.select(
        "stock_id", "date", k.cast("float").alias("k_value"), d.cast("float").alias("d_value"), (k - d).cast("float").alias("kd_diff"),
        flag((k > d) & (w.lag(k) <= w.lag(d))).alias("kd_golden"), flag(k > 80).alias("k_overbought"), flag(k < 20).alias("k_oversold"),
    )


def simple_rsi(df: DataFrame, spans=(7, 14, 21)) -> DataFrame:
    """RSI with plain means of gains and losses; null where nothing was lost."""
    step = F.col("close") - w.lag(F.col("close"))
    df = df.select("stock_id", "date", F.greatest(step, F.lit(0.0)).alias("g0"), step.alias("step"))
    df = df.select("stock_id", "date", F.when(F.col("step").isNotNull(), F.greatest("step", F.lit(0.0))).alias("gain"), F.when(F.col("step").isNotNull(), F.greatest(-F.col("step"), F.lit(0.0))).alias("loss"))
    rsi = lambda n: F.when(w.mean(F.col("loss"), n) > 1e-9, 100 - 100 / (1 + w.mean(F.col("gain"), n) / w.mean(F.col("loss"), n)))
    return df.select("stock_id", "date", *[rsi(n).cast("float").alias(f"rsi_{n}") for n in spans])


def wilder_rsi(df: DataFrame, n: int = 14) -> DataFrame:
    """RSI with Wilder's smoothing, seeded by the mean of the first n changes."""

    def compute(a):
        step = np.diff(a["close"])
        up, down = wilder(np.maximum(step, 0.0), n), wilder(np.maximum(-step, 0.0), n)
        with np.errstate(invalid="ignore", divide="ignore"):
            rsi = np.where(up + down == 0, 0.0, 100 * (up / (up + down)))
        return {"rsi": np.concatenate(([np.nan], np.where(np.isnan(up), np.nan, rsi)))}

    return per_entity(df, ["close"], "rsi double", compute).select("stock_id", "date", F.when(~F.isnan("rsi"), F.col("rsi")).cast("float").alias(f"rsi_w{n}"))


def momentum(df: DataFrame) -> DataFrame:
    df = df.select("stock_id", "date", *[gate(w.change(F.col("close"), n), -1, 1).alias(f"r{n}") for n in (1, 5, 20, 60)], *[(ratio(F.col("close"), w.roll(F.max, F.col("close"), n)) - 1).alias(f"dh{n}") for n in (60, 240)], *[(ratio(F.col("close"), w.roll(F.min, F.col("close"), n)) - 1).alias(f"dl{n}") for n in (60, 240)])
    return df.select(
        "stock_id", "date", *[F.col(f"r{n}").cast("float").alias(f"return_{n}d") for n in (1, 5, 20, 60)],
        *[F.col(f"dh{n}").cast("float").alias(f"dist_high_{n}") for n in (60, 240)], *[F.col(f"dl{n}").cast("float").alias(f"dist_low_{n}") for n in (60, 240)],
        flag(F.col("dh60") >= 0).alias("is_new_high_60"), flag((F.col("r5") > 0) & (F.col("r20") > 0) & (F.col("r60") > 0)).alias("momentum_align"),
    )


def true_range(df: DataFrame) -> DataFrame:
    before = w.lag(F.col("close"))
    return df.withColumn("tr", F.when(before.isNull(), F.col("high") - F.col("low")).otherwise(F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))))


def average_true_range(df: DataFrame, n: int = 14) -> DataFrame:
    rows = true_range(df).select("stock_id", "date", "close", "tr")
    rows = per_entity(rows, ["tr"], "atr double", lambda a: {"atr": ewm(a["tr"], 1 / n, n)}, keep=("close",))
    return rows.select("stock_id", "date", gate(ratio(F.col("atr"), F.col("close")), -1e9, 1).cast("float").alias("atr_ratio"))


def volume_flow(df: DataFrame) -> DataFrame:
    before = w.lag(F.col("close"))
    sign = F.coalesce(F.signum(F.col("close") - before), F.lit(0.0))
    span = F.col("high") - F.col("low")
    df = df.select("stock_id", "date", "close", "volume", (sign * F.col("volume")).alias("signed"), F.coalesce(ratio((F.col("close") - F.col("low")) - (F.col("high") - F.col("close")), span) * F.col("volume"), F.lit(0.0)).alias("mfv"))
    df = df.withColumn("obv", F.sum("signed").over(w.running()))
    return df.select(
        "stock_id", "date", F.col("obv"), gate(ratio(F.col("volume"), w.mean(F.col("volume"), 5)), 0, 100).cast("float").alias("vol_ratio"), ratio(w.mean(F.col("volume"), 20), w.mean(F.col("volume"), 60)).cast("float").alias("avg_vol_ratio"),
        ratio(w.roll(F.sum, F.col("mfv"), 20, 10), w.roll(F.sum, F.col("volume"), 20, 10)).cast("float").alias("cmf"),
    )


def oscillators(df: DataFrame) -> DataFrame:
    """Aroon, CCI, MFI, momentum, rate of change and Williams %R."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    at = F.row_number().over(w.line())
    df = df.withColumn("tp", typical).withColumn("at", at)
    df = df.withColumn("mf", F.col("tp") * F.col("volume")).withColumn("tp_before", w.lag(F.col("tp")))
    df = df.withColumn("mf_up", F.when(F.col("tp") > F.col("tp_before"), F.col("mf")).otherwise(0.0)).withColumn("mf_down", F.when(F.col("tp") < F.col("tp_before"), F.col("mf")).otherwise(0.0))
    since = lambda key: F.col("at") - F.max_by("at", key).over(w.trailing(15))
    whole = F.count("close").over(w.trailing(15)) == 15
    seen = F.collect_list("tp").over(w.trailing(14))
    middle = w.mean(F.col("tp"), 14)
    spread = F.aggregate(seen, F.lit(0.0), lambda s, x: s + F.abs(x - middle)) / 14
    low, high = w.roll(F.min, F.col("low"), 14), w.roll(F.max, F.col("high"), 14)
    up, down = F.sum("mf_up").over(w.trailing(14)), F.sum("mf_down").over(w.trailing(14))
    return df.select(
        "stock_id", "date",
        F.when(whole, 100 * (14 - since(F.struct("high", "at"))) / 14.0).cast("float").alias("aroon_up_14"),
        F.when(whole, 100 * (14 - since(F.struct(-F.col("low"), F.col("at")))) / 14.0).cast("float").alias("aroon_dn_14"),
        F.when(whole, 100 * (since(F.struct(-F.col("low"), F.col("at"))) - since(F.struct("high", "at"))) / 14.0).cast("float").alias("aroonosc_14"),
        F.when(F.size(seen) == 14, ratio(F.col("tp") - middle, 0.015 * spread)).cast("float").alias("cci_14"),
        F.when(F.count("tp_before").over(w.trailing(14)) == 14, 100 * ratio(up, up + down)).cast("float").alias("mfi_14"),
        F.when(F.col("close") >= 1, gate(100 * (F.col("close") - w.lag(F.col("close"), 10)) / F.col("close"), -500, 500)).cast("float").alias("mom_10"), (100 * w.change(F.col("close"), 10)).cast("float").alias("roc_10"), w.change(F.col("close"), 10).cast("float").alias("rocp_10"),
        (-100 * ratio(high - F.col("close"), high - low)).cast("float").alias("willr_14"),
    )


def candles(df: DataFrame) -> DataFrame:
    """Candle patterns on bodies and shadows: 100 bullish, -100 bearish, 0 none."""
    o = F.col("open")
    body, before_body = F.abs(F.col("close") - o), w.lag(F.abs(F.col("close") - o))
    po, pc = w.lag(o), w.lag(F.col("close"))
    upper, lower = F.col("high") - F.greatest(o, F.col("close")), F.least(o, F.col("close")) - F.col("low")
    usual = F.avg(F.col("high") - F.col("low")).over(w.line().rowsBetween(-10, -1))
    doji = body <= 0.1 * usual
    signal = lambda bull, bear: F.when(bull, 100).when(bear, -100).otherwise(0)
    long_body = body > 0.5 * usual
    return df.select(
        "stock_id", "date", F.when(doji, 100).otherwise(0).alias("cdldoji"),
        signal((F.col("close") > o) & (pc < po) & (F.col("close") > po) & (o < pc), (F.col("close") < o) & (pc > po) & (F.col("close") < pc) & (o > po) & (F.col("close") < po)).alias("cdlengulfing"),
        signal((pc < po) & (F.greatest(o, F.col("close")) < po) & (F.least(o, F.col("close")) > pc), (pc > po) & (F.greatest(o, F.col("close")) < pc) & (F.least(o, F.col("close")) > po)).alias("cdlharami"),
        F.when((lower > 2 * body) & (upper < 0.1 * usual) & ~doji, 100).otherwise(0).alias("cdlhammer"),
        F.when((upper > 2 * body) & (lower < 0.1 * usual) & ~doji, -100).otherwise(0).alias("cdlshootingstar"),
        F.when((pc > po) & (before_body > 0.5 * usual) & (o > w.lag(F.col("high"))) & (F.col("close") < (po + pc) / 2) & (F.col("close") > po), -100).otherwise(0).alias("cdldarkcloudcover"),
        F.when((pc < po) & (before_body > 0.5 * usual) & (o < w.lag(F.col("low"))) & (F.col("close") > (po + pc) / 2) & (F.col("close") < po), 100).otherwise(0).alias("cdlpiercing"),
        signal(long_body & (F.col("close") > o) & (upper < 0.05 * usual) & (lower < 0.05 * usual), long_body & (F.col("close") < o) & (upper < 0.05 * usual) & (lower < 0.05 * usual)).alias("cdlmarubozu"),
    )


def trend_strength(df: DataFrame, n: int = 14) -> DataFrame:
    """Directional index with its lines, its mean (ADX) and that mean's mean with the one n - 1 bars before, and the Ultimate Oscillator."""
    high, low, close, before = F.col("high"), F.col("low"), F.col("close"), w.lag(F.col("close"))
    up, down, floor_ = high - w.lag(high), w.lag(low) - low, F.least(low, before)
    known = before.isNotNull()
    df = df.select(
        "stock_id", "date", F.when(known, F.when((up > down) & (up > 0), up).otherwise(0.0)).alias("plus"), F.when(known, F.when((down > up) & (down > 0), down).otherwise(0.0)).alias("minus"),
        F.when(known, F.greatest(high - low, F.abs(high - before), F.abs(low - before))).alias("tr"), F.when(known, close - floor_).alias("bp"), F.when(known, F.greatest(high, before) - floor_).alias("span"),
    )
    part = lambda k: ratio(w.roll(F.sum, F.col("bp"), k), w.roll(F.sum, F.col("span"), k))
    df = df.withColumn("ultosc", 100 * (4 * part(7) + 2 * part(14) + part(28)) / 7)

    def compute(a):
        pad = lambda x: np.concatenate(([np.nan], x))[: len(a["tr"])]
        tr = wilder(a["tr"][1:], n)
        with np.errstate(invalid="ignore", divide="ignore"):
            plus_di, minus_di = 100 * wilder(a["plus"][1:], n) / tr, 100 * wilder(a["minus"][1:], n) / tr
            dx = 100 * np.abs(plus_di - minus_di) / (plus_di + minus_di)
        dx[n - 1 :] = np.nan_to_num(dx[n - 1 :])
        adx = np.full(len(dx), np.nan)
        if len(dx) >= 2 * n - 1:
            adx[n - 1 :] = wilder(dx[n - 1 :], n)
        adxr = np.full(len(dx), np.nan)
        adxr[n - 1 :] = (adx[n - 1 :] + adx[: len(adx) - n + 1]) / 2
        return {"adx_14": pad(adx), "adxr_14": pad(adxr), "dx_14": pad(dx), "plus_di": pad(plus_di), "minus_di": pad(minus_di)}

    names = ["adx_14", "adxr_14", "dx_14", "plus_di", "minus_di"]
    found = per_entity(df, ["plus", "minus", "tr"], ", ".join(f"{c} double" for c in names), compute, keep=("ultosc",))
    return found.select("stock_id", "date", *[gate(F.col(c), 0, 100).cast("float").alias(c) for c in [*names, "ultosc"]])
