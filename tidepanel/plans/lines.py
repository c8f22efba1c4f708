"""Trend lines through confirmed pivots. A line holds for a stretch of bars, until a pivot is confirmed or leaves the lookback;
it is fitted once for its stretch, and everything that depends on it is arithmetic on arrays."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows as w
from ..operators.recursive import per_entity


def extremes(x: np.ndarray, span: int, sign: int, strict: bool) -> np.ndarray:
    """Bars that are the largest (sign 1) or least (-1) of span bars to either side; strict ones also differ from the bar before."""
    if len(x) < 2 * span + 1:
        return np.zeros(0, int)
    y = sign * x
    top = np.lib.stride_tricks.sliding_window_view(y, 2 * span + 1).max(axis=1)
    at = np.arange(span, len(x) - span)
    return at[(y[at] == top) & ((y[at] > y[at - 1]) | (not strict))]


class Lines(NamedTuple):
    """Least-squares lines over as many pivots each (a row of pivots and of rests for a line), and the stretches of bars [start, stop) for which these are the pivots."""

    start: np.ndarray
    stop: np.ndarray
    pivots: np.ndarray
    slope: np.ndarray
    intercept: np.ndarray
    r2: np.ndarray
    rest: np.ndarray


def lines(pivots: np.ndarray, prices: np.ndarray, first: int, lookback: int, lag: int, least: int) -> Iterator[Lines]:
    """All lines, those of one number of pivots at once: so sums add as many terms for each as for one alone."""
    n = len(prices)
    changes = np.unique(np.clip(np.concatenate(([first, n], pivots + lag, pivots + lookback + 1)), min(first, n), n))
    start, stop = changes[:-1], changes[1:]
    low, high = np.searchsorted(pivots, start - lookback), np.searchsorted(pivots, start - lag, "right")
    for k in np.unique(high - low).tolist():
        if k < least:
            continue
        of = np.flatnonzero(high - low == k)
        held = pivots[low[of, None] + np.arange(k)]
        y, middle = prices[held], held.mean(axis=1)
        x, level = held - middle[:, None], y.mean(axis=1)
        off = y - level[:, None]
        slope, spread = (x * off).sum(axis=1) / (x * x).sum(axis=1), (off**2).sum(axis=1)
        intercept = level - slope * middle
        rest = y - (slope[:, None] * held + intercept[:, None])
        with np.errstate(invalid="ignore", divide="ignore"):
            r2 = np.where(spread != 0, 1 - (rest * rest).sum(axis=1) / spread, 0.0)
        yield Lines(start[of], stop[of], held, slope, intercept, r2, rest)


def spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bars of all stretches one after the other, the stretch of each, and where each stretch begins among them."""
    sizes = stop - start
    begin = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(start)), sizes)
    return np.arange(len(of)) + (start - begin)[of], of, begin


def bounded_distance(close: np.ndarray, line: np.ndarray) -> np.ndarray:
    """close over the line, less 1; nan where the line is below a tenth of the close, or 5 and more away."""
    with np.errstate(invalid="ignore", divide="ignore"):
        d = (close - line) / line
        return np.where((line >= close * 0.1) & (np.abs(d) <= 5), d, np.nan)


def last_known(x: np.ndarray) -> np.ndarray:
    """The last value that isn't nan before each place."""
    at = np.maximum.accumulate(np.where(np.isnan(x), -1, np.arange(len(x)))) if len(x) else np.zeros(0, int)
    before = np.concatenate(([-1], at[:-1]))[: len(x)]
    return np.where(before >= 0, x[before], np.nan)


def boundaries(a: dict[str, np.ndarray], lookback: int = 120, span: int = 5, least: int = 3, near: float = 0.01, recent: int = 20) -> dict[str, np.ndarray]:
    """Lines on the outer side of the pivots' least-squares lines, the channel between them, where they meet, and breaks.

    Touches are closes within `near` of the line in the lookback, other than its pivots. The side on which a
    close was last seen survives bars without a line. A false break is one of the last `recent` bars whose
    line is above the close again.
    """
    close, high, low, volume, usual = (a[c] for c in ("close", "high", "low", "volume", "usual"))
    n = len(close)
    out = {f"{side}_{k}": np.full(n, np.nan) for side in ("resist", "support") for k in ("dist", "slope", "r2", "touches", "pivots")}
    line, raw, base = ({side: np.full(n, np.nan) for side in ("resist", "support")} for _ in range(3))
    bars = np.arange(n)
    for side, prices, sign in (("resist", high, 1), ("support", low, -1)):
        for found in lines(extremes(prices, span, sign, False), prices, max(lookback // 4, 2 * span), lookback, span, least):
            intercept = found.intercept + sign * (sign * found.rest).max(axis=1)
            t, of, _ = spans(found.start, found.stop)
            line[side][t], raw[side][t], base[side][t] = found.slope[of] * t + intercept[of], found.slope[of], intercept[of]
            out[f"{side}_slope"][t], out[f"{side}_r2"][t], out[f"{side}_pivots"][t] = found.slope[of] / close[t], found.r2[of], found.pivots.shape[1]
            since = np.maximum(found.start - lookback, 0)
            j, seen, begin = spans(since, found.stop)
            value = found.slope[seen] * j + intercept[seen]
            with np.errstate(invalid="ignore", divide="ignore"):
                hit = (np.abs(close[j] - value) / np.abs(value) < near) & (value != 0)
            shift = begin - since  # of a bar to its place among those of its stretch
            hit[(found.pivots + shift[:, None])[found.pivots >= since[:, None]]] = False
            sums = np.concatenate(([0], np.cumsum(hit)))
            out[f"{side}_touches"][t] = sums[t + 1 + shift[of]] - sums[np.maximum(t - lookback, 0) + shift[of]]
        out[f"{side}_dist"] = bounded_distance(close, line[side])
    width = line["resist"] - line["support"]
    with np.errstate(invalid="ignore", divide="ignore"):
        open_ = width > np.maximum(close * 0.001, 1e-8)
        pos, share = (close - line["support"]) / width, width / close
        out["channel_pos"], out["channel_width"] = np.where(open_ & (np.abs(pos) <= 5), pos, np.nan), np.where(open_ & (share <= 5), share, np.nan)
        turn = raw["support"] - raw["resist"]
        apex = np.where(np.abs(turn) >= 1e-12, (base["resist"] - base["support"]) / turn - bars, np.nan)
    out["apex_bars"] = np.where(np.abs(apex) <= 500, apex, np.nan)
    triangle = (raw["support"] > 0) & (raw["resist"] < 0) & (out["apex_bars"] >= 5) & (out["apex_bars"] <= 60)
    before = np.concatenate((np.full(min(20, n), np.nan), usual[:-20]))[:n]
    out["is_triangle"], out["triangle_vol_dry"] = triangle.astype(float), (triangle & (bars >= 40) & (usual < before)).astype(float)
    above, below = np.where(np.isnan(line["resist"]), np.nan, close > line["resist"]), np.where(np.isnan(line["support"]), np.nan, close < line["support"])
    broke = (last_known(above) == 0) & (above == 1)
    out["resist_break"], out["support_break"] = broke.astype(float), ((last_known(below) == 0) & (below == 1)).astype(float)
    with np.errstate(invalid="ignore", divide="ignore"):
        out["break_vol"] = np.where(broke & (usual > 0), volume / usual, np.nan)
    last = np.maximum.accumulate(np.where(broke, bars, -1)) if n else np.zeros(0, int)
    out["days_since_break"] = np.where(last >= 0, np.log1p(bars - last), np.nan)
    out["false_breaks_20d"] = np.zeros(n)
    for i in np.flatnonzero(broke).tolist():
        after = bars[i + 1 : i + recent + 1]
        out["false_breaks_20d"][after] += close[after] < line["resist"][i]
    return out


FLOATS = [f"{side}_{k}" for side in ("resist", "support") for k in ("dist", "slope", "r2", "touches", "pivots")] + ["channel_pos", "channel_width", "apex_bars", "break_vol", "days_since_break"]
FLAGS = ["is_triangle", "triangle_vol_dry", "resist_break", "support_break", "false_breaks_20d"]


def trend_line_family(df: DataFrame) -> DataFrame:
    df = df.withColumn("usual", w.mean(F.col("volume"), 20, 5))
    found = per_entity(df, ["close", "high", "low", "volume", "usual"], ", ".join(f"{c} double" for c in FLOATS + FLAGS), boundaries)
    return found.select("stock_id", "date", *[F.col(c).cast("float").alias(f"tl_{c}") for c in FLOATS], *[F.col(c).cast("int").alias(f"tl_{c}") for c in FLAGS])


def carried_days(found: DataFrame, anchor: DataFrame) -> DataFrame:
    """tl_days_since_break continued from a stored value: anchor holds (stock_id, anchor_date, anchor_days), days as log1p of bars.

    Rows after the anchor and before their entity's next break count on from it; all others stay.
    """
    line = w.line()
    rows = found.join(anchor, "stock_id", "left").withColumn("_after", (F.col("date") > F.col("anchor_date")).cast("int"))
    rows = rows.withColumn("_n", F.sum("_after").over(w.running())).withColumn("_broke", F.max(F.when((F.col("_after") == 1) & (F.col("tl_resist_break") == 1), 1)).over(line.rowsBetween(w.Window.unboundedPreceding, 0)))
    go_on = (F.col("_after") == 1) & F.col("_broke").isNull() & F.col("anchor_days").isNotNull()
    days = F.when(go_on, F.log1p(F.expm1("anchor_days") + F.col("_n")).cast("float")).otherwise(F.col("tl_days_since_break"))
    return rows.withColumn("tl_days_since_break", days).select(*found.columns)


def lines_ahead(found: DataFrame, prices: DataFrame, days: DataFrame) -> DataFrame:
    """Both boundaries of each entity's last bar carried on: (stock_id, date, step, side, price) for the future days (stock_id, date, step).

    A line is kept as its price at the last bar and its slope a bar, found back from the stored distance and
    slope, which go by the close; a side without a line gives no rows.
    """
    rows = found.join(prices.select("stock_id", "date", "close"), ["stock_id", "date"])
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.try_divide("close", 1 + F.col(f"tl_{s}_dist").cast("double")).alias("now"), (F.col(f"tl_{s}_slope").cast("double") * F.col("close")).alias("slope")) for s in ("resist", "support")])
    last = rows.groupBy("stock_id").agg(F.max_by(F.struct("date", sides.alias("sides")), "date").alias("at"))
    states = last.select("stock_id", F.col("at.date").alias("since"), F.inline("at.sides")).where("now is not null and slope is not null")
    ahead = days.join(states, "stock_id").where(F.col("date") > F.col("since"))
    return ahead.select("stock_id", "date", "step", "side", (F.col("now") + F.col("slope") * F.col("step")).alias("price"))


def swing_lines(a: dict[str, np.ndarray], lookback: int = 120, span: int = 5, warm: int = 260) -> dict[str, np.ndarray]:
    """Support and resistance as least-squares lines over the closes' pivots, and the last pivots of large volume.

    Before two pivots are known, touches and days are 0 and the rest is unknown; nothing is told in the first `warm` bars.
    """
    close, high, low, volume, usual = (a[c] for c in ("close", "high", "low", "volume", "usual"))
    n = len(close)
    bars, told = np.arange(n), np.arange(n) >= warm
    out = {}
    for side, sign in (("support", -1), ("resist", 1)):
        for k in ("dist", "slope", "r2"):
            out[f"{side}_{k}"] = np.full(n, np.nan)
        out[f"{side}_touches"], out[f"{side}_days"] = np.where(told, 0.0, np.nan), np.where(told, 0.0, np.nan)
        for found in lines(extremes(close, span, sign, True), close, warm, lookback, span, 2):
            t, of, _ = spans(found.start, found.stop)
            line = found.slope[of] * t + found.intercept[of]
            out[f"{side}_dist"][t], out[f"{side}_r2"][t] = bounded_distance(close[t], line), found.r2[of]
            with np.errstate(invalid="ignore", divide="ignore"):
                out[f"{side}_slope"][t] = np.where(line >= close[t] * 0.1, found.slope[of] / line, np.nan)
                off = np.abs(found.rest) / close[found.pivots]
            out[f"{side}_touches"][t], out[f"{side}_days"][t] = np.count_nonzero(off < 0.01, axis=1)[of], np.log1p(t - found.pivots[of, 0])
    up, down = out["support_slope"], out["resist_slope"]
    out["is_triangle"], out["slope_align"] = ((up > 0) & (down < 0)).astype(float), (up * down > 0).astype(float)
    with np.errstate(invalid="ignore", divide="ignore"):
        strength = np.where(usual > 0, volume / usual, np.nan)
    for name, base, sign in (("vh", high, 1), ("vl", low, -1)):
        found = extremes(close, 2, sign, True)
        found = found[strength[found] >= 2]
        seen = np.searchsorted(found, bars - 2, "right")
        for k in (1, 2, 3):
            held = told & (seen >= k)
            at = found[np.maximum(seen - k, 0)] if len(found) else np.zeros(n, int)
            out[f"{name}{k}_dist"], out[f"{name}{k}_days"] = np.where(held, close / base[at] - 1, np.nan), np.where(held, np.log1p(np.maximum(bars - at, 0)), np.nan)
            if k == 1:
                out[f"{name}1_strength"] = np.where(held, strength[at], np.nan)
                out["is_above_vh1" if sign == 1 else "is_below_vl1"] = (held & (sign * (close - close[at]) > 0)).astype(float)
    return out


SWING_FLAGS = ["is_triangle", "slope_align", "is_above_vh1", "is_below_vl1"]
SWING_FLOATS = [f"{s}_{k}" for s in ("support", "resist") for k in ("dist", "slope", "r2", "touches", "days")] + [f"{v}{k}_{x}" for v in ("vh", "vl") for k in (1, 2, 3) for x in ("dist", "days")] + ["vh1_strength", "vl1_strength"]


def swing_family(df: DataFrame, warm: int = 260) -> DataFrame:
    df = df.withColumn("usual", w.mean(F.col("volume"), 60, 10))
    found = per_entity(df, ["close", "high", "low", "volume", "usual"], ", ".join(f"{c} double" for c in SWING_FLOATS + SWING_FLAGS), lambda a: swing_lines(a, warm=warm))
    return found.select("stock_id", "date", *[F.col(c).cast("float").alias(c) for c in SWING_FLOATS], *[F.col(c).cast("int").alias(c) for c in SWING_FLAGS])
