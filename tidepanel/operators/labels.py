"""Forward-looking labels: null, never 0, while the rows ahead don't decide them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .windows import ahead, lag, lead, mean, roll


def up_days(close: Column, up: Column, n: int = 20, least: int = 10) -> Column:
    """1 if at least `least` of the next n closes rise; `up` is the row's own rise as 0/1."""
    return F.when(F.count(close).over(ahead(1, n)) == n, (F.sum(up).over(ahead(1, n)) >= least).cast("int"))


def shallow_drawdown(close: Column, up: Column, n: int = 20, limit: float = -0.10) -> Column:
    """up_days and no close of the next n below the limit."""
    low = F.try_divide(F.min(close).over(ahead(1, n)), close) - 1
    return F.when(F.count(close).over(ahead(1, n)) == n, (up_days(close, up, n).cast("boolean") & (low > limit)).cast("int"))


def barrier(close: Column, average: Column, profit: float, horizon: int, persist: bool = False) -> Column:
    """Triple barrier of an entry at the next close, on the rows from 2 to horizon ahead.

    1 at the first close of profit or more over the entry; 0 at the second close in a row below its
    average; 0 where neither comes in a whole horizon; null where the rows end first. With `persist` a
    touch counts only if more than half of the days up to it rose, and else the search goes on.
    """
    entry = lead(close)
    rows = F.collect_list(F.struct(close.alias("c"), average.alias("m"))).over(ahead(2, horizon))
    start = F.struct(F.lit(None).cast("int").alias("out"), F.lit(False).alias("below"), F.lit(1).alias("k"), F.lit(0).alias("ups"), entry.alias("last"))

    def step(s: Column, x: Column) -> Column:
        k = s["k"] + 1
        ups = s["ups"] + (x["c"] > s["last"]).cast("int")
        below = F.coalesce(x["c"] < x["m"], F.lit(False))
        win = F.try_divide(x["c"], entry) - 1 >= profit
        won = F.when(win & (ups * 2 > k) if persist else win, 1).when(below & s["below"], 0)
        return F.struct(F.coalesce(s["out"], won).alias("out"), below.alias("below"), k.alias("k"), ups.alias("ups"), x["c"].alias("last"))

    end = F.aggregate(rows, start, step)
    return F.coalesce(end["out"], F.when(F.size(rows) == horizon - 1, F.lit(0)))


def local_low(close: Column, n: int = 5, gain: float = 0.07) -> Column:
    """1 at the least close of n rows to either side whose close n rows ahead is up by the gain."""
    around = ahead(-n, n)
    return F.when(F.count(close).over(around) == 2 * n + 1, ((close == F.min(close).over(around)) & (F.try_divide(lead(close, n), close) - 1 >= gain)).cast("int"))


def steady(close: Column, n: int = 20) -> tuple[Column, Column, Column]:
    """The forward return, the bar it must pass (1.5 sd over sqrt(n), 5 % at least) and the average of the last n."""
    forward = F.try_divide(lead(close, n), close) - 1
    return forward, roll(F.stddev_samp, F.try_divide(close, lag(close)) - 1, n), mean(close, n)


def efficiency(close: Column, step: Column, half: int = 10) -> Column:
    """Kaufman's ratio over a window centred on the row: net move by path; step is |close - previous close|."""
    path = F.sum(step).over(ahead(-half + 1, half))
    return F.when(F.count(step).over(ahead(-half + 1, half)) == 2 * half, F.try_divide(F.abs(lead(close, half) - lag(close, half)), path))


def zigzag(close: np.ndarray, theta: float = 0.05) -> np.ndarray:
    """1 at confirmed lows, -1 at confirmed highs, 0 elsewhere: an extreme is confirmed by a reversal of theta.

    The first extreme is the first bar; of equal closes the later is the extreme.
    """
    out = np.zeros(len(close), np.int64)
    direction, at = 0, 0
    for i, c in enumerate(close.tolist()):
        if direction and direction * (c - close[at]) >= 0:
            at = i
        elif direction <= 0 and c >= close[at] * (1 + theta):
            out[at] = 1
            direction, at = 1, i
        elif direction >= 0 and c <= close[at] * (1 - theta):
            out[at] = -1
            direction, at = -1, i
    return out


def runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the length at the end."""
    return np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)])) if len(x) else np.zeros(1, int)


def swing_states(close: np.ndarray, theta: float, flat: float, shortest_run: int = 1, shortest: int = 300, half: int = 10) -> dict[str, np.ndarray]:
    """State (1 up, -1 down, 0 flat, nan unknown), phase (0, 1, 2 by thirds of a finished run) and the run's amplitude.

    Closes that are unknown or not above 0 part the series; parts of fewer than `shortest` bars tell
    nothing. Between two pivots the state is the way from one to the other, flat where the centred efficiency
    is below `flat`, unknown after the last pivot and where there is no efficiency. Runs shorter than
    shortest_run join the one before, or the one after at the start. The last known run has no phase.
    """
    out = {k: np.full(len(close), np.nan) for k in ("state", "phase", "amplitude")}
    sound = np.isfinite(close) & (close > 0)
    edges = runs(sound)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if not sound[lo] or hi - lo < shortest:
            continue
        c = close[lo:hi]
        pivots = zigzag(c, theta)
        at, state = np.flatnonzero(pivots), np.full(len(c), 9)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            state[a : b + 1] = pivots[a]
        net, path = np.full(len(c), np.nan), np.concatenate(([0.0], np.cumsum(np.abs(np.diff(c)))))
        if len(c) > 2 * half:
            moved = path[2 * half :] - path[: -2 * half]
            with np.errstate(invalid="ignore", divide="ignore"):
                net[half:-half] = np.where(moved > 0, np.abs(c[2 * half :] - c[: -2 * half]) / moved, np.nan)
        state[~np.isfinite(net)] = 9
        state[(net < flat) & (state != 9)] = 0
        state = absorb(state, shortest_run)
        cuts = runs(state)
        known = [(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if state[a] != 9]
        for k, (a, b) in enumerate(known):
            out["state"][lo + a : lo + b], out["amplitude"][lo + a : lo + b] = state[a], c[b - 1] / c[a] - 1
            if k + 1 < len(known):
                out["phase"][lo + a : lo + b] = 3 * np.arange(b - a) // (b - a)
    return out


def absorb(state: np.ndarray, least: int) -> np.ndarray:
    """Runs of known states shorter than `least` take the state of the run before, else of the run after."""
    state = state.copy()
    while True:
        cuts = runs(state)
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        for k, (a, b) in enumerate(spans):
            beside = [spans[j][0] for j in (k - 1, k + 1) if 0 <= j < len(spans) and state[spans[j][0]] != 9]
            if state[a] != 9 and b - a < least and beside:
                state[a:b] = state[beside[0]]
                break
        else:
            return state


def trend_scan(close: Column, shortest: int = 3, longest: int = 10) -> Column:
    """Sign of the slope of the forward least-squares line, over the window length whose t-value is largest, the shorter
    of equal ones; null where fewer than `longest` rows are ahead. Sums over the rows ahead, without a frame."""
    y = [close, *[lead(close, k) for k in range(1, longest)]]
    found = []
    for n in range(shortest, longest + 1):
        x = [k - (n - 1) / 2 for k in range(n)]
        sxx = sum(v * v for v in x)
        slope = sum((y[k] * x[k] for k in range(1, n)), y[0] * x[0]) / sxx
        middle = sum(y[1:n], y[0]) / n
        rest = sum(((y[k] - middle - slope * x[k]) * (y[k] - middle - slope * x[k]) for k in range(1, n)), (y[0] - middle - slope * x[0]) * (y[0] - middle - slope * x[0]))
        t = F.abs(slope) / F.sqrt(F.greatest(rest, F.lit(1e-18)) / max(n - 2, 1) / sxx)
        found.append(F.struct(t.alias("t"), F.lit(-n).alias("n"), F.signum(slope).cast("int").alias("sign")))
    return F.when(lead(close, longest).isNotNull(), F.array_max(F.array(*found))["sign"])
