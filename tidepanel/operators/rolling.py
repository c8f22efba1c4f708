"""Statistics of the last n rows of one entity, on arrays: the engine's sliding frames add up every row of a window anew for each bar.

Sums and deviations take the same additions in the same order, oldest row first, for all bars at once; medians and
ranks keep one sorted list.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .recursive import per_entity


def known(x: np.ndarray, n: int) -> np.ndarray:
    """How many of the last n values are known."""
    sums = np.concatenate((np.zeros(n), np.cumsum(x == x)))
    return sums[n:] - sums[: len(x)]


def total(x: np.ndarray, n: int) -> np.ndarray:
    filled, out = np.where(x == x, x, 0.0), np.zeros(len(x))
    for k in range(min(n, len(x)) - 1, -1, -1):
        out[k:] += filled[: len(x) - k]
    return out


def mean(x: np.ndarray, n: int) -> np.ndarray:
    return total(x, n) / known(x, n)


def deviation(x: np.ndarray, n: int) -> np.ndarray:
    """The sample deviation by updates of mean and squares, unknown below two values."""
    first = int(np.argmax(x == x)) if len(x) else 0
    if first:  # nothing is known before: a change has no value in the first row
        return np.concatenate((np.full(first, np.nan), deviation(x[first:], n)))
    middle, squares, ok = np.zeros(len(x)), np.zeros(len(x)), x == x
    whole, filled, seen = bool(ok.all()), np.where(ok, x, 0.0), np.zeros(len(x))
    rows = np.minimum(np.arange(len(x)), n - 1) + 1.0
    for k in range(min(n, len(x)) - 1, -1, -1):
        if whole:
            step = filled[: len(x) - k] - middle[k:]
            part = step / (rows[k:] - k)
            middle[k:] += part
            squares[k:] += step * (step - part)
        else:
            there = ok[: len(x) - k]
            step = filled[: len(x) - k] - middle[k:]
            part = step / (seen[k:] + 1)
            seen[k:] += there
            middle[k:] += np.where(there, part, 0.0)
            squares[k:] += np.where(there, step * (step - part), 0.0)
    seen = rows if whole else seen
    return np.where(seen > 1, np.sqrt(squares / np.maximum(seen - 1, 1)), np.nan)


def _extreme(x: np.ndarray, n: int, reduce, least: float) -> np.ndarray:
    padded = np.concatenate((np.full(n - 1, least), np.where(x == x, x, least)))
    return reduce(np.lib.stride_tricks.sliding_window_view(padded, n), axis=1)


def highest(x: np.ndarray, n: int) -> np.ndarray:
    return _extreme(x, n, np.max, -np.inf)


def lowest(x: np.ndarray, n: int) -> np.ndarray:
    return _extreme(x, n, np.min, np.inf)


def _sorted_rows(x: np.ndarray, n: int, told) -> np.ndarray:
    """told(sorted known values of the last n rows, the row's value) for each row."""
    values, seen, out = x.tolist(), [], []
    for i, v in enumerate(values):
        if i >= n and values[i - n] == values[i - n]:
            del seen[bisect_left(seen, values[i - n])]
        if v == v:
            insort(seen, v)
        out.append(told(seen, v) if seen else np.nan)
    return np.array(out, float)


def median(x: np.ndarray, n: int) -> np.ndarray:
    if not np.isinf(x).any():  # pandas takes these for unknown
        return pd.Series(x).rolling(n, min_periods=1).median().to_numpy()

    def told(seen, _):
        k = len(seen) // 2
        return seen[k] if len(seen) % 2 else 0.5 * seen[k - 1] + 0.5 * seen[k]

    return _sorted_rows(x, n, told)


def rank(x: np.ndarray, n: int) -> np.ndarray:
    """The value's share of rank among the known values of the last n rows, ties by their mean rank."""

    def told(seen, v):
        if v != v:
            return np.nan
        a, b = bisect_left(seen, v), bisect_right(seen, v)
        return (a + (b - a + 1) / 2) / len(seen)

    return _sorted_rows(x, n, told)


def earlier(x: np.ndarray, k: int) -> np.ndarray:
    """The value k rows before."""
    return np.concatenate((np.full(min(k, len(x)), np.nan), x[: max(len(x) - k, 0)]))


def streak(hit: np.ndarray) -> np.ndarray:
    """The length of the run of true values that ends at each row."""
    at = np.arange(1, len(hit) + 1)
    return at - np.maximum.accumulate(np.where(hit, 0, at))


STATISTICS = {"mean": mean, "sum": total, "sd": deviation, "max": highest, "min": lowest, "median": median, "rank": rank}


def statistics(a: dict[str, np.ndarray], wanted: dict[str, tuple]) -> dict[str, np.ndarray]:
    """Each wanted name tells (statistic, column, n) or (.., least): unknown until `least` of the last n rows (all, by default) are known."""
    out = {}
    with np.errstate(invalid="ignore", divide="ignore"):
        for name, (how, column, n, *least) in wanted.items():
            out[name] = np.where(known(a[column], n) >= (least[0] if least else n), STATISTICS[how](a[column], n), np.nan)
    return out


def rolled(df: DataFrame, wanted: dict[str, tuple], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (entity, time, kept columns, wanted statistics)."""
    columns = list(dict.fromkeys(c for _, c, *_ in wanted.values()))
    return per_entity(df, columns, ", ".join(f"{name} double" for name in wanted), lambda a: statistics(a, wanted), keep=keep)
