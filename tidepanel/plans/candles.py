"""The 61 candle patterns as conditions over a bar (suffix 0) and the bars before it (1 to 4).

Aspects of a bar: o, h, l, c; b body; k colour (1 or -1); u and d upper and lower shadow; hi and lo the body's ends.
Measures of usual size, from the bars before: L mean body of 10, D a tenth of the mean range of 10 (a body up to it is a
doji), V the same (a shadow below it is very short), S half the mean of both shadows of 10, N, F and E 0.2, 0.6 and 0.05
of the mean range of 5. The conditions are plain expressions that SQL engines and, by a few replaced words, arrays read alike.
"""

from __future__ import annotations

import ast
import re
from functools import cache, reduce

import numpy as np
from pyspark.sql import DataFrame

from ..operators import rolling
from ..operators.recursive import per_entity

ASPECTS = {"o": "open", "h": "high", "l": "low", "c": "close", "b": "abs(close - open)", "k": "CASE WHEN close >= open THEN 1 ELSE -1 END", "u": "high - greatest(open, close)", "d": "least(open, close) - low", "hi": "greatest(open, close)", "lo": "least(open, close)"}
#: name: (what is averaged, over how many bars before, factor)
MEASURES = {"L": ("abs(close - open)", 10, 1.0), "D": ("(high - low)", 10, 0.1), "S": ("(high - greatest(open, close) + least(open, close) - low)", 10, 0.5), "N": ("(high - low)", 5, 0.2), "F": ("(high - low)", 5, 0.6), "E": ("(high - low)", 5, 0.05)}
DEPTH = 4


def up(a: int, b: int) -> str:
    return f"lo{a} > hi{b}"


def down(a: int, b: int) -> str:
    return f"hi{a} < lo{b}"


def equal(x: str, y: str, k: int) -> str:
    return f"{x} <= {y} + E{k} AND {x} >= {y} - E{k}"


def colours(**k: int) -> str:
    return " AND ".join(f"{name} = {v}" for name, v in k.items())


def star(middle: str, first: int) -> str:
    """A long body, a small one apart from it, and a body back into the first by 30 %."""
    into = "c0 < c2 - b2 * 0.3" if first == 1 else "c0 > c2 + b2 * 0.3"
    return f"b2 > L2 AND k2 = {first} AND b1 <= {middle}1 AND {up(1, 2) if first == 1 else down(1, 2)} AND b0 > L0 AND k0 = {-first} AND {into}"


_RISING = "c0 > c1 AND c1 > c2"
_NEAR_OPENS = "o1 > o2 AND o1 <= c2 + N2 AND o0 > o1 AND o0 <= c1 + N1"
_INSIDE = "hi0 < hi1 AND lo0 > lo1"
_KICK = "k1 = -k0 AND b1 > L1 AND u1 < D1 AND d1 < D1 AND b0 > L0 AND u0 < D0 AND d0 < D0 AND ((k1 = -1 AND l0 > h1) OR (k1 = 1 AND h0 < l1))"

#: pattern: (condition, value where it holds)
PATTERNS = {
    "2crows": (f"{colours(k2=1, k1=-1, k0=-1)} AND b2 > L2 AND {up(1, 2)} AND o0 < o1 AND o0 > c1 AND c0 > o2 AND c0 < c2", "-100"),
    "3blackcrows": (f"{colours(k3=1, k2=-1, k1=-1, k0=-1)} AND d2 < D2 AND d1 < D1 AND d0 < D0 AND o1 < o2 AND o1 > c2 AND o0 < o1 AND o0 > c1 AND h3 > c2 AND c2 > c1 AND c1 > c0", "-100"),
    "3inside": ("b2 > L2 AND b1 <= L1 AND hi1 < hi2 AND lo1 > lo2 AND ((k2 = 1 AND k0 = -1 AND c0 < o2) OR (k2 = -1 AND k0 = 1 AND c0 > o2))", "-k2 * 100"),
    "3linestrike": ("k3 = k2 AND k2 = k1 AND k0 = -k1 AND o2 >= lo3 - N3 AND o2 <= hi3 + N3 AND o1 >= lo2 - N2 AND o1 <= hi2 + N2 AND ((k1 = 1 AND c1 > c2 AND c2 > c3 AND o0 > c1 AND c0 < o3) OR (k1 = -1 AND c1 < c2 AND c2 < c3 AND o0 < c1 AND c0 > o3))", "k1 * 100"),
    "3outside": ("(k1 = 1 AND k2 = -1 AND c1 > o2 AND o1 < c2 AND c0 > c1) OR (k1 = -1 AND k2 = 1 AND o1 > c2 AND c1 < o2 AND c0 < c1)", "k1 * 100"),
    "3starsinsouth": (f"{colours(k2=-1, k1=-1, k0=-1)} AND b2 > L2 AND d2 > b2 AND b1 < b2 AND o1 > c2 AND o1 <= h2 AND l1 < c2 AND l1 >= l2 AND d1 > D1 AND b0 < L0 AND d0 < D0 AND u0 < D0 AND l0 > l1 AND h0 < h1", "100"),
    "3whitesoldiers": (f"{colours(k2=1, k1=1, k0=1)} AND u2 < D2 AND u1 < D1 AND u0 < D0 AND {_RISING} AND {_NEAR_OPENS} AND b1 > b2 - F2 AND b0 > b1 - F1 AND b0 > L0", "100"),
    "abandonedbaby": ("b2 > L2 AND b1 <= D1 AND b0 > L0 AND ((k2 = 1 AND k0 = -1 AND c0 < c2 - b2 * 0.3 AND l1 > h2 AND h0 < l1) OR (k2 = -1 AND k0 = 1 AND c0 > c2 + b2 * 0.3 AND h1 < l2 AND l0 > h1))", "k0 * 100"),
    "advanceblock": (f"{colours(k2=1, k1=1, k0=1)} AND {_RISING} AND {_NEAR_OPENS} AND b2 > L2 AND u2 < S2 AND ((b1 < b2 - F2 AND b0 < b1 + N1) OR b0 < b1 - F1 OR (b0 < b1 AND b1 < b2 AND (u0 > S0 OR u1 > S1)) OR (b0 < b1 AND u0 > b0))", "-100"),
    "belthold": ("b0 > L0 AND ((k0 = 1 AND d0 < D0) OR (k0 = -1 AND u0 < D0))", "k0 * 100"),
    "breakaway": (f"b4 > L4 AND k4 = k3 AND k3 = k1 AND k1 = -k0 AND ((k4 = -1 AND {down(3, 4)} AND h2 < h3 AND l2 < l3 AND h1 < h2 AND l1 < l2 AND c0 > o3 AND c0 < c4) OR (k4 = 1 AND {up(3, 4)} AND h2 > h3 AND l2 > l3 AND h1 > h2 AND l1 > l2 AND c0 < o3 AND c0 > c4))", "k0 * 100"),
    "closingmarubozu": ("b0 > L0 AND ((k0 = 1 AND u0 < D0) OR (k0 = -1 AND d0 < D0))", "k0 * 100"),
    "concealbabyswall": (f"{colours(k3=-1, k2=-1, k1=-1, k0=-1)} AND d3 < D3 AND u3 < D3 AND d2 < D2 AND u2 < D2 AND {down(1, 2)} AND u1 > D1 AND h1 > c2 AND h0 > h1 AND l0 < l1", "100"),
    "counterattack": (f"k1 = -k0 AND b1 > L1 AND b0 > L0 AND {equal('c0', 'c1', 1)}", "k0 * 100"),
    "darkcloudcover": ("k1 = 1 AND b1 > L1 AND k0 = -1 AND o0 > h1 AND c0 > o1 AND c0 < c1 - b1 * 0.5", "-100"),
    "doji": ("b0 <= D0", "100"),
    "dojistar": (f"b1 > L1 AND b0 <= D0 AND ((k1 = 1 AND {up(0, 1)}) OR (k1 = -1 AND {down(0, 1)}))", "-k1 * 100"),
    "dragonflydoji": ("b0 <= D0 AND u0 < D0 AND d0 > D0", "100"),
    "engulfing": ("(k0 = 1 AND k1 = -1 AND c0 >= o1 AND o0 <= c1 AND (c0 > o1 OR o0 < c1)) OR (k0 = -1 AND k1 = 1 AND o0 >= c1 AND c0 <= o1 AND (o0 > c1 OR c0 < o1))", "CASE WHEN o0 <> c1 AND c0 <> o1 THEN k0 * 100 ELSE k0 * 80 END"),
    "eveningdojistar": (star("D", 1), "-100"),
    "eveningstar": (star("L", 1), "-100"),
    "gapsidesidewhite": (f"(({up(1, 2)} AND {up(0, 2)}) OR ({down(1, 2)} AND {down(0, 2)})) AND k1 = 1 AND k0 = 1 AND b0 >= b1 - N1 AND b0 <= b1 + N1 AND {equal('o0', 'o1', 1)}", f"CASE WHEN {up(1, 2)} THEN 100 ELSE -100 END"),
    "gravestonedoji": ("b0 <= D0 AND d0 < D0 AND u0 > D0", "100"),
    "hammer": ("b0 < L0 AND d0 > b0 AND u0 < D0 AND lo0 <= l1 + N1", "100"),
    "hangingman": ("b0 < L0 AND d0 > b0 AND u0 < D0 AND lo0 >= h1 - N1", "-100"),
    "harami": ("b1 > L1 AND b0 <= L0 AND hi0 <= hi1 AND lo0 >= lo1 AND (hi0 < hi1 OR lo0 > lo1)", f"CASE WHEN {_INSIDE} THEN -k1 * 100 ELSE -k1 * 80 END"),
    "haramicross": ("b1 > L1 AND b0 <= D0 AND hi0 <= hi1 AND lo0 >= lo1 AND (hi0 < hi1 OR lo0 > lo1)", f"CASE WHEN {_INSIDE} THEN -k1 * 100 ELSE -k1 * 80 END"),
    "highwave": ("b0 < L0 AND u0 > 2 * b0 AND d0 > 2 * b0", "k0 * 100"),
    "homingpigeon": (f"{colours(k1=-1, k0=-1)} AND b1 > L1 AND b0 <= L0 AND o0 < o1 AND c0 > c1", "100"),
    "identical3crows": (f"{colours(k2=-1, k1=-1, k0=-1)} AND d2 < D2 AND d1 < D1 AND d0 < D0 AND c2 > c1 AND c1 > c0 AND {equal('o1', 'c2', 2)} AND {equal('o0', 'c1', 1)}", "-100"),
    "inneck": ("k1 = -1 AND b1 > L1 AND k0 = 1 AND o0 < l1 AND c0 <= c1 + E1 AND c0 >= c1", "-100"),
    "invertedhammer": (f"b0 < L0 AND u0 > b0 AND d0 < D0 AND {down(0, 1)}", "100"),
    "kicking": (_KICK, "k0 * 100"),
    "kickingbylength": (_KICK, "CASE WHEN b0 > b1 THEN k0 * 100 ELSE k1 * 100 END"),
    "ladderbottom": (f"{colours(k4=-1, k3=-1, k2=-1, k1=-1, k0=1)} AND o4 > o3 AND o3 > o2 AND c4 > c3 AND c3 > c2 AND u1 > D1 AND o0 > o1 AND c0 > h1", "100"),
    "longleggeddoji": ("b0 <= D0 AND (d0 > b0 OR u0 > b0)", "100"),
    "longline": ("b0 > L0 AND u0 < S0 AND d0 < S0", "k0 * 100"),
    "marubozu": ("b0 > L0 AND u0 < D0 AND d0 < D0", "k0 * 100"),
    "matchinglow": (f"{colours(k1=-1, k0=-1)} AND {equal('c0', 'c1', 1)}", "100"),
    "mathold": (f"b4 > L4 AND b3 < L3 AND b2 < L2 AND b1 < L1 AND b0 > L0 AND {colours(k4=1, k3=-1, k0=1)} AND {up(3, 4)} AND lo2 < c4 AND lo1 < c4 AND lo2 > c4 - b4 * 0.5 AND lo1 > c4 - b4 * 0.5 AND hi2 < o3 AND hi1 < hi2 AND o0 > c1 AND c0 > greatest(h3, h2, h1)", "100"),
    "morningdojistar": (star("D", -1), "100"),
    "morningstar": (star("L", -1), "100"),
    "onneck": (f"k1 = -1 AND b1 > L1 AND k0 = 1 AND o0 < l1 AND {equal('c0', 'l1', 1)}", "-100"),
    "piercing": ("k1 = -1 AND b1 > L1 AND k0 = 1 AND b0 > L0 AND o0 < l1 AND c0 < o1 AND c0 > c1 + b1 * 0.5", "100"),
    "rickshawman": ("b0 <= D0 AND d0 > b0 AND u0 > b0 AND lo0 <= (h0 + l0) / 2 + N0 AND hi0 >= (h0 + l0) / 2 - N0", "100"),
    "risefall3methods": ("b4 > L4 AND b3 < L3 AND b2 < L2 AND b1 < L1 AND b0 > L0 AND k4 = -k3 AND k3 = k2 AND k2 = k1 AND k1 = -k0 AND " + " AND ".join(f"lo{i} < h4 AND hi{i} > l4" for i in (3, 2, 1)) + " AND c2 * k4 < c3 * k4 AND c1 * k4 < c2 * k4 AND o0 * k4 > c1 * k4 AND c0 * k4 > c4 * k4", "k4 * 100"),
    "separatinglines": (f"k1 = -k0 AND {equal('o0', 'o1', 1)} AND b0 > L0 AND ((k0 = 1 AND d0 < D0) OR (k0 = -1 AND u0 < D0))", "k0 * 100"),
    "shootingstar": (f"b0 < L0 AND u0 > b0 AND d0 < D0 AND {up(0, 1)}", "-100"),
    "shortline": ("b0 < L0 AND u0 < S0 AND d0 < S0", "k0 * 100"),
    "spinningtop": ("b0 < L0 AND u0 > b0 AND d0 > b0", "k0 * 100"),
    "stalledpattern": (f"{colours(k2=1, k1=1, k0=1)} AND {_RISING} AND b2 > L2 AND b1 > L1 AND u1 < D1 AND o1 > o2 AND o1 <= c2 + N2 AND b0 < L0 AND o0 >= c1 - b0 - N1", "-100"),
    "sticksandwich": (f"{colours(k2=-1, k1=1, k0=-1)} AND l1 > c2 AND {equal('c0', 'c2', 2)}", "100"),
    "takuri": ("b0 <= D0 AND u0 < D0 AND d0 > 2 * b0", "100"),
    "tasukigap": (f"abs(b1 - b0) < N1 AND (({up(1, 2)} AND k1 = 1 AND k0 = -1 AND o0 < c1 AND o0 > o1 AND c0 < o1 AND c0 > hi2) OR ({down(1, 2)} AND k1 = -1 AND k0 = 1 AND o0 < o1 AND o0 > c1 AND c0 > o1 AND c0 < lo2))", "k1 * 100"),
    "thrusting": ("k1 = -1 AND b1 > L1 AND k0 = 1 AND o0 < l1 AND c0 > c1 + E1 AND c0 <= c1 + b1 * 0.5", "-100"),
    "tristar": (f"b2 <= D2 AND b1 <= D2 AND b0 <= D2 AND (({up(1, 2)} AND hi0 < hi1) OR ({down(1, 2)} AND lo0 > lo1))", f"CASE WHEN {up(1, 2)} THEN -100 ELSE 100 END"),
    "unique3river": (f"{colours(k2=-1, k1=-1, k0=1)} AND b2 > L2 AND c1 > c2 AND o1 <= o2 AND l1 < l2 AND b0 < L0 AND o0 > l1", "100"),
    "upsidegap2crows": (f"{colours(k2=1, k1=-1, k0=-1)} AND b2 > L2 AND b1 <= L1 AND {up(1, 2)} AND o0 > o1 AND c0 < c1 AND c0 > c2", "-100"),
    "xsidegap3methods": (f"k2 = k1 AND k1 = -k0 AND o0 < hi1 AND o0 > lo1 AND c0 < hi2 AND c0 > lo2 AND ((k2 = 1 AND {up(1, 2)}) OR (k2 = -1 AND {down(1, 2)}))", "k2 * 100"),
}

#: Patterns that a close within the next three bars confirms: where they stand, 100 or -100.
_TURN = "CASE WHEN h0 < h1 AND l0 < l1 THEN 100 WHEN h0 > h1 AND l0 > l1 THEN -100 ELSE 0 END"
CONFIRMED = {
    "hikkake": f"CASE WHEN h1 < h2 AND l1 > l2 THEN {_TURN} ELSE 0 END",
    "hikkakemod": "CASE WHEN h2 < h3 AND l2 > l3 AND h1 < h2 AND l1 > l2 THEN CASE WHEN h0 < h1 AND l0 < l1 AND c2 <= l2 + N2 THEN 100 WHEN h0 > h1 AND l0 > l1 AND c2 >= h2 - N2 THEN -100 ELSE 0 END ELSE 0 END",
}


def confirmation(name: str) -> str:
    """100 or -100 where the pattern stands, 200 or -200 where a close passes the bar before it within three bars, once."""
    parts = [f"WHEN {name}_0 <> 0 THEN {name}_0"]
    for k in (1, 2, 3):
        beyond = lambda j, k=k: f"(({name}_{k} = 100 AND c{j} > h{k + 1}) OR ({name}_{k} = -100 AND c{j} < l{k + 1}))"
        latest = " AND ".join([f"{name}_{k} <> 0", *[f"{name}_{j} = 0" for j in range(1, k)], *[f"NOT {beyond(j)}" for j in range(1, k)], beyond(0)])
        parts.append(f"WHEN {latest} THEN 2 * {name}_{k}")
    return f"CASE {' '.join(parts)} ELSE 0 END"


def plain(x: str) -> str:
    """Engines take upper and lower case for one: measures go by n_X."""
    return re.sub(rf"\b([{''.join(MEASURES)}])(\d)\b", r"n_\1\2", x)


def columns() -> dict[str, str]:
    """Output column: expression over the bar and those before."""
    found = {f"cdl{n}": f"CASE WHEN {condition} THEN {value} ELSE 0 END" for n, (condition, value) in PATTERNS.items()} | {f"cdl{n}": confirmation(n) for n in CONFIRMED}
    return {n: plain(x) for n, x in found.items()}


#: What the expressions call on arrays. Unknown values are NaN, of which no comparison holds.
_CALLS = {"abs": np.abs, "greatest": lambda *x: reduce(np.fmax, x), "least": lambda *x: reduce(np.fmin, x), "both": lambda *x: reduce(np.logical_and, x), "either": lambda *x: reduce(np.logical_or, x), "float32": np.float32}


def _case(*x):
    """Condition, value, condition, value, ..., else."""
    found = x[-1]
    for k in range(len(x) - 3, -1, -2):
        found = np.where(x[k], x[k + 1], found)
    return found


class _OnArrays(ast.NodeTransformer):
    def visit_BoolOp(self, node):  # noqa: N802
        """`and` and `or` ask one truth value of a whole array."""
        self.generic_visit(node)
        return ast.Call(ast.Name("both" if isinstance(node.op, ast.And) else "either", ast.Load()), node.values, [])


@cache
def _code(x: str):
    """The expression for arrays: conditions here hold AND and OR, comparisons, arithmetic and CASE, all known to Python by other words."""
    x = re.sub(r"CAST\((\S+) AS FLOAT\)", r"float32(\1)", x)
    for sql, python in (("CASE WHEN ", "case("), (" WHEN ", ", "), (" THEN ", ", "), (" ELSE ", ", "), (" END", ")"), (" AND ", " and "), (" OR ", " or "), (" <> ", " != "), (" = ", " == ")):
        x = x.replace(sql, python)
    return compile(ast.fix_missing_locations(_OnArrays().visit(ast.parse(x, mode="eval"))), x, "eval")


def value(x: str, arrays: dict[str, np.ndarray]) -> np.ndarray:
    """One of this module's expressions on arrays by name."""
    return eval(_code(x), _CALLS | {"case": _case, "__builtins__": {}}, arrays)  # noqa: S307


def _confirmed(stands: np.ndarray, a: dict[str, np.ndarray]) -> np.ndarray:
    """confirmation on arrays; a pass that can't be told, as its close is unknown, is neither a pass nor none."""
    before = [np.nan_to_num(rolling.earlier(stands, k)) for k in range(4)]
    out = np.zeros(len(stands))
    for k in (3, 2, 1):
        edge = np.where(before[k] > 0, a[f"h{k + 1}"], a[f"l{k + 1}"])
        passed = [np.where(before[k] > 0, a[f"c{j}"] > edge, a[f"c{j}"] < edge) for j in range(k)]
        none = [(a[f"c{j}"] == a[f"c{j}"]) & (edge == edge) & ~passed[j] & (before[j] == 0) for j in range(1, k)]
        out = np.where(reduce(np.logical_and, none, (before[k] != 0) & passed[0]), 2 * before[k], out)
    return np.where(stands != 0, stands, out)


def candles(bars: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """All patterns of one entity's bars: 0, or 100 and -100 for rising and falling ones."""
    with np.errstate(invalid="ignore", divide="ignore"):
        first = {a: value(x, bars) for a, x in ASPECTS.items()}
        for m, (x, n, factor) in MEASURES.items():
            whole = rolling.earlier(rolling.known(bars["close"], n), 1) == n
            first[m] = np.where(whole, rolling.earlier(rolling.mean(value(x, bars), n), 1) * factor, np.nan)
        a = {f"{name}{k}": rolling.earlier(x, k) for name, x in first.items() for k in range(DEPTH + 1)}
        found = {f"cdl{n}": np.where(value(x, a), value(there, a), 0) for n, (x, there) in PATTERNS.items()}
        found |= {f"cdl{n}": _confirmed(value(x, a), a) for n, x in CONFIRMED.items()}
    return {n: x.astype(np.int32) for n, x in found.items()}


def candle_family(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All patterns of each bar, in one group of an entity's bars. Kept columns pass through."""
    return per_entity(df, ["open", "high", "low", "close"], ", ".join(f"{n} int" for n in columns()), candles, keep=keep)
