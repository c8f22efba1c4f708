"""What holds at each of one entity's bars, as bits of whole numbers: named patterns, candles, and whether the bars ahead rose."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from . import candles, families

#: The columns of bars that are read, and one that is 0 where a row has no key.
NAMED_INPUTS = (*families.NAMED_INPUTS, "keyed")
INPUTS = tuple(dict.fromkeys((*NAMED_INPUTS, "open", "high", "low", "close")))


def word(holds: Iterable[np.ndarray]) -> np.ndarray:
    """Flags as bits of one number, the first the lowest."""
    return sum(x.astype(np.int64) << i for i, x in enumerate(holds))


def named(a: dict[str, np.ndarray], conditions: list[str]) -> dict[str, np.ndarray]:
    """The conditions on columns of the families, as bits; rows without a key meet none."""
    columns = families.named_inputs(a)
    return {"named": np.where(a["keyed"] != 0, word(candles.value(x, columns) for x in conditions), 0)}


def signs(a: dict[str, np.ndarray], conditions: list[str], names: list[str]) -> dict[str, np.ndarray]:
    """named, rising and falling candles (up, down), and 1 where the 20 bars from the next on rose, unknown near the end."""
    found, c = candles.candles(a), a["close"]
    later = lambda n: np.concatenate((c[n:], np.full(min(n, len(c)), np.nan)))
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        ret = families.over(later(21), later(1)) - 1
    won = np.ma.array((ret > 0).astype(np.int32), mask=np.isnan(ret))
    return {**named(a, conditions), "up": word(found[x] > 0 for x in names), "down": word(found[x] < 0 for x in names), "won": won}
