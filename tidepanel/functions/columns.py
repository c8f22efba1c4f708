"""Column expressions with the panel's null rules: a flag of an unknown condition is 0, a ratio over zero is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def gate(x: Column, low: float, high: float) -> Column:
    """x inside a sane range, null outside it."""
    return F.when((x >= low) & (x <= high), x)


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def known(x: Column) -> Column:
    """NaN becomes null, so that comparisons and aggregates treat it as missing."""
    return F.when(~F.isnan(x), x)


def parse_number(text: Column) -> Column:
    """A double from a string with thousands separators; sentinels and anything else unreadable are null."""
    bare = F.regexp_replace(F.trim(text), ",", "")
    return F.when(~bare.isin("", "-", "--", "---", "N/A"), bare).try_cast("double")


def number_of(df: DataFrame, name: str) -> Column:
    """The column as a double; null where df has none of that name or it can't be read."""
    return F.col(name).try_cast("double") if name in df.columns else F.lit(None).cast("double")


def flag_of(df: DataFrame, name: str) -> Column:
    """1 above a half; 0 where the column is missing or unknown."""
    return flag(number_of(df, name) > 0.5)


def chosen(df: DataFrame, prefixes: tuple[str, ...], without: tuple[str, ...] = (), least: int = 20, never: tuple[str, ...] = ("label_", "hitrate_")) -> list[str]:
    """Columns that begin with one of the prefixes and are not excluded; with fewer than `least` of them, all but keys and `never`."""
    found = [c for c in df.columns if c.startswith(prefixes) and c not in without]
    return found if len(found) >= least else [c for c in df.columns if c not in (*without, "stock_id", "date") and not c.startswith(never)]
