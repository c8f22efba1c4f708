"""Window primitives over a panel keyed by (entity, time)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.columns import flag

ENTITY, TIME = "stock_id", "date"


def line(entity: str = ENTITY, time: str = TIME) -> WindowSpec:
    return Window.partitionBy(entity).orderBy(time)


def trailing(n: int) -> WindowSpec:
    return line().rowsBetween(-(n - 1), 0)


def running() -> WindowSpec:
    return line().rowsBetween(Window.unboundedPreceding, 0)


def ahead(a: int, b: int) -> WindowSpec:
    return line().rowsBetween(a, b)


def roll(agg: Callable[[Column], Column], x: Column, n: int, least: int | None = None) -> Column:
    """agg over the last n rows, null until `least` of them (all, by default) are known."""
    frame = trailing(n)
    return F.when(F.count(x).over(frame) >= (n if least is None else least), agg(x).over(frame))


def mean(x: Column, n: int, least: int | None = None) -> Column:
    return roll(F.avg, x, n, least)


def lag(x: Column, k: int = 1) -> Column:
    return F.lag(x, k).over(line())


def lead(x: Column, k: int = 1) -> Column:
    return F.lead(x, k).over(line())


def change(x: Column, k: int = 1) -> Column:
    """x over its value k rows ago, less 1."""
    return F.try_divide(x, lag(x, k)) - 1


def rank_in_window(x: Column, n: int, least: int | None = None) -> Column:
    """The current value's share of rank among the last n rows, ties by their mean rank."""
    seen = F.collect_list(x).over(trailing(n))
    below = F.size(F.filter(seen, lambda v: v < x))
    same = F.size(F.filter(seen, lambda v: v == x))
    return F.when(x.isNotNull() & (F.size(seen) >= (n if least is None else least)), (below + (same + 1) / 2) / F.size(seen))


def rank_in_section(x: Column, name: str, time: str = TIME) -> Column:
    """The share of rank among the rows of one time, ties by their mean rank; null stays null. One order serves all parts."""
    section = Window.partitionBy(time).orderBy(F.col(name).asc_nulls_last())
    ties = F.count(x).over(section.rangeBetween(Window.currentRow, Window.currentRow))
    known = F.count(x).over(section.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.when(x.isNotNull(), (F.rank().over(section) + (ties - 1) / 2) / known)


def with_streak(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """Add the length of the run of true conditions that ends at each row, 0 where it is false or unknown."""
    df = df.withColumns({"_hit": flag(condition), "_at": F.row_number().over(line())})
    missed = F.max(F.when(F.col("_hit") == 0, F.col("_at"))).over(running())
    return df.withColumn(name, (F.col("_at") - F.coalesce(missed, F.lit(0))).cast("int")).drop("_hit", "_at")


def streak_columns(name: str, prefix: str) -> list[Column]:
    s = F.col(name)
    return [
        (s >= n).cast("int").alias(f"{prefix}_{n}d") for n in (1, 3, 5, 10)
    ] + [F.log1p(s.cast("double")).cast("float").alias(f"{prefix}_log")]


def bars_since(df: DataFrame, event: Column, name: str) -> DataFrame:
    """Add the number of rows since the last event, null before the first."""
    df = df.withColumn("_at", F.row_number().over(line())).withColumn("_event", F.when(event, F.col("_at")))
    return df.withColumn(name, (F.col("_at") - F.last("_event", ignorenulls=True).over(running())).cast("int")).drop("_at", "_event")


def event_columns(name: str, prefix: str) -> list[Column]:
    since = F.col(name)
    return [flag(since == 0).alias(f"{prefix}_1d")] + [flag(since <= n).alias(f"{prefix}_{n}d") for n in (3, 5, 10)] + [F.log1p(since.cast("double")).cast("float").alias(f"{prefix}_log")]
