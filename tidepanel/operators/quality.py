"""Data-quality rules over daily bars: each gives rows that tell what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import line


def ohlc_violations(df: DataFrame, slack: float = 1e-9) -> DataFrame:
    """Bars whose high is below, or whose low is above, one of the other prices."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return df.where((h < F.greatest(o, c, lo) - slack) | (lo > F.least(o, c, h) + slack))


def missing_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """The share of nulls of each column."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return rates.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in columns])).alias("x")).select("x.*")


def row_count_drops(df: DataFrame, least: float = 0.95, floor: int = 50) -> DataFrame:
    """Dates with fewer rows than `least` of the date before, where that had `floor` rows."""
    days = df.groupBy("date").agg(F.count("*").alias("rows"))
    days = days.withColumn("before", F.lag("rows").over(Window.orderBy("date")))
    return days.where((F.col("before") >= floor) & (F.col("rows") < F.col("before") * least))


def unexplained_jumps(df: DataFrame, events: DataFrame, move: float, listed: int = 5) -> DataFrame:
    """Closes that moved by more than `move` from the market day before, of entities listed longer, without an event.

    The market's days are numbered once; the numbers are a row per date and join by date.
    """
    days = df.select("date").distinct().withColumn("day", F.row_number().over(Window.orderBy("date")))
    rows = df.select("stock_id", "date", "close").join(days, "date")
    before = F.lag(F.struct("close", "day")).over(line())
    rows = rows.withColumn("before", before).withColumn("bars", F.row_number().over(line()))
    ret = F.try_divide("close", F.col("before.close")) - 1
    found = rows.withColumn("ret", ret).where((F.abs("ret") > move) & (F.col("day") - F.col("before.day") == 1) & (F.col("bars") > listed))
    return found.join(events.select("stock_id", "date").distinct(), ["stock_id", "date"], "left_anti").select("date", "stock_id", F.col("before.close").alias("prev_close"), "close", "ret")
