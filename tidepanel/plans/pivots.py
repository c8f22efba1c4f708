"""Swing pivots and envelope trend lines: a pivot counts from the bar at which its later neighbours are known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flag, ratio
from ..operators import windows as w
from .lines import trend_line_family


def swing_levels(df: DataFrame, span: int = 5, kept: int = 3) -> DataFrame:
    """Distance and log age of the last `kept` confirmed highs and lows of the close within `span` bars to either side.

    Each pivot carries those before it, so a row looks up the last confirmed one only and no frame gathers lists.
    """
    around, before = w.ahead(-span, span), w.line().rowsBetween(Window.unboundedPreceding, -1)
    whole = F.count("close").over(around) == 2 * span + 1
    here = F.struct("at", "close")
    df = df.select("stock_id", "date", "close", F.row_number().over(w.line()).alias("at"), flag(whole & (F.col("close") == F.max("close").over(around)) & (F.col("close") > w.lag(F.col("close")))).alias("is_high"), flag(whole & (F.col("close") == F.min("close").over(around)) & (F.col("close") < w.lag(F.col("close")))).alias("is_low"))
    columns = []
    for side in ("high", "low"):
        turn = F.col(f"is_{side}") == 1
        df = df.withColumn(f"{side}_0", F.when(turn, here))
        for k in range(1, kept):
            df = df.withColumn(f"{side}_{k}", F.last(F.when(turn, F.col(f"{side}_{k - 1}")), ignorenulls=True).over(before))
        chain = F.when(turn, F.struct(*[F.col(f"{side}_{k}").alias(f"p{k}") for k in range(kept)]))
        df = df.withColumn(side, F.last(chain, ignorenulls=True).over(w.line().rowsBetween(Window.unboundedPreceding, -span)))
        for k in range(kept):
            pivot = F.col(side)[f"p{k}"]
            columns += [(ratio(F.col("close"), pivot["close"]) - 1).cast("float").alias(f"{side}{k + 1}_dist"), F.log1p((F.col("at") - pivot["at"]).cast("double")).cast("float").alias(f"{side}{k + 1}_days")]
    return df.select("stock_id", "date", *columns)


def trend_lines(df: DataFrame) -> DataFrame:
    """The envelope's part of trend_line_family."""
    names = [f"{side}_{k}" for side in ("resist", "support") for k in ("dist", "slope", "r2")] + ["channel_width", "days_since_break", "resist_break"]
    return trend_line_family(df).select("stock_id", "date", *[f"tl_{c}" for c in names])
