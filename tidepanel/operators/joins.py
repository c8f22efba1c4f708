"""Temporal joins over a keyed panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, right_time: str, values: list[str], entity: str = "stock_id", time: str = "date") -> DataFrame:
    """left with the values of the latest right row of the same entity at or before its time; null before the first.

    One shuffle: both sides in one ordered window per entity, a right row ahead of left rows of its time.
    """
    kept = [F.col(c) for c in left.columns]
    none = [F.lit(None).cast(dict(left.dtypes)[c]).alias(c) for c in left.columns if c not in (entity, time)]
    held = F.struct(*values)
    rows = right.select(F.col(entity), F.col(right_time).cast(dict(left.dtypes)[time]).alias(time), F.lit(0).alias("_side"), *none, held.alias("_held"))
    both = left.select(*kept, F.lit(1).alias("_side"), F.lit(None).cast(rows.schema["_held"].dataType).alias("_held")).unionByName(rows)
    line = Window.partitionBy(entity).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_held", F.last("_held", ignorenulls=True).over(line)).where("_side = 1")
    return found.select(*kept, *[F.col("_held")[v].alias(v) for v in values])


def later_product(prices: DataFrame, events: DataFrame, ratio: str = "ratio", entity: str = "stock_id", time: str = "date") -> DataFrame:
    """prices with `factor`: the product of the ratios of the entity's events strictly after each time, 1 without any.

    Ratios that are null, not positive or not finite are ignored. Events enter the ordered window ahead of
    the prices of their time, and the product runs over the rows that follow.
    """
    sound = events.where((F.col(ratio) > 0) & (F.col(ratio) < float("inf"))).select(entity, time, F.lit(0).alias("_side"), F.col(ratio).alias("_ratio"))
    both = prices.withColumn("_side", F.lit(1)).withColumn("_ratio", F.lit(1.0)).unionByName(sound, allowMissingColumns=True)
    after = Window.partitionBy(entity).orderBy(time, "_side").rowsBetween(1, Window.unboundedFollowing)
    out = both.withColumn("factor", F.coalesce(F.product("_ratio").over(after), F.lit(1.0))).where("_side = 1")
    return out.drop("_side", "_ratio")


def forward_filled(df: DataFrame, columns: list[str], entity: str = "stock_id", time: str = "date") -> DataFrame:
    """Each null replaced by the entity's last known value."""
    line = Window.partitionBy(entity).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(line) for c in columns})


def held_on(positions: DataFrame, days: DataFrame, day: str = "date", start: str = "buy_date", end: str = "sell_date") -> DataFrame:
    """Every (day, position) with start <= day < end; an open end holds for ever.

    Days and positions meet by month, so that the interval is an equality join with a check.
    """
    month = lambda c: F.trunc(c, "MM")
    last = F.coalesce(F.col(end), F.lit("9999-12-31").cast("timestamp_ntz"))
    last_day = days.agg(F.max(day).alias("_last_day")).scalar()
    spread = positions.withColumn("_until", F.least(last, last_day)).where(F.col(start) <= F.col("_until"))
    spread = spread.withColumn("_month", F.explode(F.sequence(month(F.col(start)), month(F.col("_until")), F.expr("interval 1 month"))))
    joined = spread.join(days.select(day, month(F.col(day)).alias("_month")), "_month")
    return joined.where((F.col(start) <= F.col(day)) & (F.col(end).isNull() | (F.col(day) < F.col(end)))).drop("_month", "_until")


def value_differences(new: DataFrame, old: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """One row per column: compared pairs and how many differ by more than the tolerance; two nulls are equal."""
    both = new.select(*keys, *[F.col(c).alias(f"{c}_new") for c in columns]).join(old.select(*keys, *[F.col(c).alias(f"{c}_old") for c in columns]), keys)
    differs = lambda c: ~F.col(f"{c}_new").eqNullSafe(F.col(f"{c}_old")) & F.coalesce(F.abs(F.col(f"{c}_new") - F.col(f"{c}_old")) > tolerance, F.lit(True))
    sums = both.agg(F.count("*").alias("compared"), *[F.sum(differs(c).cast("long")).alias(c) for c in columns])
    return sums.select("compared", F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column_name", "mismatches"))


def latest(df: DataFrame, entity: str = "stock_id", time: str = "date", until: Column | None = None) -> DataFrame:
    """The last row of each entity, up to a time if given."""
    df = df if until is None else df.where(F.col(time) <= until)
    rest = [c for c in df.columns if c != entity]
    return df.groupBy(entity).agg(F.max_by(F.struct(*rest), time).alias("_row")).select(entity, "_row.*")
