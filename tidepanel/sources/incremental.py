"""Tables partitioned by month, and derived tables of which an increment rewrites the months that it can change, and no others.

A derived row looks `ahead` and `back` some number of its entity's rows. New rows change the rows up to
`ahead` before them; to compute those, `back` more are read. How far that is in time differs by
entity, and is found by reading the keys of ever more months until every concerned entity has enough.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .tables import drop_stored, keep_last, read_or_empty, stored

MONTH = "month"


def month_of(time: Column) -> Column:
    """The month as a number such as 199803."""
    return F.year(time) * 100 + F.month(time)


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with its column month, which prunes folders; no rows where there is no table."""
    return read_or_empty(spark, path, StructType([*schema.fields, StructField(MONTH, IntegerType())]))


def replace_months(df: DataFrame, path: str, time: str = "date") -> None:
    """Replace the months that df has rows in, as a whole; a month without rows in df stays as it is.

    Each month lies in one file or more of Spark's size; the months move into place when all are written.
    """
    rows = df.withColumn(MONTH, month_of(F.col(time)).cast("int"))
    rows.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def upsert_months(spark: SparkSession, path: str, new: DataFrame, keys: list[str], time: str = "date") -> None:
    """Put new rows in the place of the rows of their keys, and add the others; only the months of new rows are read and written."""
    new, new_path = stored(new, "increment")
    months = new.select(month_of(F.col(time)).cast("int").alias(MONTH)).distinct()
    old = read_months(spark, path, new.schema).join(F.broadcast(months), MONTH, "left_semi").select(*new.columns)
    merged, merged_path = stored(keep_last([old, new], keys), "merged")
    replace_months(merged, path, time)
    drop_stored(spark, new_path, merged_path)


def reach(rows: DataFrame, firsts: DataFrame, count: int, entity: str = "stock_id", time: str = "date", months: int = 4):
    """The first time from which every entity of firsts (entity, first) has `count` rows before its `first`, or all it has.

    rows has the column month. Keys of the last few months are read, then of eight times as many, and so on
    while an entity that lacks rows has older ones. None without entities.
    """
    start = firsts.agg(F.min("first")).first()[0]
    if start is None or count == 0:
        return start
    while True:
        since = F.add_months(F.lit(start).cast("date"), -months)
        seen = rows.where(F.col(MONTH) >= month_of(since)).select(entity, time).join(firsts, entity).where(F.col(time) < F.col("first"))
        back = seen.withColumn("_back", F.row_number().over(Window.partitionBy(entity).orderBy(F.col(time).desc()))).where(F.col("_back") <= count)
        each = back.groupBy(entity).agg(F.count("*").alias("n"), F.min(time).alias("at"))
        found = firsts.join(each, entity, "left").select(entity, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("at", "first").alias("at"))
        older = rows.where(F.col(MONTH) < month_of(since)).select(entity)
        if found.where(F.col("n") < count).join(older, entity, "left_semi").isEmpty():
            return found.agg(F.min("at")).first()[0]
        months *= 8


def recompute_tail(spark: SparkSession, source: str, schema: StructType, target: str, new: DataFrame, compute: Callable[[DataFrame], DataFrame], ahead: int, back: int, entity: str = "stock_id", time: str = "date"):
    """Bring the table at target up to date with new rows (entity, time) of the source; returns the first rewritten month.

    compute makes the derived rows (one for each row, with the same entity and time) from source rows.
    The months from the earliest row that the new ones can change are computed anew for all entities and
    replaced; no older file is touched. Without new rows nothing happens.
    """
    rows = read_months(spark, source, schema)
    firsts = new.groupBy(entity).agg(F.min(time).alias("first"))
    changed = reach(rows, firsts, ahead, entity, time)
    if changed is None:
        return None
    month = changed.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    replace_months(computed_since(spark, source, schema, month, compute, back, entity, time), target, time)
    return month


def computed_since(spark: SparkSession, source: str, schema: StructType, since, compute: Callable[[DataFrame], DataFrame], back: int, entity: str = "stock_id", time: str = "date") -> DataFrame:
    """The derived rows from a time on, computed from the source's rows since then and the `back` rows that each of their entities has before."""
    rows = read_months(spark, source, schema)
    first = F.lit(since).cast("timestamp_ntz")
    present = rows.where((F.col(MONTH) >= month_of(first)) & (F.col(time) >= first)).select(entity).distinct().withColumn("first", first)
    start = F.lit(reach(rows, present, back, entity, time)).cast("timestamp_ntz")
    needed = rows.where((F.col(MONTH) >= month_of(start)) & (F.col(time) >= start)).select(*[f.name for f in schema.fields])
    return compute(needed).where(F.col(time) >= first)
