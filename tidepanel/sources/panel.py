"""The panel tables derived from the order tables: bars, index, flows, revenue, actions and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.windows import line, rank_in_section, running
from .tables import table_bytes

PART_BYTES = 4 << 20  # of the lines' files that one task of entities takes: what it sorts stays the same however large the tables are


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str) -> int:
    """How many tasks share the order lines: one per PART_BYTES, and in small tables one per MB up to the number of cores."""
    size = table_bytes(spark, f"{sf_dir}/lineitem.parquet")
    return max(1, -(-size // PART_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))


def lines_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines, dealt by supplier: days add up and windows run behind this one exchange, as an entity's lines seldom share a day."""
    return table(spark, sf_dir, "lineitem").repartition(parts(spark, sf_dir), "l_suppkey")


def _days(spark: SparkSession, sf_dir: str, told: dict[str, Column]) -> DataFrame:
    """One row per supplier and ship date with the told aggregates of its lines."""
    px = (F.col("l_extendedprice") / F.col("l_quantity")).alias("px")
    lines = lines_by_entity(spark, sf_dir).select("*", px, F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("at"))
    return lines.groupBy(F.col("l_suppkey").alias("stock_id"), F.col("l_shipdate").alias("date")).agg(*[x.alias(name) for name, x in told.items()])


def _bar() -> dict[str, Column]:
    return {
        "open": F.min_by("px", "at"), "high": F.max("px"), "low": F.min("px"), "close": F.max_by("px", "at"),
        "volume": F.sum("l_quantity"), "amount": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"),
    }


def _flow() -> dict[str, Column]:
    q = F.col("l_quantity")
    return {
        "foreign_net": F.sum(F.when(F.col("l_returnflag") == "A", q).when(F.col("l_returnflag") == "R", -q).otherwise(0.0)),
        "trust_net": F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(-q)),
        "buy": F.sum(F.when(F.col("l_returnflag") == "N", q).otherwise(0.0)),
        "short": F.sum(F.when(F.col("l_linenumber") % 2 == 0, q).otherwise(0.0)),
    }


def _balances() -> list[Column]:
    return [F.sum(F.col(x)).over(running()).alias(name) for x, name in (("buy", "margin_balance"), ("short", "short_balance"))]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and ship date: open, high, low, close, volume, amount."""
    return _days(spark, sf_dir, _bar())


BARS = """bars AS (SELECT l_suppkey AS stock_id, l_shipdate AS date,
 first(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS open, max(px) AS high, min(px) AS low,
 last(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS close, sum(l_quantity) AS volume, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS amount
 FROM (SELECT *, l_extendedprice / l_quantity AS px FROM lineitem) GROUP BY ALL)"""


def index_bars(prices: DataFrame) -> DataFrame:
    """One row per date: the mean close of all entities, at four decimals so that its sum is exact."""
    return prices.groupBy("date").agg((F.sum(F.floor(F.col("close") * 10000).cast("long")) / F.count("*") / 10000).alias("close"))


INDEX = "idx AS (SELECT date, sum(floor(close * 10000)::BIGINT)::DOUBLE / count(*) / 10000 AS close FROM bars GROUP BY date)"


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and ship date: signed flows by return flag and line status, and running balances."""
    return _days(spark, sf_dir, _flow()).select("stock_id", "date", "foreign_net", "trust_net", *_balances())


def bars_with_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars and flows of one pass over the lines, as their join by supplier and date; a row without either key has no flows."""
    both = _days(spark, sf_dir, _bar() | _flow()).select("stock_id", "date", *_bar(), "foreign_net", "trust_net", *_balances())
    there = F.col("stock_id").isNotNull() & F.col("date").isNotNull()
    return both.withColumns({c: F.when(there, F.col(c)) for c in ("foreign_net", "trust_net", "margin_balance", "short_balance")})


FLOWS = """flows AS (SELECT stock_id, date, foreign_net, trust_net, sum(buy) OVER w AS margin_balance, sum(short) OVER w AS short_balance FROM (
 SELECT l_suppkey AS stock_id, l_shipdate AS date,
 sum(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'R' THEN -l_quantity ELSE 0 END) AS foreign_net, sum(CASE l_linestatus WHEN 'O' THEN l_quantity ELSE -l_quantity END) AS trust_net,
 sum(CASE l_returnflag WHEN 'N' THEN l_quantity ELSE 0 END) AS buy, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS short
 FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY stock_id ORDER BY date ROWS UNBOUNDED PRECEDING))"""


def revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and month, announced on the tenth of the next month."""
    month = F.trunc(F.col("l_shipdate"), "MM")
    monthly = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("stock_id"), month.alias("m")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )
    return monthly.select(
        "stock_id", F.date_add(F.add_months("m", 1), 9).cast("timestamp_ntz").alias("announce_date"), "revenue", F.month("m").alias("revenue_month"), F.year("m").alias("revenue_year")
    )


REVENUE = """rev AS (SELECT stock_id, (m + INTERVAL 1 MONTH + INTERVAL 9 DAY)::TIMESTAMP AS announce_date, revenue, month(m)::INT AS revenue_month, year(m)::INT AS revenue_year FROM (
 SELECT l_suppkey AS stock_id, date_trunc('month', l_shipdate) AS m, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue FROM lineitem GROUP BY ALL))"""


def actions(prices: DataFrame, move: float = 0.6) -> DataFrame:
    """Entity-days whose close moved by more than `move`: ratio of the close to the previous one."""
    before = F.lag("close").over(line())
    return prices.select("stock_id", "date", F.try_divide("close", before).alias("ratio")).where(F.abs(F.col("ratio") - 1) > move)


ACTIONS = """ca AS (SELECT stock_id, date, ratio FROM (SELECT stock_id, date, close / lag(close) OVER (PARTITION BY stock_id ORDER BY date) AS ratio FROM bars) WHERE abs(ratio - 1) > 0.6)"""


def scores(prices: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A stand-in for a model's score: the day's rank share of the 20-bar return. Kept columns pass through."""
    moved = prices.select("stock_id", "date", *keep, (F.try_divide("close", F.lag("close", 20).over(line())) - 1).alias("ret"))
    return moved.select("stock_id", "date", *keep, rank_in_section(F.col("ret"), "ret").alias("score"))


SCORES = """score AS (SELECT stock_id, date, CASE WHEN ret IS NOT NULL THEN (rank() OVER (PARTITION BY date ORDER BY ret NULLS LAST) + (count(ret) OVER (PARTITION BY date, ret) - 1) / 2.0::DOUBLE) / count(ret) OVER (PARTITION BY date) END AS score
 FROM (SELECT stock_id, date, close / lag(close, 20) OVER (PARTITION BY stock_id ORDER BY date) - 1 AS ret FROM bars))"""
