"""Panel construction and table maintenance as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import parse_number
from ..sources.panel import BARS, FLOWS, INDEX, bars, flows, index_bars, table
from ..sources.tables import keep_last, promote
from .registry import query


@query(f"WITH {BARS} SELECT * FROM bars")
def daily_bars(spark, sf_dir):
    return bars(spark, sf_dir)


@query(f"WITH {BARS}, {INDEX} SELECT date, close FROM idx")
def market_index(spark, sf_dir):
    return index_bars(bars(spark, sf_dir))


NEW = "SELECT stock_id, date, close + 1 AS close, volume FROM bars WHERE date >= TIMESTAMP '1998-01-01' UNION ALL SELECT stock_id + 1000, date, close, volume FROM bars WHERE date < TIMESTAMP '1993-01-01'"


@query(f"WITH {BARS}, n AS ({NEW}) SELECT stock_id, date, close, volume FROM n UNION ALL SELECT stock_id, date, close, volume FROM bars WHERE (stock_id, date) NOT IN (SELECT stock_id, date FROM n)")
def upsert_keep_last(spark, sf_dir):
    old = bars(spark, sf_dir).select("stock_id", "date", "close", "volume")
    new = old.where("date >= timestamp_ntz'1998-01-01 00:00:00'").withColumn("close", F.col("close") + 1)
    new = new.unionByName(old.where("date < timestamp_ntz'1993-01-01 00:00:00'").withColumn("stock_id", F.col("stock_id") + 1000))
    return keep_last([old, new], ["stock_id", "date"])


@query(f"WITH {BARS}, u AS (SELECT *, 0 AS o FROM bars WHERE stock_id <= 40 UNION ALL SELECT *, 1 FROM bars WHERE stock_id BETWEEN 30 AND 70 UNION ALL SELECT *, 2 FROM bars WHERE stock_id > 60), r AS (SELECT *, row_number() OVER (PARTITION BY stock_id, date ORDER BY o DESC) AS k FROM u) SELECT stock_id, date, open, high, low, close, volume, amount FROM r WHERE k = 1")
def merge_sources(spark, sf_dir):
    df = bars(spark, sf_dir)
    return keep_last([df.where("stock_id <= 40"), df.where("stock_id between 30 and 70"), df.where("stock_id > 60")], ["stock_id", "date"])


@query(f"WITH {BARS} SELECT date, stock_id, close, volume FROM bars WHERE stock_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) OR stock_id = 1")
def promote_filter(spark, sf_dir):
    universe = table(spark, sf_dir, "supplier").where("s_nationkey < 10").select(F.col("s_suppkey").alias("stock_id"))
    return promote(bars(spark, sf_dir), universe, ["date", "stock_id", "close", "volume"], always="1")


@query(f"WITH {BARS}, {FLOWS}, a AS (SELECT stock_id, date, close FROM bars WHERE volume > 30), b AS (SELECT stock_id, date, foreign_net FROM flows WHERE foreign_net <> 0) SELECT coalesce(a.stock_id, b.stock_id) AS stock_id, coalesce(a.date, b.date) AS date, close, foreign_net FROM a FULL JOIN b ON a.stock_id = b.stock_id AND a.date = b.date")
def outer_join_flows(spark, sf_dir):
    a = bars(spark, sf_dir).where("volume > 30").select("stock_id", "date", "close")
    b = flows(spark, sf_dir).where("foreign_net <> 0").select("stock_id", "date", "foreign_net")
    return a.join(b, ["stock_id", "date"], "outer")


@query("""SELECT o_orderkey, TRY_CAST(nullif(replace(t, ',', ''), '--') AS DOUBLE) AS parsed FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '--' WHEN o_orderkey % 7 = 0 THEN 'n/k' ELSE '1,' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') || '.5' END AS t FROM orders)""")
def parse_numeric_strings(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.when(key % 5 == 0, "--").when(key % 7 == 0, "n/k").otherwise(F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".5")))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_number(text).alias("parsed"))


@query("SELECT event_id, event_type, len(json_keys(props))::INT AS fields, list_aggregate(list_sort(json_keys(props)), 'string_agg', ',') AS names FROM events")
def event_json_props(spark, sf_dir):
    keys = F.json_object_keys("props")
    return table(spark, sf_dir, "events").select("event_id", "event_type", F.size(keys).alias("fields"), F.array_join(F.array_sort(keys), ",").alias("names"))


@query("SELECT s_suppkey AS stock_id, s_name AS stock_name, r_name AS market, n_name AS industry, (s_acctbal > 0)::INT AS is_active FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def stock_list(spark, sf_dir):
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return joined.select(F.col("s_suppkey").alias("stock_id"), F.col("s_name").alias("stock_name"), F.col("r_name").alias("market"), F.col("n_name").alias("industry"), (F.col("s_acctbal") > 0).cast("int").alias("is_active"))
