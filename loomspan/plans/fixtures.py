"""Views of the fixture tables that stand in for sales, bars and trades, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Tables of one folder, read when asked for: t("orders")."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def daily(t: Tables) -> DataFrame:
    """Sales by item group and day: grp, day, amount, qty."""
    items = t("part").select("p_partkey", F.col("p_brand").alias("grp"))
    lines = t("lineitem").select("l_partkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice", "l_quantity")
    return lines.join(items, F.col("l_partkey") == F.col("p_partkey")).groupBy("grp", "day").agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.sum("l_quantity").alias("qty"))


DAILY = """daily AS (SELECT p_brand AS grp, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS amount, sum(l_quantity) AS qty
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def item_sales(t: Tables) -> DataFrame:
    """Sales by item and site (the supplier's nation): item, grp, site, amount, qty, lines."""
    items = t("part").select("p_partkey", F.col("p_brand").alias("grp"))
    sites = t("supplier").select("s_suppkey", F.col("s_nationkey").alias("site"))
    lines = t("lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    joined = lines.join(items, F.col("l_partkey") == F.col("p_partkey")).join(sites, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy(F.col("l_partkey").alias("item"), "grp", "site").agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.sum("l_quantity").alias("qty"), F.count("*").alias("n_lines"))


ITEM_SALES = """item_sales AS (SELECT l_partkey AS item, p_brand AS grp, s_nationkey AS site, round(sum(l_extendedprice), 2) AS amount, sum(l_quantity) AS qty, count(*) AS n_lines
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)"""


def bars(t: Tables, minutes: int = 360) -> DataFrame:
    """Events as bars of an asset (event_type): asset, bar, open, high, low, close, volume."""
    start = F.window("ts", f"{minutes} minutes").start
    order = F.struct("ts", "event_id")
    return t("events").groupBy(F.col("event_type").alias("asset"), start.alias("bar")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume")
    )


BARS = """bars AS (SELECT event_type AS asset, time_bucket(INTERVAL '360 minutes', ts, TIMESTAMP '1970-01-01') AS bar, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
  min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2)"""


def revenue(t: Tables) -> DataFrame:
    """Orders by segment's customer nation and quarter: company, quarter, revenue, orders."""
    buyers = t("customer").select("c_custkey", F.col("c_nationkey").alias("company"))
    orders = t("orders").select("o_custkey", F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("quarter"), "o_totalprice")
    return orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).groupBy("company", "quarter").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count("*").alias("n_orders"))


REVENUE = """revenue AS (SELECT c_nationkey AS company, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""
