"""Queries that run a stream to its end, and queries that write files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.plans.fixtures import BARS, DAILY, Tables, bars, daily
from loomspan.plans.registry import Registry
from loomspan.sources import files
from loomspan.sources.shared import new_path as shared
from loomspan.streaming.bars import extend, stream_bars

Q = Registry()


@Q("st1_stream_bars", "SELECT event_type AS asset, time_bucket(INTERVAL '15 minutes', ts, TIMESTAMP '1970-01-01') AS bar, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    """In append mode: a bucket leaves the state, and is written, when the watermark has passed its end. The second run
    goes on from the progress of the first and has only a row far ahead, which closes the last buckets; its own stays open."""
    table, out, progress, source = s.read.parquet(f"{d}/events.parquet"), shared(s, "stream"), shared(s, "progress"), shared(s, "events")
    last = table.agg(F.max("ts").alias("ts"))
    ahead = last.where("ts is not null").select(*(F.expr("ts + interval 2 days").alias("ts") if c == "ts" else F.lit(None).cast(t).alias(c) for c, t in table.dtypes))
    for rows in (table, ahead):
        rows.write.mode("append").parquet(source)
        bars_ = stream_bars(s.readStream.schema(table.schema).parquet(source), "event_type", "ts", "value", "event_id")
        run = bars_.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True).start(out)
        run.awaitTermination()
    return s.read.schema(bars_.schema).parquet(out)


@Q("st2_extend_bars", f"WITH {BARS} SELECT asset, bar, CASE WHEN bar < TIMESTAMP '2024-01-15' THEN close ELSE close + 1 END AS close FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = bars(Tables(s, d)).select("asset", "bar", "close")
    return extend(rows.where("bar < timestamp'2024-01-15'"), rows.withColumn("close", F.col("close") + 1), ["asset", "bar"])


@Q("snk1_table_round_trip", f"WITH {DAILY} SELECT grp, day, amount, qty FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    path, rows = shared(s, "table"), daily(Tables(s, d)).select("grp", "day", "amount", "qty")
    rows.write.parquet(path)
    return s.read.schema(rows.schema).parquet(path)


@Q("snk2_csv_round_trip", "SELECT c_custkey AS C_CUSTKEY, c_name AS NAME, c_acctbal AS C_ACCTBAL FROM customer")
def _(s: SparkSession, d: str) -> DataFrame:
    path = shared(s, "csv")
    files.write_table(Tables(s, d)("customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return files.read_table(s, path, "c_custkey bigint, c_name string, c_acctbal double", {"C_NAME": "NAME"})


@Q("src12_decimal_commas", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_retailprice AS price FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    path = shared(s, "prices")
    files.write_table(Tables(s, d)("part").select("p_partkey", F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("price")), path)
    return files.read_prices(s, path, ["price"])


@Q("src13_epoch_bars", f"WITH {BARS} SELECT bar AS at, close, volume AS trades FROM bars WHERE asset = 'purchase'")
def _(s: SparkSession, d: str) -> DataFrame:
    path = shared(s, "bars")
    rows = bars(Tables(s, d)).where("asset = 'purchase'").select(F.unix_timestamp("bar").alias("epoch"), "open", "high", "low", "close", F.lit(0.0).alias("volume"), F.col("volume").alias("trades"))
    rows.write.csv(path)
    return files.read_bars(s, [path]).select("at", "close", "trades")


@Q("src14_history_union", f"WITH {BARS} SELECT asset, bar, CASE WHEN bar < TIMESTAMP '2024-01-20' THEN close ELSE close * 2 END AS close FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = bars(Tables(s, d)).select("asset", "bar", "close")
    return files.merge_history(rows.where("bar < timestamp'2024-01-20'"), rows.withColumn("close", F.col("close") * 2).where("bar > timestamp'2024-01-10'"), ["asset", "bar"])


@Q("src16_latest_folder", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def _(s: SparkSession, d: str) -> DataFrame:
    path = shared(s, "dated")
    Tables(s, d)("orders").select("o_orderkey", "o_totalprice", F.to_date(F.date_trunc("year", "o_orderdate")).alias("date")).write.partitionBy("date").option("header", True).csv(path)
    return files.read_latest(s, path, "o_orderkey bigint, o_totalprice double, date date").select("o_orderkey", "o_totalprice")


@Q("src19_article_files", "SELECT CAST(conv_id AS VARCHAR) AS conv_id, text FROM conversations")
def _(s: SparkSession, d: str) -> DataFrame:
    path = shared(s, "articles")
    files.write_articles(Tables(s, d)("conversations").select("conv_id", "text"), path)
    return files.read_articles(s, path)


@Q("src11_typed_files", "SELECT p_partkey AS CODE, p_name AS NAME_OF_PART, p_size AS P_SIZE, p_retailprice AS PRICE FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    """Semicolons, Latin-1, headers with spaces, slashes and accents, types, and new names for some columns."""
    path = shared(s, "typed")
    rows = Tables(s, d)("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    names = ["part/key", " name of part ", "p_size", "prix (é)"]
    rows.toDF(*names).write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return files.read_table(s, path, "`part/key` bigint, ` name of part ` string, p_size int, `prix (é)` double", {"PART_KEY": "CODE", "PRIX_": "PRICE"})


@Q("src15_exchange_bars", f"WITH {BARS} SELECT asset AS pair, bar AS at_, open, high, low, close, volume::DOUBLE AS volume, volume::BIGINT AS trades FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    """An answer for each asset and day, as an exchange gives it, and the bars out of it."""
    rows = bars(Tables(s, d))
    text = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    bar = F.concat(F.lit("["), F.concat_ws(",", F.unix_timestamp("bar").cast("string"), *map(text, ("open", "high", "low", "close", "close", "volume")), F.col("volume").cast("string")), F.lit("]"))
    lists = rows.groupBy("asset", F.to_date("bar")).agg(F.array_join(F.collect_list(bar), ",").alias("l"))
    answers = lists.select(F.concat(F.lit('{"error":[],"result":{"'), "asset", F.lit('":['), "l", F.lit('],"last":1}}')).alias("answer"))
    return files.parse_bars(answers, "answer").withColumnRenamed("at", "at_")
