"""Recurrences over ordered rows: bounded look-backs as windows, folds of one key's rows in the JVM, and lots that are
used up in order.

A fold gathers one key's rows in an array, so a key must be a series of bounded length (bars of an asset); it is not for
keys that gather a share of all rows. A look-back needs no such bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Rows that a fold works on before their results are set aside.
CHUNK = 64


def fold(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], start: Column, step: Callable[[Column, Column], Column], into: str) -> DataFrame:
    """Every row of a key with the state after it: state = step(state before, row), from start. Rows go through in
    chunks, so that what is done is copied once for a chunk and not once for a row."""
    rows = df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*order, *(c for c in columns if c not in order)))).alias("__rows"))
    nothing = F.when(F.lit(False), F.element_at("__rows", 1))
    seed = F.array(F.struct(nothing.alias("row"), start.alias("state")))
    chunks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(__rows) - 1) div {CHUNK}").cast("int")), lambda i: F.slice("__rows", i * CHUNK + 1, F.lit(CHUNK)))

    def one(done: Column, r: Column) -> Column:
        return F.concat(done, F.array(F.struct(r.alias("row"), step(F.element_at(done, -1)["state"], r).alias("state"))))

    def chunk(done: Column, some: Column) -> Column:
        last = F.element_at(F.element_at(done, -1), -1)
        return F.concat(done, F.array(F.slice(F.aggregate(some, F.array(last), one), F.lit(2), F.size(some))))

    every = F.aggregate(chunks, F.array(seed), chunk)
    done = rows.withColumn("__out", F.flatten(F.slice(every, F.lit(2), F.size(every))))
    return done.select(*by, F.explode("__out").alias("__o")).select(*by, "__o.row.*", F.col("__o.state").alias(into))


def stock_levels(df: DataFrame, by: Sequence[str], day: str, stock: str, sold: str, ordered: str, spoil: float, most: int) -> DataFrame:
    """Missing stock from the day before: max(0, max(0, stock - spoil * sold) - sold + ordered), rounded to one
    digit, for at most so many days in a row; a missing input stops it. Adds level. A missing value depends on no more
    than so many rows before it, since the last known one: a window, however long the series is."""
    w = W.partitionBy(*by).orderBy(day)
    runs = df.withColumn("__run", F.count(stock).over(w.rowsBetween(W.unboundedPreceding, 0)))
    inside = W.partitionBy(*by, "__run").orderBy(day)
    before = F.collect_list(F.struct(F.col(sold).cast("double").alias("sold"), F.col(ordered).cast("double").alias("ordered")))
    known = F.first(F.col(stock).cast("double")).over(inside.rowsBetween(W.unboundedPreceding, 0))
    rows = runs.withColumn("__place", F.row_number().over(inside)).withColumn("__known", known).withColumn("__before", before.over(inside.rowsBetween(-most, -1)))

    def step(level: Column, r: Column) -> Column:
        guess = F.greatest(F.lit(0.0), F.greatest(F.lit(0.0), level - spoil * r["sold"]) - r["sold"] + r["ordered"])
        return F.when(level.isNotNull() & r["sold"].isNotNull() & r["ordered"].isNotNull(), F.rint(guess * 10) / 10)

    level = F.when((F.col("__run") > 0) & (F.col("__place") <= most + 1), F.aggregate("__before", F.col("__known"), step))
    return rows.withColumn("level", level).drop("__run", "__place", "__known", "__before")


def order_quantity(sold: Column, sold_next: Column, stock: Column, part: float, spoil: float) -> Column:
    """What to order so that today and a part of tomorrow are covered; the last day counts a part of its own."""
    left = F.greatest(F.lit(0.0), stock - spoil * sold)
    need = sold + F.coalesce(sold_next, sold) * part
    return F.greatest(F.lit(0.0), F.rint(F.round(need - left, 6))) + 0.0


def trades(df: DataFrame, by: Sequence[str], at: str, price: str, buy: Callable[[Column, Column], Column], sell: Callable[[Column, Column], Column], fee: float, cash: float) -> DataFrame:
    """A position that is all cash or all coins: buy(row, state) and sell(row, state) decide; fee is taken from
    what moves. Adds cash, coins, paid and action (-1, 0, 1)."""
    start = F.struct(F.lit(cash).alias("cash"), F.lit(0.0).alias("coins"), F.lit(None).cast("double").alias("paid"), F.lit(0).alias("action"))

    def step(s: Column, r: Column) -> Column:
        p = r[price]
        buys = (s["coins"] == 0) & F.coalesce(buy(r, s), F.lit(False))
        sells = (s["coins"] > 0) & F.coalesce(sell(r, s), F.lit(False))
        return F.struct(
            F.when(buys, 0.0).when(sells, s["coins"] * p * (1 - fee)).otherwise(s["cash"]).alias("cash"),
            F.when(buys, s["cash"] * (1 - fee) / p).when(sells, 0.0).otherwise(s["coins"]).alias("coins"),
            F.when(buys, p).when(sells, F.lit(None)).otherwise(s["paid"]).cast("double").alias("paid"),
            F.when(buys, 1).when(sells, -1).otherwise(0).alias("action"),
        )

    columns = [c for c in df.columns if c not in (*by, at)]
    return fold(df, by, [at], columns, start, step, "__s").select("*", "__s.*").drop("__s")


def fifo(buys: DataFrame, sells: DataFrame, asset: str, order: Sequence[str], qty: str, price: str) -> DataFrame:
    """Which sale uses up which lot, first in first out: asset, buy_id, sell_id, qty, margin. Both sides are laid
    end to end by running sums, and what overlaps is a match."""
    def laid(df: DataFrame, side: str) -> DataFrame:
        w = W.partitionBy(asset).orderBy(*order)
        hi = F.round(F.sum(qty).over(w.rowsBetween(W.unboundedPreceding, 0)), 6)
        return df.withColumn("hi", hi).withColumn("lo", F.round(F.col("hi") - F.col(qty), 6)).select(asset, F.col(order[-1]).alias(f"{side}_id"), "lo", "hi", F.col(price).alias("price"))

    from loomspan.operators.joins import overlap

    # buckets as wide as a usual lot, so that an interval touches a few
    width = buys.agg(F.avg(qty)).first()[0] or 1.0
    both = overlap(laid(buys, "buy"), laid(sells, "sell"), [asset], width=float(width))
    return both.select(asset, F.col("a_buy_id").alias("buy_id"), F.col("b_sell_id").alias("sell_id"), F.round("overlap", 6).alias("qty"), F.round(F.col("overlap") * (F.col("b_price") - F.col("a_price")), 4).alias("margin"))
