"""Composite operators of replenishment: prices repaired, forecasts split and joined, availability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from loomspan.functions.scalars import half_even, only_between, ratio
from loomspan.operators.aggregates import strict_median
from loomspan.operators.recurrences import order_quantity, stock_levels
from loomspan.operators.windows import centred, fill, ordered, quantile


#: Days around a price that smooth it, and how far off a price deduced from sales may be in the median.
SMOOTH_DAYS, CLOSE = 20, 0.08


def sales_prices(sales: DataFrame, item: str, day: str, price: str) -> DataFrame:
    """item, day, deduced: the median price of an item's sales that day if plausible, smoothed over the days around it, and
    filled from after, then from before."""
    w = ordered([item], [day])
    each = sales.groupBy(item, day).agg(F.median(price).alias("__p"))
    smooth = each.withColumn("__s", quantile(only_between(F.col("__p"), 0.1, 60), 0.5, centred(w, SMOOTH_DAYS)))
    return smooth.select(item, day, only_between(fill(F.col("__s"), w), 0.1, 60).alias("deduced"))


def repair_prices(df: DataFrame, sales: DataFrame, item: str, group: str, site: str, day: str, price: str) -> DataFrame:
    """A price for every row, from the prices of orders (price, null where nothing was ordered) and of sales (item, day,
    deduced): the median of the plausible ones of SMOOTH_DAYS rows around it at the site; else the item's median that day;
    else the item's. Before the first order, items whose prices from sales are CLOSE to that take those. What is still
    missing takes the price from sales, which is the item's median unless it is within half and twice of that; else the
    group's median. Rounded to two digits. Adds repaired."""
    ends = df.where(F.col(price).isNotNull()).agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    near = quantile(only_between(F.col(price), 0.1, 60), 0.5, centred(ordered([item, site], [day]), SMOOTH_DAYS))
    rows = df.withColumn("__r", near)
    rows = rows.join(rows.groupBy(item, day).agg(F.median("__r").alias("__d")), [item, day]).withColumn("__r", F.coalesce("__r", "__d"))
    rows = rows.join(sales.select(item, day, F.col("deduced").alias("__s")), [item, day], "left")
    usual = rows.groupBy(item).agg(F.median("__r").alias("__i"), F.median("__s").alias("__m"))
    rows = rows.join(usual, item).withColumn("__r", F.coalesce("__r", "__i"))
    rows = rows.withColumn("__s", F.when(F.col("__s").between(0.5 * F.col("__m"), 2 * F.col("__m")), F.col("__s")).otherwise(F.col("__m")))
    ordered_days = F.col(day).between(F.lit(ends["lo"]), F.lit(ends["hi"]))
    off = F.try_divide(F.abs(F.col("__s") - F.col("__r")), F.col("__r"))
    close = rows.where(ordered_days).groupBy(item).agg(strict_median(off).alias("__o")).select(item, (F.col("__o") <= CLOSE).alias("__close"))
    swap = (F.col(day) < F.lit(ends["lo"])) & F.col("__close")
    rows = rows.join(close, item, "left").withColumn("__r", F.coalesce(F.when(swap, F.col("__s")), F.when(F.coalesce(~swap, F.lit(True)), F.col("__r")), "__s"))
    by_group = rows.groupBy(group).agg(F.median("__r").alias("__g"))
    full = rows.join(by_group, group, "left")
    return full.withColumn("repaired", half_even(F.coalesce("__r", "__g"), 2)).drop("__r", "__d", "__s", "__i", "__m", "__close", "__g")


def fill_sold(sold: Column, w: WindowSpec) -> Column:
    """Missing sales: half of the mean of five days around and the day a week before; where one of them is missing, the
    other."""
    week, mean = F.lag(sold, 7).over(w), F.avg(sold).over(centred(w, 5))
    return F.coalesce(sold, 0.5 * (mean + week), week, mean)


def sales_to_orders(df: DataFrame, by: Sequence[str], day: str, at_base: bool, spoil: float, most: int, part: float) -> DataFrame:
    """What to order, from sold, stock and received (columns sold, stock, ordered). At a warehouse the stock is that of
    the evening, so it is the next morning's; at a store orders are noted on the day they are placed and come the next.
    Missing stock is worked out from day to day. Adds level and order."""
    w = ordered(by, [day])
    moved = F.lag("stock").over(w) if at_base else F.col("stock")
    came = F.coalesce("ordered", F.lit(0.0))
    rows = df.withColumn("sold", fill_sold(F.col("sold"), w)).withColumn("stock", moved).withColumn("ordered", came if at_base else F.lag(came).over(w))
    rows = stock_levels(rows, by, day, "stock", "sold", "ordered", spoil, most)
    want = order_quantity(F.col("sold"), F.lead("sold").over(w), F.col("level"), part, spoil)
    return rows.withColumn("order", F.when(F.col("level").isNotNull(), want))


def split_forecast(forecast: DataFrame, weights: DataFrame, parent: Sequence[str], value: str, weight: str) -> DataFrame:
    """A parent's forecast over its children by their shares of weight; parents whose weights are all zero or
    missing are split evenly. Adds part."""
    total = weights.groupBy(*parent).agg(F.sum(weight).alias("__t"), F.count("*").alias("__n"))
    shares = weights.join(total, list(parent)).withColumn("share", F.coalesce(ratio(F.col(weight), F.col("__t")), 1 / F.col("__n"))).drop("__t", "__n")
    return forecast.join(shares, list(parent)).withColumn("part", F.col(value) * F.col("share"))


def ensemble(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, weight: float = 0.5) -> DataFrame:
    """Weighted mean of two forecasts; where one is missing, the other."""
    other = b.withColumnRenamed(value, "__b")
    both = a.join(other, list(keys), "outer")
    mean = F.col(value) * weight + F.col("__b") * (1 - weight)
    return both.withColumn(value, F.coalesce(mean, value, "__b")).drop("__b")


def with_rates(df: DataFrame, rates: DataFrame, key: str, defaults: dict[str, float]) -> DataFrame:
    """A family's rates, or the defaults where it has none."""
    out = df.join(rates, key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def as_of_features(history: DataFrame, keys: Sequence[str], day: str, value: str, lags: Sequence[int], targets: DataFrame) -> DataFrame:
    """Features as they are known the day after a key's last one, for every day that is to be predicted."""
    w = ordered(keys, [day])
    last = history.groupBy(*keys).agg(F.max(day).alias("__l"))
    next_day = last.select(*keys, F.date_add("__l", 1).alias(day), F.lit(True).alias("__next"))
    rows = history.select(*keys, day, value).unionByName(next_day, allowMissingColumns=True)
    known = rows.select(*keys, "__next", *(F.lag(value, k).over(w).alias(f"lag_{k}") for k in lags)).where("__next").drop("__next")
    return targets.join(known, list(keys), "left")
