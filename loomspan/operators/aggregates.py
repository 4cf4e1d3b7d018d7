"""Aggregates with the null rules of the data they come from."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec


def total(x: Column | str) -> Column:
    """A sum that is 0 where all is null."""
    return F.coalesce(F.sum(x), F.lit(0.0))


def weighted_mean(x: Column | str, weight: Column | str) -> Column:
    """Mean of x by weight; rows without x or weight do not count."""
    x, weight = (F.col(c) if isinstance(c, str) else c for c in (x, weight))
    return F.try_divide(F.sum(x * weight), F.sum(F.when(x.isNotNull(), weight)))


def strict_median(x: Column | str) -> Column:
    """A median that is null if any value is."""
    return F.when(F.count(x) == F.count("*"), F.median(x))


def share(x: str, by: Sequence[str]) -> Column:
    """Share of x in the sum of its group."""
    return F.try_divide(F.col(x), F.sum(x).over(W.partitionBy(*by)))


def sample_skewness(x: Column | str) -> Column:
    """Skewness corrected for bias; null under three rows."""
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def correlation(x: str, y: str, frame: WindowSpec | None = None) -> Column:
    """Correlation of a group or frame; null where either does not vary. Rows without x or y do not count."""
    a, b = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    parts = F.covar_pop(a, b), F.stddev_pop(a), F.stddev_pop(b)
    together, spread_a, spread_b = (p if frame is None else p.over(frame) for p in parts)
    return F.try_divide(together, spread_a * spread_b)


def running_counts(counts: DataFrame, x: str, n: str) -> DataFrame:
    """A row for each distinct x with its count n: adds below, the sum of n of all smaller x, and __part. Rows are laid
    out in ranges and only the ranges' totals are summed in one task."""
    ranged = counts.repartitionByRange(F.col(x)).withColumn("__part", F.spark_partition_id())
    w = W.partitionBy("__part").orderBy(x).rowsBetween(W.unboundedPreceding, -1)
    inside = ranged.withColumn("__in", F.coalesce(F.sum(n).over(w), F.lit(0)))
    # one row for each partition
    order = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    base = ranged.groupBy("__part").agg(F.sum(n).alias("__t")).withColumn("__base", F.coalesce(F.sum("__t").over(order), F.lit(0))).drop("__t")
    return inside.join(F.broadcast(base), "__part").withColumn("below", F.col("__in") + F.col("__base")).drop("__in", "__base")


def quantiles(df: DataFrame, x: str, p: Sequence[float]) -> list[float]:
    """Exact quantiles of all rows, interpolated between neighbours as percentile does; no task holds all values. Nulls
    do not count; of nothing there are none."""
    counts = df.where(F.col(x).isNotNull()).groupBy(F.col(x).cast("double").alias("x")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return []
    places = [(total - 1) * q for q in p]
    ranks = sorted({int(f(k)) for k in places for f in (math.floor, math.ceil)})
    ranked = running_counts(counts, "x", "n").withColumn("rank", F.explode(F.filter(F.array(*(F.lit(k).cast("long") for k in ranks)), lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("n")))))
    at = {r["rank"]: r["x"] for r in ranked.select("rank", "x").collect()}
    return [at[int(k)] if k == int(k) else (math.ceil(k) - k) * at[math.floor(k)] + (k - math.floor(k)) * at[math.ceil(k)] for k in places]


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row, auc: the chance that a positive scores above a negative, ties half. Ranks are of distinct scores
    with their counts, summed in ranges, so no task sorts all rows."""
    counts = df.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("p"), F.sum(1 - F.col(label).cast("long")).alias("n"))
    won = F.sum(F.col("p") * (F.col("below") + F.col("n") / 2))
    return running_counts(counts, score, "n").agg((won / (F.sum("p") * F.sum("n"))).alias("auc"))


def cut_point_bins(df: DataFrame, x: str, bins: int) -> DataFrame:
    """Adds bin: how many of the bins - 1 inner quantiles of x are below it."""
    points = quantiles(df, x, [i / bins for i in range(1, bins)])
    bin_ = sum((F.when(F.col(x) > c, 1).otherwise(0) for c in points), F.lit(0))
    return df.withColumn("bin", bin_)
