"""Frames of rows over ordered keys. All windows need an order without ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from loomspan.functions.scalars import half_even


def ordered(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*by).orderBy(*order)


def trailing(w: WindowSpec, n: int, end: int = 0) -> WindowSpec:
    """The n rows that end so many rows before the current one."""
    return w.rowsBetween(-(n - 1) - end, -end)


def centred(w: WindowSpec, n: int) -> WindowSpec:
    """n rows around the current one; of an even n one more before than after."""
    return w.rowsBetween(-(n // 2), (n - 1) // 2)


def quantile(x: Column, p: float, frame: WindowSpec) -> Column:
    """Exact, interpolated between neighbours; works in moving frames."""
    return F.percentile(x, F.lit(p)).over(frame)


def complete(value: Column, x: Column, frame: WindowSpec, n: int) -> Column:
    """A frame's value only where all n rows have an x."""
    return F.when(F.count(x).over(frame) == n, value)


def fill_forward(x: Column, w: WindowSpec) -> Column:
    return F.last(x, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))


def fill_backward(x: Column, w: WindowSpec) -> Column:
    return F.first(x, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))


def fill(x: Column, w: WindowSpec) -> Column:
    """Backward first, then forward."""
    return F.coalesce(fill_backward(x, w), fill_forward(x, w))


def lag_bank(df: DataFrame, x: str, lags: Sequence[int], w: WindowSpec, prefix: str) -> DataFrame:
    """One column for each lag, in one projection over one window."""
    return df.withColumns({f"{prefix}{k}": F.lag(x, k).over(w) for k in lags})


def change(x: Column, before: Column, digits: int, low: float, high: float) -> Column:
    """Change in percent, rounded half to even and clipped."""
    raw = half_even(100 * F.try_divide(x - before, before), digits)
    return F.when(raw < low, low).when(raw > high, high).otherwise(raw)


def top_share(df: DataFrame, by: Sequence[str], share: str, p: float, tie: Sequence[str]) -> DataFrame:
    """The rows with the largest shares that together reach p, up to the one that does, and any with share > p."""
    w = W.partitionBy(*by).orderBy(F.desc(share), *tie)
    before = F.sum(share).over(w.rowsBetween(W.unboundedPreceding, -1))
    return df.withColumn("__before", F.coalesce(F.round(before, 9), F.lit(0.0))).where((F.col("__before") < p) | (F.col(share) > p)).drop("__before")


def top_lookbacks(df: DataFrame, by: Sequence[str], item: str, day: str, x: str, p: float, months: Sequence[tuple[int, float]] = ((2, 0.0), (9, 1.0), (18, 1.0))) -> DataFrame:
    """by, item: what makes up a group's x in the last so many months (each with its part of p), and, if there is more
    history, what does over all of it with a share above min(p, 0.1). An item counts while the shares before it and its
    own do not exceed 1 - p by more than a fifth of p, or if its own share exceeds p."""
    ends = df.agg(F.max(day).alias("hi"), F.min(day).alias("lo")).first()
    if ends["hi"] is None:
        return df.select(*by, item)
    looks = [(int(30.5 * m), part * p) for m, part in months]
    longest = max(days for days, _ in looks)
    every = (ends["hi"] - ends["lo"]).days
    if every > longest:
        looks.append((every, p))
    spans = F.explode(F.array(*(F.struct(F.lit(days).alias("days"), F.lit(q).alias("q")) for days, q in looks)))
    rows = df.withColumn("__l", spans).where(F.col(day) >= F.date_sub(F.lit(ends["hi"]), F.col("__l.days")))
    sums = rows.groupBy("__l", *by, item).agg(F.sum(x).alias("__x"))
    shared = sums.withColumn("__share", F.round(F.try_divide(F.col("__x"), F.sum("__x").over(W.partitionBy("__l", *by))), 9))
    w = W.partitionBy("__l", *by).orderBy(F.desc("__share"), item).rowsBetween(W.unboundedPreceding, 0)
    over = F.round(F.sum("__share").over(w), 9) - (1 - F.col("__l.q"))
    top = shared.withColumn("__over", over).where((F.round("__over", 9) <= F.round(F.col("__l.q") * 0.2, 9)) | (F.col("__share") > F.col("__l.q")))
    recent = (F.col("__l.days") <= longest) | (F.col("__share") > min(p, 0.1))
    return top.where(recent).select(*by, item).distinct()


def mean_rank(x: Column, by: Sequence[str]) -> Column:
    """Rank by descending x, ties averaged."""
    w = W.partitionBy(*by)
    return F.rank().over(w.orderBy(F.desc(x))) + (F.count("*").over(w.orderBy(F.desc(x)).rangeBetween(0, 0)) - 1) / 2
