"""Joins with contracts and joins that are not equi-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, after a check that no key occurs twice; raises ValueError otherwise."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError(f"rows are not unique by {', '.join(keys)}")
    return df


def lookup(df: DataFrame, dim: DataFrame, on: list[str], fill: dict[str, object] | None = None) -> DataFrame:
    """Left join of a dimension that is unique by its key, with values for rows that find nothing."""
    out = df.join(assert_unique(dim, on), on, "left")
    return out.fillna(fill) if fill else out


def outer_merge(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join; columns both have are taken from a, and from b where a has none."""
    both = [c for c in a.columns if c in b.columns and c not in on]
    right = b.withColumnsRenamed({c: f"__{c}" for c in both})
    out = a.join(right, on, "outer")
    return out.withColumns({c: F.coalesce(c, f"__{c}") for c in both}).drop(*(f"__{c}" for c in both))


def asof(left: DataFrame, right: DataFrame, by: list[str], at: str, right_at: str, values: list[str]) -> DataFrame:
    """For each left row the values of the last right row of the same key at or before it. One shuffle by key:
    the rows of both are laid in one order and values carried forward."""
    l_ = left.withColumn("__side", F.lit(1)).withColumn("__at", F.col(at))
    r = right.select(*by, F.col(right_at).alias("__at"), F.struct(*values).alias("__v")).withColumn("__side", F.lit(0))
    rows = l_.unionByName(r, allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy("__at", "__side").rowsBetween(W.unboundedPreceding, 0)
    carried = rows.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__side = 1")
    return carried.select(*left.columns, *(F.col(f"__v.{v}").alias(v) for v in values))


def running_total_at(points: DataFrame, events: DataFrame, by: list[str], at: str, event_at: str, amount: str, into: str) -> DataFrame:
    """For each point the sum of all amounts of its key at or before it: a theta join as a running sum."""
    p = points.select(*by, F.col(at).alias("__at")).withColumn("__amount", F.lit(0.0)).withColumn("__side", F.lit(1))
    e = events.select(*by, F.col(event_at).alias("__at"), F.col(amount).cast("double").alias("__amount")).withColumn("__side", F.lit(0))
    w = W.partitionBy(*by).orderBy("__at", "__side").rowsBetween(W.unboundedPreceding, 0)
    return p.union(e).withColumn(into, F.sum("__amount").over(w)).where("__side = 1").select(*by, F.col("__at").alias(at), into)


def overlap(a: DataFrame, b: DataFrame, on: list[str], start: str = "lo", end: str = "hi", width: float = 1.0) -> DataFrame:
    """Pairs of intervals of one key that overlap, with the overlap's length. Intervals are dealt to buckets of
    width, so a pair meets in the buckets both touch and is kept in the first of them."""
    def dealt(df: DataFrame, side: str) -> DataFrame:
        bucket = F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))
        return df.withColumn("__bucket", bucket).withColumnsRenamed({c: f"{side}_{c}" for c in df.columns if c not in on})

    pairs = dealt(a, "a").join(dealt(b, "b"), [*on, "__bucket"])
    low, high = F.greatest(f"a_{start}", f"b_{start}"), F.least(f"a_{end}", f"b_{end}")
    return pairs.where((high > low) & (F.col("__bucket") == F.floor(low / width))).withColumn("overlap", high - low).drop("__bucket")


#: Centres that nearest() broadcasts at once.
MOST_CENTRES = 10_000


def nearest(rows: DataFrame, centres: DataFrame, distance: Column, keys: list[str], k: int) -> DataFrame:
    """The k nearest centres of each row. No more than about MOST_CENTRES are broadcast at a time; where there are more,
    the rows go over one part of them after the other, and of each part only the k nearest are kept."""
    parts = -(-centres.count() // MOST_CENTRES)
    w = W.partitionBy(*keys).orderBy("distance", *centres.columns[:1])

    def best(df: DataFrame) -> DataFrame:
        return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)

    def against(some: DataFrame) -> DataFrame:
        return best(rows.join(F.broadcast(some), F.lit(True)).withColumn("distance", distance))

    if parts <= 1:
        return against(centres)
    dealt = [centres.where(F.pmod(F.xxhash64(centres.columns[0]), F.lit(parts)) == i) for i in range(parts)]
    return best(reduce(DataFrame.union, [against(c).drop("place") for c in dealt]))
