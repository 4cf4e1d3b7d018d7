"""Panels: full calendars of keys and days, and rows added or moved in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.operators.windows import fill


def densify(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """A row for every key and every day from the first to the last of all; values are null where there were
    none. The calendar is made in place of each key, so nothing is joined with it but the values."""
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    spine = df.select(*keys).distinct()
    if ends["lo"] is None:
        return df
    spine = spine.withColumn(day, F.explode(F.sequence(F.lit(ends["lo"]), F.lit(ends["hi"]))))
    return spine.join(df, [*keys, day], "left")


def business_days(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """A row for every weekday between a key's own ends, values filled from before (at the start from after)."""
    ends = df.groupBy(*keys).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    spine = ends.select(*keys, F.explode(F.sequence("__lo", "__hi")).alias(day)).where(F.weekday(day) < 5)
    full = spine.join(df, [*keys, day], "left")
    w = W.partitionBy(*keys).orderBy(day)
    forward = lambda v: F.last(v, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return full.withColumns({v: F.coalesce(forward(v), fill(F.col(v), w)) for v in values})


def horizon(df: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """df and, after each key's last day, so many days with null values."""
    more = df.groupBy(*keys).agg(F.max(day).alias("__hi"))
    more = more.select(*keys, F.explode(F.sequence(F.date_add("__hi", 1), F.date_add("__hi", days))).alias(day))
    return df.unionByName(more, allowMissingColumns=True)


def grid(keys: DataFrame, start: Column, end: Column, day: str) -> DataFrame:
    """Every key on every day of a range."""
    return keys.distinct().withColumn(day, F.explode(F.sequence(start, end)))


def zero_rows(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """df with a row of zeros on the last day of all for keys that have none then."""
    last = df.agg(F.max(day)).first()[0]
    missing = df.select(*keys).distinct().join(df.where(F.col(day) == F.lit(last)), list(keys), "left_anti")
    zeros = missing.withColumns({day: F.lit(last), **{v: F.lit(0).cast(df.schema[v].dataType) for v in values}})
    return df.unionByName(zeros, allowMissingColumns=True)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key, the first in an order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """The first k rows of each key in an order, with their place."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
