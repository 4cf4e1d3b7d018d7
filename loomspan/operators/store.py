"""Tables that are kept: upserts by a digest of the key, late values, columns that come later, models on file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions.scalars import key_digest


def with_key(df: DataFrame, keys: Sequence[str], into: str = "row_key") -> DataFrame:
    return df.withColumn(into, key_digest(*(F.col(k) for k in keys)))


def upsert(old: DataFrame, new: DataFrame, key: str = "row_key") -> DataFrame:
    """new, and of old what new has no key of; columns either lacks are null."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def backfill(table: DataFrame, observed: DataFrame, keys: Sequence[str], value: str, day: str, until: str) -> DataFrame:
    """table with value filled in, where it is null and the day is not after until, from observed."""
    seen = observed.select(*keys, F.col(value).alias("__seen"))
    late = F.col(value).isNull() & (F.col(day) <= F.lit(until).cast("date"))
    return table.join(seen, list(keys), "left").withColumn(value, F.when(late, F.col("__seen")).otherwise(F.col(value))).drop("__seen")


def pick_model(registry: DataFrame, wanted: DataFrame, key: str, trained: str, run: str, at: str, horizon: int) -> DataFrame:
    """For each wanted key and day the latest model trained at least horizon days before; of equal days the
    latest run."""
    both = wanted.join(registry, key).where(F.col(trained) <= F.date_sub(at, horizon))
    w = W.partitionBy(key, at).orderBy(F.desc(trained), F.desc(run))
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
