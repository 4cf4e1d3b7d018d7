"""Bars of a stream: buckets of time with late rows up to a limit, and a gate for stale data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(events: DataFrame, asset: str, at: str, value: str, order: str, width: str = "15 minutes", late: str = "30 minutes") -> DataFrame:
    """open, high, low, close, volume of each asset and bucket; rows later than late are dropped by the
    watermark. Works on streams and on tables alike."""
    place = F.struct(at, order)
    events = events.withColumn(at, F.col(at).cast("timestamp"))
    kept = events.withWatermark(at, late) if events.isStreaming else events
    grouped = kept.groupBy(F.col(asset).alias("asset"), F.window(at, width).alias("w")).agg(
        F.min_by(value, place).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, place).alias("close"), F.count("*").alias("volume")
    )
    return grouped.select("asset", F.col("w.start").alias("bar"), "open", "high", "low", "close", "volume")


def fresh(bars: DataFrame, now: str, minutes: int = 15) -> bool:
    """Whether the newest bar is not older than so many minutes at a given time."""
    last = bars.agg(F.max("bar").alias("m")).select((F.col("m") >= F.lit(now).cast("timestamp") - F.expr(f"interval {minutes} minutes")).alias("ok")).first()["ok"]
    return bool(last)


def extend(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Recomputed tail after what is kept: old rows win where both have a key."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)
