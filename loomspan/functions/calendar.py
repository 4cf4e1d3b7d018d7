"""French public holidays from arithmetic, and the distance of a day to the nearest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Month, day and label of the fixed holidays; fixed values.
FIXED = [(1, 1, "NEW_YEAR"), (5, 1, "LABOUR"), (5, 8, "VICTORY"), (7, 14, "NATIONAL"), (8, 15, "ASSUMPTION"), (11, 1, "ALL_SAINTS"), (11, 11, "ARMISTICE"), (12, 25, "CHRISTMAS")]
#: Days after Easter Sunday and labels of the moving ones; fixed values.
MOVING = [(1, "EASTER_MONDAY"), (39, "ASCENSION"), (50, "WHIT_MONDAY")]
NONE = -5


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by Gauss's rule in the form for all years."""
    a, b, c = year % 19, F.floor(year / 100), year % 100
    d, e = F.floor(b / 4), b % 4
    g = F.floor((8 * b + 13) / 25)
    h = (19 * a + b - d - g + 15) % 30
    i, k = F.floor(c / 4), c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 19 * l_) / 433)
    month = F.floor((h + l_ - 7 * m + 90) / 25)
    day = (h + l_ - 7 * m + 33 * month + 19) % 32
    return F.make_date(year, month.cast("int"), day.cast("int"))


def holidays(years: DataFrame) -> DataFrame:
    """year -> one row for each holiday: holiday_date, holiday."""
    fixed = [F.struct(F.make_date("year", F.lit(m), F.lit(d)).alias("holiday_date"), F.lit(n).alias("holiday")) for m, d, n in FIXED]
    moving = [F.struct(F.date_add(easter(F.col("year")), k).alias("holiday_date"), F.lit(n).alias("holiday")) for k, n in MOVING]
    return years.select(F.explode(F.array(*fixed, *moving)).alias("h")).select("h.holiday_date", "h.holiday")


def holiday_offset(days: DataFrame, day: str, span: int = 3) -> DataFrame:
    """Adds holiday_offset: how many days after (negative: before) a holiday a day is, within span; of several the
    largest, NONE if there is none. The calendar has eleven rows a year, so it is small whatever the days are."""
    years = days.select(F.year(day).alias("year")).distinct()
    years = years.select(F.explode(F.array(F.col("year") - 1, F.col("year"), F.col("year") + 1)).alias("year")).distinct()
    near = holidays(years).select(F.explode(F.sequence(F.lit(-span), F.lit(span))).alias("k"), "holiday_date")
    near = near.groupBy(F.date_add("holiday_date", F.col("k")).alias("__day")).agg(F.max("k").alias("__k"))
    return days.join(near, F.col(day) == F.col("__day"), "left").withColumn("holiday_offset", F.coalesce("__k", F.lit(NONE))).drop("__day", "__k")


def school_holidays(days: DataFrame, day: str, seasons: DataFrame) -> DataFrame:
    """Adds school_holiday, 1 within a season (first_day..last_day) and 0 outside. The calendar of seasons is a
    table of a few rows a year that the caller supplies."""
    each = seasons.select(F.explode(F.sequence("first_day", "last_day")).alias("__day")).distinct()
    return days.join(each, F.col(day) == F.col("__day"), "left").withColumn("school_holiday", F.col("__day").isNotNull().cast("int")).drop("__day")
