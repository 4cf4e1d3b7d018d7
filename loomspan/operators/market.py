"""Composite operators of market series and of companies' figures."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions.scalars import ladder, ratio
from loomspan.operators.aggregates import correlation
from loomspan.operators.windows import ordered


def labels(bars: DataFrame, by: str, at: str, price: str, horizons: int, needed: int, up: float, down: float) -> DataFrame:
    """UP or DOWN where at least so many of the coming returns are beyond their own quantile of the series, and
    the last return is beyond the other side. Adds label."""
    w, p = ordered([by], [at]), F.col(price)
    rets = {f"__r{k}": F.lead(p, k).over(w) / p - 1 for k in range(1, horizons + 1)}
    rows = bars.withColumns(rets).withColumn("__past", p / F.lag(p).over(w) - 1)
    names = [*rets, "__past"]
    cuts = rows.groupBy(by).agg(*(F.percentile(c, q).alias(f"{c}_{side}") for c in names for side, q in (("hi", up), ("lo", down))))
    full = rows.join(cuts, by)
    n_up = sum((F.coalesce((F.col(c) >= F.col(f"{c}_hi")).cast("int"), F.lit(0)) for c in rets), F.lit(0))
    n_down = sum((F.coalesce((F.col(c) <= F.col(f"{c}_lo")).cast("int"), F.lit(0)) for c in rets), F.lit(0))
    past_low, past_high = F.col("__past") <= F.col("__past_lo"), F.col("__past") >= F.col("__past_hi")
    label = F.when((n_up >= needed) & past_low, "UP").when((n_down >= needed) & past_high, "DOWN")
    return full.withColumn("label", label).select(*bars.columns, "label")


def allocation(df: DataFrame, key: str, gain: str, value: str, cash: float) -> DataFrame:
    """Where new cash goes. Target shares from relative gains: 1 + 4 (p - mean), normalised, kept in 0 .. 2 / n, normalised
    again. What holds more than its target already gets nothing, the others by their targets, rounded down to whole units
    (0.4 less, then to the nearest). Adds target, actual, cash. The table holds one row for each asset, so one task sees
    them all."""
    w = W.partitionBy(F.lit(0))
    part = lambda c: ratio(F.col(c), F.sum(c).over(w))
    a = df.withColumn("__r", 1 + 4 * (F.col(gain) - F.avg(gain).over(w))).withColumn("__n", F.count("*").over(w)).withColumn("__s", part("__r"))
    b = a.withColumn("__c", F.greatest(F.least("__s", 2 / F.col("__n")), F.lit(0.0))).withColumn("target", part("__c")).withColumn("actual", part(value))
    c = b.withColumn("__w", F.when(F.col("actual") > F.col("target"), 0.0).otherwise(F.col("target")))
    return c.withColumn("cash", F.rint(F.round(cash * part("__w") - 0.4, 6)) + 0.0).drop("__r", "__n", "__s", "__c", "__w")


def indices(df: DataFrame, at: str, sector: str, x: str) -> DataFrame:
    """Equal-weight means by sector and of all (sector null)."""
    each = df.groupBy(at, sector).agg(F.avg(x).alias("level"), F.count("*").alias("n"))
    every = df.groupBy(at).agg(F.avg(x).alias("level"), F.count("*").alias("n"))
    return each.unionByName(every, allowMissingColumns=True)


def temporal_folds(df: DataFrame, day: str, first: str, folds: int, days: int) -> DataFrame:
    """Rows with the fold in which they are tested; folds follow each other, days long."""
    fold = F.floor(F.datediff(day, F.lit(first).cast("date")) / days)
    return df.withColumn("fold", fold.cast("int")).where((F.col("fold") >= 0) & (F.col("fold") < folds))


def order_check(df: DataFrame, side: str, price: str, bid: str, ask: str, volume: str, least: float) -> DataFrame:
    """Limit prices of orders and whether they are sent: close to the market and large enough. Nothing is close to a price
    of zero, so such orders are not sent."""
    limit = F.when(F.col(side) == "buy", F.least(F.col(bid), F.col(price) * 0.9975)).otherwise(F.greatest(F.col(ask), F.col(price) * 1.002))
    close = F.when(F.col(price) == 0, F.lit(False)).otherwise(F.abs(limit - F.col(price)) / F.col(price) <= 0.015)
    return df.withColumn("limit_price", limit).withColumn("sent", close & (F.col(volume) >= least))


def simulate(series: DataFrame, sector: str, asset: str, at: str, x: str, rounds: int, seed: int, top: int = 5) -> DataFrame:
    """So many portfolios of one asset from each sector, drawn from its top ones by gain over spread: draw, gain (in
    percent of the start), spread of the portfolio's level, and the mean correlation of its assets. A draw is an MD5 of
    sector, draw and seed, so a run can be repeated. Levels start at 100; what a portfolio does follows from the
    covariances of its assets, so series are read once and not for each draw."""
    w = W.partitionBy(asset).orderBy(at)
    levels = series.select(sector, asset, at, (100 * F.col(x) / F.first(x).over(w)).alias("v"))
    each = levels.groupBy(sector, asset).agg((F.max_by("v", at) - 100).alias("gain"), F.stddev_samp("v").alias("spread"))
    place = F.row_number().over(W.partitionBy(sector).orderBy(F.desc(F.round(ratio(F.col("gain"), F.col("spread")), 6)), asset))
    best = each.withColumn("place", place).where(F.col("place") <= top).select(sector, asset, "place", "gain")
    kept = levels.join(best.select(asset), asset, "left_semi").select(asset, at, "v")
    two = kept.join(kept.select(F.col(asset).alias("other"), at, F.col("v").alias("u")), at)
    pairs = two.groupBy(asset, "other").agg(F.covar_samp("v", "u").alias("cov"), correlation("v", "u").alias("corr"))
    sizes = best.groupBy(sector).agg(F.count("*").alias("n")).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    name = F.concat_ws(":", F.col(sector).cast("string"), F.col("draw").cast("string"), F.lit(str(seed)))
    drawn = sizes.select(sector, "draw", (F.pmod(F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("long"), F.col("n")) + 1).alias("place"))
    picked = drawn.join(best, [sector, "place"]).select("draw", asset, "gain")
    both = picked.join(picked.select("draw", F.col(asset).alias("other")), "draw").join(pairs, [asset, "other"])
    apart = F.when(F.col(asset) != F.col("other"), F.col("corr"))
    risk = both.groupBy("draw").agg(F.sqrt(F.avg("cov")).alias("spread"), F.avg(apart).alias("correlation"))
    return picked.groupBy("draw").agg(F.avg("gain").alias("gain")).join(risk, "draw")


def macro_joins(rows: DataFrame, rates: dict[str, tuple[DataFrame, dict]], country: str, company: str, month: str, rate: str) -> DataFrame:
    """One column for each table of rates, by country and month. A table may have its own list of countries that take
    another one's rates. What is missing is filled within the country from before, then from after, in the order of
    company and month."""
    out = rows
    for name, (table, swap) in rates.items():
        pairs = F.create_map(*(F.lit(x) for pair in swap.items() for x in pair)) if swap else None
        own = F.col(country) if pairs is None else F.coalesce(pairs[F.col(country)].cast(rows.schema[country].dataType), F.col(country))
        listed = table.select(F.col(country).alias("__c"), month, F.col(rate).alias(name))
        out = out.withColumn("__c", own).join(listed, ["__c", month], "left").drop("__c")
    w = ordered([country], [company, month])
    forward, back = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(forward), F.first(c, ignorenulls=True).over(back)) for c in rates})


def wide_features(rows: DataFrame, at: str, key: str, x: str, keys: Sequence[str], n: int) -> DataFrame:
    """A row for each time with the x of each key, filled from before and then from after, and for each the spread of the
    last n rows (_std) and how far it is from their mean (_off). One task sees the calendar."""
    wide = rows.groupBy(at).pivot(key, list(keys)).agg(F.max(x))
    w = W.orderBy(at)
    forward, back = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    full = wide.select(at, *(F.coalesce(F.last(c, ignorenulls=True).over(forward), F.first(c, ignorenulls=True).over(back)).alias(c) for c in keys))
    near = w.rowsBetween(-(n - 1), 0)
    features = [f for c in keys for f in (F.round(F.stddev_samp(c).over(near), 6).alias(f"{c}_std"), F.round(F.col(c) / F.avg(c).over(near) - 1, 6).alias(f"{c}_off"))]
    return full.select(at, *keys, *features)


def trailing_sum(df: DataFrame, by: Sequence[str], quarter: str, x: str, into: str) -> DataFrame:
    """Sum of four quarters that follow each other; null where one is missing."""
    w = ordered(by, [quarter]).rowsBetween(-3, 0)
    whole = (F.count(x).over(w) == 4) & (F.min(quarter).over(w) == F.add_months(quarter, -9))
    return df.withColumn(into, F.when(whole, F.sum(x).over(w)))


def year_on_year(df: DataFrame, by: Sequence[str], quarter: str, x: str, into: str) -> DataFrame:
    """Change on the same quarter a year before, over 0.1 + |before|; matched by date."""
    before = df.select(*by, F.add_months(quarter, 12).alias(quarter), F.col(x).alias("__b"))
    return df.join(before, [*by, quarter], "left").withColumn(into, (F.col(x) - F.col("__b")) / (0.1 + F.abs("__b"))).drop("__b")


#: Rows of a sector that are compared in one piece of work, about.
NEAR_BLOCK = 2000


def neighbours(df: DataFrame, key: str, sector: str, vector: str, k: int, least: float) -> DataFrame:
    """The k most similar of the same sector (cosine, rounded to six digits, at least least) with weights: key, other,
    weight, place. A sector is cut into blocks, and a piece of work holds two blocks and returns the k best of each row,
    never all pairs. Zero vectors and nulls have no neighbours."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    sizes = df.groupBy(sector).agg(F.ceil(F.count("*") / NEAR_BLOCK).cast("int").alias("__n"))
    rows = df.select(sector, key, F.transform(vector, lambda x: x.cast("double")).alias("__v")).join(sizes, sector).withColumn("__b", F.pmod(F.xxhash64(key), "__n").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    # new columns on both sides, which else are the same to the planner
    left = rows.select(F.col(sector).alias("__s"), F.col("__b").alias("__i"), every.alias("__j"), F.col(key).alias("__k"), F.concat("__v").alias("__x"))
    right = rows.select(F.col(sector).alias("__t"), every.alias("__k1"), F.col("__b").alias("__k2"), F.col(key).alias("__k"), F.concat("__v").alias("__x"))

    def unit(some: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        rows = [(i, np.asarray(v, float)) for i, v in zip(some["__k"], some["__x"], strict=True) if v is not None]
        rows = [(i, v / np.linalg.norm(v)) for i, v in rows if np.linalg.norm(v) > 0]
        return np.array([i for i, _ in rows]), np.array([v for _, v in rows]).reshape(len(rows), -1)

    def best(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        (a, x), (b, y) = unit(mine), unit(theirs)
        out = []
        if len(a) and len(b):
            for i, row in enumerate(np.round(x @ y.T, 6) + 0.0):
                ok = np.flatnonzero((row >= least) & (b != a[i]))
                ok = ok[np.lexsort((b[ok], -row[ok]))][:k]
                out += [(a[i], b[j], row[j]) for j in ok]
        return pd.DataFrame(out, columns=[key, "other", "weight"])

    near = left.groupBy("__s", "__i", "__j").cogroup(right.groupBy("__t", "__k1", "__k2")).applyInPandas(best, f"`{key}` {types[key]}, other {types[key]}, weight double")
    w = W.partitionBy(key).orderBy(F.desc("weight"), "other")
    return near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def peer_gap(df: DataFrame, near: DataFrame, key: str, x: str) -> DataFrame:
    """A figure against the weighted mean of a company's neighbours, clipped to -1..10. Adds peer, gap."""
    values = df.select(F.col(key).alias("other"), F.col(x).alias("__x"))
    peer = near.join(values, "other").groupBy(key).agg((F.sum(F.col("__x") * F.col("weight")) / F.sum("weight")).alias("peer"))
    gap = ratio(F.col(x) - F.col("peer"), F.col("peer"))
    return df.join(peer, key, "left").withColumn("gap", F.when(gap < -1, -1.0).when(gap > 10, 10.0).otherwise(gap))


def trend(df: DataFrame, by: Sequence[str], period: str, x: str) -> Column:
    """Slope of x over the periods up to this one, in percent of the first; null for one period, or if the first is 0."""
    w = ordered(by, [period]).rowsBetween(W.unboundedPreceding, 0)
    return F.when(F.count(x).over(w) > 1, 100 * ratio(F.regr_slope(F.col(x), F.col(period)).over(w), F.first(x, ignorenulls=True).over(w)))


def balance_kpis(df: DataFrame, by: Sequence[str], period: str) -> DataFrame:
    """Ratios of balance sheets and their trends. Columns: assets, liabilities, current_assets, current_liabilities,
    receivables, debt, goodwill; without current ones the totals count."""
    current = ratio(F.coalesce("current_assets", "assets"), F.coalesce("current_liabilities", "liabilities"))
    rows = df.withColumn("current_ratio", 100 * current).withColumn("equity", F.col("assets") - F.col("liabilities"))
    return rows.withColumns({
        "assets_to_liabilities": 100 * ratio(F.col("assets"), F.col("liabilities")), "cash_to_debt": 100 * ratio(F.col("receivables"), F.col("debt")), "goodwill_share": 100 * ratio(F.col("goodwill"), F.col("assets")),
        "current_trend": trend(rows, by, period, "current_ratio"), "equity_trend": trend(rows, by, period, "equity"),
    })


def cash_kpis(df: DataFrame, by: Sequence[str], period: str) -> DataFrame:
    """What becomes of the cash from operations. Columns: operating, spent (a fifth of operating where a company states
    none at all), acquired, stock, dividends, financing."""
    company = W.partitionBy(*by)
    spent = F.when(F.count("spent").over(company) == 0, 0.2 * F.col("operating")).otherwise(F.col("spent"))
    rows = df.withColumn("spent", spent).withColumn("free", F.col("operating") + F.col("spent"))
    part = lambda x: 100 * ratio(x, F.col("operating"))
    return rows.withColumns({
        "into_activity": part(F.abs("spent")), "into_acquisition": part(F.col("acquired")), "into_stock": part(F.col("stock")), "into_dividends": part(F.col("dividends")), "from_finance": part(F.col("financing")),
        "free_mean": F.avg("free").over(company), "operating_trend": trend(rows, by, period, "operating"), "free_trend": trend(rows, by, period, "free"),
    })


def income_kpis(df: DataFrame, by: Sequence[str], period: str) -> DataFrame:
    """Margins, changes on one and two periods before over 0.1 + |before|, and trends. Columns: revenue, net, operating,
    sales_cost, research."""
    w = ordered(by, [period])
    change = lambda c, k: 100 * (F.col(c) - F.lag(c, k).over(w)) / (0.1 + F.abs(F.lag(c, k).over(w)))
    both = F.col("research") + F.col("operating")
    rows = df.withColumn("sales_share", ratio(F.col("sales_cost"), F.col("revenue"))).withColumn("research_share", F.when(both == 0, 1.0).otherwise(ratio(F.col("research"), both)))
    kept = ["revenue", "net", "operating"]
    out = rows.withColumns({
        "margin": 100 * F.col("net") / (F.col("revenue") + 0.01), "taxes": 100 * ratio(F.col("operating") - F.col("net"), F.col("revenue")), "research_yoy": change("research", 1),
        **{f"{c}_yoy": change(c, 1) for c in kept}, **{f"{c}_yo2y": change(c, 2) for c in kept}, **{f"{c}_trend": trend(rows, by, period, c) for c in [*kept, "sales_share", "research_share"]},
    })
    return out.withColumn("operating_to_revenue_trend", ratio(F.col("operating_trend"), F.col("revenue_trend")))


#: Points of the scorecard: of each measure the first step that holds counts; fixed values.
LADDERS = {
    "revenue_trend": [(">", 50, 4), (">", 30, 3), (">", 10, 2), ("<", 0, -2)],
    "net_trend": [(">", 50, 4), (">", 30, 3), (">", 10, 2), ("<", 0, -2)],
    "revenue_yoy": [(">", 50, 3), (">", 30, 2), (">", 10, 1)],
    "operating_to_revenue_trend": [(">", 20, 2), (">", 10, 1)],
    "net_yoy": [(">", 50, 2), (">", 30, 1), (">", 10, 0.5)],
    "research_yoy": [(">", 30, 3), (">", 20, 2), (">", 10, 1)],
    "predicted_pe_gap": [(">", 10, 6), (">", 5, 4), (">", 2, 1)],
    "forward_pe_gap": [("<=", -10, 6), ("<=", -5, 4), ("<", -3, 1)],
    "cap_to_intrinsic": [("<", 30, 8), ("<", 50, 4), ("<", 75, 3), ("<", 100, 2), ("<", 200, 1), (">", 500, -2)],
    "rating": [(">", 3, 2), (">", 2.5, 1)],
    "goodwill_share": [(">", 50, 2), (">", 30, 1.5), (">", 10, 1)],
    "into_acquisition": [(">", 50, 2), (">", 30, 1.5), (">", 10, 1)],
    "into_activity": [(">", 50, 2), (">", 30, 1.5), (">", 10, 1)],
    "equity_trend": [(">", 50, 2), (">", 30, 1.5), (">", 10, 1), ("<", 0, -1)],
    "current_ratio": [(">", 250, 2), (">", 200, 1.5), (">", 150, 1)],
    "pe_distance": [("<", -0.3, 2), ("<", 0, 1)],
    "margin_distance": [(">", 1, 2), (">", 0.5, 1)],
    "revenue_yoy_distance": [(">", 1, 2), (">", 0.5, 1)],
}
#: The year's change of the stock below so much of that of income, and the points for it; fixed values.
STOCK_BEHIND = [(0.7, 3), (0.9, 2), (1.0, 1)]


def business_score(stock_year: str = "stock_year", income_year: str = "net_yoy") -> Column:
    """Points of all ladders; a measure that is null has none."""
    hold = {">": lambda c, v: F.col(c) > v, "<": lambda c, v: F.col(c) < v, "<=": lambda c, v: F.col(c) <= v}
    ladders = [ladder([(hold[op](c, v), float(points)) for op, v, points in steps], 0.0) for c, steps in LADDERS.items()]
    behind = ladder([(F.col(stock_year) < part * F.col(income_year), float(points)) for part, points in STOCK_BEHIND], 0.0)
    return sum(ladders, behind)


def scorecard(rules: Sequence[tuple[Column, float]]) -> Column:
    """Sum of the points of the rules that hold."""
    return sum((F.when(c, F.lit(v)).otherwise(F.lit(0.0)) for c, v in rules), F.lit(0.0))
