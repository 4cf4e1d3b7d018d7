"""Queries over window frames, sorting, sets, reshaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from loomspan.functions import calendar
from loomspan.functions import scalars as fx
from loomspan.operators import panel, store, text
from loomspan.operators.aggregates import correlation
from loomspan.operators import windows as win
from loomspan.plans.fixtures import BARS, DAILY, ITEM_SALES, REVENUE, Tables, bars, daily, item_sales, revenue
from loomspan.plans.registry import Registry

Q = Registry()
OVER = "(PARTITION BY grp ORDER BY day)"


def by_group() -> WindowSpec:
    return win.ordered(["grp"], ["day"])


def by_bar() -> WindowSpec:
    return win.ordered(["asset"], ["bar"])


def amount() -> Column:
    return F.col("amount")


def close() -> Column:
    return F.col("close")


def frame(a: int, b: int) -> str:
    side = lambda k: f"{abs(k)} {'PRECEDING' if k < 0 else 'FOLLOWING'}" if k else "CURRENT ROW"
    return f"(PARTITION BY grp ORDER BY day ROWS BETWEEN {side(a)} AND {side(b)})"


@Q("w1_centred_median", f"WITH {DAILY} SELECT grp, day, median(amount) OVER {frame(-10, 9)} AS m20, median(amount) OVER {frame(-3, 3)} AS m7 FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).select("grp", "day", win.quantile(amount(), 0.5, win.centred(by_group(), 20)).alias("m20"), win.quantile(amount(), 0.5, win.centred(by_group(), 7)).alias("m7"))


GAPS = f"{DAILY}, gaps AS (SELECT grp, day, CASE WHEN dayofmonth(day) % 4 > 0 THEN amount END AS amount FROM daily)"


def gaps(t: Tables) -> DataFrame:
    return daily(t).select("grp", "day", F.when(F.dayofmonth("day") % 4 > 0, amount()).alias("amount"))


@Q("w2_fill_both_ways", f"""WITH {GAPS} SELECT grp, day, coalesce(first_value(amount IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(amount IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS amount FROM gaps""")
def _(s: SparkSession, d: str) -> DataFrame:
    return gaps(Tables(s, d)).select("grp", "day", win.fill(amount(), by_group()).alias("amount"))


@Q("w3_price_change_lags", f"WITH {DAILY} SELECT grp, day, " + ", ".join(f"CASE WHEN lag(amount, {k}) OVER {OVER} IS NOT NULL THEN greatest(-100, least(300, round_even(100 * ((amount - lag(amount, {k}) OVER {OVER}) / nullif(lag(amount, {k}) OVER {OVER}, 0)) * 100.0::DOUBLE, 0) / 100.0::DOUBLE + 0.0)) END AS change_{k}" for k in (7, 30, 365)) + " FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).select("grp", "day", *(win.change(amount(), F.lag(amount(), k).over(by_group()), 2, -100.0, 300.0).alias(f"change_{k}") for k in (7, 30, 365)))


@Q("w4_lag_bank", f"""WITH {DAILY} SELECT grp, day, {', '.join(f'lag(amount, {k}) OVER {OVER} AS lag_{k}' for k in range(2, 9))}, round(avg(amount) OVER {frame(-8, -2)}, 6) AS lag_mean, round(stddev_samp(amount) OVER {frame(-8, -2)}, 4) AS lag_std,
  CASE WHEN lag(amount, 7) OVER {OVER} IS NOT NULL THEN greatest(-1, least(1, lag(amount, 2) OVER {OVER} / nullif(lag(amount, 7) OVER {OVER}, 0) - 1)) END AS trend FROM daily""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = win.lag_bank(daily(Tables(s, d)).select("grp", "day", "amount"), "amount", range(2, 9), by_group(), "lag_")
    f = win.trailing(by_group(), 7, 2)
    trend = fx.ratio(F.lag(amount(), 2).over(by_group()), F.lag(amount(), 7).over(by_group())) - 1
    return rows.withColumns({"lag_mean": F.round(F.avg(amount()).over(f), 6), "lag_std": F.round(F.stddev_samp(amount()).over(f), 4), "trend": fx.clip(trend, -1.0, 1.0)}).drop("amount")


@Q("w5_rolling_mean_full", f"WITH {GAPS}, x AS (SELECT grp, day, lag(amount, 2) OVER {OVER} AS v FROM gaps) SELECT grp, day, CASE WHEN count(v) OVER {frame(-2, 0)} = 3 THEN round(avg(v) OVER {frame(-2, 0)}, 6) END AS m FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows, f = gaps(Tables(s, d)).select("grp", "day", F.lag(amount(), 2).over(by_group()).alias("v")), win.trailing(by_group(), 3)
    return rows.select("grp", "day", win.complete(F.round(F.avg("v").over(f), 6), F.col("v"), f, 3).alias("m"))


@Q("w6_rolling_p75_ratio", f"""WITH {DAILY}, x AS (SELECT grp, day, CASE WHEN count(amount) OVER {frame(-27, 0)} = 28 THEN quantile_cont(amount, 0.75) OVER {frame(-27, 0)} END AS p FROM daily),
  r AS (SELECT grp, day, p / lag(p, 7) OVER {OVER} AS r7, p / lag(p, 30) OVER {OVER} AS r30 FROM x) SELECT grp, day, lag(r7, 2) OVER {OVER} AS r7, lag(r30, 2) OVER {OVER} AS r30 FROM r""")
def _(s: SparkSession, d: str) -> DataFrame:
    f = win.trailing(by_group(), 28)
    rows = daily(Tables(s, d)).select("grp", "day", win.complete(win.quantile(amount(), 0.75, f), amount(), f, 28).alias("p"))
    rows = rows.select("grp", "day", *(fx.ratio(F.col("p"), F.lag("p", k).over(by_group())).alias(f"r{k}") for k in (7, 30)))
    return rows.select("grp", "day", *(F.lag(c, 2).over(by_group()).alias(c) for c in ("r7", "r30")))


@Q("w7_trailing_mean", f"WITH {DAILY} SELECT grp, day, round(avg(amount) OVER {frame(-13, 0)}, 6) AS m FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).select("grp", "day", F.round(F.avg(amount()).over(win.trailing(by_group(), 14)), 6).alias("m"))


@Q("w8_trailing_median_nonzero", f"WITH {DAILY}, x AS (SELECT grp, day, CASE WHEN amount > 20000 THEN amount ELSE 0 END AS v FROM daily) SELECT grp, day, median(v) OVER {frame(-27, 0)} AS med, round(avg(nullif(v, 0)) OVER {frame(-27, 0)}, 6) AS mean FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows, f = daily(Tables(s, d)).select("grp", "day", F.when(amount() > 20000, amount()).otherwise(0.0).alias("v")), win.trailing(by_group(), 28)
    return rows.select("grp", "day", win.quantile(F.col("v"), 0.5, f).alias("med"), F.round(F.avg(F.nullif(F.col("v"), F.lit(0.0))).over(f), 6).alias("mean"))


@Q("w9_smoothed_lags", f"WITH {DAILY}, x AS (SELECT *, median(amount) OVER {frame(-3, 3)} AS v FROM daily) SELECT grp, day, lag(v, 4) OVER {OVER} AS v4, round(avg(v) OVER {frame(-10, -4)}, 6) AS m7, round(avg(v) OVER {frame(-31, -4)}, 6) AS m28 FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).withColumn("v", win.quantile(amount(), 0.5, win.centred(by_group(), 7)))
    return rows.select("grp", "day", F.lag("v", 4).over(by_group()).alias("v4"), *(F.round(F.avg("v").over(win.trailing(by_group(), n, 4)), 6).alias(f"m{n}") for n in (7, 28)))


@Q("w10_price_lag", f"WITH {DAILY} SELECT grp, day, lag(amount / qty, 3) OVER {OVER} AS price FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).select("grp", "day", F.lag(fx.ratio(amount(), F.col("qty")), 3).over(by_group()).alias("price"))


@Q("w11_recency_weight", f"WITH {DAILY} SELECT grp, day, round(1 / (1 + exp((datediff('day', day, max(day) OVER (PARTITION BY grp)) - 365) / 60.0)), 8) AS weight FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d))
    last = rows.groupBy("grp").agg(F.max("day").alias("last"))
    return rows.join(last, "grp").select("grp", "day", F.round(fx.decay(F.datediff("last", "day"), 365, 60), 8).alias("weight"))


SHARES = f"{ITEM_SALES}, sh AS (SELECT item, grp, round(sum(amount) / sum(sum(amount)) OVER (PARTITION BY grp), 9) AS share FROM item_sales GROUP BY item, grp)"


def shares(t: Tables) -> DataFrame:
    each = item_sales(t).groupBy("item", "grp").agg(F.sum("amount").alias("v"))
    return each.select("item", "grp", F.round(fx.ratio(F.col("v"), F.sum("v").over(W.partitionBy("grp"))), 9).alias("share"))


def cumulative(p: float) -> str:
    return f"(SELECT item, grp FROM (SELECT *, coalesce(round(sum(share) OVER (PARTITION BY grp ORDER BY share DESC, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 9), 0) AS before FROM sh) WHERE before < {p} OR share > {p})"


@Q("w12_top_cumulative_share", f"WITH {SHARES} SELECT item, grp FROM {cumulative(0.6)}")
def _(s: SparkSession, d: str) -> DataFrame:
    return win.top_share(shares(Tables(s, d)), ["grp"], "share", 0.6, ["item"]).select("item", "grp")


@Q("w13_top_many_lookbacks", """WITH l AS (SELECT l_partkey AS item, p_brand AS grp, s_nationkey AS site, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS v FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
  e AS (SELECT max(day) AS hi FROM l), k AS (SELECT * FROM (VALUES (61, 0.0), (274, 0.3), (549, 0.3), (1000000, 0.3)) t(back, p)),
  q AS (SELECT back, p, grp, site, item, sum(v) AS x FROM l, e, k WHERE back = 1000000 OR day >= hi - back GROUP BY ALL),
  h AS (SELECT *, round(x / sum(x) OVER (PARTITION BY back, grp, site), 9) AS share FROM q),
  r AS (SELECT *, round(sum(share) OVER (PARTITION BY back, grp, site ORDER BY share DESC, item ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS upto FROM h)
  SELECT DISTINCT grp, site, item FROM r WHERE (round(upto - (1 - p::DOUBLE), 9) <= round(p::DOUBLE * 0.2, 9) OR share > p) AND (back < 1000000 OR share > 0.1)""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = lines.select(F.col("p_brand").alias("grp"), F.col("s_nationkey").alias("site"), F.col("l_partkey").alias("item"), F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("v"))
    return win.top_lookbacks(rows, ["grp", "site"], "item", "day", "v", 0.3)


@Q("w14_impute_cascade", f"WITH {GAPS} SELECT grp, day, round(coalesce(amount, avg(amount) OVER {frame(-2, 2)}, lag(amount, 7) OVER {OVER}), 6) AS amount FROM gaps")
def _(s: SparkSession, d: str) -> DataFrame:
    return gaps(Tables(s, d)).select("grp", "day", F.round(F.coalesce(amount(), F.avg(amount()).over(win.centred(by_group(), 5)), F.lag(amount(), 7).over(by_group())), 6).alias("amount"))


@Q("w15_redate", f"WITH {DAILY} SELECT grp, day, lag(qty) OVER {OVER} AS stock, lead(qty) OVER {OVER} AS ordered FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).select("grp", "day", F.lag("qty").over(by_group()).alias("stock"), F.lead("qty").over(by_group()).alias("ordered"))


@Q("w16_history_columns", f"WITH {DAILY} SELECT grp, day, {', '.join(f'lag(amount, {k}) OVER {OVER} AS j_{k}' for k in [*range(2, 11), 28])} FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return win.lag_bank(daily(Tables(s, d)).select("grp", "day", "amount"), "amount", [*range(2, 11), 28], by_group(), "j_").drop("amount")


@Q("w17_carry_weights", f"""WITH {DAILY}, h AS (SELECT grp, day, amount FROM daily UNION ALL SELECT grp, CAST(unnest(generate_series(last + 1, last + 5, INTERVAL 1 DAY)) AS DATE), NULL FROM (SELECT grp, max(day) AS last FROM daily GROUP BY 1))
  SELECT grp, day, last_value(amount IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount FROM h""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = panel.horizon(daily(Tables(s, d)).select("grp", "day", "amount"), ["grp"], "day", 5)
    return rows.select("grp", "day", win.fill_forward(amount(), by_group()).alias("amount"))


BW = "(PARTITION BY asset ORDER BY bar)"


def bframe(a: int, b: int) -> str:
    return frame(a, b).replace("grp", "asset").replace("day", "bar")


@Q("w20_forward_returns", f"WITH {BARS} SELECT asset, bar, {', '.join(f'lead(close, {k}) OVER {BW} / close - 1 AS r_{k}' for k in range(1, 9))} FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    return bars(Tables(s, d)).select("asset", "bar", *((fx.ratio(F.lead(close(), k).over(by_bar()), close()) - 1).alias(f"r_{k}") for k in range(1, 9)))


def mirrored(df: DataFrame, by: list[str], order: str, x: str, n: int) -> DataFrame:
    """df with place (row number) and, before its first rows, their mirror image at places 0, -1, .. 1 - n."""
    w = W.partitionBy(*by).orderBy(order)
    placed = df.withColumn("place", F.row_number().over(w))
    edge = placed.where(F.col("place") <= n).select(*by, (1 - F.col("place")).alias("place"), x)
    return placed.unionByName(edge, allowMissingColumns=True)


@Q("w21_mirrored_zscore", f"""WITH {BARS}, p AS (SELECT asset, bar, close, row_number() OVER {BW} AS place FROM bars), m AS (SELECT asset, bar, close, place FROM p UNION ALL SELECT asset, NULL, close, 1 - place FROM p WHERE place <= 10),
  z AS (SELECT asset, bar, (close - avg(close) OVER w) / nullif(stddev_pop(close) OVER w, 0) AS z FROM m WINDOW w AS (PARTITION BY asset ORDER BY place ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) SELECT asset, bar, round(z, 6) AS z FROM z WHERE bar IS NOT NULL""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = mirrored(bars(Tables(s, d)).select("asset", "bar", "close"), ["asset"], "bar", "close", 10)
    f = W.partitionBy("asset").orderBy("place").rowsBetween(-9, 0)
    z = F.round(fx.ratio(close() - F.avg(close()).over(f), F.stddev_pop(close()).over(f)), 6)
    return rows.withColumn("z", z).where("bar is not null").select("asset", "bar", "z")


@Q("w22_distance_to_others", f"""WITH {BARS}, x AS (SELECT asset, bar, avg(close) OVER {bframe(-6, 0)} AS m FROM bars), t AS (SELECT bar, sum(m) AS s, count(*) AS n FROM x GROUP BY 1)
  SELECT asset, bar, round(m - (s - m) / nullif(n - 1, 0), 7) AS gap FROM x JOIN t USING (bar)""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = bars(Tables(s, d)).select("asset", "bar", F.avg(close()).over(win.trailing(by_bar(), 7)).alias("m"))
    total = rows.groupBy("bar").agg(F.sum("m").alias("s"), F.count("*").alias("n"))
    others = fx.ratio(F.col("s") - F.col("m"), F.col("n") - 1)
    return rows.join(total, "bar").select("asset", "bar", F.round(F.col("m") - others, 7).alias("gap"))


BLOCKS = (6, 11, 21, 41)


@Q("w25_top_five", f"WITH {ITEM_SALES}, r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY amount DESC, item)::INTEGER AS place FROM item_sales) SELECT site, item, amount, place FROM r WHERE place <= 5")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.top_by(item_sales(Tables(s, d)), ["site"], [F.desc("amount"), "item"], 5).select("site", "item", "amount", "place")


@Q("w26_mean_rank", "SELECT s_suppkey, s_nationkey, rank() OVER w + (count(*) OVER (PARTITION BY s_nationkey, round(s_acctbal / 1000)) - 1) / 2 AS place FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY round(s_acctbal / 1000) DESC)")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = Tables(s, d)("supplier").withColumn("x", F.round(F.col("s_acctbal") / 1000))
    return rows.select("s_suppkey", "s_nationkey", win.mean_rank(F.col("x"), ["s_nationkey"]).alias("place"))


@Q("w27_index_to_100", f"WITH {DAILY}, r AS (SELECT *, row_number() OVER {OVER} AS n FROM daily) SELECT grp, day, round(100 * amount / first_value(amount) OVER {OVER}, 6) AS index1, round(100 * amount / avg(CASE WHEN n <= 5 THEN amount END) OVER (PARTITION BY grp), 6) AS index5 FROM r")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).withColumn("n", F.row_number().over(by_group()))
    base = F.avg(F.when(F.col("n") <= 5, amount())).over(W.partitionBy("grp"))
    return rows.select("grp", "day", F.round(100 * fx.ratio(amount(), F.first(amount()).over(by_group())), 6).alias("index1"), F.round(100 * fx.ratio(amount(), base), 6).alias("index5"))


@Q("w28_year_range", f"WITH {DAILY} SELECT grp, arg_max(amount, day) / arg_min(amount, day) - 1 AS change, max(amount) AS high, min(amount) AS low FROM daily WHERE day > DATE '2000-12-31' - 364 AND day <= DATE '2000-12-31' GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    end = F.lit("2000-12-31").cast("date")
    rows = daily(Tables(s, d)).where((F.col("day") > F.date_sub(end, 364)) & (F.col("day") <= end))
    return rows.groupBy("grp").agg((fx.ratio(F.max_by("amount", "day"), F.min_by("amount", "day")) - 1).alias("change"), F.max("amount").alias("high"), F.min("amount").alias("low"))


@Q("t1_multi_key_sort", "SELECT c_nationkey, c_custkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("customer").select("c_nationkey", "c_custkey", "c_acctbal").orderBy("c_nationkey", F.desc("c_acctbal"), "c_custkey")


@Q("t2_schema_probe", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 1)")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").limit(1).agg(F.count("*").alias("n"))


@Q("t3_top_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.top_by(Tables(s, d)("orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "o_totalprice")


@Q("t5_first_by_key", "SELECT * EXCLUDE n FROM (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.first_by(Tables(s, d)("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@Q("u1_union_all", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'S' FROM supplier")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    a = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("S").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


@Q("u2_union_distinct", "SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("customer").select(F.col("c_nationkey").alias("n")).union(t("supplier").select("s_nationkey")).distinct()


@Q("u3_intersect_days", "SELECT CAST(o_orderdate AS DATE) AS day FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("orders").select(F.to_date("o_orderdate").alias("day")).intersect(t("lineitem").select(F.to_date("l_shipdate")))


@Q("u4_except_keys", "SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("orders").select(F.col("o_orderkey").alias("k")).subtract(t("lineitem").select("l_orderkey"))


@Q("r1_densify_panel", f"WITH {DAILY}, e AS (SELECT min(day) AS lo, max(day) AS hi FROM daily), g AS (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT grp FROM daily), e) SELECT g.grp, g.day, amount, qty FROM g LEFT JOIN daily USING (grp, day)")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.densify(daily(Tables(s, d)), ["grp"], "day").select("grp", "day", "amount", "qty")


@Q("r2_business_day_fill", f"""WITH {GAPS}, s AS (SELECT grp, day, amount FROM gaps WHERE dayofmonth(day) < 20), e AS (SELECT grp, min(day) AS lo, max(day) AS hi FROM s GROUP BY 1), g AS (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM e), f AS (SELECT g.grp, g.day, amount FROM g LEFT JOIN s USING (grp, day) WHERE isodow(g.day) < 6)
  SELECT grp, day, coalesce(last_value(amount IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(amount IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS amount FROM f""")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.business_days(gaps(Tables(s, d)).where(F.dayofmonth("day") < 20), ["grp"], "day", ["amount"])


@Q("r3_append_horizon", f"WITH {DAILY} SELECT grp, day, amount FROM daily UNION ALL SELECT grp, CAST(unnest(generate_series(last + 1, last + 10, INTERVAL 1 DAY)) AS DATE), NULL FROM (SELECT grp, max(day) AS last FROM daily GROUP BY 1)")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.horizon(daily(Tables(s, d)).select("grp", "day", "amount"), ["grp"], "day", 10)


@Q("r4_scoring_grid", f"WITH {ITEM_SALES} SELECT grp, site, CAST(unnest(generate_series(DATE '2001-11-05', DATE '2001-11-11', INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT grp, site FROM item_sales)")
def _(s: SparkSession, d: str) -> DataFrame:
    keys = item_sales(Tables(s, d)).select("grp", "site")
    return panel.grid(keys, F.lit("2001-11-05").cast("date"), F.lit("2001-11-11").cast("date"), "day")


@Q("r5_zero_rows", f"WITH {DAILY}, m AS (SELECT max(day) AS last FROM daily) SELECT grp, day, amount FROM daily UNION ALL SELECT DISTINCT grp, last, 0.0 FROM daily, m WHERE grp NOT IN (SELECT grp FROM daily, m WHERE day = last)")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.zero_rows(daily(Tables(s, d)).select("grp", "day", "amount"), ["grp"], "day", ["amount"])


@Q("r6_long_per_asset", f"WITH {BARS} SELECT asset, bar, unnest(['open', 'close']) AS kind, unnest([open, close]) AS price FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    return bars(Tables(s, d)).select("asset", "bar", "open", "close").unpivot(["asset", "bar"], ["open", "close"], "kind", "price")


@Q("r7_stack_years", f"WITH {REVENUE}, y AS (SELECT company, year(quarter)::INTEGER AS yr, round(sum(revenue), 2) AS revenue FROM revenue GROUP BY 1, 2) SELECT a.company, a.yr, a.revenue, b.revenue AS before FROM y a LEFT JOIN y b ON a.company = b.company AND a.yr = b.yr + 1")
def _(s: SparkSession, d: str) -> DataFrame:
    y = revenue(Tables(s, d)).groupBy("company", F.year("quarter").alias("yr")).agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    return y.join(y.select("company", (F.col("yr") + 1).alias("yr"), F.col("revenue").alias("before")), ["company", "yr"], "left")


@Q("r8_explode_list", "SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS word FROM documents")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("documents").select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("word"))


@Q("s1_round_times", "SELECT event_id, date_trunc('hour', ts) AS hour, CAST(ts AS DATE) AS day, make_timestamp((floor((epoch(ts)::BIGINT + 450) / 900) * 900 * 1000000)::BIGINT) AS quarter FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("events").select("event_id", F.date_trunc("hour", "ts").alias("hour"), F.to_date("ts").alias("day"), fx.round_to(F.col("ts"), 900).alias("quarter"))


@Q("s2_date_parts", "SELECT o_orderkey, (isodow(o_orderdate) - 1)::INTEGER AS weekday, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day, dayofyear(o_orderdate)::INTEGER AS doy, weekofyear(o_orderdate)::INTEGER AS week FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    o = F.col("o_orderdate")
    return Tables(s, d)("orders").select("o_orderkey", F.weekday(o).alias("weekday"), F.month(o).alias("month"), F.dayofmonth(o).alias("day"), F.dayofyear(o).alias("doy"), F.weekofyear(o).alias("week"))


@Q("s3_periods", "SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS DATE) AS next, CAST(date_trunc('quarter', o_orderdate) - INTERVAL 12 MONTH AS DATE) AS year_before FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    q = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    return Tables(s, d)("orders").select("o_orderkey", q.alias("quarter"), F.add_months(q, 3).alias("next"), F.add_months(q, -12).alias("year_before"))


@Q("s4_clock_parse", "SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %I:%M %p'), '%Y-%m-%d %I:%M %p') AS parsed FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd hh:mm a")
    return Tables(s, d)("events").select("event_id", F.to_timestamp(text, "yyyy-MM-dd hh:mm a").alias("parsed"))


HOLIDAYS = """y AS (SELECT unnest(generate_series(1994, 2003)) AS y), g AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y), h1 AS (SELECT *, (19 * a + b - b // 4 - (8 * b + 13) // 25 + 15) % 30 AS h FROM g),
  h2 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM h1), h3 AS (SELECT *, (a + 11 * h + 19 * l) // 433 AS m FROM h2), h4 AS (SELECT *, (h + l - 7 * m + 90) // 25 AS mo FROM h3), easter AS (SELECT y, make_date(y, mo, (h + l - 7 * m + 33 * mo + 19) % 32) AS e FROM h4),
  hol AS (SELECT make_date(y, m, d) AS holiday_date, n AS holiday FROM y, (VALUES (1, 1, 'NEW_YEAR'), (5, 1, 'LABOUR'), (5, 8, 'VICTORY'), (7, 14, 'NATIONAL'), (8, 15, 'ASSUMPTION'), (11, 1, 'ALL_SAINTS'), (11, 11, 'ARMISTICE'), (12, 25, 'CHRISTMAS')) v(m, d, n)
  UNION ALL SELECT CAST(e + k AS DATE), n FROM easter, (VALUES (1, 'EASTER_MONDAY'), (39, 'ASCENSION'), (50, 'WHIT_MONDAY')) w(k, n))"""


@Q("s5_holiday_calendar", f"WITH {HOLIDAYS} SELECT DISTINCT holiday_date, holiday FROM hol WHERE year(holiday_date) IN (SELECT year(o_orderdate) FROM orders)")
def _(s: SparkSession, d: str) -> DataFrame:
    return calendar.holidays(Tables(s, d)("orders").select(F.year("o_orderdate").alias("year")).distinct())


@Q("s6_holiday_distance", f"WITH {HOLIDAYS}, o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) SELECT day, coalesce((SELECT max(day - holiday_date) FROM hol WHERE abs(day - holiday_date) <= 3), -5)::INTEGER AS holiday_offset, isodow(day) = 7 AS sunday FROM o")
def _(s: SparkSession, d: str) -> DataFrame:
    days = Tables(s, d)("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return calendar.holiday_offset(days, "day").withColumn("sunday", F.weekday("day") == 6)


@Q("s8_codes", "SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, upper(trim(p_name)) AS name, upper(regexp_replace(regexp_replace(trim(p_brand), '[/ ]+', '_', 'g'), '[^A-Za-z0-9_]', '', 'g')) AS header FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").select("p_partkey", fx.coded(F.col("p_partkey"), 8).alias("code"), F.upper(F.trim("p_name")).alias("name"), fx.header(F.col("p_brand")).alias("header"))


@Q("s9_accounting_numbers", "SELECT c_custkey, c_acctbal AS amount, c_acctbal AS comma FROM customer")
def _(s: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    written = F.when(b < 0, F.concat(F.lit("("), F.format_number(-b, 2), F.lit(")"))).otherwise(F.format_number(b, 2))
    return Tables(s, d)("customer").select("c_custkey", fx.accounting(written).alias("amount"), fx.decimal_comma(F.replace(b.cast("string"), F.lit("."), F.lit(","))).alias("comma"))


@Q("s10_suffix_currency", "SELECT page_id, CASE WHEN contains(url, '.com') THEN 'USD' WHEN contains(url, '.org') THEN 'EUR' ELSE 'GBP' END AS currency FROM pages")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("pages").select("page_id", fx.first_match(F.col("url"), [(".com", "USD"), (".org", "EUR")], "GBP").alias("currency"))


@Q("s11_kind_from_items", "SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'RETURNED' ELSE 'CLEAN' END AS kind FROM lineitem GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    flags = Tables(s, d)("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    return flags.select("l_orderkey", F.when(F.array_contains("f", "R"), "RETURNED").otherwise("CLEAN").alias("kind"))


@Q("s12_profile_fields", r"SELECT p_partkey, regexp_extract(p_brand, '#([0-9]+)', 1) AS number, regexp_extract(p_type, '^(\S+)', 1) AS first FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").select("p_partkey", F.regexp_extract("p_brand", "#([0-9]+)", 1).alias("number"), F.regexp_extract("p_type", r"^(\S+)", 1).alias("first"))


@Q("s13_key_digest", "SELECT o_orderkey, sha1(CAST(o_orderkey AS VARCHAR) || CAST(o_custkey AS VARCHAR) || o_orderstatus) AS row_key FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    return store.with_key(Tables(s, d)("orders"), ["o_orderkey", "o_custkey", "o_orderstatus"]).select("o_orderkey", "row_key")


@Q("s14_snake_case", r"SELECT DISTINCT lower(regexp_replace(regexp_replace('order' || upper(substr(o_orderstatus, 1, 1)) || 'StatusKey', '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS name FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").select(fx.snake(F.concat(F.lit("order"), F.upper(F.substring("o_orderstatus", 1, 1)), F.lit("StatusKey"))).alias("name")).distinct()


@Q("s15_fade", "SELECT o_orderkey, round(exp(-ln(2.0) * datediff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') / 90.0), 9) AS weight FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").select("o_orderkey", F.round(fx.fade(F.datediff(F.lit("2001-12-31").cast("date"), F.to_date("o_orderdate")), 90.0), 9).alias("weight"))


@Q("s16_intrinsic_value", "WITH v AS (SELECT c_custkey, list_sum([c_acctbal * pow(1 + 8 * pow(0.85, i) / 100, i) / pow(1.1, i) FOR i IN generate_series(0, 9)]) + 0.85 * 1000 AS v FROM customer) SELECT c_custkey, CASE WHEN v > 0 THEN round(v, 2) END AS value FROM v")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("customer").select("c_custkey", F.round(fx.intrinsic_value(F.col("c_acctbal"), F.lit(8.0), F.lit(1000.0)), 2).alias("value"))


@Q("s17_convert_currency", """WITH fx AS (SELECT n_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(0.5 + avg(o_totalprice) / 1e6, 6) AS rate FROM orders, nation WHERE n_nationkey = o_orderkey % 25 GROUP BY 1, 2)
  SELECT o_orderkey, o_totalprice * rate AS amount FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN fx ON n_nationkey = c_nationkey AND month = CAST(date_trunc('month', o_orderdate) AS DATE)""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    orders = t("orders").withColumn("month", F.trunc("o_orderdate", "MM"))
    rates = orders.withColumn("c_nationkey", (F.col("o_orderkey") % 25).cast("int")).groupBy("c_nationkey", "month").agg(F.round(0.5 + F.avg("o_totalprice") / 1e6, 6).alias("rate"))
    named = orders.join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return named.join(rates, ["c_nationkey", "month"], "left").select("o_orderkey", (F.col("o_totalprice") * F.col("rate")).alias("amount"))


@Q("s18_cosine", "SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id")
def _(s: SparkSession, d: str) -> DataFrame:
    return text.cosines(Tables(s, d)("embeddings"), "vec_id", "label", "embedding")


@Q("s19_array_filter", "SELECT vec_id, len(list_filter(embedding, lambda x: x >= 0.2)) AS n, embedding[1:3] AS head FROM embeddings")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x >= F.lit(0.2).cast("float"))).cast("long").alias("n"), F.slice("embedding", 1, 3).alias("head"))


@Q("s20_text_segments", "SELECT doc_id, array_to_string(string_split(text, chr(10))[1:2], ' ') AS head, len(string_split(text, chr(10))) AS n_lines FROM documents")
def _(s: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n")
    return Tables(s, d)("documents").select("doc_id", F.array_join(F.slice(lines, 1, 2), " ").alias("head"), F.size(lines).cast("long").alias("n_lines"))


@Q("s21_signed_score", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN value / 500 WHEN event_type = 'error' THEN -value / 500 ELSE 0 END AS score FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    v, k = F.col("value") / 500, F.col("event_type")
    return Tables(s, d)("events").select("event_id", F.when(k == "purchase", v).when(k == "error", -v).otherwise(0.0).alias("score"))


@Q("snk3_upsert", """WITH o AS (SELECT sha1(CAST(o_orderkey AS VARCHAR)) AS row_key, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT sha1(CAST(o_orderkey AS VARCHAR)) AS row_key, o_orderkey, o_totalprice + 1 AS o_totalprice, 'V2' AS run FROM orders WHERE o_orderkey % 2 = 0)
  SELECT *, NULL AS run FROM o WHERE row_key NOT IN (SELECT row_key FROM n) UNION ALL SELECT * FROM n""")
def _(s: SparkSession, d: str) -> DataFrame:
    o = store.with_key(Tables(s, d)("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    new = o.where("o_orderkey % 2 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 1, "run": F.lit("V2")})
    return store.upsert(o.where("o_orderkey % 3 <> 0"), new)


@Q("snk4_backfill", f"""WITH {DAILY} SELECT grp, day, CASE WHEN dayofmonth(day) % 4 = 0 AND day > DATE '2000-06-30' THEN NULL ELSE amount END AS amount FROM daily""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return store.backfill(gaps(t), daily(t), ["grp", "day"], "amount", "day", "2000-06-30").select("grp", "day", "amount")


@Q("snk5_added_columns", "SELECT r_regionkey, r_name, NULL::DOUBLE AS area FROM region UNION ALL SELECT 99, 'NEW', 1.5")
def _(s: SparkSession, d: str) -> DataFrame:
    new = s.sql("select 99 r_regionkey, 'NEW' r_name, double(1.5) area")
    return Tables(s, d)("region").select("r_regionkey", "r_name").unionByName(new, allowMissingColumns=True)


@Q("snk6_pick_model", """WITH m AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS trained, o_orderkey AS run FROM orders), w AS (SELECT c_custkey AS k, DATE '2000-01-15' AS asof_day FROM customer)
  SELECT k, asof_day, trained, run FROM (SELECT w.k, asof_day, trained, run, row_number() OVER (PARTITION BY w.k ORDER BY trained DESC, run DESC) AS n FROM w JOIN m ON w.k = m.k WHERE trained <= asof_day - 7) WHERE n = 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    models = t("orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("trained"), F.col("o_orderkey").alias("run"))
    wanted = t("customer").select(F.col("c_custkey").alias("k"), F.lit("2000-01-15").cast("date").alias("asof_day"))
    return store.pick_model(models, wanted, "k", "trained", "run", "asof_day", 7)


@Q("s7_school_holidays", "WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) SELECT day, (day BETWEEN DATE '1996-07-06' AND DATE '1996-09-01' OR day BETWEEN DATE '1996-12-21' AND DATE '1997-01-05')::INTEGER AS school_holiday FROM o")
def _(s: SparkSession, d: str) -> DataFrame:
    seasons = s.sql("values (date'1996-07-06', date'1996-09-01'), (date'1996-12-21', date'1997-01-05') as t(first_day, last_day)")
    days = Tables(s, d)("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return calendar.school_holidays(days, "day", seasons)


# Windows with very many lags and frames.

LAGS, MEANS = range(1, 192), range(1, 192, 4)
BARS_15 = BARS.replace("360 minutes", "15 minutes") + ", priced AS (SELECT * FROM bars WHERE close > 0)"


def bar_lags(rows: DataFrame) -> DataFrame:
    """Closes 1 to 8 bars ahead, closes and volumes 1 to 191 bars back, of bars that have all of these."""
    w = by_bar()
    ahead = [F.lead("close", k).over(w).alias(f"next_{k}") for k in range(1, 9)]
    past = [F.lag(x, k).over(w).alias(f"{name}_{k}") for x, name in (("close", "past"), ("volume", "past_volume")) for k in LAGS]
    return rows.where("close > 0").select("asset", "bar", "close", "volume", *ahead, *past).where("past_191 is not null")


@Q("w18_bar_lags", f"WITH {BARS_15}, x AS (SELECT asset, bar, close, volume, {', '.join(f'lead(close, {k}) OVER {BW} AS next_{k}' for k in range(1, 9))}, {', '.join(f'lag({x}, {k}) OVER {BW} AS {name}_{k}' for x, name in (('close', 'past'), ('volume', 'past_volume')) for k in LAGS)} FROM priced) SELECT * FROM x WHERE past_191 IS NOT NULL")
def _(s: SparkSession, d: str) -> DataFrame:
    return bar_lags(bars(Tables(s, d), 15))


def trailing_stats(rows: DataFrame) -> DataFrame:
    """Means and deviations of the last 1, 5, .. 189 closes and volumes and the close's distance to each mean (also to
    that of volumes, as the reference has it) and to the closes 2 to 24 back, of bars that have 191 before them. All
    from running sums, which are decimal, so that what is taken off is exact: a frame costs the same however long it is."""
    w, out = by_bar(), {}
    before = w.rowsBetween(W.unboundedPreceding, -1)
    sums = {f"__{n}_{x}": F.coalesce(F.sum(v.cast("decimal(28,8)")).over(before), F.lit(0).cast("decimal(38,8)")) for x in ("close", "volume") for n, v in (("s", F.col(x)), ("q", F.col(x) * F.col(x)))}
    run = rows.where("close > 0").select("asset", "bar", "close", *(v.alias(k) for k, v in sums.items()))
    for m in MEANS:
        for x in ("close", "volume"):
            s, q = ((F.col(f"__{n}_{x}") - F.lag(f"__{n}_{x}", m).over(w)).cast("double") for n in "sq")
            out |= {f"s_{x}_{m}": s, f"q_{x}_{m}": q}
    back = {f"delta_close_{k}": fx.ratio(close(), F.lag("close", k).over(w)) - 1 for k in range(2, 25)}
    full = run.select("asset", "bar", "close", F.lag("close", LAGS[-1]).over(w).alias("__far"), *(v.alias(k) for k, v in (out | back).items())).where("__far is not null")

    def stats(x: str, m: int) -> list[Column]:
        s, q = F.col(f"s_{x}_{m}"), F.col(f"q_{x}_{m}")
        spread = F.sqrt(F.greatest(q - s * s / m, F.lit(0.0)) / (m - 1)) if m > 1 else F.lit(None).cast("double")
        off = fx.ratio(close(), s / m) - 1
        return [F.round(s / m, 6).alias(f"mean_{x}_{m}"), F.round(spread, 4).alias(f"std_{x}_{m}"), off.alias(f"delta_{x}_mean_{m}")]

    return full.select("asset", "bar", *(c for m in MEANS for x in ("close", "volume") for c in stats(x, m)), *back)


@Q("w19_trailing_stats", f"WITH {BARS_15}, x AS (SELECT asset, bar, lag(close, 191) OVER {BW} AS far, " + ", ".join(f"round(avg({x}) OVER {bframe(-m, -1)}, 6) AS mean_{x}_{m}, round(stddev_samp({x}) OVER {bframe(-m, -1)}, 4) AS std_{x}_{m}, close / nullif((sum({x}::DECIMAL(28, 8)) OVER {bframe(-m, -1)})::DOUBLE / {m}, 0) - 1 AS delta_{x}_mean_{m}" for m in MEANS for x in ("close", "volume")) + ", " + ", ".join(f"close / lag(close, {k}) OVER {BW} - 1 AS delta_close_{k}" for k in range(2, 25)) + " FROM priced) SELECT * EXCLUDE (far) FROM x WHERE far IS NOT NULL")
def _(s: SparkSession, d: str) -> DataFrame:
    return trailing_stats(bars(Tables(s, d), 15))


def block_lags(rows: DataFrame) -> DataFrame:
    """Lags 0 to 385 of amount; deviations of blocks of five lags and the distance of lag 5 to their means and to the
    mean of lags 355 to 384; the change since lag 5. Of days that have all lags."""
    w = by_group()
    lags = [F.lag("amount", k).over(w).alias(f"lag_{k}") for k in range(386)]
    five = F.lag("amount", 5).over(w)
    cols = [F.round(fx.ratio(amount(), five) - 1, 6).alias("target")]
    for k in BLOCKS:
        f = win.trailing(w, 5, k)
        cols += [F.round(F.stddev_samp(amount()).over(f), 4).alias(f"std_{k}"), F.round(fx.ratio(five, F.avg(amount()).over(f)) - 1, 6).alias(f"distance_{k}")]
    cols += [F.round(fx.ratio(five, F.avg(amount()).over(win.trailing(w, 30, 355))) - 1, 6).alias("year_trend")]
    return rows.select("grp", "day", *lags, *cols).where("lag_385 is not null")


@Q("w23_block_lags", f"WITH {DAILY}, x AS (SELECT grp, day, {', '.join(f'lag(amount, {k}) OVER {OVER} AS lag_{k}' for k in range(386))}, round(amount / nullif(lag(amount, 5) OVER {OVER}, 0) - 1, 6) AS target, " + ", ".join(f"round(stddev_samp(amount) OVER {frame(-(k + 4), -k)}, 4) AS std_{k}, round(lag(amount, 5) OVER {OVER} / nullif(avg(amount) OVER {frame(-(k + 4), -k)}, 0) - 1, 6) AS distance_{k}" for k in BLOCKS) + f", round(lag(amount, 5) OVER {OVER} / nullif(avg(amount) OVER {frame(-384, -355)}, 0) - 1, 6) AS year_trend FROM daily) SELECT * FROM x WHERE lag_385 IS NOT NULL")
def _(s: SparkSession, d: str) -> DataFrame:
    return block_lags(daily(Tables(s, d)))


def rolling_correlation(rows: DataFrame, n: int = 360) -> DataFrame:
    """Correlation of amount and qty over the last n days of a group, null before there are so many."""
    f = win.trailing(by_group(), n)
    return rows.select("grp", "day", win.complete(F.round(correlation("amount", "qty", f), 5), amount(), f, n).alias("r"))


@Q("w24_rolling_correlation", f"WITH {DAILY} SELECT grp, day, CASE WHEN count(*) OVER {frame(-359, 0)} = 360 THEN round(corr(amount, qty) OVER {frame(-359, 0)}, 5) END AS r FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    return rolling_correlation(daily(Tables(s, d)))
