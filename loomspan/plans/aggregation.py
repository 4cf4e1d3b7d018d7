"""Queries over aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions import scalars as fx
from loomspan.operators import aggregates as ag
from loomspan.plans.fixtures import BARS, DAILY, ITEM_SALES, REVENUE, Tables, bars, daily, item_sales, revenue
from loomspan.plans.registry import Registry

Q = Registry()


@Q("a1_mixed_group", "SELECT l_partkey, round(sum(l_extendedprice), 2) AS amount, median(l_quantity) AS qty, min(l_discount) AS discount FROM lineitem GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.median("l_quantity").alias("qty"), F.min("l_discount").alias("discount"))


@Q("a2_group_median_back", f"WITH {DAILY} SELECT grp, day, amount, median(amount) OVER (PARTITION BY grp) AS usual FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d))
    usual = rows.groupBy("grp").agg(F.median("amount").alias("usual"))
    return rows.join(usual, "grp").select("grp", "day", "amount", "usual")


@Q("a3_share_in_parent", f"WITH {ITEM_SALES} SELECT item, grp, site, round(amount / sum(amount) OVER (PARTITION BY grp, site), 6) AS share FROM item_sales")
def _(s: SparkSession, d: str) -> DataFrame:
    return item_sales(Tables(s, d)).select("item", "grp", "site", F.round(ag.share("amount", ["grp", "site"]), 6).alias("share"))


@Q("a4_weighted_price", "SELECT l_suppkey, round(sum(l_extendedprice / l_quantity * l_quantity) / sum(l_quantity), 4) AS price FROM lineitem GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").groupBy("l_suppkey").agg(F.round(ag.weighted_mean(F.col("l_extendedprice") / F.col("l_quantity"), "l_quantity"), 4).alias("price"))


@Q("a5_group_level", f"WITH {ITEM_SALES} SELECT grp, site, round(sum(amount), 2) AS target, max(n_lines) AS seasonal, round(avg(qty), 4) AS mean_qty FROM item_sales GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return item_sales(Tables(s, d)).groupBy("grp", "site").agg(F.round(F.sum("amount"), 2).alias("target"), F.max("n_lines").alias("seasonal"), F.round(F.avg("qty"), 4).alias("mean_qty"))


@Q("a6_warehouse_rollup", f"WITH {ITEM_SALES} SELECT grp, round(sum(amount), 2) AS amount, median(nullif(amount / qty, 0)) AS price FROM item_sales GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    price = F.nullif(fx.ratio(F.col("amount"), F.col("qty")), F.lit(0.0))
    return item_sales(Tables(s, d)).groupBy("grp").agg(F.round(F.sum("amount"), 2).alias("amount"), F.median(price).alias("price"))


@Q("a7_cluster_rollup", f"""WITH {ITEM_SALES}, c AS (SELECT grp, n_regionkey AS cluster, amount, qty, amount / (0.1 + sum(amount) OVER (PARTITION BY grp, n_regionkey)) AS w FROM item_sales JOIN nation ON site = n_nationkey)
  SELECT grp, cluster, round(sum(amount), 2) AS amount, round(sum(qty * w), 4) AS qty FROM c GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    rows = item_sales(t).join(t("nation").select(F.col("n_nationkey").alias("site"), F.col("n_regionkey").alias("cluster")), "site")
    total = F.sum("amount").over(W.partitionBy("grp", "cluster"))
    return rows.withColumn("w", F.col("amount") / (0.1 + total)).groupBy("grp", "cluster").agg(F.round(F.sum("amount"), 2).alias("amount"), F.round(F.sum(F.col("qty") * F.col("w")), 4).alias("qty"))


@Q("a8_daily_snapshot", """WITH r AS (SELECT CAST(ts AS DATE) AS day, round(sum(value), 4) AS rain FROM events GROUP BY 1), n AS (SELECT CAST(ts AS DATE) AS day, arg_min(value, (ts, event_id)) AS noon FROM events WHERE hour(ts) = 12 GROUP BY 1)
  SELECT day, rain, last_value(noon IGNORE NULLS) OVER (ORDER BY day) AS noon, round(rain / 100) * 100 AS pressure FROM r LEFT JOIN n USING (day)""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = Tables(s, d)("events").withColumn("day", F.to_date("ts"))
    noon = F.min_by(F.when(F.hour("ts") == 12, F.col("value")), F.when(F.hour("ts") == 12, F.struct("ts", "event_id")))
    each = rows.groupBy("day").agg(F.round(F.sum("value"), 4).alias("rain"), noon.alias("noon"))
    # a row for each day: a calendar, not the data, goes through one task
    return each.select("day", "rain", F.last("noon", ignorenulls=True).over(W.orderBy("day")).alias("noon"), (F.round(F.col("rain") / 100) * 100).alias("pressure"))


@Q("a9_daily_means", "SELECT CAST(l_shipdate AS DATE) AS day, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax FROM lineitem GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(*(F.round(F.avg(c), 6).alias(c) for c in ("l_quantity", "l_discount", "l_tax")))


@Q("a10_significant_pairs", f"""WITH {ITEM_SALES}, g AS (SELECT grp, median(amount) / 3 AS floor FROM item_sales GROUP BY 1), p AS (SELECT item, grp, median(amount) AS usual, sum(n_lines) AS days FROM item_sales GROUP BY 1, 2)
  SELECT item, p.grp FROM p JOIN g ON p.grp = g.grp WHERE NOT (usual < floor OR days < 20)""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = item_sales(Tables(s, d))
    floor = rows.groupBy("grp").agg((F.median("amount") / 3).alias("floor"))
    pairs = rows.groupBy("item", "grp").agg(F.median("amount").alias("usual"), F.sum("n_lines").alias("days"))
    return pairs.join(floor, "grp").where(~((F.col("usual") < F.col("floor")) | (F.col("days") < 20))).select("item", "grp")


@Q("a11_high_volume", "SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > (SELECT count(DISTINCT s_nationkey) FROM supplier) * 30")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    sites = t("supplier").agg(F.countDistinct("s_nationkey")).first()[0]
    return t("lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty")).where(F.col("qty") > sites * 30)


@Q("a12_active_pairs", "SELECT l_partkey, l_suppkey, count_if(l_discount <> 0) AS n FROM lineitem GROUP BY 1, 2 HAVING count_if(l_discount <> 0) > 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count_if(F.col("l_discount") != 0).alias("n")).where("n > 1")


@Q("a13_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_partkey) AS items, count(DISTINCT l_suppkey) AS sites FROM lineitem GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("items"), F.countDistinct("l_suppkey").alias("sites"))


@Q("a14_recent_ratio", f"WITH {DAILY}, m AS (SELECT max(day) AS last FROM daily) SELECT grp, round(sum(qty) / (0.01 + sum(amount)), 8) AS ratio FROM daily, m WHERE day > last - 28 GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d))
    last = rows.agg(F.max("day")).first()[0]
    return rows.where(F.col("day") > F.date_sub(F.lit(last), 28)).groupBy("grp").agg(F.round(F.sum("qty") / (0.01 + F.sum("amount")), 8).alias("ratio"))


@Q("a15_common_days_ratio", f"""WITH {DAILY}, o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT day, sum(qty) AS q FROM daily GROUP BY 1), k AS (SELECT day FROM o INTERSECT SELECT day FROM s),
  l AS (SELECT day FROM k WHERE day > (SELECT max(day) FROM k) - 7) SELECT greatest(0, least(100, round_even(100.0::DOUBLE * (SELECT sum(n) FROM o WHERE day IN (FROM l)) / (SELECT sum(q) FROM s WHERE day IN (FROM l)), 0))) AS ratio""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    o = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    sold = daily(t).groupBy("day").agg(F.sum("qty").alias("q"))
    both = o.join(sold, "day")
    last = both.agg(F.max("day")).first()[0]
    recent = both.where(F.col("day") > F.date_sub(F.lit(last), 7)).agg(fx.half_even(100 * fx.ratio(F.sum("n").cast("double"), F.sum("q"))).alias("r"))
    return recent.select(fx.clip(F.col("r"), 0.0, 100.0).alias("ratio"))


@Q("a16_median_difference", "WITH e AS (SELECT l_partkey, abs(l_extendedprice / l_quantity - p_retailprice) / p_retailprice AS off FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT l_partkey, CASE WHEN count(off) = count(*) THEN median(off) END AS off FROM e GROUP BY 1 HAVING median(off) <= 20")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    off = F.abs(F.col("l_extendedprice") / F.col("l_quantity") - F.col("p_retailprice")) / F.col("p_retailprice")
    return t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("off", off).groupBy("l_partkey").agg(ag.strict_median("off").alias("off")).where("off <= 20")


@Q("a17_quantile_thresholds", "SELECT event_type AS asset, quantile_cont(value, 0.08) AS low, quantile_cont(value, 0.95) AS high, quantile_cont(value, 0.96) AS top, quantile_cont(value, 0.03) AS bottom FROM events GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    p = lambda q: F.percentile("value", q)
    return Tables(s, d)("events").groupBy(F.col("event_type").alias("asset")).agg(p(0.08).alias("low"), p(0.95).alias("high"), p(0.96).alias("top"), p(0.03).alias("bottom"))


@Q("a18_portfolio_summary", "SELECT user_id, event_type AS asset, round(sum(value), 4) AS total, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("events").groupBy("user_id", F.col("event_type").alias("asset")).agg(F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


@Q("a19_market_sector_median", f"WITH {DAILY}, x AS (SELECT *, substr(grp, 1, 7) AS sector FROM daily) SELECT grp, day, amount - median(amount) OVER (PARTITION BY day) AS to_market, amount - median(amount) OVER (PARTITION BY day, sector) AS to_sector FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).withColumn("sector", F.substring("grp", 1, 7))
    market = rows.groupBy("day").agg(F.median("amount").alias("market"))
    sector = rows.groupBy("day", "sector").agg(F.median("amount").alias("peer"))
    return rows.join(market, "day").join(sector, ["day", "sector"]).select("grp", "day", (F.col("amount") - F.col("market")).alias("to_market"), (F.col("amount") - F.col("peer")).alias("to_sector"))


@Q("a20_quarterly_trend", f"WITH {REVENUE} SELECT company, quarter, revenue / lag(revenue) OVER w - 1 AS qoq, revenue / lag(revenue, 4) OVER w - 1 AS yoy FROM revenue WINDOW w AS (PARTITION BY company ORDER BY quarter)")
def _(s: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("company").orderBy("quarter")
    r = F.col("revenue")
    return revenue(Tables(s, d)).select("company", "quarter", (fx.ratio(r, F.lag(r).over(w)) - 1).alias("qoq"), (fx.ratio(r, F.lag(r, 4).over(w)) - 1).alias("yoy"))


@Q("a21_monthly_mean", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(avg(o_totalprice), 4) AS rate FROM orders GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").groupBy(F.trunc("o_orderdate", "MM").alias("month")).agg(F.round(F.avg("o_totalprice"), 4).alias("rate"))


@Q("a22_pair_correlation", f"WITH {DAILY} SELECT a.grp AS a, b.grp AS b, round(corr(a.amount, b.amount), 6) AS r FROM daily a JOIN daily b ON a.day = b.day AND a.grp < b.grp GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).select("grp", "day", "amount")
    other = rows.withColumnsRenamed({"grp": "b", "amount": "other"})
    return rows.join(other, "day").where("grp < b").groupBy(F.col("grp").alias("a"), "b").agg(F.round(ag.correlation("amount", "other"), 6).alias("r"))


@Q("a23_slope", f"WITH {REVENUE} SELECT company, round(regr_slope(revenue, datediff('day', DATE '1995-01-01', quarter)), 6) AS slope FROM revenue GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    day = F.datediff("quarter", F.lit("1995-01-01").cast("date"))
    return revenue(Tables(s, d)).groupBy("company").agg(F.round(F.regr_slope("revenue", day), 6).alias("slope"))


@Q("a24_moments", f"WITH {DAILY} SELECT grp, round(stddev_samp(amount), 4) AS std, min(amount) AS low, max(amount) AS high, round(skewness(amount), 6) AS skew FROM daily GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    return daily(Tables(s, d)).groupBy("grp").agg(F.round(F.stddev_samp("amount"), 4).alias("std"), F.min("amount").alias("low"), F.max("amount").alias("high"), F.round(ag.sample_skewness("amount"), 6).alias("skew"))


@Q("a25_concat_group", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS text FROM conversations GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", "text")))
    return Tables(s, d)("conversations").groupBy("conv_id").agg(turns.alias("t")).select("conv_id", F.array_join(F.col("t.text"), " ").alias("text"))


@Q("a26_padded_lists", "WITH l AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS k FROM orders GROUP BY 1) SELECT o_custkey, list_resize(k, (SELECT max(len(k)) FROM l), -1) AS keys FROM l")
def _(s: SparkSession, d: str) -> DataFrame:
    lists = Tables(s, d)("orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("k"))
    longest = lists.agg(F.max(F.size("k"))).first()[0] or 0
    return lists.select("o_custkey", F.concat("k", F.array_repeat(F.lit(-1).cast("long"), F.lit(longest) - F.size("k"))).alias("keys"))


@Q("a27_pivot", """SELECT CAST(ts AS DATE) AS day, round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 4) AS purchase, round(coalesce(sum(value) FILTER (event_type = 'error'), 0), 4) AS error, round(coalesce(sum(value) FILTER (event_type = 'click'), 0), 4) AS click FROM events GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    wide = Tables(s, d)("events").groupBy(F.to_date("ts").alias("day")).pivot("event_type", ["purchase", "error", "click"]).agg(F.round(F.sum("value"), 4))
    return wide.fillna(0.0)


@Q("a28_most_frequent", "SELECT c_nationkey, arg_max(c_mktsegment, (n, c_mktsegment)) AS segment FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    counts = Tables(s, d)("customer").groupBy("c_nationkey", "c_mktsegment").count()
    return counts.groupBy("c_nationkey").agg(F.max_by("c_mktsegment", F.struct("count", "c_mktsegment")).alias("segment"))


NAIVE = f"{DAILY}, f AS (SELECT grp, day, amount AS y, lag(amount, 7) OVER (PARTITION BY grp ORDER BY day) AS p FROM daily)"


def naive(t: Tables) -> DataFrame:
    return daily(t).select("grp", "day", F.col("amount").alias("y"), F.lag("amount", 7).over(W.partitionBy("grp").orderBy("day")).alias("p"))


@Q("a29_forecast_errors", f"WITH {NAIVE} SELECT grp, round(avg(abs(y - p) / y) FILTER (y > 10), 6) AS mape, round(avg(2 * abs(y - p) / (abs(y) + abs(p))) FILTER (y > 10), 6) AS smape, median(abs(y - p) / y) FILTER (y > 10) AS median_ape FROM f GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    y, p = F.col("y"), F.col("p")
    ape = F.when(y > 10, F.abs(y - p) / y)
    smape = F.when(y > 10, 2 * F.abs(y - p) / (F.abs(y) + F.abs(p)))
    return naive(Tables(s, d)).groupBy("grp").agg(F.round(F.avg(ape), 6).alias("mape"), F.round(F.avg(smape), 6).alias("smape"), F.median(ape).alias("median_ape"))


@Q("a30_accuracy_curve", f"WITH {NAIVE}, t AS (SELECT unnest(generate_series(0, 20)) AS pct) SELECT pct::INTEGER AS pct, round(avg(CASE WHEN abs(y - p) / y <= pct / 100.0::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM f, t WHERE p IS NOT NULL AND y > 0 GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = naive(Tables(s, d)).where("p is not null and y > 0").select((F.abs(F.col("y") - F.col("p")) / F.col("y")).alias("ape"))
    each = rows.withColumn("pct", F.explode(F.sequence(F.lit(0), F.lit(20))))
    return each.groupBy("pct").agg(F.round(F.avg((F.col("ape") <= F.col("pct") / 100).cast("int")), 6).alias("accuracy"))


@Q("a31_auc", """WITH x AS (SELECT n_chars AS score, quality AS label FROM labels JOIN documents USING (doc_id)), c AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM x GROUP BY 1),
  r AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c) SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 8) AS auc FROM r""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    rows = t("labels").join(t("documents"), "doc_id").select(F.col("n_chars").alias("score"), F.col("quality").alias("label"))
    return ag.auc(rows, "score", "label").select(F.round("auc", 8).alias("auc"))


@Q("a32_payment_history", """SELECT o_custkey, arg_max(CAST(o_orderdate AS DATE), (o_orderdate, o_orderkey)) AS last_day, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last, round((arg_max(o_totalprice, (o_orderdate, o_orderkey)) - avg(o_totalprice)) * 100 / avg(o_totalprice), 6) AS off_mean,
  round(count(DISTINCT year(o_orderdate)) / 3, 6) AS regular, round(count(*) / count(DISTINCT year(o_orderdate)), 6) AS per_year FROM orders GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The last payment and how far it is from the mean of all, in percent; years with payments over three; payments a year."""
    when, years = F.struct("o_orderdate", "o_orderkey"), F.countDistinct(F.year("o_orderdate"))
    last, mean = F.max_by("o_totalprice", when), F.avg("o_totalprice")
    return Tables(s, d)("orders").groupBy("o_custkey").agg(
        F.max_by(F.to_date("o_orderdate"), when).alias("last_day"), last.alias("last"), F.round((last - mean) * 100 / mean, 6).alias("off_mean"),
        F.round(years / 3, 6).alias("regular"), F.round(F.count("*") / years, 6).alias("per_year"),
    )


@Q("a33_conditional_counts", "SELECT c_nationkey, count(*) AS n, count_if(c_mktsegment = 'BUILDING') AS builders, round(avg(c_acctbal) FILTER (c_mktsegment = 'BUILDING'), 4) AS their_balance FROM customer GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    b = F.col("c_mktsegment") == "BUILDING"
    return Tables(s, d)("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(b).alias("builders"), F.round(F.avg(F.when(b, F.col("c_acctbal"))), 4).alias("their_balance"))


@Q("a34_binned_means", """WITH p AS (SELECT quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM orders), b AS (SELECT len(list_filter(q, lambda x: x < o_totalprice))::INTEGER AS bin, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM orders, p)
  SELECT bin, count(*) AS n, round(avg(y), 6) AS mean, round(1.96 * stddev_samp(y) / sqrt(count(*)), 6) AS half FROM b GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = ag.cut_point_bins(Tables(s, d)("orders"), "o_totalprice", 10).withColumn("y", (F.col("o_orderstatus") == "F").cast("double"))
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg("y"), 6).alias("mean"), F.round(1.96 * F.stddev_samp("y") / F.sqrt(F.count("*")), 6).alias("half"))


@Q("bars_6h", f"WITH {BARS} SELECT * FROM bars")
def _(s: SparkSession, d: str) -> DataFrame:
    return bars(Tables(s, d))
