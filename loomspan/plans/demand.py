"""Queries over the composite operators of replenishment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import scalars as fx
from loomspan.operators import demand, panel
from loomspan.operators import recurrences as rec
from loomspan.operators import windows as win
from loomspan.plans.fixtures import DAILY, ITEM_SALES, Tables, daily, item_sales
from loomspan.plans.registry import Registry

Q = Registry()

LINES = """lines AS (SELECT l_partkey AS item, p_brand AS grp, s_nationkey AS site, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) / sum(l_quantity) / 30 AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4)"""


def lines(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    keys = [F.col("l_partkey").alias("item"), F.col("p_brand").alias("grp"), F.col("s_nationkey").alias("site"), F.to_date("l_shipdate").alias("day")]
    return joined.groupBy(*keys).agg((F.round(F.sum("l_extendedprice"), 2) / F.sum("l_quantity") / 30).alias("price"))


REPAIRED = f"""{LINES}, x AS (SELECT *, CASE WHEN day >= DATE '1996-07-01' AND item % 10 <> 0 THEN price * (1 + (item % 4) * 0.05::DOUBLE) END AS own FROM lines),
  e AS (SELECT min(day) FILTER (own IS NOT NULL) AS lo, max(day) FILTER (own IS NOT NULL) AS hi FROM x),
  r0 AS (SELECT *, median(CASE WHEN own BETWEEN 0.1 AND 60 THEN own END) OVER (PARTITION BY item, site ORDER BY day ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS r FROM x),
  r1 AS (SELECT item, grp, site, day, coalesce(r, median(r) OVER (PARTITION BY item, day)) AS r FROM r0),
  s0 AS (SELECT item, day, median(price) AS p FROM lines GROUP BY 1, 2),
  s1 AS (SELECT item, day, median(CASE WHEN p BETWEEN 0.1 AND 60 THEN p END) OVER (PARTITION BY item ORDER BY day ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS v FROM s0),
  s2 AS (SELECT item, day, coalesce(first_value(v IGNORE NULLS) OVER (PARTITION BY item ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(v IGNORE NULLS) OVER (PARTITION BY item ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS v FROM s1),
  b0 AS (SELECT r1.*, CASE WHEN v BETWEEN 0.1 AND 60 THEN v END AS v FROM r1 LEFT JOIN s2 USING (item, day)),
  b1 AS (SELECT item, grp, site, day, coalesce(r, median(r) OVER (PARTITION BY item)) AS r, v, median(v) OVER (PARTITION BY item) AS m FROM b0),
  b2 AS (SELECT item, grp, site, day, r, CASE WHEN v BETWEEN 0.5 * m AND 2 * m THEN v ELSE m END AS v FROM b1),
  c AS (SELECT item, CASE WHEN count(*) = count(abs(v - r) / r) THEN median(abs(v - r) / r) END <= 0.08 AS close FROM b2, e WHERE day BETWEEN lo AND hi GROUP BY 1),
  f AS (SELECT b2.item, grp, site, day, coalesce(CASE WHEN day < lo AND close THEN v ELSE r END, v) AS r FROM b2 CROSS JOIN e LEFT JOIN c ON b2.item = c.item),
  rep AS (SELECT item, grp, site, day, round_even(coalesce(r, median(r) OVER (PARTITION BY grp)) * 100.0::DOUBLE, 0) / 100.0::DOUBLE + 0.0 AS repaired FROM f)"""


@Q("d_price_cascade", f"WITH {REPAIRED} SELECT item, grp, site, day, repaired FROM rep")
def _(s: SparkSession, d: str) -> DataFrame:
    """Orders begin in July 1996 and leave out every tenth item; three items of four pay more in them than in sales."""
    rows = lines(Tables(s, d))
    own = F.when((F.col("day") >= F.lit("1996-07-01").cast("date")) & (F.col("item") % 10 != 0), F.col("price") * (1 + (F.col("item") % 4) * 0.05))
    sales = demand.sales_prices(rows, "item", "day", "price")
    return demand.repair_prices(rows.withColumn("own", own), sales, "item", "grp", "site", "day", "own").select("item", "grp", "site", "day", "repaired")


@Q("d_target", f"WITH {DAILY} SELECT grp, day, amount * 0.5 / nullif(round_even(amount / qty * 100.0::DOUBLE, 0) / 100.0::DOUBLE, 0) AS target FROM daily")
def _(s: SparkSession, d: str) -> DataFrame:
    price = fx.half_even(fx.ratio(F.col("amount"), F.col("qty")), 2)
    return daily(Tables(s, d)).select("grp", "day", fx.ratio(F.col("amount") * 0.5, price).alias("target"))


@Q("d_tops_relevant", f"""WITH {ITEM_SALES}, sh AS (SELECT item, grp, site, n_lines, round(amount / sum(amount) OVER (PARTITION BY grp, site), 9) AS share FROM item_sales),
  c AS (SELECT *, coalesce(round(sum(share) OVER (PARTITION BY grp, site ORDER BY share DESC, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 9), 0) AS before FROM sh) SELECT item, grp, site FROM c WHERE (before < 0.7 OR share > 0.7) AND n_lines >= 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    from loomspan.operators.aggregates import share

    rows = item_sales(Tables(s, d)).withColumn("share", F.round(share("amount", ["grp", "site"]), 9))
    return win.top_share(rows, ["grp", "site"], "share", 0.7, ["item"]).where("n_lines >= 2").select("item", "grp", "site")


@Q("d_split1_cluster_to_site", f"""WITH {ITEM_SALES}, w AS (SELECT grp, site, n_regionkey AS cluster, sum(qty) AS weight FROM item_sales JOIN nation ON site = n_nationkey GROUP BY 1, 2, 3), f AS (SELECT grp, cluster, round(sum(weight) * 1.1, 4) AS forecast FROM w GROUP BY 1, 2)
  SELECT w.grp, w.cluster, site, round(forecast * weight / sum(weight) OVER (PARTITION BY w.grp, w.cluster), 6) AS part FROM f JOIN w ON f.grp = w.grp AND f.cluster = w.cluster""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    weights = item_sales(t).join(t("nation"), F.col("site") == F.col("n_nationkey")).groupBy("grp", "site", F.col("n_regionkey").alias("cluster")).agg(F.sum("qty").alias("weight"))
    forecast = weights.groupBy("grp", "cluster").agg(F.round(F.sum("weight") * 1.1, 4).alias("forecast"))
    return demand.split_forecast(forecast, weights, ["grp", "cluster"], "forecast", "weight").select("grp", "cluster", "site", F.round("part", 6).alias("part"))


@Q("d_split2_group_to_item", f"""WITH {ITEM_SALES}, f AS (SELECT grp, site, round(sum(amount) / 100, 4) AS forecast FROM item_sales GROUP BY 1, 2)
  SELECT item, i.grp, i.site, round(forecast * amount / sum(amount) OVER (PARTITION BY i.grp, i.site), 6) AS part FROM item_sales i JOIN f ON i.grp = f.grp AND i.site = f.site""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = item_sales(Tables(s, d))
    forecast = rows.groupBy("grp", "site").agg(F.round(F.sum("amount") / 100, 4).alias("forecast"))
    weights = rows.select("item", "grp", "site", "amount")
    return demand.split_forecast(forecast, weights, ["grp", "site"], "forecast", "amount").select("item", "grp", "site", F.round("part", 6).alias("part"))


@Q("d_ens_two", f"""WITH {DAILY}, a AS (SELECT grp, day, lag(amount, 7) OVER (PARTITION BY grp ORDER BY day) AS f FROM daily WHERE dayofmonth(day) < 25), b AS (SELECT grp, day, lag(amount, 28) OVER (PARTITION BY grp ORDER BY day) AS f FROM daily WHERE dayofmonth(day) > 5)
  SELECT coalesce(a.grp, b.grp) AS grp, coalesce(a.day, b.day) AS day, coalesce(a.f * 0.7::DOUBLE + b.f * (1 - 0.7::DOUBLE), a.f, b.f) AS f FROM a FULL JOIN b ON a.grp = b.grp AND a.day = b.day""")
def _(s: SparkSession, d: str) -> DataFrame:
    w, rows = win.ordered(["grp"], ["day"]), daily(Tables(s, d))
    a = rows.where(F.dayofmonth("day") < 25).select("grp", "day", F.lag("amount", 7).over(w).alias("f"))
    b = rows.where(F.dayofmonth("day") > 5).select("grp", "day", F.lag("amount", 28).over(w).alias("f"))
    return demand.ensemble(a, b, ["grp", "day"], "f", 0.7)


STOCK = f"{DAILY}, s AS (SELECT grp, day, CASE WHEN dayofmonth(day) % 9 IN (1, 2) THEN qty * 3 END AS stock, qty AS sold, CASE WHEN dayofmonth(day) = 17 THEN NULL ELSE round(qty * 0.8) END AS ordered, row_number() OVER (PARTITION BY grp ORDER BY day) AS n FROM daily)"


def stock_rows(t: Tables) -> DataFrame:
    stock = F.when((F.dayofmonth("day") % 9).isin(1, 2), F.col("qty") * 3)
    return daily(t).select("grp", "day", stock.alias("stock"), F.col("qty").alias("sold"), F.when(F.dayofmonth("day") != 17, F.round(F.col("qty") * 0.8)).alias("ordered"))


@Q("d_stock_recurrence", f"""WITH RECURSIVE {STOCK}, r AS (SELECT grp, n, day, stock AS level, CASE WHEN stock IS NULL THEN 1 ELSE 0 END AS gap, sold, ordered FROM s WHERE n = 1 UNION ALL
  SELECT s.grp, s.n, s.day, CASE WHEN s.stock IS NOT NULL THEN s.stock WHEN r.level IS NOT NULL AND r.sold IS NOT NULL AND r.ordered IS NOT NULL AND r.gap < 5 THEN round_even(greatest(0, greatest(0, r.level - 0.02::DOUBLE * r.sold) - r.sold + r.ordered) * 10, 0) / 10 END,
  CASE WHEN s.stock IS NOT NULL THEN 0 ELSE r.gap + 1 END, s.sold, s.ordered FROM r JOIN s ON s.grp = r.grp AND s.n = r.n + 1) SELECT grp, day, level FROM r""")
def _(s: SparkSession, d: str) -> DataFrame:
    return rec.stock_levels(stock_rows(Tables(s, d)), ["grp"], "day", "stock", "sold", "ordered", 0.02, 5).select("grp", "day", "level")


def _orders_sql(base: bool) -> str:
    stock = "lag(stock) OVER w" if base else "stock"
    came = "coalesce(ordered, 0)" if base else "lag(coalesce(ordered, 0)) OVER w"
    return f"""WITH RECURSIVE {STOCK}, g AS (SELECT grp, day, stock, CASE WHEN dayofmonth(day) % 6 = 3 THEN NULL ELSE sold END AS sold, ordered FROM s),
  h AS (SELECT *, lag(sold, 7) OVER (PARTITION BY grp ORDER BY day) AS week, avg(sold) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mean FROM g),
  x AS (SELECT grp, day, {stock} AS stock, coalesce(sold, 0.5 * (mean + week), week, mean) AS sold, {came} AS ordered, row_number() OVER w AS n FROM h WINDOW w AS (PARTITION BY grp ORDER BY day)),
  r AS (SELECT grp, n, day, stock AS level, CASE WHEN stock IS NULL THEN 1 ELSE 0 END AS gap, sold, ordered FROM x WHERE n = 1 UNION ALL
  SELECT x.grp, x.n, x.day, CASE WHEN x.stock IS NOT NULL THEN x.stock WHEN r.level IS NOT NULL AND r.sold IS NOT NULL AND r.ordered IS NOT NULL AND r.gap < 7 THEN round_even(greatest(0, greatest(0, r.level - 0.02::DOUBLE * r.sold) - r.sold + r.ordered) * 10, 0) / 10 END,
  CASE WHEN x.stock IS NOT NULL THEN 0 ELSE r.gap + 1 END, x.sold, x.ordered FROM r JOIN x ON x.grp = r.grp AND x.n = r.n + 1)
  SELECT grp, day, round(level, 4) AS level, CASE WHEN level IS NOT NULL THEN greatest(0, round_even(round(sold + coalesce(lead(sold) OVER (PARTITION BY grp ORDER BY day), sold) * 0.3::DOUBLE - greatest(0, level - 0.02::DOUBLE * sold), 6), 0)) + 0.0 END AS "order" FROM r"""


def _orders(s: SparkSession, d: str, base: bool) -> DataFrame:
    rows = stock_rows(Tables(s, d)).withColumn("sold", F.when(F.dayofmonth("day") % 6 != 3, F.col("sold")))
    return demand.sales_to_orders(rows, ["grp"], "day", base, 0.02, 7, 0.3).select("grp", "day", F.round("level", 4).alias("level"), "order")


@Q("d_flow_orders_warehouse", _orders_sql(True))
def _(s: SparkSession, d: str) -> DataFrame:
    return _orders(s, d, True)


@Q("d_flow_orders_store", _orders_sql(False))
def _(s: SparkSession, d: str) -> DataFrame:
    return _orders(s, d, False)


@Q("d_order1_warehouse", f"WITH {DAILY}, x AS (SELECT grp, day, qty AS sold, lead(qty) OVER (PARTITION BY grp ORDER BY day) AS nxt, greatest(round(qty * 0.5), qty * 0.3::DOUBLE) AS stock FROM daily) SELECT grp, day, greatest(0, round_even(round(sold + coalesce(nxt, sold) * 0.3::DOUBLE - greatest(0, stock - 0.02::DOUBLE * sold), 6), 0)) + 0.0 AS ordered FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    w, sold = win.ordered(["grp"], ["day"]), F.col("qty")
    stock = F.greatest(F.round(sold * 0.5), sold * 0.3)
    return daily(Tables(s, d)).select("grp", "day", rec.order_quantity(sold, F.lead("qty").over(w), stock, 0.3, 0.02).alias("ordered"))


@Q("d_order2_store", f"WITH {DAILY}, x AS (SELECT grp, day, qty AS sold, lead(qty) OVER (PARTITION BY grp ORDER BY day) AS nxt, CASE WHEN dayofmonth(day) % 5 > 0 THEN round(qty * 0.4) END AS stock FROM daily) SELECT grp, day, CASE WHEN stock IS NOT NULL THEN greatest(0, round_even(round(sold + coalesce(nxt, sold) * 0.2::DOUBLE - greatest(0, stock - 0.01::DOUBLE * sold), 6), 0)) + 0.0 END AS ordered FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    w, sold = win.ordered(["grp"], ["day"]), F.col("qty")
    stock = F.when(F.dayofmonth("day") % 5 > 0, F.round(sold * 0.4))
    wanted = rec.order_quantity(sold, F.lead("qty").over(w), stock, 0.2, 0.01)
    return daily(Tables(s, d)).select("grp", "day", F.when(stock.isNotNull(), wanted).alias("ordered"))


@Q("d_rate_defaults", "SELECT p_partkey, p_type, coalesce(CASE WHEN p_type LIKE '%STEEL%' THEN 0.05 END, 0.02)::DOUBLE AS spoilage, coalesce(CASE WHEN p_type LIKE '%STEEL%' THEN 0.3 END, 0.1)::DOUBLE AS min_stock FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    parts = Tables(s, d)("part").select("p_partkey", "p_type")
    rates = parts.where("p_type like '%STEEL%'").select("p_type").distinct().withColumns({"spoilage": F.lit(0.05), "min_stock": F.lit(0.3)})
    return demand.with_rates(parts, rates, "p_type", {"spoilage": 0.02, "min_stock": 0.1})


@Q("d_load_normalised", "SELECT lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS item, n_name AS site, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    rows = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(fx.coded(F.col("l_partkey"), 8).alias("item"), F.col("n_name").alias("site"), F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("qty"))


@Q("d_scope_as_of", f"""WITH {DAILY}, l AS (SELECT grp, amount, row_number() OVER (PARTITION BY grp ORDER BY day DESC) AS n, max(day) OVER (PARTITION BY grp) AS last FROM daily), k AS (SELECT grp, max(CASE WHEN n = 1 THEN amount END) AS lag_1, max(CASE WHEN n = 7 THEN amount END) AS lag_7 FROM l GROUP BY 1)
  SELECT grp, CAST(d AS DATE) AS day, lag_1, lag_7 FROM k, generate_series(DATE '2001-11-05', DATE '2001-11-07', INTERVAL 1 DAY) g(d)""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d))
    targets = panel.grid(rows.select("grp"), F.lit("2001-11-05").cast("date"), F.lit("2001-11-07").cast("date"), "day")
    return demand.as_of_features(rows, ["grp"], "day", "amount", [1, 7], targets)


@Q("d_hor_availability", f"WITH {DAILY} SELECT grp, max(day) AS last, datediff('day', max(day), DATE '2001-12-31')::INTEGER AS horizon, max(day) >= DATE '2001-11-01' AS available FROM daily GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    last = F.max("day")
    return daily(Tables(s, d)).groupBy("grp").agg(last.alias("last"), F.datediff(F.lit("2001-12-31").cast("date"), last).alias("horizon"), (last >= F.lit("2001-11-01").cast("date")).alias("available"))


FLOW = f"""WITH {DAILY}, e AS (SELECT min(day) AS lo, max(day) AS hi FROM daily), g AS (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT grp FROM daily), e),
  p AS (SELECT g.grp, g.day, amount / nullif(qty, 0) AS price FROM g LEFT JOIN daily USING (grp, day)), f AS (SELECT grp, day, last_value(price IGNORE NULLS) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM p),
  m AS (SELECT grp, day, median(price) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS smooth FROM f)
  SELECT grp, day, smooth, """ + ", ".join(f"CASE WHEN lag(smooth, {k}) OVER w IS NOT NULL THEN greatest(-100, least(300, round_even(100 * ((smooth - lag(smooth, {k}) OVER w) / nullif(lag(smooth, {k}) OVER w, 0)) * 100.0::DOUBLE, 0) / 100.0::DOUBLE + 0.0)) END AS change_{k}" for k in (7, 30)) + " FROM m WINDOW w AS (PARTITION BY grp ORDER BY day)"


@Q("d_flow_price_change", FLOW)
def panel_price_change(s: SparkSession, d: str) -> DataFrame:
    """Scan, join, aggregate, densify, fill, smooth, compare: the spine of the replenishment flow."""
    w = win.ordered(["grp"], ["day"])
    full = panel.densify(daily(Tables(s, d)), ["grp"], "day").select("grp", "day", fx.ratio(F.col("amount"), F.col("qty")).alias("price"))
    filled = full.select("grp", "day", win.fill_forward(F.col("price"), w).alias("price"))
    smooth = filled.select("grp", "day", win.quantile(F.col("price"), 0.5, win.centred(w, 7)).alias("smooth"))
    x = F.col("smooth")
    return smooth.select("grp", "day", "smooth", *(win.change(x, F.lag(x, k).over(w), 2, -100.0, 300.0).alias(f"change_{k}") for k in (7, 30)))


FMT = f"""WITH {ITEM_SALES}, f AS (SELECT grp, site, round(sum(amount) / 100, 4) AS forecast FROM item_sales GROUP BY 1, 2), p AS (SELECT item, i.grp, i.site, forecast * amount / sum(amount) OVER (PARTITION BY i.grp, i.site) AS part, qty FROM item_sales i JOIN f ON i.grp = f.grp AND i.site = f.site)
  SELECT lpad(CAST(item AS VARCHAR), 8, '0') AS "UB", site AS "SITE", round(part, 4) AS "TARGET", CASE WHEN contains(p_type, 'STEEL') THEN round(part, 4) ELSE round_even(round(part / p_size, 6), 0) + 0.0 END AS "UNITS", 'V1' AS "RUN" FROM p JOIN part ON p_partkey = item"""


@Q("d_fmt_export", FMT)
def _(s: SparkSession, d: str) -> DataFrame:
    """Group forecasts split to items, coded, in weights or units, under the names of the export."""
    t = Tables(s, d)
    rows = item_sales(t)
    forecast = rows.groupBy("grp", "site").agg(F.round(F.sum("amount") / 100, 4).alias("forecast"))
    parts = demand.split_forecast(forecast, rows.select("item", "grp", "site", "amount"), ["grp", "site"], "forecast", "amount")
    items = t("part").select(F.col("p_partkey").alias("item"), "p_type", "p_size")
    kind = fx.first_match(F.col("p_type"), [("STEEL", "BULK")], "PIECE")
    units = F.when(kind == "PIECE", fx.half_even(F.round(F.col("part") / F.col("p_size"), 6))).otherwise(F.round("part", 4))
    named = parts.join(items, "item").select(fx.coded(F.col("item"), 8).alias("item"), "site", F.round("part", 4).alias("target"), units.alias("units"))
    return named.withColumnsRenamed({"item": "UB", "site": "SITE", "target": "TARGET", "units": "UNITS"}).withColumn("RUN", F.lit("V1"))
