"""Queries over market series, trades and companies' figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions import scalars as fx
from loomspan.operators import market
from loomspan.operators import recurrences as rec
from loomspan.plans.fixtures import BARS, DAILY, REVENUE, Tables, bars, daily, revenue
from loomspan.plans.registry import Registry

Q = Registry()

_R = ", ".join(f"lead(close, {k}) OVER w / close - 1 AS r{k}" for k in range(1, 9))
_CUT = ", ".join(f"quantile_cont({c}, {q}) AS {c}_{s}" for c in (*(f"r{k}" for k in range(1, 9)), "past") for s, q in (("hi", 0.6), ("lo", 0.4)))
_UP = " + ".join(f"coalesce((r{k} >= r{k}_hi)::INT, 0)" for k in range(1, 9))
_DOWN = " + ".join(f"coalesce((r{k} <= r{k}_lo)::INT, 0)" for k in range(1, 9))


@Q("m_label", f"WITH {BARS}, r AS (SELECT asset, bar, close, {_R}, close / lag(close) OVER w - 1 AS past FROM bars WINDOW w AS (PARTITION BY asset ORDER BY bar)), c AS (SELECT asset, {_CUT} FROM r GROUP BY 1) SELECT r.asset, bar, close, CASE WHEN {_UP} >= 6 AND past <= past_lo THEN 'UP' WHEN {_DOWN} >= 6 AND past >= past_hi THEN 'DOWN' END AS label FROM r JOIN c ON r.asset = c.asset")
def _(s: SparkSession, d: str) -> DataFrame:
    return market.labels(bars(Tables(s, d)).select("asset", "bar", "close"), "asset", "bar", "close", 8, 6, 0.6, 0.4)


@Q("m_state_machine", f"""WITH RECURSIVE {BARS}, b AS (SELECT asset, bar, close, close / lag(close) OVER w - 1 AS delta, row_number() OVER w AS n FROM bars WINDOW w AS (PARTITION BY asset ORDER BY bar)),
  z AS (SELECT asset, 0::BIGINT AS n, NULL::TIMESTAMP AS bar, 1000.0::DOUBLE AS cash, 0.0::DOUBLE AS coins, NULL::DOUBLE AS paid, 0 AS action FROM (SELECT DISTINCT asset FROM b) UNION ALL
  SELECT asset, n, bar, CASE WHEN buys THEN 0 WHEN sells THEN coins * close * (1 - 0.0015::DOUBLE) ELSE cash END, CASE WHEN buys THEN cash * (1 - 0.0015::DOUBLE) / close WHEN sells THEN 0 ELSE coins END, CASE WHEN buys THEN close WHEN sells THEN NULL ELSE paid END, CASE WHEN buys THEN 1 WHEN sells THEN -1 ELSE 0 END
  FROM (SELECT z.asset, b.n, b.bar, b.close, cash, coins, paid, coins = 0 AND coalesce(delta < -0.04, false) AS buys, coins > 0 AND coalesce(delta > 0.04 OR close / paid - 1 > 0.06 OR close / paid - 1 < -0.03, false) AS sells FROM z JOIN b ON b.asset = z.asset AND b.n = z.n + 1) x)
  SELECT asset, bar, round(cash, 6) AS cash, round(coins, 9) AS coins, paid, action FROM z WHERE n > 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("asset").orderBy("bar")
    rows = bars(Tables(s, d)).select("asset", "bar", "close", (F.col("close") / F.lag("close").over(w) - 1).alias("delta"))
    gain = lambda r, st: r["close"] / st["paid"] - 1
    buy = lambda r, st: r["delta"] < -0.04
    sell = lambda r, st: (r["delta"] > 0.04) | (gain(r, st) > 0.06) | (gain(r, st) < -0.03)
    done = rec.trades(rows, ["asset"], "bar", "close", buy, sell, 0.0015, 1000.0)
    return done.select("asset", "bar", F.round("cash", 6).alias("cash"), F.round("coins", 9).alias("coins"), "paid", "action")


@Q("m_base_buy_and_hold", f"WITH {BARS} SELECT asset, bar, round(1000 / first_value(close) OVER w * close, 6) AS value FROM bars WINDOW w AS (PARTITION BY asset ORDER BY bar)")
def _(s: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("asset").orderBy("bar")
    return bars(Tables(s, d)).select("asset", "bar", F.round(1000 / F.first("close").over(w) * F.col("close"), 6).alias("value"))


@Q("m_merge_portfolio", f"""WITH {BARS}, k AS (SELECT DISTINCT bar FROM bars), a AS (SELECT DISTINCT asset FROM bars), f AS (SELECT asset, bar, coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY bar ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY bar ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS c
  FROM k CROSS JOIN a LEFT JOIN bars USING (asset, bar)) SELECT bar, round(sum(c), 4) AS portfolio FROM f GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    from loomspan.operators.windows import fill_backward, fill_forward

    rows = bars(Tables(s, d)).select("asset", "bar", "close")
    names = [r["asset"] for r in rows.select("asset").distinct().orderBy("asset").collect()]  # assets are few
    spine = rows.select("bar").distinct().withColumn("asset", F.explode(F.array(*map(F.lit, names))))
    w = W.partitionBy("asset").orderBy("bar")
    full = spine.join(rows, ["asset", "bar"], "left").withColumn("c", F.coalesce(fill_forward(F.col("close"), w), fill_backward(F.col("close"), w)))
    return full.groupBy("bar").agg(F.round(F.sum("c"), 4).alias("portfolio"))


@Q("m_alloc", f"""WITH {BARS}, g AS (SELECT asset, arg_max(close, bar) / arg_min(close, bar) - 1 AS p, arg_max(close, bar) * sum(volume) AS value FROM bars GROUP BY 1), r AS (SELECT *, 1 + 4 * (p - avg(p) OVER ()) AS r, count(*) OVER () AS n FROM g),
  c AS (SELECT *, greatest(least(r / nullif(sum(r) OVER (), 0), 2 / n), 0) AS c FROM r), t AS (SELECT asset, c / sum(c) OVER () AS target, value / sum(value) OVER () AS actual FROM c), w AS (SELECT *, CASE WHEN actual > target THEN 0.0::DOUBLE ELSE target END AS w FROM t)
  SELECT asset, round(target, 6) AS target, round(actual, 6) AS actual, round_even(round(1000 * w / sum(w) OVER () - 0.4, 6), 0) + 0.0 AS cash FROM w""")
def _(s: SparkSession, d: str) -> DataFrame:
    gains = bars(Tables(s, d)).groupBy("asset").agg((F.max_by("close", "bar") / F.min_by("close", "bar") - 1).alias("p"), (F.max_by("close", "bar") * F.sum("volume")).alias("value"))
    return market.allocation(gains, "asset", "p", "value", 1000.0).select("asset", F.round("target", 6).alias("target"), F.round("actual", 6).alias("actual"), "cash")


TRADES = """t AS (SELECT user_id AS asset, ts, event_id, event_type, round(1 + value, 2) AS qty, value AS price, round(sum(round(1 + value, 2)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), 6) AS hi FROM events WHERE event_type IN ('purchase', 'error')), i AS (SELECT *, round(hi - qty, 6) AS lo FROM t)"""


@Q("m_fifo_lots", f"WITH {TRADES} SELECT b.asset, b.event_id AS buy_id, s.event_id AS sell_id, round(least(b.hi, s.hi) - greatest(b.lo, s.lo), 6) AS qty, round((least(b.hi, s.hi) - greatest(b.lo, s.lo)) * (s.price - b.price), 4) AS margin FROM i b JOIN i s ON b.asset = s.asset AND b.lo < s.hi AND s.lo < b.hi WHERE b.event_type = 'purchase' AND s.event_type = 'error'")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)("events").select(F.col("user_id").alias("asset"), "ts", "event_id", "event_type", F.round(1 + F.col("value"), 2).alias("qty"), F.col("value").alias("price"))
    return rec.fifo(t.where("event_type = 'purchase'"), t.where("event_type = 'error'"), "asset", ["ts", "event_id"], "qty", "price")


@Q("m_orders_checked", "SELECT event_id, side, limit_price, abs(limit_price - value) / value <= 0.015 AND user_id >= 10 AS sent FROM (SELECT event_id, value, user_id, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, CASE WHEN event_id % 2 = 0 THEN least(value * 0.99, value * 0.9975) ELSE greatest(value * 1.001, value * 1.002) END AS limit_price FROM events)")
def _(s: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    moves = Tables(s, d)("events").select("event_id", "value", "user_id", F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell").alias("side"), (v * 0.99).alias("bid"), (v * 1.001).alias("ask"))
    return market.order_check(moves, "side", "value", "bid", "ask", "user_id", 10).select("event_id", "side", "limit_price", "sent")


@Q("m_fold_temporal", f"WITH {DAILY} SELECT grp, day, (datediff('day', DATE '1996-01-01', day) // 180)::INTEGER AS fold FROM daily WHERE day >= DATE '1996-01-01' AND day < DATE '1996-01-01' + 900")
def _(s: SparkSession, d: str) -> DataFrame:
    return market.temporal_folds(daily(Tables(s, d)).select("grp", "day"), "day", "1996-01-01", 5, 180)


@Q("m_sharpe_rank", f"WITH {DAILY}, g AS (SELECT grp, arg_max(amount, day) / arg_min(amount, day) AS gain, stddev_samp(amount) / avg(amount) AS risk FROM daily GROUP BY 1) SELECT grp, round((gain - 1) / risk, 6) AS score, rank() OVER (ORDER BY round((gain - 1) / risk, 6) DESC)::INTEGER AS place FROM g")
def _(s: SparkSession, d: str) -> DataFrame:
    g = daily(Tables(s, d)).groupBy("grp").agg((F.max_by("amount", "day") / F.min_by("amount", "day")).alias("gain"), (F.stddev_samp("amount") / F.avg("amount")).alias("risk"))
    scored = g.select("grp", F.round(fx.ratio(F.col("gain") - 1, F.col("risk")), 6).alias("score"))
    return scored.withColumn("place", F.rank().over(W.orderBy(F.desc("score"))))  # a row for each group


@Q("m_index_levels", f"WITH {DAILY}, x AS (SELECT day, substr(grp, 1, 7) AS sector, amount FROM daily) SELECT day, sector, round(avg(amount), 6) AS level, count(*) AS n FROM x GROUP BY 1, 2 UNION ALL SELECT day, NULL, round(avg(amount), 6), count(*) FROM x GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).withColumn("sector", F.substring("grp", 1, 7))
    return market.indices(rows, "day", "sector", "amount").select("day", "sector", F.round("level", 6).alias("level"), "n")


@Q("m_mc_draws", f"""WITH {DAILY}, q AS (SELECT substr(grp, 1, 7) AS sector, grp AS asset, CAST(date_trunc('quarter', day) AS DATE) AS qd, round(sum(amount), 2) AS x FROM daily GROUP BY 1, 2, 3),
  l AS (SELECT sector, asset, qd, 100 * x / first_value(x) OVER (PARTITION BY asset ORDER BY qd) AS v FROM q),
  e AS (SELECT sector, asset, arg_max(v, qd) - 100 AS gain, stddev_samp(v) AS spread FROM l GROUP BY 1, 2),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY round(gain / spread, 6) DESC, asset) AS place FROM e) WHERE place <= 5),
  c AS (SELECT l.asset, m.asset AS other, covar_samp(l.v, m.v) AS cov, corr(l.v, m.v) AS corr FROM l JOIN l m ON l.qd = m.qd WHERE l.asset IN (SELECT asset FROM b) AND m.asset IN (SELECT asset FROM b) GROUP BY 1, 2),
  n AS (SELECT sector, draw, 1 + ('0x' || substr(md5(sector || ':' || draw || ':7'), 1, 12))::BIGINT % count(*) AS place FROM b, generate_series(0, 2999) g(draw) GROUP BY sector, draw),
  k AS (SELECT draw, asset, gain FROM n JOIN b ON n.sector = b.sector AND n.place = b.place),
  r AS (SELECT k.draw, sqrt(avg(cov)) AS spread, avg(CASE WHEN c.asset <> c.other THEN corr END) AS correlation FROM k JOIN k o ON k.draw = o.draw JOIN c ON c.asset = k.asset AND c.other = o.asset GROUP BY 1)
  SELECT k.draw::INTEGER AS draw, round(avg(gain), 6) AS gain, round(any_value(spread), 6) AS spread, round(any_value(correlation), 6) AS correlation FROM k JOIN r ON k.draw = r.draw GROUP BY k.draw""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).groupBy(F.substring("grp", 1, 7).alias("sector"), F.col("grp").alias("asset"), F.to_date(F.date_trunc("quarter", "day")).alias("at")).agg(F.round(F.sum("amount"), 2).alias("x"))
    made = market.simulate(rows, "sector", "asset", "at", "x", 3000, 7)
    return made.select("draw", *(F.round(c, 6).alias(c) for c in ("gain", "spread", "correlation")))


@Q("m_neutral_features", f"WITH {DAILY}, x AS (SELECT *, substr(grp, 1, 7) AS sector FROM daily), y AS (SELECT grp, day, amount, median(amount) OVER (PARTITION BY day) AS m, median(amount) OVER (PARTITION BY day, sector) AS p FROM x) SELECT grp, day, (amount - m) / (m + 0.1::DOUBLE) AS to_market, (amount - p) / (p + 0.1::DOUBLE) AS to_sector FROM y")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d)).withColumn("sector", F.substring("grp", 1, 7))
    full = rows.join(rows.groupBy("day").agg(F.median("amount").alias("m")), "day").join(rows.groupBy("day", "sector").agg(F.median("amount").alias("p")), ["day", "sector"])
    rel = lambda c: (F.col("amount") - F.col(c)) / (F.col(c) + 0.1)
    return full.select("grp", "day", rel("m").alias("to_market"), rel("p").alias("to_sector"))


#: Rates by the order priority that stands in for them, and the countries (regions) that take another one's rates.
MACRO = {"inflation": ("1-URGENT", {4: 1}), "long_rates": ("2-HIGH", {3: 2}), "short_rates": ("3-MEDIUM", {3: 1}), "producer_prices": ("4-NOT SPECIFIED", {3: 2, 0: 4}), "unemployment": ("5-LOW", {3: 2, 0: 0})}


def _macro_sql() -> str:
    own = {c: "CASE region " + " ".join(f"WHEN {k} THEN {v}" for k, v in swap.items()) + " ELSE region END" for c, (_, swap) in MACRO.items()}
    joins = " ".join(f"LEFT JOIN m m_{c} ON m_{c}.kind = '{kind}' AND m_{c}.region = {own[c]} AND m_{c}.month = k.month" for c, (kind, _) in MACRO.items())
    order = "PARTITION BY region ORDER BY company, month ROWS BETWEEN"
    fills = ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}" for c in MACRO)
    return f"""WITH o AS (SELECT n_regionkey AS region, c_nationkey AS company, o_orderpriority AS kind, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
      m AS (SELECT region, kind, month, round(avg(v), 4) AS rate FROM o WHERE month(month) % 5 > 0 GROUP BY 1, 2, 3), k AS (SELECT DISTINCT region, company, month FROM o),
      j AS (SELECT k.*, {", ".join(f"m_{c}.rate AS {c}" for c in MACRO)} FROM (SELECT * FROM k) k {joins.replace('region END', 'k.region END').replace('CASE region', 'CASE k.region')}) SELECT region, company, month, {fills} FROM j"""


@Q("m_macro_joins", _macro_sql())
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    sold = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sold = sold.select(F.col("n_regionkey").alias("region"), F.col("c_nationkey").alias("company"), F.col("o_orderpriority").alias("kind"), F.trunc("o_orderdate", "MM").alias("month"), "o_totalprice")
    rates = sold.where(F.month("month") % 5 > 0).groupBy("region", "kind", "month").agg(F.round(F.avg("o_totalprice"), 4).alias("rate"))
    tables = {c: (rates.where(F.col("kind") == kind).select("region", "month", "rate"), swap) for c, (kind, swap) in MACRO.items()}
    return market.macro_joins(sold.select("region", "company", "month").distinct(), tables, "region", "company", "month", "rate")


ASSETS = ["click", "error", "purchase", "signup", "view"]


def _commodities_sql() -> str:
    fill = lambda c: f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY bar ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (ORDER BY bar ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
    near = "OVER (ORDER BY bar ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
    feats = ", ".join(f"round(stddev_samp({c}) {near}, 6) AS {c}_std, round({c} / avg({c}) {near} - 1, 6) AS {c}_off" for c in ASSETS)
    wide = ", ".join(f"max(close) FILTER (asset = '{c}') AS {c}" for c in ASSETS)
    return f"WITH {BARS}, p AS (SELECT bar, {wide} FROM bars GROUP BY 1), f AS (SELECT bar, {', '.join(fill(c) for c in ASSETS)} FROM p), k AS (SELECT bar, {', '.join(ASSETS)}, {feats} FROM f) SELECT asset, close, k.* FROM bars JOIN k ON bars.bar = k.bar"


@Q("m_commodity_pivot", _commodities_sql())
def _(s: SparkSession, d: str) -> DataFrame:
    rows = bars(Tables(s, d)).select("asset", "bar", "close")
    return rows.join(market.wide_features(rows, "bar", "asset", "close", ASSETS, 5), "bar")


@Q("e_ttm_sum", f"WITH {REVENUE} SELECT company, quarter, CASE WHEN count(*) OVER w = 4 AND min(quarter) OVER w = CAST(quarter - INTERVAL 9 MONTH AS DATE) THEN round(sum(revenue) OVER w, 2) END AS ttm FROM revenue WINDOW w AS (PARTITION BY company ORDER BY quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def _(s: SparkSession, d: str) -> DataFrame:
    return market.trailing_sum(revenue(Tables(s, d)), ["company"], "quarter", "revenue", "ttm").select("company", "quarter", F.round("ttm", 2).alias("ttm"))


#: A statement of a company (nation) and year: sums of orders by priority and status stand in for its items.
STATEMENT = """statement AS (SELECT c_nationkey AS company, year(o_orderdate)::INTEGER AS yr, sum(o_totalprice)::DOUBLE AS revenue, (sum(o_totalprice) FILTER (o_orderpriority = '1-URGENT') - sum(o_totalprice) FILTER (o_orderpriority = '5-LOW'))::DOUBLE AS net,
  (sum(o_totalprice) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')))::DOUBLE AS operating, (sum(o_totalprice) FILTER (o_orderpriority = '4-NOT SPECIFIED'))::DOUBLE AS sales_cost, (sum(o_totalprice) FILTER (o_orderpriority = '3-MEDIUM'))::DOUBLE AS research,
  (sum(o_totalprice) FILTER (o_orderstatus = 'F'))::DOUBLE AS liabilities, (CASE WHEN c_nationkey % 4 > 0 THEN sum(o_totalprice) FILTER (o_orderpriority < '4') END)::DOUBLE AS current_assets, (CASE WHEN c_nationkey % 4 > 0 THEN sum(o_totalprice) FILTER (o_orderstatus = 'O') END)::DOUBLE AS current_liabilities,
  (CASE WHEN c_nationkey % 3 > 0 THEN -sum(o_totalprice) FILTER (o_orderstatus = 'P') END)::DOUBLE AS spent FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def statement(t: Tables) -> DataFrame:
    def part(where: Column) -> Column:
        return F.sum(F.when(where, F.col("o_totalprice")))

    pr, st, some = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_nationkey")
    rows = t("orders").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy(F.col("c_nationkey").alias("company"), F.year("o_orderdate").alias("yr")).agg(
        F.sum("o_totalprice").alias("revenue"), (part(pr == "1-URGENT") - part(pr == "5-LOW")).alias("net"), part(pr.isin("1-URGENT", "2-HIGH")).alias("operating"), part(pr == "4-NOT SPECIFIED").alias("sales_cost"), part(pr == "3-MEDIUM").alias("research"),
        part(st == "F").alias("liabilities"), part((some % 4 > 0) & (pr < "4")).alias("current_assets"), part((some % 4 > 0) & (st == "O")).alias("current_liabilities"), (-part((some % 3 > 0) & (st == "P"))).alias("spent"),
    )


def _trend_sql(c: str) -> str:
    w = "OVER (PARTITION BY company ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {w} > 1 THEN round(100 * (regr_slope({c}, yr) {w}) / nullif(first_value({c} IGNORE NULLS) {w}, 0), 6) END"


def _change_sql(c: str, k: int) -> str:
    before = f"lag({c}, {k}) OVER (PARTITION BY company ORDER BY yr)"
    return f"round(100 * ({c} - {before}) / (0.1 + abs({before})), 6)"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("company", "yr", *(F.round(c, 6).alias(c) for c in columns))


INCOME = {
    "margin": "round(100 * net / (revenue + 0.01), 6)", "taxes": "round(100 * (operating - net) / revenue, 6)", "research_yoy": _change_sql("research", 1),
    **{f"{c}_yoy": _change_sql(c, 1) for c in ("revenue", "net", "operating")}, **{f"{c}_yo2y": _change_sql(c, 2) for c in ("revenue", "net", "operating")},
    **{f"{c}_trend": _trend_sql(c) for c in ("revenue", "net", "operating", "sales_share", "research_share")},
}


@Q("e_is_year_on_year", f"WITH {STATEMENT}, x AS (SELECT *, sales_cost / revenue AS sales_share, research / (research + operating) AS research_share FROM statement) SELECT company, yr, {', '.join(f'{v} AS {k}' for k, v in INCOME.items())} FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    return _rounded(market.income_kpis(statement(Tables(s, d)), ["company"], "yr"), *INCOME)


BALANCE = {
    "equity": "round(equity, 6)", "current_ratio": "round(current_ratio, 6)", "assets_to_liabilities": "round(100 * revenue / liabilities, 6)", "cash_to_debt": "round(100 * operating / liabilities, 6)",
    "goodwill_share": "round(100 * research / revenue, 6)", "current_trend": _trend_sql("current_ratio"), "equity_trend": _trend_sql("equity"),
}


@Q("e_bs_ratios", f"WITH {STATEMENT}, x AS (SELECT *, revenue - liabilities AS equity, 100 * coalesce(current_assets, revenue) / coalesce(current_liabilities, liabilities) AS current_ratio FROM statement) SELECT company, yr, {', '.join(f'{v} AS {k}' for k, v in BALANCE.items())} FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = statement(Tables(s, d)).withColumns({"assets": F.col("revenue"), "receivables": F.col("operating"), "debt": F.col("liabilities"), "goodwill": F.col("research")})
    return _rounded(market.balance_kpis(rows, ["company"], "yr"), *BALANCE)


CASH = {
    "free": "round(free, 6)", "free_mean": "round(avg(free) OVER (PARTITION BY company), 6)", "into_activity": "round(100 * abs(spent) / operating, 6)", "into_acquisition": "round(100 * research / operating, 6)", "into_stock": "round(100 * net / operating, 6)",
    "into_dividends": "round(100 * sales_cost / operating, 6)", "from_finance": "round(100 * liabilities / operating, 6)", "operating_trend": _trend_sql("operating"), "free_trend": _trend_sql("free"),
}


@Q("e_cf_free_cash", f"WITH {STATEMENT}, y AS (SELECT * REPLACE (CASE WHEN count(spent) OVER (PARTITION BY company) = 0 THEN 0.2 * operating ELSE spent END AS spent) FROM statement), x AS (SELECT *, operating + spent AS free FROM y) SELECT company, yr, {', '.join(f'{v} AS {k}' for k, v in CASH.items())} FROM x")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = statement(Tables(s, d)).withColumns({"acquired": F.col("research"), "stock": F.col("net"), "dividends": F.col("sales_cost"), "financing": F.col("liabilities")})
    return _rounded(market.cash_kpis(rows, ["company"], "yr"), *CASH)


NEAR = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(a.v, b.v), 6) AS weight, a.label FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
  k AS (SELECT vec_id, other, weight, row_number() OVER (PARTITION BY vec_id ORDER BY weight DESC, other)::INTEGER AS place FROM n WHERE weight >= 0.2), near AS (SELECT * FROM k WHERE place <= 5)"""


def near(t: Tables) -> DataFrame:
    return market.neighbours(t("embeddings"), "vec_id", "label", "embedding", 5, 0.2)


@Q("j17_sector_neighbours", f"WITH {NEAR} SELECT vec_id, other, weight, place FROM near")
def _(s: SparkSession, d: str) -> DataFrame:
    return near(Tables(s, d))


@Q("e_peer_gap", f"WITH {NEAR}, x AS (SELECT vec_id, 10 + vec_id % 17 AS x FROM e), p AS (SELECT near.vec_id, sum(x.x * weight) / sum(weight) AS peer FROM near JOIN x ON x.vec_id = other GROUP BY 1) SELECT x.vec_id, x::DOUBLE AS x, round(peer, 6) AS peer, CASE WHEN peer IS NOT NULL THEN round(greatest(-1, least(10, (x - peer) / peer)), 4) + 0.0 END AS gap FROM x LEFT JOIN p ON x.vec_id = p.vec_id")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    rows = t("embeddings").select("vec_id", (10 + F.col("vec_id") % 17).cast("double").alias("x"))
    return market.peer_gap(rows, near(t), "vec_id", "x").select("vec_id", "x", F.round("peer", 6).alias("peer"), (F.round("gap", 4) + 0.0).alias("gap"))


@Q("e_pe_stack", f"WITH {REVENUE}, y AS (SELECT company, year(quarter)::INTEGER AS yr, round(sum(revenue), 2) AS revenue, sum(n_orders)::BIGINT AS n FROM revenue GROUP BY 1, 2) SELECT a.company, a.yr, a.revenue / a.n AS pe, b.revenue / b.n AS pe_before, a.revenue / b.revenue - 1 AS growth FROM y a JOIN y b ON a.company = b.company AND a.yr = b.yr + 1")
def _(s: SparkSession, d: str) -> DataFrame:
    y = revenue(Tables(s, d)).groupBy("company", F.year("quarter").alias("yr")).agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("n_orders").alias("n"))
    before = y.select("company", (F.col("yr") + 1).alias("yr"), F.col("revenue").alias("rb"), F.col("n").alias("nb"))
    return y.join(before, ["company", "yr"]).select("company", "yr", (F.col("revenue") / F.col("n")).alias("pe"), (F.col("rb") / F.col("nb")).alias("pe_before"), (F.col("revenue") / F.col("rb") - 1).alias("growth"))


@Q("e_clip_three_years", f"WITH {REVENUE}, y AS (SELECT company, year(quarter)::INTEGER AS yr, round(sum(revenue), 2) AS revenue FROM revenue GROUP BY 1, 2) SELECT company, yr, greatest(1e6, least(3e7, revenue))::DOUBLE AS revenue, round(avg(revenue) OVER (PARTITION BY company ORDER BY yr ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS mean3 FROM y")
def _(s: SparkSession, d: str) -> DataFrame:
    y = revenue(Tables(s, d)).groupBy("company", F.year("quarter").alias("yr")).agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    w = W.partitionBy("company").orderBy("yr").rowsBetween(-2, 0)
    return y.select("company", "yr", fx.clip(F.col("revenue"), 1e6, 3e7).alias("revenue"), F.round(F.avg("revenue").over(w), 4).alias("mean3"))


#: Stand-ins for the measures of the scorecard: a balance, scaled and moved so that every step of its ladder is met.
_MEASURE = {c: (k * 37 % 101 + 7, min(v for _, v, _ in steps), max(v for _, v, _ in steps)) for k, (c, steps) in enumerate([*market.LADDERS.items(), ("stock_year", [("<", -30, 0), ("<", 60, 0)])])}


def _measure_sql(c: str) -> str:
    k, low, high = _MEASURE[c]
    return f"CASE WHEN (c_custkey + {k}) % 11 > 0 THEN round({low} + ((c_custkey * {k}) % 97 / 96.0::DOUBLE * 1.4 - 0.2) * ({high} - ({low})), 6) END"


def _score_sql() -> str:
    steps = {c: " ".join(f"WHEN {c} {op} {v} THEN {p}" for op, v, p in rungs) for c, rungs in market.LADDERS.items()}
    ladders = " + ".join(f"CASE {x} ELSE 0 END::DOUBLE" for x in steps.values())
    behind = " ".join(f"WHEN stock_year < {part}::DOUBLE * net_yoy THEN {p}" for part, p in market.STOCK_BEHIND)
    return f"WITH m AS (SELECT c_custkey, {', '.join(f'{_measure_sql(c)} AS {c}' for c in _MEASURE)} FROM customer) SELECT c_custkey, {ladders} + CASE {behind} ELSE 0 END::DOUBLE AS score FROM m"


@Q("e_score_additive", _score_sql())
def _(s: SparkSession, d: str) -> DataFrame:
    def measure(c: str) -> Column:
        k, low, high = _MEASURE[c]
        x = F.col("c_custkey")
        return F.when((x + k) % 11 > 0, F.round(low + (x * k % 97 / 96 * 1.4 - 0.2) * (high - low), 6)).alias(c)

    rows = Tables(s, d)("customer").select("c_custkey", *map(measure, _MEASURE))
    return rows.select("c_custkey", market.business_score().alias("score"))


@Q("e_prof_fields", r"SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS rating, string_split(p_type, ' ')[1] AS kind FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").select("p_partkey", F.regexp_extract("p_brand", "([0-9]+)", 1).try_cast("int").alias("rating"), F.split_part(F.col("p_type"), F.lit(" "), F.lit(1)).alias("kind"))


@Q("j18_nearest_centres", """WITH p AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, generate_series(1, 64) g(i) GROUP BY 1, 2), d AS (SELECT vec_id, p.label AS centre, round(sum(pow(embedding[i]::DOUBLE - m, 2)), 6) AS distance FROM embeddings, p GROUP BY 1, 2)
  SELECT vec_id, arg_min(centre, (distance, centre)) AS centre, min(distance) AS distance FROM d GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    from loomspan.operators.joins import nearest
    from loomspan.operators.text import centroids

    e = Tables(s, d)("embeddings")
    centres = centroids(e, "label", "embedding").select(F.col("label").alias("centre"), "centroid")
    square = F.aggregate(F.zip_with("embedding", "centroid", lambda x, y: F.pow(x.cast("double") - y, 2)), F.lit(0.0), lambda a, x: a + x)
    return nearest(e.select("vec_id", "embedding"), centres, F.round(square, 6), ["vec_id"], 1).select("vec_id", "centre", "distance")


@Q("m_cond_fixed_exit", f"""WITH RECURSIVE {BARS}, b AS (SELECT asset, bar, close, row_number() OVER (PARTITION BY asset ORDER BY bar) AS n FROM bars),
  z AS (SELECT asset, 0::BIGINT AS n, NULL::TIMESTAMP AS bar, 1000.0::DOUBLE AS cash, 0.0::DOUBLE AS coins, NULL::DOUBLE AS paid FROM (SELECT DISTINCT asset FROM b) UNION ALL
  SELECT asset, n, bar, CASE WHEN buys THEN 0 WHEN sells THEN coins * close ELSE cash END, CASE WHEN buys THEN cash / close WHEN sells THEN 0 ELSE coins END, CASE WHEN buys THEN close WHEN sells THEN NULL ELSE paid END
  FROM (SELECT z.asset, b.n, b.bar, b.close, cash, coins, paid, coins = 0 AND b.close < 200 AS buys, coins > 0 AND abs(close / paid - 1) > 0.03 AS sells FROM z JOIN b ON b.asset = z.asset AND b.n = z.n + 1) x) SELECT asset, bar, round(cash, 6) AS cash, round(coins, 9) AS coins FROM z WHERE n > 0""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = bars(Tables(s, d)).select("asset", "bar", "close")
    done = rec.trades(rows, ["asset"], "bar", "close", lambda r, st: r["close"] < 200, lambda r, st: F.abs(r["close"] / st["paid"] - 1) > 0.03, 0.0, 1000.0)
    return done.select("asset", "bar", F.round("cash", 6).alias("cash"), F.round("coins", 9).alias("coins"))


@Q("m_pnl_realised", f"""WITH {TRADES}, m AS (SELECT b.asset, s.ts, (least(b.hi, s.hi) - greatest(b.lo, s.lo)) * (s.price - b.price) AS margin FROM i b JOIN i s ON b.asset = s.asset AND b.lo < s.hi AND s.lo < b.hi WHERE b.event_type = 'purchase' AND s.event_type = 'error')
  SELECT CAST(ts AS DATE) AS day, round(sum(round(margin, 4)), 2) AS margin FROM m GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)("events").select(F.col("user_id").alias("asset"), "ts", "event_id", "event_type", F.round(1 + F.col("value"), 2).alias("qty"), F.col("value").alias("price"))
    lots = rec.fifo(t.where("event_type = 'purchase'"), t.where("event_type = 'error'"), "asset", ["ts", "event_id"], "qty", "price")
    when = t.select(F.col("event_id").alias("sell_id"), F.to_date("ts").alias("day"))
    return lots.join(when, "sell_id").groupBy("day").agg(F.round(F.sum("margin"), 2).alias("margin"))


@Q("j15_interval_overlap", f"WITH {TRADES} SELECT b.asset, count(*) AS n, round(sum(least(b.hi, s.hi) - greatest(b.lo, s.lo)), 3) AS qty FROM i b JOIN i s ON b.asset = s.asset AND b.lo < s.hi AND s.lo < b.hi WHERE b.event_type = 'purchase' AND s.event_type = 'error' GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)("events").select(F.col("user_id").alias("asset"), "ts", "event_id", "event_type", F.round(1 + F.col("value"), 2).alias("qty"), F.col("value").alias("price"))
    lots = rec.fifo(t.where("event_type = 'purchase'"), t.where("event_type = 'error'"), "asset", ["ts", "event_id"], "qty", "price")
    return lots.groupBy("asset").agg(F.count("*").alias("n"), F.round(F.sum("qty"), 3).alias("qty"))
