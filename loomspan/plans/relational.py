"""Queries over sources, projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import scalars as fx
from loomspan.operators import joins
from loomspan.plans.fixtures import DAILY, Tables, daily
from loomspan.plans.registry import Registry

Q = Registry()


@Q("src1_sales_projection", "SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey AS site, lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS item, l_extendedprice AS amount, l_quantity AS qty FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_suppkey").alias("site"), fx.coded(F.col("l_partkey"), 8).alias("item"), F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("qty"))


@Q("src2_sales_left_joins", "SELECT l_orderkey, l_partkey, p_brand, p_type, s_name, s_nationkey, l_extendedprice FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"), "left").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "l_partkey", "p_brand", "p_type", "s_name", "s_nationkey", "l_extendedprice")


@Q("src3_sales_site_list", "SELECT l_orderkey, l_partkey, p_brand, s_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey IN (1, 4, 7)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    lines = t("lineitem").where(F.col("l_suppkey").isin(1, 4, 7))
    return lines.join(t("part"), F.col("l_partkey") == F.col("p_partkey"), "left").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", "l_partkey", "p_brand", "s_name")


@Q("src4_store_last_months", """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, n_name, n_regionkey, round(sum(o_totalprice), 2) AS sales FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderdate > TIMESTAMP '2001-02-01' AND o_orderdate <= TIMESTAMP '2001-08-01' GROUP BY ALL""")
def _(s: SparkSession, d: str) -> DataFrame:
    t, as_of = Tables(s, d), F.lit("2001-08-01").cast("timestamp")
    recent = t("orders").where((F.col("o_orderdate") > F.add_months(as_of, -6).cast("timestamp")) & (F.col("o_orderdate") <= as_of))
    joined = recent.join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "n_name", "n_regionkey").agg(F.round(F.sum("o_totalprice"), 2).alias("sales"))


@Q("src5_family_counts", "SELECT p_brand, p_type, count(p_name) AS n_items FROM part GROUP BY 1, 2 ORDER BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").groupBy("p_brand", "p_type").agg(F.count("p_name").alias("n_items")).orderBy("p_brand", "p_type")


@Q("src6_distinct_map", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").select("l_partkey", "l_suppkey").distinct()


@Q("src7_plain_projections", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")


def sales_window(days: str, objective: str, as_of: str, months: int = 3, years: int = 2):
    """Filter on a date column: the months before as_of to predict, years to train (30.5 days a month)."""
    back = int(months * 30.5) if objective == "predict" else int(years * 12 * 30.5)
    end = F.lit(as_of).cast("date")
    return F.col(days).between(F.date_sub(end, back), end)


@Q("src8_predicate_builder", """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#23') AND CAST(l_shipdate AS DATE) BETWEEN DATE '2000-12-31' - 91 AND DATE '2000-12-31'""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    sites = t("supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"))
    items = t("part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#23")).select(F.col("p_partkey").alias("l_partkey"))
    lines = t("lineitem").withColumn("day", F.to_date("l_shipdate")).where(sales_window("day", "predict", "2000-12-31"))
    return lines.join(sites, "l_suppkey", "left_semi").join(items, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey", "day")


@Q("src9_recent_tables", """WITH last AS (SELECT max(CAST(l_shipdate AS DATE)) AS m FROM lineitem) SELECT lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS item, lpad(CAST(l_suppkey AS VARCHAR), 3, '0') AS base, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS qty
  FROM lineitem, last WHERE CAST(l_shipdate AS DATE) > m - 40 GROUP BY 1, 2, 3""")
def _(s: SparkSession, d: str) -> DataFrame:
    lines = Tables(s, d)("lineitem").withColumn("day", F.to_date("l_shipdate"))
    last = lines.agg(F.max("day")).first()[0]
    base = F.when(F.length(F.col("l_suppkey").cast("string")) < 3, fx.coded(F.col("l_suppkey"), 3)).otherwise(F.col("l_suppkey").cast("string").substr(1, 3))
    return lines.where(F.col("day") > F.date_sub(F.lit(last), 40)).groupBy(fx.coded(F.col("l_partkey"), 8).alias("item"), base.alias("base"), "day").agg(F.sum("l_quantity").alias("qty"))


@Q("src10_site_clusters", "SELECT DISTINCT s_suppkey AS site, r_name AS cluster FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA'")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    named = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.assert_unique(named.where("r_name <> 'AFRICA'").select(F.col("s_suppkey").alias("site"), F.col("r_name").alias("cluster")).distinct(), ["site"])


@Q("src17_macro_periods", "SELECT n_name AS location, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, round(avg(o_totalprice), 4) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    period = F.to_date(F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-01")))
    return rows.groupBy(F.col("n_name").alias("location"), period.alias("period")).agg(F.round(F.avg("o_totalprice"), 4).alias("value"))


@Q("src18_wide_to_long", "SELECT c_custkey, unnest(['nation', 'balance']) AS measure, unnest([CAST(c_nationkey AS DOUBLE), c_acctbal]) AS value FROM customer")
def _(s: SparkSession, d: str) -> DataFrame:
    wide = Tables(s, d)("customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("nation"), F.col("c_acctbal").alias("balance"))
    return wide.unpivot("c_custkey", ["nation", "balance"], "measure", "value")


@Q("src20_url_parts", r"SELECT page_id, split_part(url, '/', 4) AS section, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS number FROM pages WHERE split_part(url, '/', 4) IN ('en', 'fr')")
def _(s: SparkSession, d: str) -> DataFrame:
    section = F.split_part(F.col("url"), F.lit("/"), F.lit(4))
    return Tables(s, d)("pages").where(section.isin("en", "fr")).select("page_id", section.alias("section"), F.nullif(F.regexp_extract("url", "/([0-9]+)", 1), F.lit("")).alias("number"))


@Q("src21_page_fields", r"SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, nullif(regexp_extract(html, '<html lang=\"([a-z]+)\"', 1), '') AS lang, len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs FROM pages")
def _(s: SparkSession, d: str) -> DataFrame:
    part = lambda p: F.nullif(F.regexp_extract("html", p, 1), F.lit(""))
    return Tables(s, d)("pages").select("page_id", part("<title>([^<]*)</title>").alias("title"), part('<html lang="([a-z]+)"').alias("lang"), F.regexp_count("html", F.lit("<p[ >]")).cast("long").alias("n_paragraphs"))


@Q("src22_work_list", """WITH seen AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY 1) SELECT c_custkey, last, last IS NULL AS missing FROM customer LEFT JOIN seen ON c_custkey = o_custkey WHERE last IS NULL OR DATE '2001-08-01' - last > 15""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    seen = t("orders").groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("last"))
    every = t("customer").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    return every.where(F.col("last").isNull() | (F.datediff(F.lit("2001-08-01").cast("date"), F.col("last")) > 15)).select("c_custkey", "last", F.col("last").isNull().alias("missing"))


@Q("f1_clean_sales", "SELECT l_orderkey, l_partkey, l_extendedprice / nullif(l_quantity, 0) AS unit_price FROM lineitem WHERE l_extendedprice >= 0 AND l_quantity >= 0 AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    known = t("part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return t("lineitem").where("l_extendedprice >= 0 and l_quantity >= 0").join(known, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", fx.ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"))


@Q("f2_days_between", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").select(F.to_date("o_orderdate").alias("day"), "o_orderpriority").where(F.col("day").between("1996-01-01", "1996-06-30")).distinct()


@Q("f3_null_outliers", "SELECT p_partkey, CASE WHEN p_retailprice / 20 BETWEEN 0.1 AND 60 THEN round(p_retailprice / 20, 4) END AS price FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").select("p_partkey", F.round(fx.only_between(F.col("p_retailprice") / 20, 0.1, 60), 4).alias("price"))


@Q("f4_replace_codes", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 OR p_size % 3 = 1 THEN p_brand ELSE p_type END AS code FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    other = F.when(F.col("p_size") % 3 == 1, F.lit("OK")).when(F.col("p_size") % 3 == 2, F.col("p_type"))
    return Tables(s, d)("part").select("p_partkey", fx.replacement(F.col("p_brand"), other).alias("code"))


@Q("f5_classify_substring", "SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'BULK' ELSE 'PIECE' END AS kind FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("part").select("p_partkey", fx.first_match(F.col("p_type"), [("STEEL", "BULK")], "PIECE").alias("kind"))


@Q("f6_clip_ranges", "SELECT event_id, least(value, 20.0::DOUBLE) AS rain, greatest(least(value - 100, 30.0::DOUBLE), -10.0::DOUBLE) AS temperature, value / 100000 AS pressure FROM events")
def _(s: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return Tables(s, d)("events").select("event_id", fx.clip(v, high=20.0).alias("rain"), fx.clip(v - 100, -10.0, 30.0).alias("temperature"), (v / 100000).alias("pressure"))


@Q("f7_log_target", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS target, round(exp(ln(1 + o_totalprice)) - 1, 2) AS back FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    x = F.log1p("o_totalprice")
    return Tables(s, d)("orders").select("o_orderkey", F.round(x, 6).alias("target"), F.round(F.expm1(x), 2).alias("back"))


@Q("f8_case_ladder", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 WHEN c_acctbal < 2500 THEN 0.5 WHEN c_acctbal < 7500 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM customer")
def _(s: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    return Tables(s, d)("customer").select("c_custkey", fx.ladder([(b < 0, 0.0), (b < 2500, 0.5), (b < 7500, 1.0)], 2.0).alias("weight"))


@Q("f9_floor_zero", "SELECT c_custkey, greatest(c_acctbal, 0.0::DOUBLE) AS forecast FROM customer")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("customer").select("c_custkey", fx.clip(F.col("c_acctbal"), low=0.0).alias("forecast"))


@Q("f10_weight_to_units", "SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN p_retailprice ELSE round_even(p_retailprice / p_size, 0) END AS units FROM part")
def _(s: SparkSession, d: str) -> DataFrame:
    piece = ~F.col("p_type").contains("STEEL")
    return Tables(s, d)("part").select("p_partkey", F.when(piece, fx.half_even(F.col("p_retailprice") / F.col("p_size"))).otherwise(F.col("p_retailprice")).alias("units"))


@Q("f11_export_names", "SELECT o_orderkey AS ORDER_ID, o_totalprice AS AMOUNT, 'V1' AS RUN FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("orders").select("o_orderkey", "o_totalprice").withColumnsRenamed({"o_orderkey": "ORDER_ID", "o_totalprice": "AMOUNT"}).withColumn("RUN", F.lit("V1"))


@Q("f12_columns_by_pattern", "SELECT COLUMNS('.*key') FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    lines = Tables(s, d)("lineitem")
    return lines.select(lines.colRegex("`.*key`"))


@Q("f13_positive_only", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal")).dropna(subset=["c_acctbal"])


def drop_sparse(df: DataFrame, columns: list[str], share: float) -> DataFrame:
    """Without the columns of which more than a share is null."""
    counts = df.agg(F.count("*").alias("__n"), *(F.count(c).alias(c) for c in columns)).first()
    return df.drop(*(c for c in columns if counts["__n"] and 1 - counts[c] / counts["__n"] > share))


@Q("f14_drop_sparse", "SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN o_totalprice END AS kept FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = Tables(s, d)("orders").select("o_orderkey", F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("kept"), F.when(F.col("o_totalprice") < 0, F.lit(1)).alias("gone"))
    return drop_sparse(rows, ["kept", "gone"], 0.9)


@Q("f15_safe_ratio", "SELECT l_orderkey, l_partkey, coalesce(l_extendedprice / nullif(l_tax, 0), 0) AS ratio FROM lineitem")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("lineitem").select("l_orderkey", "l_partkey", F.coalesce(fx.ratio(F.col("l_extendedprice"), F.col("l_tax")), F.lit(0.0)).alias("ratio"))


@Q("f16_screen", "SELECT s_suppkey, s_acctbal, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 1000 AND n_regionkey IN (1, 3)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("supplier").where("s_acctbal >= 1000").join(t("nation").where("n_regionkey in (1, 3)"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_acctbal", "n_name")


@Q("j1_left_join", "SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_partkey", "l_quantity")


@Q("j2_right_filter", "SELECT c_custkey, c_name, o_orderkey FROM orders RIGHT JOIN (SELECT * FROM customer WHERE c_nationkey < 3) ON o_custkey = c_custkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("orders").join(t("customer").where("c_nationkey < 3"), F.col("o_custkey") == F.col("c_custkey"), "right").select("c_custkey", "c_name", "o_orderkey")


@Q("j3_inner_join", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@Q("j4_outer_merge", """WITH a AS (SELECT l_partkey AS item, round(avg(l_extendedprice / l_quantity), 4) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT p_partkey AS item, p_retailprice AS price, p_size FROM part WHERE p_size > 10)
  SELECT coalesce(a.item, b.item) AS item, coalesce(a.price, b.price) AS price, p_size FROM a FULL JOIN b ON a.item = b.item""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    a = t("lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("item")).agg(F.round(F.avg(F.col("l_extendedprice") / F.col("l_quantity")), 4).alias("price"))
    b = t("part").where("p_size > 10").select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("price"), "p_size")
    return joins.outer_merge(a, b, ["item"])


@Q("j5_anti_missing", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@Q("j6_semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("customer").join(t("orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@Q("j7_keys_by_dates", "SELECT n_nationkey, CAST(day AS DATE) AS day FROM nation, generate_series(DATE '2000-01-01', DATE '2000-01-31', INTERVAL 1 DAY) g(day)")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("nation").select("n_nationkey", F.explode(F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2000-01-31").cast("date"))).alias("day"))


@Q("j8_many_to_many", "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    return t("supplier").join(t("customer"), F.col("s_nationkey") == F.col("c_nationkey")).select("s_suppkey", "c_custkey")


@Q("j9_checked_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    dim = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup(t("customer").select("c_custkey", "c_nationkey"), dim, ["c_nationkey"]).select("c_custkey", "n_name")


@Q("j10_renamed_keys", "SELECT a.s_suppkey AS s_suppkey, b.s_suppkey AS s_suppkey_other FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def _(s: SparkSession, d: str) -> DataFrame:
    a = Tables(s, d)("supplier").select("s_suppkey", "s_nationkey")
    b = a.select(F.col("s_suppkey").alias("s_suppkey_other"), "s_nationkey")
    return a.join(b, "s_nationkey").where("s_suppkey < s_suppkey_other").select("s_suppkey", "s_suppkey_other")


@Q("j11_dictionary", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FILLED' WHEN 'O' THEN 'OPEN' ELSE 'OTHER' END AS status FROM orders")
def _(s: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*map(F.lit, ("F", "FILLED", "O", "OPEN")))
    return Tables(s, d)("orders").select("o_orderkey", F.coalesce(names[F.col("o_orderstatus")], F.lit("OTHER")).alias("status"))


@Q("j12_index_join", f"WITH {DAILY} SELECT a.grp, a.day, a.amount, b.qty FROM daily a JOIN daily b ON a.grp = b.grp AND a.day = b.day")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = daily(Tables(s, d))
    return rows.select("grp", "day", "amount").join(rows.select("grp", "day", "qty"), ["grp", "day"])


@Q("j13_asof_price", """WITH p AS (SELECT c_nationkey AS site, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS price FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), s AS (SELECT s_nationkey AS site, CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
  SELECT s.site, s.day, s.n AS n, p.price FROM s ASOF LEFT JOIN p ON s.site = p.site AND s.day >= p.day""")
def _(s: SparkSession, d: str) -> DataFrame:
    t = Tables(s, d)
    prices = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("site"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("price"))
    ships = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("site"), F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    return joins.asof(ships, prices, ["site"], "day", "day", ["price"])


@Q("j14_theta_running", """WITH h AS (SELECT event_type AS asset, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 6 HOUR)) AS hour FROM (SELECT DISTINCT event_type FROM events))
  SELECT asset, hour, round(coalesce(sum(value), 0), 4) AS pnl FROM h LEFT JOIN events ON event_type = asset AND ts <= hour GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    events = Tables(s, d)("events").withColumnRenamed("event_type", "asset")
    hours = F.expr("sequence(timestamp'2024-01-01', timestamp'2024-01-30', interval 6 hours)")
    spine = events.select("asset").distinct().select("asset", F.explode(hours).alias("hour"))
    return joins.running_total_at(spine, events, ["asset"], "hour", "ts", "value", "pnl").withColumn("pnl", F.round("pnl", 4))


@Q("j16_pair_legs", """SELECT a.event_id AS buy, b.event_id AS sell, a.user_id AS user_id FROM events a JOIN events b ON a.user_id = b.user_id AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE) WHERE a.event_type = 'purchase' AND b.event_type = 'error'""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = Tables(s, d)("events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    buys = e.where("event_type = 'purchase'").select(F.col("event_id").alias("buy"), "user_id", "day")
    return buys.join(e.where("event_type = 'error'").select(F.col("event_id").alias("sell"), "user_id", "day"), ["user_id", "day"]).select("buy", "sell", "user_id")


@Q("j19_fuzzy_match", """WITH seed(word) AS (VALUES ('STANDARD BRASS'), ('PROMO STEEL'), ('SMALL COPPER')), types AS (SELECT DISTINCT p_type FROM part)
  SELECT p_type, arg_min(word, (levenshtein(p_type, word), word)) AS word, min(levenshtein(p_type, word)) AS edits FROM types, seed GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    seed = F.explode(F.array(*map(F.lit, ("STANDARD BRASS", "PROMO STEEL", "SMALL COPPER"))))
    pairs = Tables(s, d)("part").select("p_type").distinct().withColumn("word", seed).withColumn("edits", F.levenshtein("p_type", "word").cast("long"))
    return pairs.groupBy("p_type").agg(F.min_by("word", F.struct("edits", "word")).alias("word"), F.min("edits").alias("edits"))

