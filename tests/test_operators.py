import datetime as dt
import random

import duckdb
import pytest
from compare import same_rows
from pyspark.sql import functions as F

from loomspan.functions import calendar
from loomspan.functions import scalars as fx
from loomspan.operators import aggregates as ag
from loomspan.operators import demand, joins, market, panel, store, text
from loomspan.operators import recurrences as rec
from loomspan.operators import windows as win
from loomspan.plans import catalog
from loomspan.sources import files
from loomspan.streaming.bars import extend, fresh, stream_bars


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_ratio_clip_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (0.5, 1.0), (2.5, 1.0), (-0.4, 1.0)], "a double, b double")
    got = df.select(fx.ratio(F.col("a"), F.col("b")).alias("r"), fx.clip(F.col("a"), 0.0, 1.0).alias("c"), fx.half_even(F.col("a")).alias("h")).collect()
    assert [r.r for r in got] == [None, None, 0.5, 2.5, -0.4]
    assert [r.c for r in got] == [1.0, None, 0.5, 1.0, 0.0]
    assert [r.h for r in got] == [1.0, None, 0.0, 2.0, 0.0] and str(got[4].h) == "0.0"


def test_accounting_numbers(spark):
    df = spark.createDataFrame([("(1,234.5)",), ("--",), (" 12 ",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(fx.accounting(F.col("t"))).collect()] == [-1234.5, None, 12.0, None, None]


def test_total_is_zero_without_values_and_median_is_strict(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None), ("c", 2.0)], "k string, x double")
    got = df.groupBy("k").agg(ag.total("x").alias("t"), ag.strict_median("x").alias("m"))
    assert values(got, "k", "t", "m") == [("a", 0.0, None), ("b", 1.0, None), ("c", 2.0, 2.0)]


def test_even_centred_frame(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(30)], "k int, d int, x double")
    w = win.ordered(["k"], ["d"])
    got = {r.d: r.m for r in df.withColumn("m", win.quantile(F.col("x"), 0.5, win.centred(w, 20))).collect()}
    assert got[15] == 14.5 and got[0] == 4.5


def test_easter_and_offsets(spark):
    years = spark.createDataFrame([(1999,), (2000,), (2008,), (2024,)], "year int")
    assert [r[0] for r in years.select(calendar.easter(F.col("year"))).collect()] == [dt.date(1999, 4, 4), dt.date(2000, 4, 23), dt.date(2008, 3, 23), dt.date(2024, 3, 31)]
    days = spark.createDataFrame([(dt.date(2008, 5, 1),), (dt.date(2008, 5, 4),), (dt.date(2008, 6, 20),)], "day date")
    assert values(calendar.holiday_offset(days, "day"), "day", "holiday_offset") == [(dt.date(2008, 5, 1), 0), (dt.date(2008, 5, 4), 3), (dt.date(2008, 6, 20), -5)]


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(ValueError, match="unique"):
        joins.assert_unique(df, ["k"])


def test_overlap_meets_each_pair_once(spark):
    draw = random.Random(4)
    rows = [[(k, i, draw.randint(0, 90) / 10, draw.randint(0, 90) / 10) for i in range(40) for k in "ab"] for _ in range(2)]
    rows = [[(k, i, min(x, y), max(x, y)) for k, i, x, y in part] for part in rows]
    a, b = (spark.createDataFrame(part, "k string, id int, lo double, hi double") for part in rows)
    want = sorted((k, i, j) for k, i, p, q in rows[0] for m, j, r, s in rows[1] if k == m and min(q, s) > max(p, r))
    for width in (0.7, 3.0, 100.0):
        assert sorted((r.k, r.a_id, r.b_id) for r in joins.overlap(a, b, ["k"], width=width).collect()) == want


def test_stock_levels_against_a_loop(spark):
    draw, rows = random.Random(1), []
    for key in range(6):
        for day in range(25):
            rows.append((key, day, float(draw.randint(5, 20)) if draw.random() < 0.3 else None, float(draw.randint(0, 6)) if draw.random() < 0.95 else None, float(draw.randint(0, 6))))
    want, level, gap, last = [], None, 0, None
    for key, day, stock, sold, ordered in rows:
        if day == 0:
            level, gap, last = None, 0, None
        if stock is not None:
            level, gap = stock, 0
        else:
            ok = level is not None and last and last[0] is not None and gap < 3
            level = round(max(0.0, max(0.0, level - 0.1 * last[0]) - last[0] + last[1]) * 10) / 10 if ok else None
            gap += 1
        last = (sold, ordered)
        want.append((key, day, level))
    df = spark.createDataFrame(rows, "k int, d int, stock double, sold double, ordered double")
    assert values(rec.stock_levels(df, ["k"], "d", "stock", "sold", "ordered", 0.1, 3), "k", "d", "level") == sorted(want, key=repr)


def test_fifo_conserves_quantity(spark):
    buys = spark.createDataFrame([("x", 1, 5.0, 10.0), ("x", 2, 5.0, 20.0), ("x", 3, 5.0, 30.0)], "asset string, id int, qty double, price double")
    sells = spark.createDataFrame([("x", 9, 6.0, 40.0)], "asset string, id int, qty double, price double")
    got = values(rec.fifo(buys, sells, "asset", ["id"], "qty", "price"), "buy_id", "sell_id", "qty", "margin")
    assert got == [(1, 9, 5.0, 150.0), (2, 9, 1.0, 20.0)]


def test_split_adds_up_and_spreads_evenly_without_weights(spark):
    forecast = spark.createDataFrame([("a", 9.0), ("b", 4.0)], "g string, f double")
    weights = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 0.0), ("b", 2, 0.0)], "g string, i int, w double")
    assert values(demand.split_forecast(forecast, weights, ["g"], "f", "w"), "g", "i", "part") == [("a", 1, 3.0), ("a", 2, 6.0), ("b", 1, 2.0), ("b", 2, 2.0)]


def test_allocation_leaves_out_what_is_above_target(spark):
    df = spark.createDataFrame([("a", 0.5, 10.0), ("b", 0.0, 900.0), ("c", -0.9, 0.0), ("d", 0.1, 90.0)], "k string, p double, v double")
    got = {r.k: r for r in market.allocation(df, "k", "p", "v", 1000.0).collect()}
    assert sum(r.target for r in got.values()) == pytest.approx(1) and got["a"].target > got["b"].target > got["c"].target == 0
    assert got["b"].cash == 0 and got["b"].actual == pytest.approx(0.9)
    cash = got["a"].target / (got["a"].target + got["c"].target + got["d"].target) * 1000 - 0.4
    assert got["a"].cash == round(cash) and sum(r.cash for r in got.values()) <= 1000


def test_fold_of_a_long_series(spark):
    """Several chunks, and the last one not full."""
    rows = [("a", i, float(i % 5)) for i in range(3 * rec.CHUNK + 7)] + [("b", 0, 1.0)]
    step = lambda s, r: F.struct((s["t"] * 0.5 + r["x"]).alias("t"))
    df = spark.createDataFrame(rows, "k string, i int, x double")
    got = values(rec.fold(df, ["k"], ["i"], ["x"], F.struct(F.lit(0.0).alias("t")), step, "s").select("k", "i", "x", F.col("s.t").alias("t")), "k", "i", "t")
    want, total, before = [], 0.0, None
    for k, i, x in rows:
        total = (total if k == before else 0.0) * 0.5 + x
        before = k
        want.append((k, i, total))
    assert got == sorted(want, key=repr)


def test_quantiles_are_those_of_percentile(spark):
    draw = random.Random(3)
    df = spark.createDataFrame([(draw.choice([None, float(draw.randint(0, 9)), draw.random() * 9]),) for _ in range(400)], "x double").repartition(5)
    p = [0.0, 0.1, 1 / 3, 0.5, 0.975, 1.0]
    assert ag.quantiles(df, "x", p) == pytest.approx(df.agg(F.percentile("x", p)).first()[0], abs=1e-12)
    assert ag.quantiles(df.where("x is null"), "x", p) == []


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    schema, source, out, progress = "a string, ts timestamp, v double, id int", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    for some in ([("x", t(1), 1.0, 1), ("x", t(5), 2.0, 2)], [("x", t(1, 5), 9.0, 3), ("x", t(4, 50), 3.0, 4)], [("x", t(23), 0.0, 5)]):
        spark.createDataFrame(some, schema).write.mode("append").parquet(source)
        bars = stream_bars(spark.readStream.schema(schema).parquet(source), "a", "ts", "v", "id")
        bars.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination()
    assert values(spark.read.parquet(out), "bar", "close") == [(t(1), 1.0), (t(4, 45), 3.0), (t(5), 2.0)]


def test_panel_helpers(spark):
    d = dt.date
    df = spark.createDataFrame([("a", d(2024, 1, 5), 1.0), ("a", d(2024, 1, 9), 2.0), ("b", d(2024, 1, 8), 3.0)], "k string, day date, x double")
    assert panel.densify(df, ["k"], "day").count() == 10
    assert values(panel.business_days(df.where("k = 'a'"), ["k"], "day", ["x"]), "day", "x") == [(d(2024, 1, 5), 1.0), (d(2024, 1, 8), 1.0), (d(2024, 1, 9), 2.0)]
    assert values(panel.zero_rows(df, ["k"], "day", ["x"]).where("k = 'b'"), "day", "x") == [(d(2024, 1, 8), 3.0), (d(2024, 1, 9), 0.0)]


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("1", 1), ("2", 2)], "row_key string, v int")
    new = spark.createDataFrame([("2", 9, "n"), ("3", 3, "n")], "row_key string, v int, run string")
    assert values(store.upsert(old, new), "row_key", "v", "run") == [("1", 1, None), ("2", 9, "n"), ("3", 3, "n")]


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (2.0, 0), (3.0, 1)], "s double, y int")
    assert ag.auc(df, "s", "y").first()[0] == pytest.approx(3.5 / 4)


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", 2.5), (2, None, None)], "`Item/Code` int, `Name ` string, `Price (EUR)` double")
    files.write_table(df, str(tmp_path / "t"))
    got = files.read_table(spark, str(tmp_path / "t"), "`Item/Code` int, `Name ` string, `Price (EUR)` double", {"PRICE_EUR": "PRICE"}, encoding="UTF-8")
    assert got.columns == ["ITEM_CODE", "NAME", "PRICE"]
    assert values(got, *got.columns) == [(1, "é", 2.5), (2, None, None)]


def test_nearest_of_more_centres_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_CENTRES", 5)
    rows = spark.createDataFrame([(i, float(i)) for i in range(20)], "k int, x double")
    centres = spark.createDataFrame([(c, c * 1.7) for c in range(17)], "centre int, y double")
    got = values(joins.nearest(rows, centres, F.abs(F.col("x") - F.col("y")), ["k"], 2), "k", "place", "centre")
    want = [(k, n + 1, c) for k in range(20) for n, (_, c) in enumerate(sorted((abs(k - c * 1.7), c) for c in range(17))[:2])]
    assert got == sorted(want, key=repr)


def test_neighbours_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(market, "NEAR_BLOCK", 4)
    draw = random.Random(5)
    rows = [(i, "ab"[i % 2], [draw.random() - 0.5 for _ in range(5)]) for i in range(30)] + [(90, "a", [0.0] * 5), (91, "a", None)]
    got = values(market.neighbours(spark.createDataFrame(rows, "k int, s string, v array<double>"), "k", "s", "v", 3, 0.1), "k", "other", "place")
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = []
    for k, s, v in rows[:30]:
        near = sorted((-round(sum(p * q for p, q in zip(v, u, strict=True)) / norm(v) / norm(u), 6), o) for o, t, u in rows[:30] if t == s and o != k)
        want += [(k, o, n + 1) for n, (w, o) in enumerate([x for x in near if -x[0] >= 0.1][:3])]
    assert got == sorted(want, key=repr)


def test_odd_answers_of_an_exchange(spark):
    texts = ['{"error":["down"]}', None, "no json", '{"result":{"X":[[60,"1.5","2","1","x",null,"3",4]],"last":60}}', '{"result":{"Y":[]}}']
    got = files.parse_bars(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()
    assert [tuple(r)[:1] + tuple(r)[2:] for r in got] == [("X", 1.5, 2.0, 1.0, None, 3.0, 4)] and got[0]["at"] == dt.datetime(1970, 1, 1, 0, 1)


def test_latest_folder_is_found_by_its_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-02-01"), (3, "2023-12-01")], "x int, date string")
    df.write.partitionBy("date").option("header", True).csv(str(tmp_path / "t"))
    got = files.read_latest(spark, str(tmp_path / "t"), "x int, date date")
    assert [(r.x, str(r.date)) for r in got.collect()] == [(2, "2024-02-01")]
    assert len(got.inputFiles()) == 1
    (tmp_path / "none").mkdir()
    assert files.read_latest(spark, str(tmp_path / "none"), "x int, date date").count() == 0


def test_articles_keep_empty_and_missing_texts(spark, tmp_path):
    rows = [(1, ""), (2, None), (3, ' a "b"\n\nc, '), (4, "\\N"), (5, "\\")]
    files.write_articles(spark.createDataFrame(rows[:3] + rows[4:], "id int, text string"), str(tmp_path / "t"))
    got = sorted((int(r.id), r.text) for r in files.read_articles(spark, str(tmp_path / "t")).collect())
    assert got == rows[:3] + rows[4:]


def test_stream_tail_and_freshness(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    old = spark.createDataFrame([("a", t(1), 1.0)], "asset string, bar timestamp, close double")
    new = spark.createDataFrame([("a", t(1), 9.0), ("a", t(2), 2.0)], "asset string, bar timestamp, close double")
    both = extend(old, new, ["asset", "bar"])
    assert sorted(r.close for r in both.collect()) == [1.0, 2.0]
    assert fresh(both, "2024-01-01 02:10:00") and not fresh(both, "2024-01-01 03:00:00")


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 2.0), ("b", 2.0, 4.0), ("b", None, 9.0), ("c", 1.0, 1.0)], "k string, x double, y double")
    got = {r.k: r.r for r in df.groupBy("k").agg(ag.correlation("x", "y").alias("r")).collect()}
    assert got["a"] is None and got["c"] is None and got["b"] == pytest.approx(1.0)


def test_orders_at_a_price_of_zero_are_not_sent(spark, tmp_path):
    """A price of zero is no error: the SQL says false for it, and so does the query."""
    nan = float("nan")
    rows = [(i, v, u) for i, (v, u) in enumerate((v, u) for v in (0.0, -0.0, None, nan, 2.0) for u in (5, 20, None) for _ in range(2))]
    spark.createDataFrame(rows, "event_id long, value double, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    df = catalog.queries()["m_orders_checked"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    same_rows(df, con, catalog.oracle_sql()["m_orders_checked"])
    assert [r.sent for r in df.where("limit_price = 0").collect()] == [False] * 12


@pytest.mark.parametrize("kind", ["long", "string"])
def test_cosines_of_odd_vectors_in_small_blocks(spark, monkeypatch, kind):
    """As by the formula over a join: nulls, zeros, lengths that differ, copies, a key that occurs twice, halves."""
    monkeypatch.setattr(text, "PAIR_BLOCK", 3)
    monkeypatch.setattr(text, "PAIR_BATCH", 5)
    draw, nan = random.Random(9), float("nan")
    odd = [None, [], [0.0] * 5, [1.0, None, 0.0, 0.0, 0.0], [1.0, 2.0], [nan, 1.0, 1.0, 1.0, 1.0], [1.0, 0.0, 0.0, 0.0, 0.0], [-1.0, 0.0, 0.0, 0.0, 0.0], [1.0, 127.0, 15.0, 5.0, 2.0], [1.0, 127.0, 15.0, 5.0, 2.0]]
    some = [(g, v) for g in (1, 2) for v in odd + [[draw.gauss(0, 1) for _ in range(5)] for _ in range(6)]] + [(3, odd[-1]), (None, odd[-1]), (None, odd[-2])]
    rows = [(i, g, v) for i, (g, v) in enumerate(draw.sample(some, len(some)))]
    rows += [(rows[0][0], 1, [3.0, 4.0, 0.0, 0.0, 0.0]), (None, 1, odd[-1])]
    df = spark.createDataFrame(rows, "k long, g int, v array<float>").withColumn("k", F.col("k").cast(kind))
    a, b = df.select(F.col("k").alias("a"), "g", F.col("v").alias("x")), df.select(F.col("k").alias("b"), "g", F.col("v").alias("y"))
    want = a.join(b, "g").where("a < b").select("a", "b", F.round(fx.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))
    got = values(text.cosines(df, "k", "g", "v"), "a", "b", "cosine")
    assert repr(got) == repr(values(want, "a", "b", "cosine"))
    assert {0.007813, -0.007813, None, 1.0} <= {c for *_, c in got}


def test_cosines_of_one_label_are_dealt_to_tasks(spark, tmp_path):
    """All pairs of a label with more rows than a block, the same as by SQL, and not from one task."""
    draw, n = random.Random(2), text.PAIR_BLOCK + 500
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)], 7) for i in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    df = catalog.queries()["s18_cosine"](spark, str(tmp_path))
    digits = F.rint(F.col("cosine") * 1e6).cast("long")
    parts = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(digits).alias("c"), F.sum(digits * (F.col("b") % 97)).alias("w")).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(f"SELECT count(*), sum(a), sum(b), sum(round(cosine * 1e6)::BIGINT), sum(round(cosine * 1e6)::BIGINT * (b % 97)) FROM ({catalog.oracle_sql()['s18_cosine']})").fetchall()[0]
    assert tuple(sum(r[c] for r in parts) for c in "nabcw") == want and want[0] == n * (n - 1) // 2
    assert len(parts) > 1


def test_cosines_of_whole_numbers_beyond_a_double(spark):
    rows = [(1, 7, [2**60 + 1, 0]), (2, 7, [2**60 + 1, 0]), (3, 7, [0, 3]), (4, 8, [1, 1])]
    df = spark.createDataFrame(rows, "k long, g int, v array<long>")
    assert values(text.cosines(df, "k", "g", "v"), "a", "b", "cosine") == [(1, 2, 1.0), (1, 3, 0.0), (2, 3, 0.0)]
