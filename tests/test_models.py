import datetime
import math

import numpy as np
import pytest
from compare import SF
from pyspark.sql import functions as F

from loomspan.operators import models
from loomspan.operators import windows as win
from loomspan.plans import catalog
from loomspan.plans.fixtures import Tables, daily


def test_every_row_is_predicted_once_by_the_other_folds(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 7) * 2) for i in range(60)], "k int, x double, y double")
    made, full = models.cross_validated(df, ["k"], ["x"], "y", 3, rounds=2)
    got = {r.k: (r.fold, r.prediction) for r in made.collect()}
    assert made.count() == 60 and sorted(got) == list(range(60)) and {f for f, _ in got.values()} == {0, 1, 2}
    dealt = models.folds(df, ["k"], 3)
    for fold in range(3):
        alone = models.boosted_trees(dealt.where(F.col("fold") != fold), ["x"], "y", rounds=2).predict(dealt.where(F.col("fold") == fold))
        assert {r.k: r.prediction for r in alone.collect()} == {k: p for k, (f, p) in got.items() if f == fold}
    assert full.predict(df).count() == 60


def test_boosted_trees_predicts_all_complete_rows(spark):
    rows = win.lag_bank(daily(Tables(spark, SF)), "amount", [1, 7, 14], win.ordered(["grp"], ["day"]), "lag_").dropna()
    got = catalog.queries()["ml1_boosted_trees"](spark, SF)
    assert sorted(tuple(r) for r in got.select("grp", "day").collect()) == sorted(tuple(r) for r in rows.select("grp", "day").collect())


def test_categories_weights_and_early_stop(spark):
    rows = [(i, "abcd"[i % 4], float(i % 3), float((i % 4) * 10 + i % 3), 1.0 if i < 90 else 0.0, i % 5 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, name string, x double, y double, w double, late boolean")
    model = models.boosted_trees(df, ["x"], "y", weight="w", categories=["name"], rounds=15)
    new = spark.createDataFrame([(1, "zz", 1.0)], "k int, name string, x double")
    got = {r.k: (r.prediction, r.y) for r in model.predict(df).collect()}
    assert all(abs(p - y) < 1.5 for p, y in got.values()) and model.predict(new).count() == 1
    assert "__name" not in model.predict(df).columns
    stopped = models.boosted_trees(df, ["x"], "y", categories=["name"], check="late", rounds=15)
    assert stopped.predict(df).count() == 120


def test_seasonal_forecast_against_normal_equations(spark):
    """The same model written out as loops over days and terms."""
    first, draw = datetime.date(2000, 1, 1), np.random.default_rng(2)
    rows = []
    for n in range(500):
        day = first + datetime.timedelta(n)
        y = 50 + 0.02 * n + 5 * math.sin(2 * math.pi * day.toordinal() / 7) + (30 if (day.month, day.day) == (12, 25) else 0) + float(draw.normal())
        rows.append(("a", day, y if n % 11 else None))
    df = spark.createDataFrame([*rows, ("b", first, 3.0)], "k string, day date, y double")
    got = {(r.k, r.day): r.prediction for r in models.seasonal(df, ["k"], "day", "y", 400, ["CHRISTMAS", "LABOUR"]).collect()}
    assert len(got) == 800 and all(got["b", first + datetime.timedelta(n)] == pytest.approx(3.0, abs=3) for n in range(1, 5))
    known = [(d, y) for _, d, y in rows if y is not None]
    low, high = known[0][0].toordinal(), known[-1][0].toordinal()

    def terms(day):
        x = (day.toordinal() - low) / (high - low)
        out = [1.0, x] + [max(x - 0.8 * k / models.CHANGES, 0.0) for k in range(1, models.CHANGES + 1)]
        for period, n in models.WAVES:
            for k in range(1, n + 1):
                out += [math.sin(2 * math.pi * k * day.toordinal() / period), math.cos(2 * math.pi * k * day.toordinal() / period)]
        return [*out, float((day.month, day.day) == (12, 25)), float((day.month, day.day) == (5, 1))]

    m = len(terms(first))
    left, right = [[0.0] * m for _ in range(m)], [0.0] * m
    for day, y in known:
        t = terms(day)
        for i in range(m):
            right[i] += t[i] * y
            for j in range(m):
                left[i][j] += t[i] * t[j]
    for i in range(m):
        left[i][i] += 1e-9 if i < 2 else 1.0
    beta = np.linalg.solve(np.array(left), np.array(right))
    last = rows[-1][1] if rows[-1][2] is not None else rows[-2][1]
    for n in (1, 10, 100, 399):
        day = last + datetime.timedelta(n)
        assert got["a", day] == pytest.approx(float(np.dot(terms(day), beta)), abs=1e-4)


def test_seasonal_query_predicts_two_weeks_of_every_group(spark):
    ends = {r.grp: r.last for r in daily(Tables(spark, SF)).groupBy("grp").agg(F.max("day").alias("last")).collect()}
    got = catalog.queries()["ml2_seasonal_forecast"](spark, SF).collect()
    assert {(r.grp, r.day) for r in got} == {(g, d + datetime.timedelta(n)) for g, d in ends.items() for n in range(1, 15)}


def test_item_models_against_plain_stumps(spark):
    draw, first = np.random.default_rng(4), datetime.date(2020, 1, 1)
    x = draw.normal(size=(80, 2))
    y = np.where(x[:, 0] > 0, 5.0, 1.0) + x[:, 1]
    df = spark.createDataFrame([("a", first + datetime.timedelta(i), float(x[i, 0]), float(x[i, 1]), float(y[i])) for i in range(80)] + [("late", datetime.date(2021, 1, 1), 0.0, 0.0, 1.0)], "k string, day date, u double, v double, y double")
    got = models.item_models(df, ["k"], "day", ["u", "v"], "y", "2020-03-01", rounds=10).orderBy("day").collect()
    train, left = [i for i in range(60)], None
    value = [float(np.mean(y[:60]))] * 80
    left = [y[i] - value[i] for i in range(80)]
    for _ in range(10):
        best = None
        for j in range(2):
            for c in sorted(set(np.quantile(x[:60, j], np.arange(1, 8) / 8).tolist())):
                low, high = [left[i] for i in train if x[i, j] <= c], [left[i] for i in train if x[i, j] > c]
                if low and high:
                    gain = sum(low) ** 2 / len(low) + sum(high) ** 2 / len(high)
                    if best is None or gain > best[0] + 1e-12:
                        best = gain, j, c, 0.2 * sum(low) / len(low), 0.2 * sum(high) / len(high)
        for i in range(80):
            step = best[3] if x[i, best[1]] <= best[2] else best[4]
            value[i] += step
            left[i] -= step
    assert [r.k for r in got] == ["a"] * 20 and [r.prediction for r in got] == pytest.approx(value[60:], abs=1e-9)


def test_principal_components_against_eigenvectors(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    x = np.array([v for _, v in rows])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int(np.searchsorted(np.cumsum(values / values.sum()), 0.95)) + 1
    got = {r.vec_id: r for r in catalog.queries()["x12_principal_components"](spark, SF).collect()}
    assert len(got) == len(rows)
    for i, (vec_id, _) in enumerate(rows):
        assert got[vec_id].n == k and np.abs(got[vec_id].reduced) == pytest.approx(np.abs(z[i] @ vectors[:, :k]), abs=1e-6)


def test_cluster_tree_is_a_partition_with_compact_parts(spark):
    got = catalog.queries()["x13_cluster_tree"](spark, SF).collect()
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert sorted(r.vec_id for r in got) == sorted(rows) and len({r.cluster for r in got}) == 8
    parts = {}
    for r in got:
        parts.setdefault(r.cluster, []).append(rows[r.vec_id])
    inside = sum(((np.array(p) - np.mean(p, axis=0)) ** 2).sum() for p in parts.values())
    every = np.array(list(rows.values()))
    # the fixture's vectors are noise: any split into eight by chance keeps 0.984 of the squares
    assert inside < 0.95 * ((every - every.mean(0)) ** 2).sum()


def test_cluster_tree_finds_planted_clusters(spark):
    draw = np.random.default_rng(3)
    # two halves far apart, each of two parts
    centres = np.array([[50, 10], [50, -10], [-50, 10], [-50, -10]]) @ np.eye(2, 10)
    rows = [(i, i % 4, (centres[i % 4] + draw.normal(size=10)).tolist()) for i in range(200)]
    got = models.clusters(spark.createDataFrame(rows, "id int, real int, v array<double>"), "v", 4, tree=True).collect()
    assert len({(r.real, r.cluster) for r in got}) == 4 and len({r.cluster for r in got}) == 4


def test_perceptron_learns_what_the_other_folds_teach(spark):
    draw = np.random.default_rng(6)
    rows = [(i, "xyz"[i % 3], (np.eye(4)[i % 3] * 5 + draw.normal(size=4)).tolist()) for i in range(150)]
    got = models.perceptron(spark.createDataFrame(rows, "id int, name string, v array<double>"), ["id"], "v", "name", 3, [6]).collect()
    assert sorted(r.id for r in got) == list(range(150)) and {r.fold for r in got} == {0, 1, 2}
    assert np.mean([r.name == r.predicted for r in got]) > 0.95 and all(1 / 3 <= r.probability <= 1 for r in got)
