import datetime as dt
import random
from statistics import correlation, mean, stdev

import pytest

from loomspan.plans import windowing


@pytest.fixture(scope="module")
def series():
    draw = random.Random(3)
    return [(draw.uniform(1, 9), draw.randrange(1, 50)) for _ in range(400)]


def test_bars_have_lags_to_191_and_means_to_189(spark, series):
    start = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("a", start + i * dt.timedelta(minutes=15), c, v) for i, (c, v) in enumerate(series[:195])], "asset string, bar timestamp, close double, volume int")
    lags = {r.bar: r for r in windowing.bar_lags(rows).collect()}
    stats = {r.bar: r for r in windowing.trailing_stats(rows).collect()}
    assert sorted(lags) == sorted(stats) == [start + i * dt.timedelta(minutes=15) for i in range(191, 195)]
    for i in range(191, 195):
        at = start + i * dt.timedelta(minutes=15)
        for k in range(1, 192):
            assert (lags[at][f"past_{k}"], lags[at][f"past_volume_{k}"]) == series[i - k]
        for k in range(1, 9):
            assert lags[at][f"next_{k}"] == (series[i + k][0] if i + k < 195 else None)
        for m in range(1, 190, 4):
            for j, x in enumerate(("close", "volume")):
                part = [series[i - k][j] for k in range(1, m + 1)]
                assert stats[at][f"mean_{x}_{m}"] == pytest.approx(mean(part), abs=1e-6)
                assert stats[at][f"std_{x}_{m}"] == (pytest.approx(stdev(part), abs=1e-4) if m > 1 else None)
                assert stats[at][f"delta_{x}_mean_{m}"] == pytest.approx(series[i][0] / mean(part) - 1, abs=1e-6)
        for k in range(2, 25):
            assert stats[at][f"delta_close_{k}"] == pytest.approx(series[i][0] / series[i - k][0] - 1, abs=1e-6)


def test_days_have_lags_to_385_and_correlations_of_360(spark, series):
    start = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([("g", start + dt.timedelta(days=i), a, q) for i, (a, q) in enumerate(series)], "grp string, day date, amount double, qty int")
    got = {r.day: r for r in windowing.block_lags(rows).collect()}
    assert len(got) == 15
    for i in range(385, 400):
        r = got[start + dt.timedelta(days=i)]
        back = [series[i - k][0] for k in range(386)]
        assert [r[f"lag_{k}"] for k in range(386)] == back
        assert r.target == pytest.approx(back[0] / back[5] - 1, abs=1e-6)
        for k in (6, 11, 21, 41):
            assert r[f"std_{k}"] == pytest.approx(stdev(back[k : k + 5]), abs=1e-4)
            assert r[f"distance_{k}"] == pytest.approx(back[5] / mean(back[k : k + 5]) - 1, abs=1e-6)
        assert r.year_trend == pytest.approx(back[5] / mean(back[355:385]) - 1, abs=1e-6)
    for r in windowing.rolling_correlation(rows).collect():
        i = (r.day - start).days
        assert r.r == (pytest.approx(correlation(*zip(*series[i - 359 : i + 1], strict=True)), abs=1e-5) if i >= 359 else None)
