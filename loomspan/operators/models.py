"""Models behind one interface: fit(rows) gives something with predict(rows)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def boosted_trees(train: DataFrame, features: Sequence[str], target: str, weight: str | None = None, categories: Sequence[str] = (), check: str | None = None, rounds: int = 20, depth: int = 4, seed: int = 1):
    """Gradient-boosted regression trees; the model has predict(df) -> df with prediction. categories: features that are
    names; ones not seen before are a category of their own. check: a column that is true for rows that decide when to
    stop, and of which nothing is learned."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
    from pyspark.ml.regression import GBTRegressor

    whole = train.dropna(subset=[target])
    index = StringIndexer(inputCols=list(categories), outputCols=[f"__{c}" for c in categories], handleInvalid="keep").fit(whole) if categories else None
    indexed = (lambda df: index.transform(df)) if index else (lambda df: df)
    most = max([2, *(len(v) + 1 for v in index.labelsArray)]) if index else 2
    gather = VectorAssembler(inputCols=[*(f"__{c}" for c in categories), *features], outputCol="__f", handleInvalid="keep")
    # which features are categories is known by how few values they have; plain ones are told by the slots' order
    kinds = VectorIndexer(inputCol="__f", outputCol="__x", maxCategories=most, handleInvalid="keep").fit(gather.transform(indexed(whole))) if categories else None
    laid = (lambda df: kinds.transform(gather.transform(indexed(df)))) if kinds else (lambda df: gather.transform(df).withColumnRenamed("__f", "__x"))
    trees = GBTRegressor(featuresCol="__x", labelCol=target, maxIter=rounds, maxDepth=depth, seed=seed, predictionCol="prediction", maxBins=max(32, most + 1))
    if weight:
        trees = trees.setWeightCol(weight)
    if check:
        trees = trees.setValidationIndicatorCol(check)
    fitted = trees.fit(laid(whole))

    class Model:
        def predict(self, df: DataFrame) -> DataFrame:
            return fitted.transform(laid(df)).drop("__f", "__x", *(f"__{c}" for c in categories))

    return Model()


def folds(df: DataFrame, keys: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """Adds fold, 0..k-1, by a hash of the keys: the same rows in the same folds however the data lie."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(k)).cast("int"))


def cross_validated(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, k: int, **settings):
    """Every row with the prediction of a model trained on the other folds, and a model trained on all rows.
    settings are those of boosted_trees."""
    dealt = folds(df, keys, k)
    made = [boosted_trees(dealt.where(F.col("fold") != i), features, target, **settings).predict(dealt.where(F.col("fold") == i)) for i in range(k)]
    return reduce(DataFrame.union, made), boosted_trees(dealt, features, target, **settings)


#: Periods in days and numbers of waves, and changes of trend, spread over the first four fifths of the days.
WAVES, CHANGES = ((365.25, 3), (30.5, 2), (7.0, 2)), 10


def design(t: np.ndarray, low: float, high: float, holidays: np.ndarray) -> np.ndarray:
    """Columns of the seasonal model for days t: level, trend, its changes, waves, and a column for each holiday."""
    x = (t - low) / max(high - low, 1.0)
    bends = [np.maximum(x - 0.8 * k / CHANGES, 0.0) for k in range(1, CHANGES + 1)]
    waves = [f(2 * np.pi * k * t / period) for period, n in WAVES for k in range(1, n + 1) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(x), x, *bends, *waves, holidays])


def seasonal(df: DataFrame, by: Sequence[str], day: str, target: str, ahead: int, names: Sequence[str] = (), ridge: float = 1.0) -> DataFrame:
    """A trend that may bend, with yearly, monthly and weekly waves and holidays, for each key, fitted by least squares with
    a penalty on all but level and trend, and so many days ahead: keys, day, prediction. names: holidays that count. A key
    is a series of days, so it fits in one task."""
    from loomspan.functions.calendar import holidays
    from loomspan.operators.panel import horizon

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = horizon(df.select(*by, day, target).where(F.col(target).isNotNull()), by, day, ahead)
    years = rows.select(F.year(day).alias("year")).distinct()
    # eleven rows a year
    listed = F.broadcast(holidays(years).where(F.col("holiday").isin(list(names))))
    rows = rows.join(listed, F.col(day) == F.col("holiday_date"), "left").drop("holiday_date")

    def one(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values(day)
        t = pd.to_datetime(some[day]).map(pd.Timestamp.toordinal).to_numpy(float)
        known = some[target].notna().to_numpy()
        seen = [np.asarray(some["holiday"] == n, float) for n in names]
        a = design(t, t[known][0], t[known][-1], np.column_stack(seen) if seen else np.zeros((len(t), 0)))
        penalty = ridge * np.diag([1e-9, 1e-9, *[1.0] * (a.shape[1] - 2)])
        beta = np.linalg.solve(a[known].T @ a[known] + penalty, a[known].T @ some[target].to_numpy(float)[known])
        return some.loc[~known, [*by, day]].assign(prediction=a[~known] @ beta)

    schema = ", ".join(f"`{c}` {types[c]}" for c in [*by, day]) + ", prediction double"
    # two holidays on one day are one row
    once = rows.groupBy(*by, day).agg(F.first(target, ignorenulls=True).alias(target), F.min("holiday").alias("holiday"))
    return once.groupBy(*by).applyInPandas(one, schema)


def boost(x: np.ndarray, y: np.ndarray, rounds: int, rate: float, bins: int) -> list[tuple[int, float, float, float]]:
    """Boosted stumps: the mean first (as a stump on nothing), then for each round the feature, the cut and the two
    values that take most from the squares of what is left. Cuts are at quantiles."""
    out, left = [(-1, 0.0, float(y.mean()), float(y.mean()))], y - y.mean()
    cuts = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
    for _ in range(rounds):
        best = None
        for j, at in enumerate(cuts):
            for c in at:
                low = x[:, j] <= c
                n = int(low.sum())
                if 0 < n < len(y):
                    a, b = left[low].mean(), left[~low].mean()
                    gain = n * a * a + (len(y) - n) * b * b
                    if best is None or gain > best[0] + 1e-12:
                        best = gain, j, float(c), rate * float(a), rate * float(b)
        if best is None:
            break
        out.append(best[1:])
        left = left - np.where(x[:, best[1]] <= best[2], best[3], best[4])
    return out


def boosted_value(stumps: list[tuple[int, float, float, float]], x: np.ndarray) -> np.ndarray:
    return sum(np.where(x[:, j] <= c, a, b) if j >= 0 else np.full(len(x), a) for j, c, a, b in stumps)


def item_models(df: DataFrame, by: Sequence[str], day: str, features: Sequence[str], target: str, cut: str, rounds: int = 40, rate: float = 0.2, bins: int = 8) -> DataFrame:
    """A model of boosted stumps for each key, trained on the days before cut and used on those from it on: by, day, target,
    prediction. Rows without a feature or the target do not count; keys without days before cut give none. A key is a series of
    days, so it fits in one task."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    kept = [*by, day, target]

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(day)
        old = (pd.to_datetime(rows[day]) < pd.Timestamp(cut)).to_numpy()
        if not old.any():
            return rows.iloc[:0][kept].assign(prediction=pd.Series(dtype=float))
        x = rows[list(features)].to_numpy(float)
        stumps = boost(x[old], rows[target].to_numpy(float)[old], rounds, rate, bins)
        return rows.loc[~old, kept].assign(prediction=boosted_value(stumps, x[~old]))

    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", prediction double"
    return df.select(*dict.fromkeys([*kept, *features])).dropna().groupBy(*by).applyInPandas(one, schema)


def tame_outliers(df: DataFrame, by: Sequence[str], day: str, x: str, p: float) -> DataFrame:
    """Values above a percentile of the key, and zeros, become the key's median of the month."""
    cuts = df.groupBy(*by).agg(F.percentile(x, p).alias("__c"))
    usual = df.groupBy(*by, F.month(day).alias("__m")).agg(F.median(F.when(F.col(x) > 0, F.col(x))).alias("__u"))
    full = df.withColumn("__m", F.month(day)).join(cuts, list(by)).join(usual, [*by, "__m"])
    odd = (F.col(x) > F.col("__c")) | (F.col(x) == 0)
    return full.withColumn("tamed", F.when(odd, F.col("__u")).otherwise(F.col(x))).drop("__c", "__m", "__u")


def clusters(df: DataFrame, vector: str, k: int, seed: int = 1, tree: bool = False) -> DataFrame:
    """K-means (or bisecting k-means, for a tree of clusters) on arrays of numbers. Adds cluster."""
    from pyspark.ml.clustering import BisectingKMeans, KMeans
    from pyspark.ml.functions import array_to_vector

    data = df.withColumn("__v", array_to_vector(F.col(vector)))
    model = (BisectingKMeans if tree else KMeans)(featuresCol="__v", predictionCol="cluster", k=k, seed=seed).fit(data)
    return model.transform(data).drop("__v")


def principal(df: DataFrame, vector: str, share: float) -> DataFrame:
    """Standardised vectors on as many principal components as explain a share of the variance. Adds reduced. Vectors are
    of one length."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = df.withColumn("__v", array_to_vector(F.col(vector)))
    scaled = StandardScaler(inputCol="__v", outputCol="__s", withMean=True).fit(data).transform(data)
    dim = data.select(F.max(F.size(vector))).first()[0]
    model = PCA(k=dim, inputCol="__s", outputCol="__p").fit(scaled)
    k = min(int(np.searchsorted(np.cumsum(model.explainedVariance.toArray()), share)) + 1, dim)
    return model.transform(scaled).withColumn("reduced", F.slice(vector_to_array("__p"), 1, k)).drop("__v", "__s", "__p")


def farthest(df: DataFrame, by: str, distance: str, p: float) -> DataFrame:
    """Adds outlier: whether a row's distance is above a percentile of its cluster."""
    cuts = df.groupBy(by).agg(F.percentile(distance, p).alias("__c"))
    return df.join(cuts, by).withColumn("outlier", F.col(distance) > F.col("__c")).drop("__c")


def perceptron(df: DataFrame, keys: Sequence[str], vector: str, label: str, k: int, hidden: Sequence[int], rounds: int = 60, seed: int = 1) -> DataFrame:
    """A feed-forward network on arrays of numbers; every row is classified by the one trained on the other folds. Adds
    fold, predicted and probability."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer
    from pyspark.ml.functions import array_to_vector, vector_to_array

    dealt = folds(df, keys, k, seed).withColumn("__v", array_to_vector(F.col(vector)))
    index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(dealt)
    names = IndexToString(inputCol="__p", outputCol="__l", labels=index.labels)
    data = index.transform(dealt)
    layers = [data.select(F.max(F.size(vector))).first()[0], *hidden, len(index.labels)]

    def fold(i: int) -> DataFrame:
        net = MultilayerPerceptronClassifier(featuresCol="__v", labelCol="__y", predictionCol="__p", probabilityCol="__q", layers=layers, maxIter=rounds, seed=seed)
        return net.fit(data.where(F.col("fold") != i)).transform(data.where(F.col("fold") == i))

    out = names.transform(reduce(DataFrame.union, [fold(i) for i in range(k)]))
    return out.withColumn("predicted", F.col("__l").cast(df.schema[label].dataType)).withColumn("probability", F.array_max(vector_to_array("__q"))).drop("__v", "__y", "__p", "__q", "__l", "rawPrediction")


def latest_by(df: DataFrame, key: str, at: str) -> DataFrame:
    w = W.partitionBy(key).orderBy(F.desc(at))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
