"""Queries over texts, vectors and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import scalars as fx
from loomspan.operators import models, panel, text
from loomspan.operators import windows as win
from loomspan.operators.aggregates import quantiles
from loomspan.plans.fixtures import Tables, daily
from loomspan.plans.registry import Registry

Q = Registry()

NORMAL = r"""trim(regexp_replace(regexp_replace(replace(regexp_replace(replace(replace(replace(replace(replace(lower(regexp_replace(text, '([a-z])([A-Z])', '\1 \2', 'g')), 'n''t', ' not'), '''re', ' are'), '''ll', ' will'), '''ve', ' have'), '''m', ' am'), '\([^)]*\)', ' ', 'g'), '&', ' and '), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"""
TALK = f"talk AS (SELECT conv_id, turn, role, {NORMAL} AS t FROM conversations)"
WORDS = f"{TALK}, words AS (SELECT conv_id, turn, role, list_filter(string_split(t, ' '), lambda w: length(w) >= 3 AND regexp_full_match(w, '[a-z]+') AND w NOT IN ('the', 'and')) AS w FROM talk)"


def talk(t: Tables) -> DataFrame:
    return t("conversations").select("conv_id", "turn", "role", text.normalise(F.col("text")).alias("t"))


def words(t: Tables) -> DataFrame:
    return talk(t).select("conv_id", "turn", "role", text.tokens(F.col("t"), ["the", "and"]).alias("w"))


@Q("x1_normalise", f"WITH {TALK} SELECT * FROM talk")
def _(s: SparkSession, d: str) -> DataFrame:
    return talk(Tables(s, d))


@Q("x2_tokens", f"WITH {WORDS} SELECT conv_id, turn, role, array_to_string(w, ' ') AS t FROM words")
def _(s: SparkSession, d: str) -> DataFrame:
    return words(Tables(s, d)).select("conv_id", "turn", "role", F.array_join("w", " ").alias("t"))


@Q("x3_sentences", r"SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]+'), lambda s: trim(s)), lambda s: length(s) BETWEEN 10 AND 350)) AS sentence FROM documents")
def _(s: SparkSession, d: str) -> DataFrame:
    return Tables(s, d)("documents").select("doc_id", F.explode(text.sentences(F.col("text"), 10, 350)).alias("sentence"))


@Q("x4_long_sentences", r"""WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(text, '[.!?\n]+'), lambda s: trim(s)), lambda s: length(s) BETWEEN 10 AND 350)) AS sentence FROM documents), p AS (SELECT doc_id, quantile_cont(length(sentence), 0.75) AS q FROM s GROUP BY 1)
  SELECT s.doc_id, sentence FROM s JOIN p ON s.doc_id = p.doc_id WHERE length(sentence) >= q""")
def _(s: SparkSession, d: str) -> DataFrame:
    rows = Tables(s, d)("documents").select("doc_id", F.explode(text.sentences(F.col("text"), 10, 350)).alias("sentence"))
    cut = rows.groupBy("doc_id").agg(F.percentile(F.length("sentence"), 0.75).alias("q"))
    return rows.join(cut, "doc_id").where(F.length("sentence") >= F.col("q")).select("doc_id", "sentence")


#: A word is known if it makes up this share of all words.
KNOWN_SHARE = 0.001


@Q("x5_spelling", f"""WITH {WORDS}, v AS (SELECT unnest(w) AS word, count(*) AS n FROM words GROUP BY 1), known AS (SELECT word AS known, n FROM v WHERE n >= {KNOWN_SHARE}::DOUBLE * (SELECT sum(n) FROM v)), c AS (SELECT word, known, known.n, levenshtein(word, known) AS edits FROM v, known WHERE word NOT IN (SELECT known FROM known))
  SELECT word, arg_min(known, (edits, -n, known)) AS known, min(edits)::INTEGER AS edits FROM c WHERE edits <= 3 GROUP BY 1""")
def _(s: SparkSession, d: str) -> DataFrame:
    v = words(Tables(s, d)).select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return text.closest_words(v, "word", "n", KNOWN_SHARE)


GRAMS = f"{WORDS}, grams AS (SELECT conv_id, turn, role, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)])) AS term FROM words)"


def grams(t: Tables) -> DataFrame:
    both = F.concat("w", text.ngrams(F.col("w"), 2))
    return words(t).select("conv_id", "turn", "role", F.explode(both).alias("term"))


@Q("x7_ngram_counts", f"WITH {GRAMS}, n AS (SELECT count(DISTINCT conv_id) AS n FROM grams) SELECT term, count(DISTINCT conv_id) AS docs FROM grams, n GROUP BY term, n.n HAVING count(DISTINCT conv_id) >= 2 AND count(DISTINCT conv_id) <= 0.5 * n.n")
def _(s: SparkSession, d: str) -> DataFrame:
    return text.document_frequency(grams(Tables(s, d)), "conv_id", "term", 2, 0.5)


TFIDF = f"""{GRAMS}, c AS (SELECT role, term, count(*) AS n FROM grams GROUP BY 1, 2), f AS (SELECT role, term, n, round(n / sum(n) OVER (PARTITION BY role) * ln(1 + (SELECT count(DISTINCT role) FROM c) / (sum(n) OVER (PARTITION BY term))), 9) AS weight FROM c)"""


def tfidf(t: Tables) -> DataFrame:
    counts = grams(t).groupBy("role", "term").agg(F.count("*").alias("n"))
    return text.class_tfidf(counts, "role", "term", "n").withColumn("weight", F.round("weight", 9))


@Q("x8_class_tfidf", f"WITH {TFIDF} SELECT role, term, n, weight FROM f")
def _(s: SparkSession, d: str) -> DataFrame:
    return tfidf(Tables(s, d)).select("role", "term", "n", "weight")


@Q("x9_top_terms", f"WITH {TFIDF} SELECT role, term, place FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY weight DESC, term)::INTEGER AS place FROM f) WHERE place <= 10")
def _(s: SparkSession, d: str) -> DataFrame:
    return panel.top_by(tfidf(Tables(s, d)), ["role"], [F.desc("weight"), "term"], 10).select("role", "term", "place")


@Q("x10_prune_by_idf", f"WITH {WORDS}, v AS (SELECT DISTINCT conv_id, unnest(w) AS word FROM words), i AS (SELECT word, round(ln((SELECT count(DISTINCT conv_id) FROM v) / count(*)), 9) AS idf FROM v GROUP BY 1), p AS (SELECT quantile_cont(idf, 0.025) AS lo, quantile_cont(idf, 0.975) AS hi FROM i) SELECT word, idf FROM i, p WHERE idf BETWEEN lo AND hi")
def _(s: SparkSession, d: str) -> DataFrame:
    v = words(Tables(s, d)).select("conv_id", F.explode("w").alias("word")).distinct()
    n = v.select("conv_id").distinct().count()
    idf = v.groupBy("word").agg(F.round(F.log(n / F.count("*")), 9).alias("idf"))
    lo, hi = quantiles(idf, "idf", [0.025, 0.975]) or (0, 0)
    return idf.where(F.col("idf").between(lo, hi))


@Q("x12_principal_components")
def _(s: SparkSession, d: str) -> DataFrame:
    return models.principal(Tables(s, d)("embeddings"), "embedding", 0.95).select("vec_id", F.size("reduced").alias("n"), "reduced")


@Q("x13_cluster_tree")
def _(s: SparkSession, d: str) -> DataFrame:
    return models.clusters(Tables(s, d)("embeddings"), "embedding", 8, tree=True).select("vec_id", "label", "cluster")


@Q("x14_centroids", "WITH p AS (SELECT label, i, round(avg(embedding[i]::DOUBLE), 6) AS m FROM embeddings, generate_series(1, 64) g(i) GROUP BY 1, 2) SELECT label, list(m ORDER BY i) AS centroid FROM p GROUP BY 1")
def _(s: SparkSession, d: str) -> DataFrame:
    c = text.centroids(Tables(s, d)("embeddings"), "label", "embedding")
    return c.select("label", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


@Q("x15_outliers", """WITH p AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, generate_series(1, 64) g(i) GROUP BY 1, 2), d AS (SELECT vec_id, p.label, round(sqrt(sum(pow(embedding[i]::DOUBLE - m, 2))), 6) AS distance FROM embeddings e JOIN p ON e.label = p.label GROUP BY 1, 2),
  c AS (SELECT label, quantile_cont(distance, 0.9) AS q FROM d GROUP BY 1) SELECT vec_id, d.label, distance, distance > q AS outlier FROM d JOIN c ON d.label = c.label""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = Tables(s, d)("embeddings")
    square = F.aggregate(F.zip_with("embedding", "centroid", lambda x, y: F.pow(x.cast("double") - y, 2)), F.lit(0.0), lambda a, x: a + x)
    rows = e.join(text.centroids(e, "label", "embedding"), "label").select("vec_id", "label", F.round(F.sqrt(square), 6).alias("distance"))
    return models.farthest(rows, "label", "distance", 0.9)


@Q("x16_levels", """WITH e AS (SELECT label // 4 AS a, label // 2 AS b, label AS c, vec_id % 3 = 0 AS f FROM embeddings), u AS (SELECT avg(f::INT) AS u FROM e),
  l AS (SELECT 0 AS level, a AS cluster, NULL::INTEGER AS parent, f FROM e UNION ALL SELECT 1, b, a, f FROM e UNION ALL SELECT 2, c, b, f FROM e)
  SELECT level, cluster::INTEGER AS cluster, min(parent)::INTEGER AS parent, count(*) AS volume, count_if(f) AS flagged, count_if(f) / count(*) >= any_value(u) AS above FROM l, u GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    e = Tables(s, d)("embeddings").select(F.expr("int(label div 4)").alias("a"), F.expr("int(label div 2)").alias("b"), F.col("label").cast("int").alias("c"), (F.col("vec_id") % 3 == 0).alias("f"))
    return text.tree_volumes(e, ["a", "b", "c"], "f")


@Q("x17_label_shares", "SELECT source, lang, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY source), 6) AS share FROM documents GROUP BY 1, 2")
def _(s: SparkSession, d: str) -> DataFrame:
    return text.label_shares(Tables(s, d)("documents"), "source", "lang").withColumn("share", F.round("share", 6))


@Q("x18_seed_labels", """WITH k AS (SELECT label, 'T' || (vec_id * 7 % 5) AS target, count(*) AS n FROM embeddings WHERE vec_id % 4 = 0 AND label % 5 > 0 GROUP BY 1, 2),
  b AS (SELECT label, arg_min(target, (-n, target)) AS target FROM k GROUP BY 1), g AS (SELECT label, max(label) OVER (PARTITION BY target) AS final FROM b)
  SELECT vec_id, CASE coalesce(final, e.label) WHEN 1 THEN 'M' WHEN 2 THEN 'M' ELSE coalesce(final, e.label)::VARCHAR END AS grouped FROM embeddings e LEFT JOIN g ON e.label = g.label""")
def _(s: SparkSession, d: str) -> DataFrame:
    """Clusters that share a seed word's category become one; then a list made by hand names some."""
    rows = Tables(s, d)("embeddings").select("vec_id", "label")
    seeds = rows.where("vec_id % 4 = 0 and label % 5 > 0").select("label", F.concat(F.lit("T"), (F.col("vec_id") * 7 % 5).cast("string")).alias("target"))
    merged = rows.join(F.broadcast(text.seed_groups(seeds, "target", "label")), "label", "left").select("vec_id", F.coalesce("final", "label").alias("final"))
    named = F.create_map(*map(F.lit, ("1", "M", "2", "M")))
    return merged.select("vec_id", F.coalesce(named[F.col("final").cast("string")], F.col("final").cast("string")).alias("grouped"))


@Q("x19_mean_neighbours", """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT a.vec_id, b.vec_id AS other, k, list_cosine_similarity(a.v[1:k], b.v[1:k]) AS w FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id, (VALUES (16), (32), (64)) t(k)),
  m AS (SELECT vec_id, other, round(avg(w), 6) + 0.0 AS weight FROM n GROUP BY 1, 2) SELECT vec_id, other, weight FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY weight DESC, other) AS place FROM m) WHERE place <= 3""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The mean of the cosines at three depths is the cosine of the three unit vectors end to end."""
    from loomspan.operators.market import neighbours

    def depth(k: int) -> Column:
        v = F.slice("embedding", 1, k)
        n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
        return F.transform(v, lambda x: x.cast("double") / n)

    rows = Tables(s, d)("embeddings").select("vec_id", "label", F.concat(*(depth(k) for k in (16, 32, 64))).alias("v"))
    return neighbours(rows, "vec_id", "label", "v", 3, -2.0).select("vec_id", "other", "weight")


@Q("t4_top_sentences", """WITH u AS (SELECT vec_id, label, i, embedding[i]::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x FROM embeddings, generate_series(1, 64) g(i)), t AS (SELECT label, i, sum(x) AS t FROM u GROUP BY 1, 2),
  s AS (SELECT vec_id, u.label, round(sum(x * t), 6) AS similarity FROM u JOIN t ON u.label = t.label AND u.i = t.i GROUP BY 1, 2) SELECT label, vec_id, similarity, place FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id)::INTEGER AS place FROM s) WHERE place <= 30""")
def _(s: SparkSession, d: str) -> DataFrame:
    """The sentences of a cluster that are most like all others of it."""
    return text.central(Tables(s, d)("embeddings"), "label", "vec_id", "embedding", 30)


@Q("ml1_boosted_trees")
def _(s: SparkSession, d: str) -> DataFrame:
    """Lags and the weekday of each group, the group a category, late rows with more weight; every row is predicted by the
    model of the other folds."""
    w, full = win.ordered(["grp"], ["day"]), daily(Tables(s, d))
    rows = win.lag_bank(full, "amount", [1, 7, 14], w, "lag_").withColumn("weekday", F.weekday("day")).dropna()
    last = full.agg(F.max("day")).first()[0]
    rows = rows.withColumn("weight", fx.decay(F.datediff(F.lit(last), F.col("day")), 365, 60) + 0.1)
    made, _ = models.cross_validated(rows, ["grp", "day"], ["lag_1", "lag_7", "lag_14", "weekday"], "amount", 5, weight="weight", categories=["grp"])
    return made.select("grp", "day", "amount", "prediction")


@Q("ml2_seasonal_forecast")
def _(s: SparkSession, d: str) -> DataFrame:
    return models.seasonal(daily(Tables(s, d)), ["grp"], "day", "amount", 14, ["NEW_YEAR", "LABOUR", "NATIONAL", "CHRISTMAS"])


@Q("ml3_tamed", "WITH daily AS (SELECT p_brand AS grp, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS amount FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), m AS (SELECT *, quantile_cont(amount, 0.95) OVER (PARTITION BY grp) AS c, median(CASE WHEN amount > 0 THEN amount END) OVER (PARTITION BY grp, month(day)) AS u FROM daily) SELECT grp, day, CASE WHEN amount > c OR amount = 0 THEN u ELSE amount END AS tamed FROM m")
def _(s: SparkSession, d: str) -> DataFrame:
    return models.tame_outliers(daily(Tables(s, d)), ["grp"], "day", "amount", 0.95).select("grp", "day", "tamed")


@Q("ml5_model_choice", """WITH m AS (SELECT p_brand AS k, CAST(l_shipdate AS DATE) AS trained, max(l_orderkey) AS run FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), w AS (SELECT DISTINCT p_brand AS k, DATE '2000-03-01' AS asof_day FROM part)
  SELECT w.k, asof_day, max(trained) AS trained, arg_max(run, (trained, run)) AS run FROM w JOIN m ON w.k = m.k WHERE trained <= asof_day - 14 GROUP BY 1, 2""")
def _(s: SparkSession, d: str) -> DataFrame:
    from loomspan.operators.store import pick_model

    t = Tables(s, d)
    made = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("k"), F.to_date("l_shipdate").alias("trained")).agg(F.max("l_orderkey").alias("run"))
    wanted = t("part").select(F.col("p_brand").alias("k"), F.lit("2000-03-01").cast("date").alias("asof_day")).distinct()
    return pick_model(made, wanted, "k", "trained", "run", "asof_day", 14)


@Q("ml4_item_backtest")
def _(s: SparkSession, d: str) -> DataFrame:
    """A model for each group, trained before a day and scored after it."""
    rows = win.lag_bank(daily(Tables(s, d)), "amount", [1, 7, 14], win.ordered(["grp"], ["day"]), "lag_").withColumn("weekday", F.weekday("day"))
    made = models.item_models(rows, ["grp"], "day", ["lag_1", "lag_7", "lag_14", "weekday"], "amount", "2001-07-01")
    return made.groupBy("grp").agg(F.avg(F.abs(F.col("amount") - F.col("prediction")) / F.col("amount")).alias("mape"), F.count("*").alias("n"))


@Q("ml7_perceptron")
def _(s: SparkSession, d: str) -> DataFrame:
    """The label of every vector by networks trained on the other folds, with its probability."""
    return models.perceptron(Tables(s, d)("embeddings"), ["vec_id"], "embedding", "label", 3, [32]).select("vec_id", "label", "predicted", "probability")
