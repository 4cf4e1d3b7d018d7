"""Short texts: normal forms, tokens, sentences, n-grams, terms of classes, vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions.scalars import ratio

#: Contractions and what they stand for; fixed values.
CONTRACTIONS = [("n't", " not"), ("'re", " are"), ("'ll", " will"), ("'ve", " have"), ("'m", " am")]


def normalise(text: Column) -> Column:
    """Word boundaries in camelCase, lower case, contractions and & in words, no parentheses, no punctuation."""
    out = F.lower(F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2"))
    for short, long in CONTRACTIONS:
        out = F.replace(out, F.lit(short), F.lit(long))
    out = F.replace(F.regexp_replace(out, r"\([^)]*\)", " "), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(out, "[^a-z0-9 ]", " "), " +", " "))


def tokens(text: Column, stop: Sequence[str] = (), shortest: int = 3) -> Column:
    """Alphabetic words of a normal form, long enough and not in a list."""
    keep = lambda w: (F.length(w) >= shortest) & w.rlike("^[a-z]+$") & ~F.array_contains(F.array(*map(F.lit, stop)).cast("array<string>"), w)
    return F.filter(F.split(text, " "), keep)


def sentences(text: Column, low: int, high: int) -> Column:
    """Sentences between . ! ? and line ends, of so many characters."""
    parts = F.transform(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: F.length(s).between(low, high))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words, joined by spaces."""
    places = F.sequence(F.lit(1), F.size(words) - n + 1)
    return F.when(F.size(words) >= n, F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def class_tfidf(df: DataFrame, label: str, term: str, count: str) -> DataFrame:
    """Weights of terms in classes: the share of a term in its class, times ln of documents' mean over the term's
    total. df holds a count for each class and term. Adds weight."""
    in_class = F.sum(count).over(W.partitionBy(label))
    totals = df.groupBy(term).agg(F.sum(count).alias("__t"))
    n = df.select(label).distinct().count()
    return df.join(totals, term).withColumn("weight", F.col(count) / in_class * F.log1p(F.lit(float(n)) / F.col("__t"))).drop("__t")


def document_frequency(df: DataFrame, doc: str, term: str, at_least: int, at_most: float) -> DataFrame:
    """Terms that are in at least so many documents and in no more than a share of all: term, docs."""
    n = df.select(doc).distinct().count()
    return df.groupBy(term).agg(F.countDistinct(doc).alias("docs")).where((F.col("docs") >= at_least) & (F.col("docs") <= at_most * n))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector of each label: label, centroid."""
    each = df.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return each.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


#: Rows of a label that are compared in one piece of work, on each side, about; pairs that Python returns at once, about.
PAIR_BLOCK, PAIR_BATCH = 2000, 250_000


def cosines(df: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """All pairs of rows of one label with different keys, the smaller one first: a, b, cosine, rounded to six digits, halves
    away from zero. Null where a vector is null, zero or has a null in it, or the lengths differ. A large label is cut into
    blocks, and a piece of work holds two of them, so its pairs are dealt to many tasks and come out a few at a time."""
    spark, name = df.sparkSession, df.schema[key].dataType.simpleString()
    rows = df.select(F.col(label).alias("__g"), F.col(key).alias("__k"), F.col(vector).alias("__v")).where("__g is not null and __k is not null")
    # no more than one row for each PAIR_BLOCK rows of the table
    large = rows.groupBy(F.col("__g").alias("__h")).agg(F.ceil(F.count("*") / PAIR_BLOCK).cast("int").alias("__n")).where("__n > 1")
    cut = rows.join(F.broadcast(large), F.col("__g") == F.col("__h"), "left").withColumn("__n", F.coalesce("__n", F.lit(1)))
    dealt = cut.withColumn("__b", F.pmod(F.xxhash64("__k"), "__n").cast("int")).withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    pieces = dealt.select("__g", F.least("__b", "__o").alias("__i"), F.greatest("__b", "__o").alias("__j"), "__b", "__k", "__v")
    # by number: pieces are small to read and long to work on, so tasks are not to be merged by what they read
    spread = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__g", "__i", "__j")

    def matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lists of numbers as rows, filled up with zeros, and their lengths; -1 for a list that is null or has a null in it."""
        sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten()
        x = np.zeros((len(sizes), max(sizes.max(initial=0), 0)))
        x[np.arange(x.shape[1]) < sizes[:, None]] = flat.cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False)
        if flat.null_count:
            sizes[pc.list_parent_indices(vectors).filter(flat.is_null()).to_numpy(zero_copy_only=False)] = -1
        return x, sizes

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        column = {c: rows[c].combine_chunks() for c in rows.column_names}
        i, j, keys = column["__i"][0].as_py(), column["__j"][0].as_py(), column["__k"]
        names, block = pc.unique(keys.take(pc.sort_indices(keys))), column["__b"].to_numpy()
        place = pc.index_in(keys, names).to_numpy()
        x, sizes = matrix(column["__v"])
        norm, right = np.sqrt((x * x).sum(axis=1)), np.flatnonzero(block == j)
        left, y = np.flatnonzero(block == i), x[right].T
        step = max(1, PAIR_BATCH // max(1, len(right)))
        for part in (left[k : k + step] for k in range(0, len(left), step)):
            one, two = place[part][:, None], place[right][None]
            keep = one < two if i == j else one != two
            long = norm[part][:, None] * norm[right]
            none = (long == 0) | (sizes[part][:, None] != sizes[right]) | (sizes[part] < 0)[:, None]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                digits = x[part] @ y / long * 1e6
                cosine = np.trunc(digits + np.copysign(0.5, digits)) / 1e6 + 0.0
            a, b = (names.take(pa.array(f(one, two)[keep])) for f in (np.minimum, np.maximum))
            if len(a):
                yield pa.RecordBatch.from_arrays([a, b, pa.array(cosine[keep], mask=none[keep], from_pandas=False)], ["a", "b", "cosine"])

    return spread.groupBy("__g", "__i", "__j").applyInArrow(pairs, f"a {name}, b {name}, cosine double")


def central(df: DataFrame, label: str, key: str, vector: str, k: int) -> DataFrame:
    """The k rows of each label with the largest sum of cosines to all rows of the label: label, key, similarity, place. The
    sum is the product of a row's unit vector with the sum of all of them, so no pairs are made. Zero vectors count 0."""
    long = F.sqrt(F.aggregate(F.col(vector), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = df.withColumn("__n", long).select(label, key, F.transform(vector, lambda x: F.coalesce(F.try_divide(x.cast("double"), F.col("__n")), F.lit(0.0))).alias("__u"))
    each = unit.select(label, F.posexplode("__u").alias("i", "x")).groupBy(label, "i").agg(F.sum("x").alias("x"))
    total = each.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("__t"))
    dot = F.aggregate(F.zip_with("__u", "__t", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = unit.join(total, label).select(label, key, F.round(dot, 6).alias("similarity"))
    w = W.partitionBy(label).orderBy(F.desc("similarity"), key)
    return scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def tree_volumes(df: DataFrame, levels: Sequence[str], flag: str) -> DataFrame:
    """A row for each cluster of each level, from the widest: level, cluster, parent (its cluster on the level above, of the
    smallest one if it has several; null on the first), volume, flagged, and whether it has more flagged rows than usual."""
    usual = F.avg(F.col(flag).cast("double"))
    names = F.explode(F.array(*(F.struct(F.lit(i).alias("level"), F.col(c).alias("cluster"), (F.col(levels[i - 1]) if i else F.lit(None).cast("int")).alias("parent")) for i, c in enumerate(levels))))
    each = df.select(flag, names.alias("__c")).select(flag, "__c.*")
    counted = each.groupBy("level", "cluster").agg(F.min("parent").alias("parent"), F.count("*").alias("volume"), F.count_if(F.col(flag)).alias("flagged"))
    return counted.join(F.broadcast(df.agg(usual.alias("__u"))), F.lit(True)).withColumn("above", F.col("flagged") / F.col("volume") >= F.col("__u")).drop("__u")


def seed_groups(seeds: DataFrame, target: str, label: str) -> DataFrame:
    """label, final: labels of which one target has most seeds (ties: the first by name) become one, the largest of them;
    label -1 is left out. Labels without seeds are not listed and stay what they are."""
    counts = seeds.groupBy(label, target).agg(F.count("*").alias("n"))
    best = counts.groupBy(label).agg(F.min_by(target, F.struct(-F.col("n"), target)).alias("__t"))
    groups = best.groupBy("__t").agg(F.max(label).alias("final"))
    return best.join(groups, "__t").where(F.col(label) != -1).select(label, "final")


def label_shares(df: DataFrame, hue: str, label: str) -> DataFrame:
    """Share of labels in each hue, in percent."""
    counts = df.groupBy(hue, label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", 100 * ratio(F.col("n"), F.sum("n").over(W.partitionBy(hue))))


def _deletes(word: Column, edits: int, prefix: int) -> Column:
    """The beginning of a word and all that is left of it after up to so many deletions."""
    left = F.array(F.substring(word, 1, prefix))
    for _ in range(edits):
        less = F.flatten(F.transform(left, lambda t: F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t))))).otherwise(F.array(t))))
        left = F.array_distinct(F.concat(left, less))
    return left


def closest_words(counts: DataFrame, word: str, n: str, share: float, edits: int = 3, prefix: int = 7) -> DataFrame:
    """word, known, edits: for each word that is not known itself the closest known one, at most so many edits away;
    of equally close ones the most frequent, then the first by letters. Known are words with at least a share of all
    counts. Words meet where deletions make their beginnings equal: two words within so many edits always do."""
    known = counts.crossJoin(counts.agg(F.sum(n).alias("__all"))).where(F.col(n) >= share * F.col("__all")).select(F.col(word).alias("known"), F.col(n).alias("__n"))
    rare = counts.join(known, F.col(word) == F.col("known"), "left_anti").select(word)
    left = rare.select(word, F.explode(_deletes(F.col(word), edits, prefix)).alias("__key"))
    right = known.select("known", "__n", F.explode(_deletes(F.col("known"), edits, prefix)).alias("__key"))
    pairs = left.join(right, "__key").where(F.abs(F.length(word) - F.length("known")) <= edits).select(word, "known", "__n").distinct()
    near = pairs.withColumn("edits", F.levenshtein(word, "known")).where(F.col("edits") <= edits)
    best = F.min(F.struct("edits", (-F.col("__n")).alias("less"), "known"))
    return near.groupBy(word).agg(best.alias("__b")).select(word, "__b.known", "__b.edits")
