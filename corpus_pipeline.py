"""A corpus pipeline: documents in, token sequences out, each stage written and read again.

Stages: quality (what the classifier rejects goes), near_duplicates (of a group of near copies the smallest doc_id
stays), passages (passages that a smaller document has are cut out), mixing (small sources are read up to twice,
every document at least once), tokens (ids of each text, as counts and digests).

Every stage but the last returns the columns it is given, whatever their names; names that begin with __ are its own.
Defined results: null and empty texts are scored by the classifier's bias, are near copies of nothing, come out of passages
empty, are read once and have no tokens; rows without doc_id are never copies of others, lose what any document with an
id has too, and are dealt as 'null'; of rows with one doc_id, near_duplicates keeps the first by text, then by the other
columns; very long texts are worked on whole; ties go to the smaller doc_id; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.llm import near_duplicates, piece_tokens, quality_classifier, source_mixing, suffix_dedup
from loomspan.llm.common import new_path, stage

#: Most times that the mix reads a document.
MAX_EPOCHS = 2.0
#: Units that a worker of the last stage keeps at hand; stages before it have filled the executors' heaps.
UNITS = 120_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more. It learns from the labels outside the held-out fold, and
    the texts of the labelled documents among docs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality_classifier.fit(docs, quality_classifier.learned_fold(docs, labels))
    scored = quality_classifier.score(docs, weights, docs.columns, into="__quality")
    return scored.where("__quality >= 0.5").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and one row of each doc_id; rows without doc_id stay."""
    found = stage(near_duplicates.near_duplicates(docs), "near")
    each = found.where("doc_id is not null").groupBy("doc_id").agg(F.first("kept").alias("kept"), F.count("*").alias("n"))
    odd = stage(each.where("not kept or n > 1").select(F.col("doc_id").alias("__id"), F.col("kept").alias("__kept")), "odd")
    # Most documents are not in the list, which a small filter tells without moving them.
    maybe = near_duplicates.maybe_in(docs, "doc_id", odd.select(F.col("__id").alias("id")))
    sure = maybe.where("not __maybe").select(*docs.columns)
    rest = maybe.where("__maybe").join(odd, F.col("doc_id") == F.col("__id"), "left")
    plain = rest.where("__id is null").select(*docs.columns)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", F.to_json(F.struct(*docs.columns))))
    ordered = rest.where("__kept").withColumn("__row", first)
    return sure.union(plain).union(ordered.where("__row = 1").select(*docs.columns))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller doc_id has; those of which nothing is left go."""
    keep = [c for c in docs.columns if c != "text"]
    left = suffix_dedup.remove_repeats(docs, keep, as_text=True, prefix="__").where("__n_bytes = 0 or __n_removed < __n_bytes")
    columns = {"text": F.col("__kept_text"), "n_chars": F.length("__kept_text").cast("long")}
    return left.select(*(columns.get(c, F.col(c)).alias(c) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mixed to 95 % of the entropy of equal source weights, or as far as MAX_EPOCHS allows."""
    return source_mixing.mix_sources(docs, docs.columns, max_epochs=MAX_EPOCHS, whole=True, prefix="__").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every reading of a document."""
    return piece_tokens.digest(docs, ["doc_id"], units=UNITS)


STAGES = [("quality", quality), ("near_duplicates", near_copies), ("passages", passages), ("mixing", mixing), ("tokens", tokens)]

#: No stage but mixing can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
