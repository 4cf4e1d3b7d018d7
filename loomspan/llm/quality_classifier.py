"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader.

Words and punctuation runs, their shapes, and pairs of neighbours of both are hashed into one table of
weights; a pair of shapes also says whether the word is repeated. A score is the sigmoid of the mean weight of a text's features plus a bias: a sparse dot product.

The sample to learn from is bounded: ROWS_PER_CLASS documents of each class, about, chosen by a hash of doc_id, never
more than twice as many, nor more than SAMPLE_FEATURES features in all. What reaches the driver are counts of hashed
features, packed; no texts.

Defined results: a null or empty text has no features and gets the sigmoid of the bias; a null doc_id counts
as the text 'null' when folds are dealt; repeated rows are scored each; texts of any length are scored whole; an empty
table gives an empty result; without labelled rows every score is 0.5. Only doc_id, text (and doc_id, quality of the
labels) are read, so other columns, whatever their names, do no harm; a kept column named like the score gives way to
it. Labels that are null are not learned from; if a doc_id has several labels each counts as a row; equal rows of the
sample count once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import beside, bound_batches, crc_mod, drop_path, read_documents, stage, trimmed

BITS = 18
#: Bounds of the training sample: labelled rows of each class, about, and features of all rows.
ROWS_PER_CLASS, SAMPLE_FEATURES = 4000, 20_000_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-6, 1e-6
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE_MAX = 30_000
_MASK = np.uint64((1 << BITS) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    """Letter case and kind of a token: AA, Aa, aa, 9, a9 or the first punctuation mark and its length."""
    if word[0].isalpha():
        if word.isalpha():
            return "AA" if word.isupper() and len(word) > 1 else "Aa" if word[0].isupper() else "aa"
        return "a9"
    return "9" if word.isalnum() else word[0] + str(min(len(word), 4))


class Featurizer:
    """Texts to indexes into the weights. Hashes of words are kept until the cache is full, then anew."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def _hash(self, word: str) -> tuple[int, int]:
        if len(self.known) >= _CACHE_MAX:
            self.known.clear()
        pair = xxhash.xxh64_intdigest(word), xxhash.xxh64_intdigest(_shape(word), 7)
        self.known[word] = pair
        return pair

    def __call__(self, text: str | None) -> np.ndarray:
        words = _TOKEN.findall(text) if text else []
        if not words:
            return np.zeros(0, np.int64)
        known, make = self.known, self._hash
        flat = np.array([known.get(w) or make(w) for w in words], dtype=np.uint64)
        word, shape = flat[:, 0], flat[:, 1]
        again = (word[:-1] == word[1:]).astype(np.uint64)
        mixed = [word, shape, (word[:-1] * _MULT) ^ word[1:], ((shape[:-1] * _MULT) ^ shape[1:]) + again]
        return ((np.concatenate(mixed) * _MULT) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss; the last weight is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def _weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, index: np.ndarray, value: np.ndarray, label: float, weight: float) -> None:
        w = self._weights(index)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
        g = weight * (p - label) * value
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += g - sigma * w
        self.n[index] += g * g

    def weights(self) -> np.ndarray:
        return self._weights(slice(None)).astype(np.float32)


def pack(index: np.ndarray) -> bytes:
    """A text's features as distinct indexes with their counts, by byte planes, compressed."""
    found, count = np.unique(index, return_counts=True)
    both = np.concatenate([np.diff(found, prepend=0), count]).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and counts."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=8 << BITS), np.uint8)
    both = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(both[: len(both) // 2], dtype=np.int64), both[len(both) // 2 :]


def train(rows: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) learned from packed features; rows in an order fixed by a seed."""
    model, order = Ftrl(), np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index, count = unpack(rows[i])
            value = 20 * count / max(int(count.sum()), 1)
            model.learn(np.append(index, 1 << BITS), np.append(value, 1.0), float(labels[i]), float(weights[i]))
    return model.weights()


def score_texts(texts: list[str | None], weights: np.ndarray, make: Featurizer) -> np.ndarray:
    out = np.empty(len(texts))
    for k, text in enumerate(texts):
        index = make(text)
        out[k] = weights[-1] + (20 * weights[index].mean(dtype=np.float64) if len(index) else 0.0)
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _counted(batches):
    make = Featurizer()
    for batch in batches:
        index = [make(t) for t in batch.column("text").to_pylist()]
        rows = [pack(i) for i in index]
        place = [xxhash.xxh64_intdigest(r, seed=h & 0xFFFFFFFF) >> 1 for r, h in zip(rows, batch.column("h").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(place, pa.int64()), pa.array([len(i) for i in index], pa.int64()), pa.array(rows, pa.binary())], names=["quality", "place", "n", "features"])


def fit(documents: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, features: int = SAMPLE_FEATURES) -> np.ndarray:
    """Learn from labelled documents, weighted so that the classes keep their shares."""
    spark = documents.sparkSession
    bound_batches(spark)
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    none = np.zeros((1 << BITS) + 1, np.float32)
    if not counts:
        return none
    kept = F.lit(False)
    for k, n in counts.items():
        kept = kept | ((F.col("quality") == k) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, rows_per_class / n) * (1 << 20))))
    chosen = known.where(kept).distinct()
    if chosen.count() <= 4 * rows_per_class * len(counts):  # else labels repeat ids, and the join is left to the planner
        chosen = F.broadcast(chosen)
    found = documents.select("doc_id", "text").join(chosen, "doc_id").select("text", "quality", F.xxhash64("doc_id").alias("h"))
    counted = found.mapInArrow(trimmed(_counted), "quality int, place bigint, n bigint, features binary")
    sample = stage(counted.dropDuplicates(["quality", "place"]), "sample")
    # where the bounds fall: sizes first, then the rows before that
    sizes = sample.select("place", "n").orderBy("place").limit(2 * rows_per_class * len(counts)).toArrow()
    place, upto = sizes.column("place").to_numpy(), np.cumsum(sizes.column("n").to_numpy())
    place = place[upto <= features]
    if not len(place):
        return none
    rows = sample.where(F.col("place") <= int(place[-1])).toArrow().sort_by([("place", "ascending"), ("quality", "ascending")])
    drop_path(spark, sample.staged_path)
    quality = rows.column("quality").to_numpy()
    weights = np.array([counts[q] for q in quality]) / np.bincount(quality, minlength=2)[quality]
    return train(rows.column("features").to_pylist(), quality, weights / weights.mean())


def score(documents: DataFrame, weights: np.ndarray, keep: list[str], into: str = "quality_score") -> DataFrame:
    """The columns named in keep (doc_id and text among them or not) and the score, named as into says."""
    spark = documents.sparkSession
    bound_batches(spark)
    held = spark.sparkContext.broadcast(weights)
    keep = beside(keep, [into])
    given = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = "".join(f"`{given.schema[c].name}` {given.schema[c].dataType.simpleString()}, " for c in keep)

    def scored(batches):
        make = Featurizer()
        for batch in batches:
            got = score_texts(batch.column("text").to_pylist(), held.value, make)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(got)], names=[*keep, into])

    return given.mapInArrow(trimmed(scored), f"{schema}`{into}` double")


def learned_fold(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold."""
    return labels.where(crc_mod(F.col("doc_id"), 3) != 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document's score, learned from labels whose crc32(doc_id) mod 3 is not 1."""
    documents, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = fit(documents, learned_fold(documents, labels))
    return score(documents, weights, ["doc_id"]).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )
