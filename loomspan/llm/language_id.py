"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of WINDOW bytes (the last one padded). Bytes are embedded, filters of several
widths slide over them, each filter's largest response is kept, and a softmax layer gives the languages'
probabilities; a document's are the mean of its windows' log-probabilities by their lengths. The network is trained
in numpy on the driver.

Trained on WINDOWS_PER_DOC windows from each of DOCS_PER_LANGUAGE documents of a language, about, chosen by a hash of
doc_id, and never from more than twice as many of all languages together. Every language that occurs is learned.

Defined results: a text that is null or has no letter is `und` with score 0; texts are scored whole, at any length;
rows are scored one by one, so repeated rows and null ids do no harm; an empty table gives an empty result; if nothing
can be learned every text is `und`; a kept column named lang_pred or lang_score gives way to the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.common import beside, bound_batches, crc_mod, read_documents, text_bytes

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 12, 6
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 500, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
UNKNOWN = "und"
#: Windows in one pass; keeps what it makes in the cache.
CHUNK = 64


class ByteNet:
    """Weights and languages; all float32."""

    def __init__(self, languages: list[str], seed: int = 11) -> None:
        draw = np.random.default_rng(seed)
        self.languages, n = languages, FILTERS * len(WIDTHS)
        self.p = {
            "embed": draw.normal(0, 0.3, (256, EMBED)).astype(np.float32),
            "filters": draw.normal(0, 0.3, (max(WIDTHS) * EMBED, n)).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "dense": draw.normal(0, 0.3, (n, len(languages))).astype(np.float32),
            "out": np.zeros(len(languages), np.float32),
        }
        # a narrow filter sees the first bytes of the widest patch only
        self.seen = np.zeros_like(self.p["filters"])
        for k, width in enumerate(WIDTHS):
            self.seen[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
        self.p["filters"] *= self.seen

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(windows), WINDOW + max(WIDTHS) - 1, EMBED), np.float32)
        wide[:, :WINDOW] = self.p["embed"][windows]
        flat = wide.reshape(len(windows), -1)
        view = np.lib.stride_tricks.as_strided(flat, (len(windows), WINDOW, max(WIDTHS) * EMBED), (flat.strides[0], EMBED * 4, 4))
        return np.ascontiguousarray(view)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """windows: uint8 rows of WINDOW bytes."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), CHUNK):
            patches = self._patches(windows[at : at + CHUNK])
            top = (patches.reshape(-1, patches.shape[2]) @ self.p["filters"]).reshape(*patches.shape[:2], -1).max(axis=1) + self.p["bias"]
            z = np.maximum(top, 0) @ self.p["dense"] + self.p["out"]
            z -= z.max(axis=1, keepdims=True)
            out[at : at + CHUNK] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray) -> ByteNet:
        """Adam on the cross entropy."""
        draw = np.random.default_rng(12)
        m, v, step = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for epoch in range(EPOCHS):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                grads, step = self._gradients(windows[some], labels[some]), step + 1
                rate = RATE * (1 - epoch / EPOCHS * 0.8)
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        n, rows = len(windows), np.arange(len(windows))
        patches = self._patches(windows)
        response = (patches.reshape(-1, patches.shape[2]) @ self.p["filters"]).reshape(n, WINDOW, -1)
        place = response.argmax(axis=1)
        top = np.take_along_axis(response, place[:, None], axis=1)[:, 0] + self.p["bias"]
        kept = np.maximum(top, 0)
        z = kept @ self.p["dense"] + self.p["out"]
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        p[rows, labels] -= 1
        p /= n
        back = (p @ self.p["dense"].T) * (top > 0)
        chosen = patches[rows[:, None], place]  # window, filter, patch
        filters = np.einsum("wf,wfp->pf", back, chosen) * self.seen
        embed = np.zeros_like(self.p["embed"])
        spread = (back[:, :, None] * self.p["filters"].T[None]).reshape(n, -1, max(WIDTHS), EMBED)
        wide = np.zeros((n, WINDOW + max(WIDTHS) - 1), np.uint8)
        wide[:, :WINDOW] = windows
        for k in range(max(WIDTHS)):
            inside = place + k < WINDOW
            np.add.at(embed, wide[rows[:, None], place + k][inside], spread[:, :, k][inside])
        return {"embed": embed, "filters": filters, "bias": back.sum(0), "dense": kept.T @ p, "out": p.sum(0)}


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text of each, and its bytes that are not padding."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    start = offsets[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    length = np.minimum(offsets[1:][owner] - start, WINDOW)
    wide = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(wide, WINDOW)[start] if len(start) else np.zeros((0, WINDOW), np.uint8)
    windows = np.where(np.arange(WINDOW)[None] < length[:, None], windows, 0).astype(np.uint8)
    return windows, owner, length


def fit(documents: DataFrame) -> ByteNet | None:
    """Learn from documents with a text and a lang; None where there are none."""
    known = documents.where("text is not null and lang is not null and length(text) > 0").select("doc_id", "lang", "text")
    counts = [(r["lang"], r["count"]) for r in known.groupBy("lang").count().collect()]
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    limit = F.create_map(*[x for name, n in counts for x in (F.lit(name), F.lit(max(1, int(min(1.0, DOCS_PER_LANGUAGE / n) * (1 << 20)))))])
    chosen = known.where(draw < limit[F.col("lang")])
    place = lambda k: F.lit(1) + F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))).cast("int")
    parts = F.array(*(F.substring("text", place(k), F.lit(WINDOW)) for k in range(WINDOWS_PER_DOC)))
    # a hard bound, as rows may repeat an id; the order is by hash, so that no language goes first
    some = chosen.select("doc_id", "lang", parts.alias("parts")).withColumn("h", F.xxhash64("doc_id", "parts", F.lit(7)))
    rows = some.orderBy("h", "lang").limit(2 * DOCS_PER_LANGUAGE * len(counts)).select("lang", "parts").toArrow()
    names = sorted(name for name, _ in counts)
    windows, labels = [], []
    for lang, texts in zip(rows.column("lang").to_pylist(), rows.column("parts").to_pylist(), strict=True):
        for part in texts:
            raw = np.frombuffer(part.encode()[:WINDOW], np.uint8)
            windows.append(np.pad(raw, (0, WINDOW - len(raw))))
            labels.append(names.index(lang))
    if not windows:
        return None
    return ByteNet(names).train(np.stack(windows), np.array(labels))


def identify(documents: DataFrame, net: ByteNet | None, keep: list[str]) -> DataFrame:
    """The columns in keep, lang_pred and lang_score."""
    spark = documents.sparkSession
    bound_batches(spark)
    keep = beside(keep, ["lang_pred", "lang_score"])
    given = documents.select(*dict.fromkeys([*keep, "text"]))
    schema = "".join(f"`{given.schema[c].name}` {given.schema[c].dataType.simpleString()}, " for c in keep)
    held = spark.sparkContext.broadcast(net)

    def run(batches):
        model = held.value
        for batch in batches:
            n = batch.num_rows
            texts = batch.column("text").to_pylist()
            lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if model is not None and n:
                windows, owner, length = cut(*text_bytes(batch.column("text")))
                total = np.zeros((n, len(model.languages)))
                np.add.at(total, owner, model.log_probabilities(windows).astype(np.float64) * length[:, None])
                total /= np.maximum(np.bincount(owner, length, n), 1)[:, None]
                p = np.exp(total - total.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                lang[lettered] = np.array(model.languages, object)[best[lettered]]
                score[lettered] = p[np.arange(n), best][lettered]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang.tolist(), pa.string()), pa.array(score)], names=[*keep, "lang_pred", "lang_score"])

    return given.mapInArrow(run, f"{schema}lang_pred string, lang_score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document's language, learned from the fold with crc32(doc_id) mod 5 other than 0."""
    documents = read_documents(spark, sf_dir)
    fold = crc_mod(F.col("doc_id"), 5)
    net = fit(documents.where(fold != 0))
    return identify(documents, net, ["doc_id"]).select("doc_id", (fold == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
